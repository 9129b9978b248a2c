"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The field reads what they leave: a
text is cut into tokens, and every run of at most `MAX_TOKENS` words and numbers, with what
stands between them, may be an entity of one kind, scored by features of the whole span
(digits, groups, check digits, words for "at" and "dot", what stands before it and whether
it goes on). A Viterbi pass over spans chooses boundaries and
kinds together. Only stretches around digits, "@" and "at" can hold an entity; elsewhere
"no entity" is certain, so the pass runs on those stretches alone.

The field is fitted by gradient ascent on the conditional likelihood, on contexts from a
bounded sample of the corpus into which entities in spellings that the patterns miss, and
numbers that are none, are written.
"""

from __future__ import annotations

import random
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simalign.llm import files, words

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
#: No kind of number has more digits. More numbers in a row than CHAIN are a table, which the features of a span tell.
MAX_DIGITS, CHAIN = 19, 8
#: Texts of the corpus that lend contexts to the training set, and the longest of them in bytes.
SAMPLE_TEXTS, SAMPLE_BYTES, EXAMPLES, EPOCHS = 400, 20_000, 600, 100
#: An entity is kept if it beats "no entity" by this log-odds margin.
MARGIN = 0.5

# ---- base spans --------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match begins with a whole run of digits, so it need not be tried from within one
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' matches, sorted.

    Leftmost and non-overlapping for each kind; a match that fails its test is dropped.
    """
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(x) <= 255 for x in m.group().split(".") if len(x) <= 1000) and max(map(len, m.group().split("."))) <= 1000:
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# ---- stretches and tokens ------------------------------------------------------------------

SPACE, DIGITS, LETTERS, OTHER = b"sdap"
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|[^\w\s]|_")
# Words that stand for "@" and "." in spelt-out addresses, and words before a number.
AT_WORDS = frozenset(["at", "arroba", "chez", "bei"])
DOT_WORDS = frozenset(["dot", "punkt", "punto", "point"])
CUES = {
    "email": frozenset(["mail", "email", "write", "contact"]), "ip": frozenset(["ip", "host", "server", "address"]),
    "card": frozenset(["card", "visa", "mastercard", "karte", "carte", "tarjeta"]),
    "phone": frozenset(["tel", "phone", "call", "fax", "mobile", "telefon", "telephone"]),
}
#: An "at" with a host behind it: a label, then a dot or a word for one. A label has at most 63 characters.
_SPELT = r"(?<![^\W\d_])(?:at|arroba|chez|bei)(?=[\s\])}>]{1,8}[^\s.\[({<]{1,63}(?:\.\w|[\s\[({<]{1,8}(?:dot|punkt|punto|point)\b|\s?[\[(]\.))"
_TRIGGER = re.compile(_SPELT + r"|[0-9]{2,}|@|[0-9]\W{1,3}[0-9]|[0-9][\s\[({<]+(?:dot|punkt|punto|point)\b", re.I)
_spelt = re.compile(_SPELT, re.I).search
REACH = 60


def stretches(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of a text that may hold an entity, none of which meets a taken span."""
    low = high = None
    edges = [(a, b) for a, _, b in taken]
    covered = before = 0
    for m in _TRIGGER.finditer(text):
        while covered < len(edges) and edges[covered][1] <= m.start():
            before = max(before, edges[covered][1])
            covered += 1
        if any(a < m.end() and m.start() < b for a, b in edges[covered : covered + 4]):
            continue
        start, stop = max(0, before, m.start() - REACH), min(len(text), m.end() + REACH)
        for at in range(covered, len(edges)):
            if edges[at][0] >= m.end():
                stop = min(stop, edges[at][0])
                break
        if high is not None and start <= high:
            high = max(high, stop)
            continue
        if high is not None:
            yield low, high
        low, high = start, stop
    if high is not None:
        yield low, high


@dataclass
class Tokens:
    text: str
    starts: array
    ends: array
    kinds: bytearray  # d digits, a letters, s space, p other

    def __len__(self) -> int:
        return len(self.starts)


def tokens(text: str, low: int, high: int) -> Tokens:
    out = Tokens(text, array("q"), array("q"), bytearray())
    # a stretch begins and ends between tokens, so that no number or word is cut
    while low > 0 and low < len(text) and text[low].isalnum() and text[low - 1].isalnum() and low > 0:
        low += 1
        if low >= high:
            return out
    while high < len(text) and high > low and text[high - 1].isalnum() and text[high].isalnum():
        high -= 1
    for m in _TOKEN.finditer(text, low, high):
        c = m.group()[0]
        out.starts.append(m.start())
        out.ends.append(m.end())
        out.kinds.append(SPACE if c.isspace() else DIGITS if c in "0123456789" else LETTERS if c.isalnum() else OTHER)
    return out


# ---- features of a span --------------------------------------------------------------------

FEATURES = (
    "bias", "at_sign", "at_word", "dots2", "dots3", "dot_word", "tld", "local_space", "host_space", "no_letters", "letters_mixed",
    "digits<7", "digits7-9", "digits10-11", "digits12-15", "digits14-19", "digits>19", "groups1", "groups2", "groups3",
    "groups4", "groups>4", "octets", "luhn", "four_by_four", "plus_or_paren", "zero_first", "same_separator", "slash_or_colon",
    "comma", "date_like", "cue", "touches_word", "long_space", "goes_on", "in_table", "apart_in_table", "table_edge",
)
#: What tells that a span lies in a table, or begins or ends its row.
TABLE = ("in_table", "apart_in_table", "table_edge")
_INDEX = {name: i for i, name in enumerate(FEATURES)}
_AT = re.compile(r"@|(?<=[\s\[({<])(?:at|arroba|chez|bei)(?=[\s\])}>])", re.I)
_DOT = re.compile(r"[\s\[({<]*(?:\.|(?<=[\s\[({<])(?:dot|punkt|punto|point)(?=[\s\])}>]))[\s\])}>]*", re.I)
#: Behind a span: another label of a domain or another octet.
_GOES_ON = re.compile(r"[\s\[({<]+(?:dot|punkt|punto|point)[\s\])}>]+\w|\.\w| \. \w|[\[(]\.[\])]\w", re.I)
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/. ]\d{1,2}[-/. ]\d{1,2}|\d{1,2}[-/. ]\d{1,2}[-/. ](?:19|20)?\d\d)\Z")


def span_features(t: Tokens, i: int, j: int, cues: set[str]) -> tuple[list[int], list[int]] | None:
    """(features of the span of tokens i .. j, those of each kind's cue), or None if it cannot be an entity."""
    first, last = t.kinds[i], t.kinds[j]
    if last in (SPACE, OTHER) or first == SPACE or (first == OTHER and t.text[t.starts[i]] not in "+("):
        return None
    text = t.text[t.starts[i] : t.ends[j]]
    runs = [t.text[t.starts[x] : t.ends[x]] for x in range(i, j + 1) if t.kinds[x] == DIGITS]
    letters = [t.text[t.starts[x] : t.ends[x]].lower() for x in range(i, j + 1) if t.kinds[x] == LETTERS]
    digits = sum(map(len, runs))
    if not letters and (digits > MAX_DIGITS or "\n" in text):
        return None
    sign, at_word = "@" in text, any(x in AT_WORDS for x in letters[1:-1])
    octets = len(runs) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in runs)
    spelt_ip = octets and bool(letters) and len(letters) <= 3 and all(x in DOT_WORDS for x in letters)
    if not (sign or at_word or spelt_ip) and (digits < 7 and len(runs) < 4 or letters):
        return None
    if not (sign or at_word) and not 4 <= digits <= MAX_DIGITS:
        return None
    dots, dot_words = text.count("."), sum(x in DOT_WORDS for x in letters)
    if (sign or at_word) and not (dots or dot_words):
        return None
    out = ["bias"]
    add = out.append
    if sign or at_word:
        add("at_sign" if sign else "at_word")
        if dot_words:
            add("dot_word")
        if last == LETTERS and 2 <= len(letters[-1]) <= 6 and letters[-1] not in AT_WORDS | DOT_WORDS:
            add("tld")
        local, host = _AT.split(text, 1) if _AT.search(text) else (text, "")
        if " " in local.strip(" ([{<"):
            add("local_space")
        if " " in _DOT.sub(".", host.strip(" )]}>")):
            add("host_space")
        if first == LETTERS and letters[0] not in AT_WORDS | DOT_WORDS:
            add("letters_mixed")
    else:
        add("dot_word" if spelt_ip else "no_letters")
        add(
            "digits<7" if digits < 7 else "digits7-9" if digits < 10 else "digits10-11" if digits < 12
            else "digits12-15" if digits < 14 else "digits14-19" if digits < 20 else "digits>19"
        )
        add(f"groups{len(runs)}" if len(runs) <= 4 else "groups>4")
        if octets:
            add("octets")
        if 14 <= digits <= 19 and luhn("".join(runs)):
            add("luhn")
        if len(runs) == 4 and all(len(x) == 4 for x in runs):
            add("four_by_four")
        between = {re.sub(r"[0-9]", "", t.text[t.ends[x] : t.starts[y]]) for x, y in _gaps(t, i, j)}
        if len(between) == 1:
            add("same_separator")
        if text[0] in "+(":
            add("plus_or_paren")
        if runs[0].startswith("0"):
            add("zero_first")
        if "/" in text or ":" in text:
            add("slash_or_colon")
        if "," in text or ";" in text:
            add("comma")
        if dots + dot_words == 3:
            add("dots3")
        elif dots + dot_words:
            add("dots2")
        if _DATE.match(text):
            add("date_like")
    if "  " in text or "\n" in text:
        add("long_space")
    before, after = t.text[t.starts[i] - 1 : t.starts[i]], t.text[t.ends[j] : t.ends[j] + 1]
    if before.isalnum() or after.isalnum() or before in ("-", "_", "/", "=") and before or after in ("-", "_", "/", "=") and after:
        add("touches_word")
    if _GOES_ON.match(t.text, t.ends[j]) or before == "." and t.text[max(0, t.starts[i] - 2) : t.starts[i] - 1].isalnum():
        add("goes_on")
    cued = [k for k, kind in enumerate(KINDS) if CUES[kind] & cues]
    return [_INDEX[x] for x in out], cued


def _gaps(t: Tokens, i: int, j: int) -> Iterator[tuple[int, int]]:
    last = None
    for x in range(i, j + 1):
        if t.kinds[x] == DIGITS:
            if last is not None:
                yield last, x
            last = x


@dataclass
class Lattice:
    """Possible spans of a stretch: first and last place, feature row.

    Places are numbered over the ends of spans alone. Tokens between them belong to no entity
    and score 0, so leaving them out changes neither the best segmentation nor any sum.
    """

    n: int
    first: np.ndarray
    last: np.ndarray
    features: np.ndarray  # spans x (features + one cue per kind)
    spans: list[tuple[int, int]]


WIDTH = len(FEATURES) + len(KINDS)


def _rows_of_numbers(t: Tokens) -> tuple[array, array]:
    """For every token the first and last token of the row of more than CHAIN numbers it lies in, else -1."""
    low, high = array("q", [-1]) * len(t), array("q", [-1]) * len(t)
    first = last = -1
    count = 0
    for x in range(len(t) + 1):
        number = x < len(t) and t.kinds[x] == DIGITS
        gap = t.starts[x] - t.ends[last] if number and last >= 0 else 0
        if number and (last < 0 or gap <= 3 and "\n" not in t.text[t.ends[last] : t.starts[x]] and LETTERS not in t.kinds[last:x]):
            first, last, count = (x if last < 0 else first), x, count + 1
        elif number or x == len(t):
            if count > CHAIN:
                for y in range(first, last + 1):
                    low[y], high[y] = first, last
            first, last, count = x, x, 1
    return low, high


def _apart(t: Tokens, i: int, j: int, low: int, high: int) -> bool:
    """Whether what stands between the numbers of a span stands neither before nor behind it, within its row low .. high."""
    before, after, outer = i - 1, j + 1, []
    while before >= low and t.kinds[before] != DIGITS:
        before -= 1
    while after <= high and t.kinds[after] != DIGITS:
        after += 1
    if before >= low:
        outer.append(t.text[t.ends[before] : t.starts[i]])
    if after <= high:
        outer.append(t.text[t.ends[j] : t.starts[after]])
    inner = [t.text[t.ends[x] : t.starts[y]] for x, y in _gaps(t, i, j)]
    return bool(inner) and not any(x in outer for x in inner)


def candidates(t: Tokens) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """(first token, last token, features, kinds whose cue is near) of all possible spans, by first token."""
    lowered = [t.text[a:b].lower() if k == LETTERS else "" for a, b, k in zip(t.starts, t.ends, t.kinds, strict=True)]
    places = array("q", [x for x, k in enumerate(t.kinds) if k in (DIGITS, LETTERS)])
    lives = array("q", [x for x, k in enumerate(t.kinds) if k == DIGITS or lowered[x] in AT_WORDS or t.text[t.starts[x]] == "@"])
    low, high = _rows_of_numbers(t)
    letters, numbers, signs, digits = array("q", [0]), array("q", [0]), array("q", [0]), array("q", [0])
    for x, k in enumerate(t.kinds):
        letters.append(letters[-1] + (k == LETTERS))
        numbers.append(numbers[-1] + (k == DIGITS))
        signs.append(signs[-1] + (k == OTHER and t.text[t.starts[x]] == "@"))
        digits.append(digits[-1] + (t.ends[x] - t.starts[x] if k == DIGITS else 0))
    next_letters = array("q", [len(t)]) * (len(t) + 1)
    for x in range(len(t) - 1, -1, -1):
        next_letters[x] = x if t.kinds[x] == LETTERS else next_letters[x + 1]
    p = q = 0
    for i in range(len(t)):
        while p < len(places) and places[p] < i:
            p += 1
        while q < len(lives) and lives[q] < i:
            q += 1
        if t.kinds[i] == SPACE or t.kinds[i] == OTHER and t.text[t.starts[i]] not in "+(":
            continue
        stop = places[p + MAX_TOKENS] if p + MAX_TOKENS < len(places) else len(t)
        if q == len(lives) or lives[q] >= stop:
            continue
        number = places[p] if p < len(places) else i
        ends = places[p : p + MAX_TOKENS]
        if t.kinds[i] != LETTERS:  # without letters an entity ends in its line
            line = t.text.find("\n", t.starts[i], t.ends[ends[-1]] if ends else t.starts[i])
            if line >= 0:
                ends = [x for x in ends if t.ends[x] <= line or LETTERS in t.kinds[i:x + 1]]
        if not ends:
            continue
        cues = {x for x in lowered[max(0, i - 5) : i] if x}
        for j in ends:
            plain = letters[j + 1] == letters[i]
            if plain:  # what `span_features` refuses, told by counts: no span is lost
                n, runs = digits[j + 1] - digits[i], numbers[j + 1] - numbers[i]
                if n > MAX_DIGITS:
                    if next_letters[i] > ends[-1]:
                        break
                    continue
                if n < 7 and runs < 4 and signs[j + 1] == signs[i]:
                    continue
            got = span_features(t, i, j, cues)
            if got is None:
                continue
            if plain and high[number] >= 0:
                edge = low[number] == number or j >= high[number]
                got[0].append(_INDEX["apart_in_table" if _apart(t, i, j, low[number], high[number]) else "table_edge" if edge else "in_table"])
            yield i, j, *got


def lattice(t: Tokens) -> Lattice:
    first, last, rows, spans = [], [], [], []
    for i, j, features, cued in candidates(t):
        row = np.zeros(WIDTH)
        row[features] = 1
        for k in cued:
            row[len(FEATURES) + k] = 1
        first.append(i)
        last.append(j)
        rows.append(row)
        spans.append((t.starts[i], t.ends[j]))
    features = np.array(rows) if rows else np.zeros((0, WIDTH))
    low, high = np.array(first, np.int64), np.array(last, np.int64) + 1
    edges = np.unique(np.concatenate((low, high)))
    return Lattice(max(0, len(edges) - 1), np.searchsorted(edges, low), np.searchsorted(edges, high) - 1, features, spans)


def _logsumexp(x: np.ndarray) -> float:
    top = x.max()
    return float(top + np.log(np.exp(x - top).sum()))


def log_partition(lat: Lattice, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Log of the sum over all segmentations, and the probability of every (span, kind).

    A token outside entities scores 0, so its segment adds nothing.
    """
    by_last: dict[int, list[int]] = {}
    by_first: dict[int, list[int]] = {}
    for s in range(len(lat.first)):
        by_last.setdefault(int(lat.last[s]), []).append(s)
        by_first.setdefault(int(lat.first[s]), []).append(s)
    total = np.array([_logsumexp(x) for x in scores]) if len(scores) else np.zeros(0)
    alpha, beta = np.zeros(lat.n + 1), np.zeros(lat.n + 1)
    for e in range(1, lat.n + 1):
        terms = [alpha[e - 1], *(alpha[lat.first[s]] + total[s] for s in by_last.get(e - 1, ()))]
        alpha[e] = _logsumexp(np.array(terms))
    for b in range(lat.n - 1, -1, -1):
        terms = [beta[b + 1], *(beta[lat.last[s] + 1] + total[s] for s in by_first.get(b, ()))]
        beta[b] = _logsumexp(np.array(terms))
    z = alpha[lat.n]
    share = np.exp(alpha[lat.first][:, None] + scores + beta[lat.last + 1][:, None] - z) if len(scores) else scores
    return float(z), share


def fit(examples: list[tuple[Lattice, dict[tuple[int, int], int]]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (features x kinds) by AdaGrad on the conditional log-likelihood, with an L2 term.

    Examples without a table give all other weights, then those with one the weights of what tells a
    table: tables change nothing elsewhere.
    """
    of_table = np.array([name in TABLE for name in FEATURES] + [False] * len(KINDS))
    weights, sides = np.zeros((WIDTH, len(KINDS))), ([], [])
    for lat, gold in examples:
        if len(lat.first):
            sides[int(lat.features[:, of_table].any())].append((lat, gold))
    for side, free in zip(sides, (~of_table, of_table), strict=True):
        squares = np.full((WIDTH, len(KINDS)), 1e-6)
        for _ in range(epochs):
            gradient = -0.005 * weights * len(side) / 100
            for lat, gold in side:
                wanted = np.zeros((len(lat.first), len(KINDS)))
                for s, span in enumerate(lat.spans):
                    if span in gold:
                        wanted[s, gold[span]] = 1
                _, share = log_partition(lat, lat.features @ weights)
                gradient += lat.features.T @ (wanted - share)
            gradient[~free] = 0
            squares += gradient**2
            weights += 0.5 * gradient / np.sqrt(squares)
    return weights


def decode(lat: Lattice, weights: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int, int]]:
    """Best segmentation: (start, kind, end) of its entities that beat "none" by the margin."""
    if not len(lat.first):
        return []
    scores = lat.features @ weights
    kind, value = scores.argmax(axis=1), scores.max(axis=1) - margin
    by_last: dict[int, list[int]] = {}
    for s in range(len(lat.first)):
        by_last.setdefault(int(lat.last[s]), []).append(s)
    best, back = np.zeros(lat.n + 1), [None] * (lat.n + 1)
    for e in range(1, lat.n + 1):
        best[e] = best[e - 1]
        for s in by_last.get(e - 1, ()):
            if best[lat.first[s]] + value[s] > best[e]:
                best[e], back[e] = best[lat.first[s]] + value[s], s
    out, e = [], lat.n
    while e:
        s = back[e]
        if s is None:
            e -= 1
        else:
            out.append((lat.spans[s][0], int(kind[s]), lat.spans[s][1]))
            e = int(lat.first[s])
    return out[::-1]


def decode_tokens(t: Tokens, weights: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int, int]]:
    """As `decode` of the lattice of a stretch, span by span: of a span only its score is kept,
    and of a token one number and where the best entity that ends there begins."""
    best, gain, back = array("d", [0.0]), array("d", [-np.inf]) * (len(t) + 1), array("q", [-1]) * (len(t) + 1)

    def settle(upto: int) -> None:
        for e in range(len(best), upto + 1):
            if gain[e] > best[-1]:
                best.append(gain[e])
            else:
                best.append(best[-1])
                back[e] = -1

    for i, j, features, cued in candidates(t):
        settle(i)
        scores = weights[[*features, *(len(FEATURES) + k for k in cued)]].sum(axis=0)
        kind = int(scores.argmax())
        value = best[i] + scores[kind] - margin
        if value > gain[j + 1]:
            gain[j + 1], back[j + 1] = value, i * len(KINDS) + kind
    settle(len(t))
    out, e = [], len(t)
    while e:
        if back[e] < 0:
            e -= 1
        else:
            i, kind = divmod(back[e], len(KINDS))
            out.append((t.starts[i], kind, t.ends[e - 1]))
            e = i
    return out[::-1]


# ---- training set --------------------------------------------------------------------------


def _with_luhn(rng: random.Random) -> str:
    stem = rng.choice("456") + "".join(rng.choice("0123456789") for _ in range(14))
    return next(stem + c for c in "0123456789" if luhn(stem + c))


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _entity(rng: random.Random, pool: list[str]) -> tuple[str, int | None]:
    """An entity in a spelling the patterns miss, or a number that is none."""
    word = lambda: rng.choice(pool).lower()
    tld = rng.choice(["com", "org", "net", "de", "fr", "es", "info"])
    octets = [str(rng.randrange(256)) for _ in range(4)]
    card, phone = _with_luhn(rng), (_digits(rng, 3), _digits(rng, 3), _digits(rng, 4))
    made = rng.choice("email email ip card phone none none none".split())
    if made == "email":
        at = rng.choice([" at ", " (at) ", "[at]", " [at] ", " [ at ] ", " @ ", "(at)"])
        dot = rng.choice([" dot ", "[dot]", ".", " (dot) ", " [dot] ", " [ dot ] "]) if "@" not in at else rng.choice([" . ", "."])
        return f"{word()}{rng.choice(['', '.' + word(), _digits(rng, 2)])}{at}{dot.join([*(word() for _ in range(rng.choice([1, 1, 2, 3]))), tld])}", 0
    if made == "ip":
        return rng.choice(["[.]", " . ", "(.)", "[dot]", " dot ", " (dot) "]).join(octets), 1
    if made == "card":
        return rng.choice([".", "  ", "/", " - "]).join(card[k : k + 4] for k in (0, 4, 8, 12)), 2
    if made == "phone":
        a, b, c = phone
        return rng.choice([f"({a}) {b}-{c}", f"+{rng.randrange(1, 99)} ({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{_digits(rng, 2)} {a} {b} {c}", f"{a}.{b}.{c}", f"0{a} {b} {c}", f"+{_digits(rng, 2)} (0) {b[:2]} {a} {' '.join(_digits(rng, 2) for _ in range(rng.randrange(1, 4)))}"]), 3
    y, m, d = rng.randrange(1900, 2030), rng.randrange(1, 13), rng.randrange(1, 29)
    return rng.choice([
        f"{y}-{m:02}-{d:02}", f"{d}/{m}/{y}", f"{m}:{d:02}:{_digits(rng, 2)}", f"{rng.randrange(9)}.{rng.randrange(9)}",
        f"{rng.randrange(9)}.{rng.randrange(9)}.{rng.randrange(30)}", f"{y}-{y + 5}", _digits(rng, rng.randrange(5, 13)), _digits(rng, 20),
        f"{_digits(rng, 1)},{_digits(rng, 3)},{_digits(rng, 3)}", f"{rng.randrange(99)} of {rng.randrange(999)}", f"{m} at {d}",
        f"978-3-{_digits(rng, 2)}-{_digits(rng, 6)}-{_digits(rng, 1)}", f"{y}{m:02}{d:02}{_digits(rng, 6)}",
        "".join(rng.choice("0123456789abcdef") for _ in range(32)), f"{_digits(rng, 2)} {_digits(rng, 3)} {_digits(rng, 2)} {_digits(rng, 1)}",
        f"{word()} at {word()} dot {word()}ing",
    ]), None


def _table_example(rng: random.Random, near: list[str]) -> tuple[Lattice, dict]:
    """A row of more than CHAIN numbers, none of them an entity but for a phone that may stand among them."""
    width, separator = rng.randrange(1, 6), rng.choice([" ", "  ", ", ", "; ", "-", "/", " - "])
    even = rng.random() < 0.5
    cells = [_digits(rng, width if even else rng.randrange(1, width + 1)) for _ in range(rng.randrange(CHAIN + 1, 2 * CHAIN + 1))]
    left, gold = " ".join(near[:2]) + " ", {}
    if separator in (", ", "; ") and rng.random() < 0.5:
        at = rng.randrange(len(cells))
        cells[at] = rng.choice(["({}) {}-{}", "{}-{}-{}"]).format(_digits(rng, 3), _digits(rng, 3), _digits(rng, 4))
        low = len(left) + len(separator.join([*cells[:at], ""]))
        gold = {(low, low + len(cells[at])): KINDS.index("phone")}
    text = left + separator.join(cells) + " " + " ".join(near[2:4])
    return lattice(tokens(text, 0, len(text))), gold


def training_set(texts: list[str], examples: int = EXAMPLES, seed: int = 11) -> list[tuple[Lattice, dict]]:
    """Contexts of the given texts with written-in entities, and their stretches as they are."""
    rng = random.Random(seed)
    lines = [w for t in texts for w in [re.findall(r"[^\W\d_]+[.,]?", t)] if len(w) >= 12] or [["lorem", "ipsum"] * 8]
    pool = sorted({x.strip(".,") for w in lines for x in w if 3 <= len(x.strip(".,")) <= 10}) or ["lorem", "ipsum"]
    out = []
    for _ in range(examples):
        w = rng.choice(lines)
        at = rng.randrange(len(w) - 8)
        left, right = " ".join(w[at : at + 4]), " ".join(w[at + 4 : at + 8])
        made, kind = _entity(rng, pool)
        if kind is not None and rng.random() < 0.3:
            left += " " + rng.choice(sorted(CUES[KINDS[kind]])) + rng.choice([":", ""])
        text = f"{left} {made} {right}"
        gold = {} if kind is None else {(len(left) + 1, len(left) + 1 + len(made)): kind}
        out.append((lattice(tokens(text, 0, len(text))), gold))
    for _ in range(examples // 8):
        out.append(_table_example(rng, rng.choice(lines)))
    real = 0
    for t in texts:
        for low, high in stretches(t, base_spans(t)):
            if real < examples // 3:
                out.append((lattice(tokens(t, low, high)), {}))
                real += 1
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights of the field, fitted on the driver.

    Contexts come from at most `SAMPLE_TEXTS` texts of at most `SAMPLE_BYTES` bytes, the
    first in the order of a hash, so reruns agree; nothing else reaches the driver.
    """
    order = F.xxhash64(F.lit(3), F.col(id_col).cast("string"), F.col(text_col))
    usable = docs.select(order.alias("o"), F.col(text_col).alias("t")).filter(F.octet_length("t").between(100, SAMPLE_BYTES))
    rows = files.hash_share(usable, F.col("o"), SAMPLE_TEXTS).orderBy("o").limit(SAMPLE_TEXTS).collect()
    return fit(training_set([r["t"] for r in sorted(rows, key=lambda r: (r["o"], r["t"]))]))


# ---- Spark ---------------------------------------------------------------------------------

FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, n_added long"
)


def find_all(text: str, weights: np.ndarray) -> tuple[list, list]:
    """(base spans, spans the field adds) of a whole text."""
    base = base_spans(text)
    added = []
    for low, high in stretches(text, base):
        added += decode_tokens(tokens(text, low, high), weights)
    return base, added


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, counts of base spans by kind, base spans, all spans, number added) of every row.

    Spans are kind:start:end in code points, end exclusive, sorted by start and kind. A NULL
    or empty text has none; rows that repeat are searched alike; NULL ids pass; an empty
    table gives no row. Very long texts are read span by span: what is kept of a token does not
    depend on how many spans it lies in. Other columns are ignored. No row moves between tasks; texts without
    a digit, "@" or "+" and without a spelt-out "at" are passed over after one look.
    """
    if weights is None:
        weights = train(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # features x kinds
    live = np.zeros(256, bool)
    live[[*range(0x30, 0x3A), 0x40, 0x2B]] = True

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            texts = batch.column(1)
            raw, offsets = words.text_buffer(texts)
            counts = [[], [], [], []]
            base_out, all_out, added_out = [], [], []
            for i, text in enumerate(texts):
                part = raw[offsets[i] : offsets[i + 1]]
                base, added = [], []
                if live[part].any() or (value := text.as_py()) and _spelt(value):
                    base, added = find_all(text.as_py() or "", shared.value)
                for k in range(4):
                    counts[k].append(sum(s[1] == k for s in base))
                base_out.append(joined(base))
                all_out.append(joined(sorted(base + added)) if added else base_out[-1])
                added_out.append(len(added))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(base_out, pa.string()),
                pa.array(all_out, pa.string()), pa.array(added_out, pa.int64()),
            ], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans", "n_added"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(search, FOUND)


