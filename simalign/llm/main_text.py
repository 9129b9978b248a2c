"""Main text of web pages by two passes of block rules.

The first pass cuts a page into blocks at block-level tags and labels each block by its
length, the share of its text in links and its density of stop words: running text is good,
link lists and text without function words are bad, and what is too short to tell stays
open. What markup says plainly (menus, footers, forms) is bad whatever it reads like, and so
is an element with a name of boilerplate, unless it wraps most of the good text. The second
pass gives an open block the label of the nearest decided blocks of the same container, so
headings and one-line paragraphs follow their neighbours. Good text outside of article and
main goes only if these hold most of the good text.

Few stop words alone do not drop a block from an article, nor from a page most of whose text has
few: lists of names, code and other languages are main text too. Such a block stays open and
follows its neighbours.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from simalign.llm import words

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH, LINKS_HIGH = 0.12, 0.25, 0.4

#: Frequent function words of the languages at hand; a text of another language passes a list of its own.
STOP_WORDS = frozenset(
    "the of and to a in is it that was for on are as with his they at be this from i have or by one had not but what all were"
    " when we there can an your which their said if do will each about how up out them then she many some so these would her"
    " der die und das von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird"
    " bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei den in"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec ou son aux d l s y a été"
    " el los las y por con para una del al se lo como más pero sus su o este sí porque esta entre cuando muy sin sobre también me"
    " hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso ante ellos e esto mí antes algunos qué".split()
)

_INVISIBLE = {"script", "style", "noscript", "template", "svg", "iframe", "object", "math", "head", "title", "canvas", "audio", "video"}
#: Of these, what holds markup of its own: without an end tag only the start tag is passed over.
_FOREIGN = {"svg", "math", "object", "canvas", "audio", "video", "template"}
_BAD_TAGS = {"nav", "footer", "aside", "form", "button", "select", "option", "textarea", "menu", "dialog", "label", "fieldset"}
_GOOD_TAGS = {"article", "main"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BLOCKS = {
    "p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr",
    "td", "th", "thead", "tbody", "tfoot", "caption", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "form", "fieldset",
    "figure", "figcaption", "address", "hr", "br", "body", "html", "details", "summary", "option", "select", "textarea", "button", "menu",
    "dialog", "legend", "center",
}
# Class and id names that mark what is not the article, and words that only shape them.
_BAD_NAMES = re.compile(
    r"ads?|advert(?:s|isement|ising)?|banner|breadcrumbs?|comments?|comment-?list|disqus|cookies?|consent|copyright|footer|"
    r"header|masthead|menu|nav(?:bar|igation)?|newsletter|notice|alert|pagination|pager|popup|modal|promo(?:tion)?|related|replies|reply|respond|"
    r"share|sharing|sidebar|side-?bar|social|sponsor(?:ed)?|subscribe|subscription|toolbar|widget|login|signup|search|skip|tags?|gdpr|privacy|"
    r"feedback|discussion|responses?|recommend(?:ed|ations?)?|trending|teaser|outbrain|taboola",
    re.I,
)
_SHAPES = frozenset("area bar block box buttons container form items links list section site top bottom main wrap wrapper".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Inside an article these name the part with its title.
_TITLE_NAMES = {"header", "masthead"}
_BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "toolbar"}

_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|<", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(?<=[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Piece:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    bad: bool = False
    named: tuple[int, ...] = ()  # numbers of the elements around it with a name of boilerplate
    inside: int = 0  # number of the innermost article or main, 0 for none
    heading: bool = False
    text: str = ""


def _bad_names(value: str) -> set[str]:
    """Names of boilerplate among the tokens of a class or id; a token counts as a whole."""
    found = set()
    for token in value.split():
        parts = [x for x in re.split(r"[-_]+", _CAMEL.sub("-", token).lower()) if x]
        bad = {x for x in parts if _BAD_NAMES.fullmatch(x)}
        if _BAD_NAMES.fullmatch(token) or bad and parts[0] != "tag" and all(x in bad or x in _SHAPES for x in parts):
            found |= bad or {token.lower()}
    return found


def _excluded(tag: str, raw: str, within_good: bool) -> tuple[bool, bool]:
    """Whether markup, and whether a name, says that an element is not main text."""
    if tag in _BAD_TAGS or tag == "header" and not within_good:
        return True, False
    named = False
    if "=" not in raw and "hidden" not in raw:
        return False, False
    for m in _ATTRIBUTE.finditer(raw):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            named |= bool(_bad_names(value) - (_TITLE_NAMES if within_good else set()))
        if name == "role" and value.lower() in _BAD_ROLES or name == "hidden":
            return True, False
        if name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True, False
    return False, named


def blocks(page: str) -> list[Piece]:
    """Blocks with text, in page order. Markup may be broken: open tags end with the page."""
    out, current = [], Piece()
    stack: list[tuple[str, bool, bool, bool]] = []  # open elements: tag, excluded, article or main, named
    bad = links = 0
    names: list[int] = []
    goods: list[int] = []
    made = at = 0
    skip = None  # an invisible element whose end is awaited
    endless: set[str] = set()  # foreign elements that do not end on the rest of the page

    def close():
        nonlocal current
        if current.parts:
            current.text = " ".join(html.unescape("".join(current.parts)).split())
            if current.text:
                out.append(current)
        current = Piece(bad=bad > 0, named=tuple(names), inside=goods[-1] if goods else 0, heading=bool(stack) and stack[-1][0] in ("h1", "h2", "h3", "h4", "h5", "h6"))

    def write(text: str):
        if text:
            if not current.parts:
                current.bad, current.named, current.inside = bad > 0, tuple(names), goods[-1] if goods else 0
            current.parts.append(text)
            if links:
                current.linked += len(text.strip())

    position = 0
    while True:
        m = _PIECE.search(page, position)
        if skip is not None:
            # raw text up to the end tag, as the element's content is not markup
            end = re.compile(rf"</{re.escape(skip)}\b[^>]*>", re.I).search(page, position)
            if end is None and skip in _FOREIGN:
                endless.add(skip)
            else:
                position = end.end() if end else len(page)
            skip = None
            continue
        if m is None:
            write(page[position:])
            break
        write(page[position : m.start()])
        raw, position = m.group(), m.end()
        t = _TAG.match(raw)
        if t is None:
            if raw == "<":
                write("<")
            elif raw.startswith("<![CDATA["):
                pass
            continue
        closing, tag = t.group(1) == "/", t.group(2).lower()
        if tag in _INVISIBLE and tag != "head":
            if not closing and not raw.endswith("/>") and tag not in endless:
                skip = tag
            continue
        if tag in _BLOCKS:
            close()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    for name, was_bad, was_good, was_named in stack[k:]:
                        bad -= was_bad
                        links -= name == "a"
                        if was_good:
                            goods.pop()
                        if was_named:
                            names.pop()
                    del stack[k:]
                    break
        elif tag not in _VOID and not raw.endswith("/>"):
            if tag in ("p", "li", "td", "tr", "dt", "dd", "option", "a"):  # their end tag may be left out
                for k in range(len(stack) - 1, -1, -1):
                    name = stack[k][0]
                    if name == tag:
                        for name, was_bad, was_good, was_named in stack[k:]:
                            bad -= was_bad
                            links -= name == "a"
                            if was_good:
                                goods.pop()
                            if was_named:
                                names.pop()
                        del stack[k:]
                        break
                    if name in _BLOCKS and name != "p":
                        break
            (is_bad, is_named), is_good = _excluded(tag, raw, bool(goods)), tag in _GOOD_TAGS
            stack.append((tag, is_bad, is_good, is_named))
            bad += is_bad
            links += tag == "a"
            if is_good or is_named:
                made += 1
                if is_good:
                    goods.append(made)
                if is_named:
                    names.append(made)
        if tag in _BLOCKS:
            close()
    close()
    return out


def label(block: Piece, stop_words=STOP_WORDS) -> bool | None:
    """Good, bad, or open."""
    text = block.text
    if block.bad:
        return False
    if block.linked > LINKS_HIGH * len(text):
        return False
    found = _WORD.findall(text.lower())
    density = sum(w in stop_words for w in found) / len(found) if found else 0.0
    if len(text) < SHORT or block.heading:
        return None
    if density >= STOP_HIGH or density >= STOP_LOW and len(text) >= LONG:
        return True
    # bad if so few stop words are no chance of a text at the lower density; fewer words cannot tell
    spread = 2 * (len(found) * STOP_LOW * (1 - STOP_LOW)) ** 0.5
    return False if (STOP_LOW - density) * len(found) > spread else None


def _wrappers(found: list[Piece], good: list[bool]) -> set[int]:
    """Named elements around most of the page's good text.

    They hold more than one good block, and no good text outside of them is in an article.
    """
    size = [len(b.text) if g else 0 for b, g in zip(found, good, strict=True)]
    total, out = sum(size), set()
    for name in {x for b, g in zip(found, good, strict=True) if g for x in b.named}:
        held = [n for b, n in zip(found, size, strict=True) if n and name in b.named]
        rival = any(n and b.inside and name not in b.named for b, n in zip(found, size, strict=True))
        if len(held) > 1 and 2 * sum(held) > total and not rival:
            out.add(name)
    return out


def main_text(page: str, stop_words=STOP_WORDS) -> str:
    """The good blocks of a page, joined by one space."""
    found = blocks(page)
    labels = [label(b, stop_words) for b in found]
    wrappers = _wrappers(found, [x is True for x in labels])
    for i, block in enumerate(found):
        if not set(block.named) <= wrappers:
            block.bad, labels[i] = True, False
    # only their stop words speak against these: lists, names, code, or another language
    strange = [x is False and not b.bad and b.linked <= LINKS_HIGH * len(b.text) for x, b in zip(labels, found, strict=True)]
    known = sum(len(b.text) for b, x in zip(found, labels, strict=True) if x)
    unknown = sum(len(b.text) for b, x in zip(found, strange, strict=True) if x)
    # markup tells what an article leaves out, and on a page mostly of an unknown language stop words tell nothing
    labels = [None if x and (b.inside or unknown > known) else y for b, x, y in zip(found, strange, labels, strict=True)]
    good_size = [0, 0]  # outside and inside of articles
    for block, good, odd in zip(found, labels, strange, strict=True):
        if good or good is None and odd and block.inside:
            good_size[block.inside > 0] += len(block.text)
    articles = any(b.inside and not b.bad for b in found) and good_size[1] >= good_size[0]
    n = len(found)
    before, after = [None] * n, [None] * n  # nearest decided block of the same container
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict[int, int] = {}
        for i in order:
            out[i] = last.get(found[i].inside)
            if labels[i] is not None and not (found[i].bad and found[i].inside):
                last[found[i].inside] = i
    kept = []
    for i, block in enumerate(found):
        good = labels[i]
        if good is None:
            near = [(abs(i - j), not labels[j]) for j in (before[i], after[i]) if j is not None]
            # of equally near neighbours a good one counts
            good = not min(near)[1] if near else bool(block.inside) or not articles
        if good and (block.inside or not articles):
            kept.append(block.text)
    return " ".join(kept)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, out_col: str = "text") -> DataFrame:
    """The columns `keep` (all by default) of every page and its main text.

    A NULL or empty page, and one without main text, has an empty text. Rows that repeat are
    read alike, an empty table gives no row; an earlier column of the name `out_col` gives
    way. Pages do not move between tasks and whole pages are read. An unclosed script, style,
    title, iframe or noscript goes on to the end of the page, as in a browser; of an unclosed
    svg, math, object, canvas, audio, video or template only the start tag is passed over.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c != out_col]
    read = list(dict.fromkeys([*kept, html_col]))
    schema = StructType([*(pages.schema[c] for c in kept), StructField(out_col, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.pieces(batches):
            texts = [main_text(x.as_py() or "") for x in batch.column(html_col)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, out_col]
            )

    return pages.select(*[F.col(c) for c in read]).mapInArrow(run, schema)
