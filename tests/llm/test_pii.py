"""Base spans against the patterns, the field against enumeration and held-out examples."""

import math
import random
import re

import numpy as np

from simalign.llm import pii

TEXT = (
    "Write to ann.b@mail9.example.com, or x@y.z. Bad: a@b, @c.d, e@f.. Twice a@b.c@d.ef! IPs 196.3.67.149 and 300.1.1.1 and 1.2.3.4.5.6.7.8, "
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112, 4012888888881881; phones +1 (528) 555-3435, +12, +44 20 7946 0958. +1 (826) 555-4081 190.137.223.20"
)


def plain(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    assert pii.base_spans(TEXT) == plain(TEXT)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789+-. ()@ab%") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain(text), text


def test_partition_sums_all_segmentations():
    rng = np.random.default_rng(2)
    n = 6
    spans = [(i, j) for i in range(n) for j in range(i, min(n, i + 3)) if rng.random() < 0.6]
    lat = pii.Lattice(n, np.array([a for a, _ in spans]), np.array([b for _, b in spans]), np.zeros((len(spans), pii.WIDTH)), spans)
    scores = rng.normal(size=(len(spans), len(pii.KINDS)))

    def walk(at):  # (sum, mass of each span and kind) of all segmentations from a token on
        if at == n:
            return [(0.0, [])]
        out = [*walk(at + 1)]
        for s, (a, b) in enumerate(spans):
            if a == at:
                out += [(v + scores[s, k], [(s, k), *used]) for k in range(len(pii.KINDS)) for v, used in walk(b + 1)]
        return out

    every = walk(0)
    z, share = pii.log_partition(lat, scores)
    total = sum(math.exp(v) for v, _ in every)
    assert abs(z - math.log(total)) < 1e-9
    want = np.zeros_like(scores)
    for v, used in every:
        for s, k in used:
            want[s, k] += math.exp(v) / total
    assert np.abs(share - want).max() < 1e-9
    # the best segmentation too
    lat.features[:, :] = 0
    lat.features[np.arange(len(spans)), np.arange(len(spans))] = 1
    weights = np.zeros((pii.WIDTH, len(pii.KINDS)))
    weights[: len(spans)] = scores
    best = max(every, key=lambda x: x[0])
    got = pii.decode(lat, weights, margin=0.0)
    assert got == sorted((spans[s][0], k, spans[s][1]) for s, k in best[1])


def _sample():
    rng = random.Random(1)
    return [" ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(200)) for _ in range(20)]


def test_held_out_entities_are_found(spark):
    docs = spark.createDataFrame(list(enumerate(_sample())), "doc_id long, text string")
    weights = pii.train(docs)
    hit = miss = wrong = 0
    for lat, gold in pii.training_set(_sample(), 400, seed=77):
        got = {(a, b): k for a, k, b in pii.decode(lat, weights)}
        hit += sum(got.get(s) == k for s, k in gold.items())
        miss += sum(got.get(s) != k for s, k in gold.items())
        wrong += sum(gold.get(s) != k for s, k in got.items())
    assert hit > 0.85 * (hit + miss) and wrong < 0.06 * (hit + wrong)
    rows = [(0, "tell anna at posteo dot de about it", "x"), (1, None, "x"), (2, "", "x"), (None, TEXT, "x"), (None, TEXT, "x"), (3, "plain words " * 20_000, "x"),
            (4, "on 2024-01-15 we met at noon, 3.5 of 40", "x")]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string, spans string"), weights=weights).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and by[0]["spans"] == "email:5:26" and by[0]["n_added"] == 1 and by[0]["base_spans"] == ""
    assert by[1]["spans"] == by[2]["spans"] == by[3]["spans"] == by[4]["spans"] == ""
    for r in found:
        assert set(filter(None, r["base_spans"].split(","))) <= set(r["spans"].split(","))
    assert by[None]["n_email"] == sum(k == 0 for _, k, _ in plain(TEXT)) and "phone" in by[None]["spans"]
    assert pii.find(docs.limit(0), weights=weights).count() == 0


LONG_SPELLINGS = [
    ("email", "john (at) mail (dot) example (dot) com"), ("email", "jane.doe [at] corp [dot] co [dot] uk"), ("email", "first.last [ at ] example [ dot ] com"),
    ("ip", "192[dot]168[dot]1[dot]1"), ("ip", "8 dot 8 dot 4 dot 4"), ("phone", "0049 (0) 30 123 45 67 89 01"),
]


def test_long_spellings_are_candidates_and_found():
    weights = pii.fit(pii.training_set(_sample()))
    for kind, made in LONG_SPELLINGS:
        text = f"reach them under {made}, please"
        low = text.index(made)
        cut = next(pii.stretches(text, []))
        assert (low, low + len(made)) in pii.lattice(pii.tokens(text, *cut)).spans, made
        if kind != "phone":
            assert pii.find_all(text, weights) == ([], [(low, pii.KINDS.index(kind), low + len(made))]), made


def test_spelt_addresses_with_a_plain_dot():
    weights = pii.fit(pii.training_set(_sample()))
    for text, made in [
        ("please write to jane (at) mail.com about the garden", "jane (at) mail.com"), ("write to jane at mail.com today", "jane at mail.com"),
        ("contact jane.doe[at]mail.com soon", "jane.doe[at]mail.com"),
    ]:
        low = text.index(made)
        assert pii.find_all(text, weights) == ([], [(low, 0, low + len(made))])
    for text in ("we met at noon. Next day", "look at him.", "at home, at last. Then"):
        assert pii.find_all(text, weights) == ([], [])


def test_recall_and_false_alarms_of_the_whole_search():
    weights = pii.fit(pii.training_set(_sample()))
    rng = random.Random(123)
    pool = [a + b for a in ("gar", "mai", "hos", "lin", "tor") for b in ("den", "ler", "tan", "vik", "mon")]
    met, alarms, plain_texts = {}, 0, 0
    for _ in range(900):
        made, kind = pii._entity(rng, pool)
        left = " ".join(rng.choice(pool) for _ in range(5))
        base, added = pii.find_all(f"{left} {made} {rng.choice(pool)}", weights)
        if kind is None:
            alarms, plain_texts = alarms + bool(added), plain_texts + 1
        else:
            met.setdefault(kind, []).append((len(left) + 1, kind, len(left) + 1 + len(made)) in base + added)
    assert all(sum(v) >= 0.9 * len(v) for v in met.values()) and len(met) == 4
    assert alarms <= 0.03 * plain_texts


def test_span_by_span_is_the_lattice():
    weights = pii.fit(pii.training_set(_sample(), 200), 30)
    rng = random.Random(8)
    for _ in range(200):
        text = f"see {pii._entity(rng, ['mail', 'host'])[0]} and {pii._entity(rng, ['garden'])[0]}, then {rng.randrange(10**9)}"
        t = pii.tokens(text, 0, len(text))
        assert pii.decode_tokens(t, weights) == pii.decode(pii.lattice(t), weights)


def test_very_long_numbers_and_tables(spark):
    weights = pii.fit(pii.training_set(_sample(), 100), 10)
    rng = random.Random(3)
    texts = ["1234567890" * 100_000, " ".join(str(rng.randrange(100)) for _ in range(30_000)), "1.2.3." * 40_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(rows, weights=weights).collect()}
    assert got[0]["spans"] == got[1]["spans"] == "" and got[2]["n_ip"] == 30_000


def test_every_span_of_a_row_of_numbers_is_tried():
    rng = random.Random(12)
    for _ in range(60):
        made = "".join(rng.choice(["12", "7", "345", "9876", " ", " ", ", ", "-", ".", "(", "+", "\n", "@", "at", "mail", "dot"]) for _ in range(40))
        t = pii.tokens(made, 0, len(made))
        places = [x for x, k in enumerate(t.kinds) if k in (pii.DIGITS, pii.LETTERS)]
        want = set()
        for i in range(len(t)):
            for j in [x for x in places if x >= i][: pii.MAX_TOKENS]:
                if t.kinds[i] != pii.SPACE and pii.span_features(t, i, j, set()) is not None:
                    want.add((i, j))
        assert {(i, j) for i, j, *_ in pii.candidates(t)} == want, made


def test_a_phone_within_a_table_is_found():
    weights = pii.fit(pii.training_set(_sample()))
    rng = random.Random(9)
    for made in ("(555) 123-4567", "(218) 904-7731"):
        cells = [str(rng.randrange(1000)) for _ in range(24)]
        cells[11] = made
        text = "amounts " + ", ".join(cells) + " end"
        low = text.index(made)
        assert pii.find_all(text, weights) == ([], [(low, 3, low + len(made))])
    for separator in (" ", ", ", "  ", "/"):
        text = "rows " + separator.join(str(rng.randrange(100)) for _ in range(3000)) + " end"
        assert len(pii.find_all(text, weights)[1]) <= 3, separator
