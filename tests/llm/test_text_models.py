"""Main text on written pages, ordinal regression on held-out rows."""

import random

import numpy as np
import pytest

from simalign.llm import main_text, ordinal

GOOD = "The cat sat on the mat and it was there for the whole of the day, as it was told to do by them all."
PAGES = [
    (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/a>{GOOD}</a></ul></nav><div class='ad'>{GOOD}</div>"
     f"<article><h1>A title</h1><p>{GOOD}</p><p>Short.<br>Line two<p><b>{GOOD}</b> &amp; &lt;x&gt;</p><div id=comments><p>{GOOD}</p></div></article>"
     f"<aside>{GOOD}</aside><footer>&copy; {GOOD}</footer></body></html>", f"A title {GOOD} Short. Line two {GOOD} & <x>"),
    (f"<body><div class=menu><a href=x>Home</a></div><h2>Head</h2><p>{GOOD}</p><p>Tiny</p><p>{GOOD}</p><form><p>{GOOD}</p></form><script>var a='<p>{GOOD}</p>';</script>",
     f"Head {GOOD} Tiny {GOOD}"),
    (f"<div><p>{GOOD}</p></div><ul><li><a href=1>one of the links that one can follow from here to there and back</a><li><a href=2>two</a></ul>", GOOD),
    ("just words", "just words"), ("", ""), (None, ""), ("<p>a  b\n\tc</p><!-- <p>no</p> --><p>d &eacute;&#233;</p", "a b c d éé"), ("<", "<"), ("<script>open", ""),
    (f"<p class='cookie-notice'>{GOOD}</p><p hidden>{GOOD}</p><p style='display: none'>{GOOD}</p><div role=navigation>{GOOD}</div>", ""),
]


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_main_text(number):
    page, want = PAGES[number]
    assert main_text.main_text(page or "") == want


CARD = "<article class='card'><h3>Other</h3><p><a href=o>One more of the stories that can be read here as well by all of you</a></p></article>"
CODES = ("Zx41 kq77 lorp vexit 9931 qorlan mitra suvel prond karvit zelot brunda fexil tormak vindel " * 3).strip()
WRAPPERS = [
    "class='has-sidebar content'", "class='right-sidebar main-content'", "class='no-sidebar'", "class='hentry post tag-python'", "class='article-share-wrapper'",
    "id='search-results-page'", "class='widget'",
]


def test_decoy_article_does_not_take_the_page():
    story = " ".join([GOOD] * 6)
    page = f"<body><div class='content'>{''.join(f'<p>{GOOD}</p>' for _ in range(6))}</div>{CARD}</body>"
    assert main_text.main_text(page) == story
    short = f"<body><div class='content'>{''.join(f'<p>{GOOD}</p>' for _ in range(6))}</div><article class='card'><p>{GOOD}</p></article></body>"
    assert main_text.main_text(short) == f"{story} {GOOD}"
    assert main_text.main_text(f"<body><p>{GOOD}</p><article>{f'<p>{GOOD}</p>' * 6}</article></body>") == story


def test_few_stop_words_alone_drop_nothing_from_an_article():
    page = f"<article><p>{GOOD}</p><p>{GOOD}</p><p>{CODES}</p><p>Tiny</p><pre>{CODES}</pre><p>{GOOD}</p></article>"
    assert main_text.main_text(page) == f"{GOOD} {GOOD} {CODES} Tiny {CODES} {GOOD}"
    assert main_text.main_text(f"<p>{CODES}</p>") == CODES
    # outside of one they do, if the page is of a known language
    assert main_text.main_text(f"<div>{f'<p>{GOOD}</p>' * 6}<p>{CODES}</p></div>") == " ".join([GOOD] * 6)
    # and so do links around it
    links = f"<ul><li><a href=1>{GOOD}</a><li><a href=2>{GOOD}</a></ul>"
    assert main_text.main_text(f"<article><p>{GOOD}</p><p>x</p>{links}<p>{CODES}</p>{links}</article>") == f"{GOOD} x"


POLISH = "Wczoraj wieczorem wszyscy mieszkańcy naszego miasta wyszli na ulice, żeby zobaczyć zorzę nad rzeką, która świeciła przez całą noc. "


def test_a_page_of_an_unknown_language():
    text = (POLISH * 3).strip()
    notice = f"<p>{GOOD}</p>"
    assert main_text.main_text(f"<body>{notice}<article><p>{text}</p><p>{text}</p></article></body>") == f"{text} {text}"
    assert main_text.main_text(f"<body><div><p>{text}</p><p>{text}</p></div></body>") == f"{text} {text}"
    assert text in main_text.main_text(f"<body><div><p>{text}</p><p>{text}</p></div>{notice}</body>")


@pytest.mark.parametrize("tag", ["svg", "object", "video", "canvas", "math"])
def test_unclosed_foreign_elements_do_not_swallow_the_page(tag):
    assert main_text.main_text(f"<div><p>{GOOD}</p><{tag} id=x></div><p>{GOOD}</p>") == f"{GOOD} {GOOD}"
    assert main_text.main_text(f"<div><p>{GOOD}</p><{tag}><p>{GOOD}</p></{tag}></div><p>{GOOD}</p>") == f"{GOOD} {GOOD}"


@pytest.mark.parametrize("attribute", WRAPPERS)
def test_names_of_wrappers_keep_the_page(attribute):
    page = f"<body><div {attribute}><p>{GOOD}</p><p>{GOOD}</p></div><div class='ad-box'><p>{GOOD}</p></div></body>"
    assert main_text.main_text(page) == f"{GOOD} {GOOD}"


def test_more_comments_than_article():
    assert main_text.main_text(f"<article><p>{GOOD}</p></article><div class='comments-area'>{f'<p>{GOOD}</p>' * 5}</div>") == GOOD


def test_pages_keep_their_columns(spark):
    rows = [(i, "u", p, "old") for i, (p, _) in enumerate(PAGES)] * 2 + [(None, None, f"<p>{GOOD}</p>" * 5000, "old")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(pages, keep=["page_id", "url"]).collect()
    assert len(got) == len(rows)
    assert all(r["text"] == (PAGES[r["page_id"]][1] if r["page_id"] is not None else " ".join([GOOD] * 5000)) for r in got)
    assert main_text.extract(pages.limit(0)).count() == 0


def _rated(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        grade = rng.choice([0, 1, 2, 2, 2])
        for word in {0: ["vile", "awful"], 1: ["meh", "dull"], 2: []}[grade]:
            w[rng.randrange(len(w))] = word
        rows.append((seed * 100_000 + i, " ".join(w), grade))
    return rows


def test_held_out_grades(spark):
    rated = spark.createDataFrame([*_rated(900, 1), (5, "none", None), (6, "out", 9), (7, None, 2)], "doc_id long, text string, grade int")
    model = ordinal.train(rated, "text", "grade", "doc_id", 3)
    assert model[1][0] < model[1][1]
    fresh = _rated(400, 2)
    docs = spark.createDataFrame([*fresh, (None, None, 0), (1, "", 0)], "doc_id long, text string, expected_grade int")
    got = ordinal.score(docs, model, keep=["doc_id"]).collect()
    grade = {a: c for a, _, c in fresh}
    right = np.mean([(r["expected_grade"] > 1.5) == (grade[r["doc_id"]] == 2) for r in got if r["doc_id"] in grade])
    mean = {g: np.mean([r["expected_grade"] for r in got if grade.get(r["doc_id"]) == g]) for g in range(3)}
    assert right > 0.9 and mean[0] < mean[1] < mean[2]
    for r in got:
        assert 0 <= r["p_at_least_2"] <= r["p_at_least_1"] <= 1
        assert abs(r["expected_grade"] - r["p_at_least_1"] - r["p_at_least_2"]) < 1e-9
    assert ordinal.score(docs.limit(0), model).count() == 0


def test_fit_climbs_the_likelihood_and_takes_no_rows():
    weights, cuts = ordinal.fit([], np.zeros(0, np.int64), 4)
    assert not weights.any() and (np.diff(cuts) > 0).all()
    rows = [np.array([i % 3, *range(1 << ordinal.BITS, (1 << ordinal.BITS) + 3)]) for i in range(90)]
    grades = np.arange(90) % 3
    weights, cuts = ordinal.fit(rows, grades, 3)
    score = np.array([weights[r].sum() * ordinal.damping(len(r)) for r in rows])
    assert ((score[:, None] > cuts).sum(axis=1) == grades).mean() > 0.95
