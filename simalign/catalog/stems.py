"""Stems, and the same rules as a chain of SQL tables (w: word so far, s: its shape)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simalign.catalog.base import WORDS, documents, query
from simalign.functions.stem import STEP2, STEP3, STEP4
from simalign.functions.tokens import word_tokens
from simalign.operators import vocab
from simalign.plans import models


def _cut(text: str, letters) -> str:
    return f"left({text}, greatest(length({text}) - {letters}, 0))"


def _ending(suffixes) -> str:
    return f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"


def _either(*choices: tuple[str, str, str]) -> str:
    """term, w, s with the first choice (when, word, shape) that holds."""
    word = " ".join(f"WHEN {when} THEN {w}" for when, w, _ in choices)
    shape = " ".join(f"WHEN {when} THEN {s}" for when, _, s in choices)
    return f"term, CASE {word} ELSE w END AS w, CASE {shape} ELSE s END AS s"


def _replace(rules: dict[str, str]) -> str:
    letters = lambda new: "".join("v" if ch in "aeiou" else "c" for ch in new)
    new = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in rules.items())
    form = " ".join(f"WHEN '{old}' THEN '{letters(new)}'" for old, new in rules.items())
    kept = _cut("s", "length(e)")
    return _either((
        f"e <> '' AND {kept} LIKE '%vc%'", f"{_cut('w', 'length(e)')} || CASE e {new} END", f"{kept} || CASE e {form} END",
    ))


MANY = "regexp_matches({}, 'vc+v+c')"
LEFT, LAST = _cut("s", "length(e)"), _cut("s", 1)
SHORT = "s LIKE '%cvc' AND NOT regexp_matches(w, '[wxy]$')"
GROW = "regexp_matches(w, '(at|bl|iz)$')"
DROP = f"(NOT {GROW} AND s LIKE '%c' AND length(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND NOT regexp_matches(w, '[lsz]$'))"
SILENT = (
    f"({MANY.format(LAST)} OR ({LAST} LIKE '%vc%' AND NOT ({LAST} LIKE '%cvc' AND NOT regexp_matches({_cut('w', 1)}, '[wxy]$'))))"
)
STEMS = [
    ("raw", f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) GROUP BY ALL"),
    ("shaped", "SELECT term, term AS w, list_reduce(list_prepend('', string_split(term, '')), lambda a, ch: a ||"
     " CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') OR (ch = 'y' AND a LIKE '%c') THEN 'v' ELSE 'c' END) AS s"
     " FROM (SELECT DISTINCT term FROM raw)"),
    ("plural", "SELECT " + _either(
        ("w LIKE '%sses' OR w LIKE '%ies'", _cut("w", 2), _cut("s", 2)),
        ("w LIKE '%s' AND w NOT LIKE '%ss'", _cut("w", 1), _cut("s", 1)),
    ) + " FROM shaped"),
    ("verb", f"SELECT *, {_ending(('eed', 'ed', 'ing'))} AS e FROM plural"),
    ("bared", "SELECT " + _either(
        (f"e = 'eed' AND {_cut('s', 3)} LIKE '%vc%'", _cut("w", 1), _cut("s", 1)),
        (f"e IN ('ed', 'ing') AND {LEFT} LIKE '%v%'", _cut("w", "length(e)"), LEFT),
    ) + f", e IN ('ed', 'ing') AND {LEFT} LIKE '%v%' AS bare FROM verb"),
    ("tidied", "SELECT " + _either(
        (f"bare AND {DROP}", _cut("w", 1), _cut("s", 1)),
        (f"bare AND ({GROW} OR (s LIKE '%vc%' AND NOT {MANY.format('s')} AND {SHORT}))", "w || 'e'", "s || 'v'"),
    ) + " FROM bared"),
    ("soft", "SELECT " + _either((f"w LIKE '%y' AND {LAST} LIKE '%v%'", f"{_cut('w', 1)} || 'i'", f"{LAST} || 'v'")) + " FROM tidied"),
    ("second", f"SELECT {_replace(STEP2)} FROM (SELECT *, {_ending(STEP2)} AS e FROM soft)"),
    ("third", f"SELECT {_replace(STEP3)} FROM (SELECT *, {_ending(STEP3)} AS e FROM second)"),
    ("fourth", "SELECT " + _either((
        f"e <> '' AND {MANY.format(LEFT)} AND (e <> 'ion' OR regexp_matches(w, '[st]ion$'))", _cut("w", "length(e)"), LEFT,
    )) + f" FROM (SELECT *, {_ending(STEP4)} AS e FROM third)"),
    ("mute", f"SELECT {_either((f"w LIKE '%e' AND {SILENT}", _cut('w', 1), LAST))} FROM fourth"),
    ("single", f"SELECT {_either((f"w LIKE '%ll' AND {MANY.format('s')}", _cut('w', 1), LAST))} FROM mute"),
]
STEM_SQL = (
    "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in STEMS)
    + "\nSELECT doc_id, CASE WHEN length(term) < 3 THEN term ELSE w END AS stem, sum(tf) AS tf"
    " FROM raw JOIN single USING (term) GROUP BY ALL"
)


@query("stem_text", "doc_id long, stem string, tf long", STEM_SQL)
def stem_text(spark, sf):
    docs = documents(spark, sf)
    return models.stem_words(vocab.doc_term_counts(docs, word_tokens(F.col("text")), "doc_id"))
