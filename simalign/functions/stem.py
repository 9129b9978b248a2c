"""Porter's 1980 suffix-stripping rules as Column expressions.

A word travels with its shape, one letter a character: c for consonants, v for vowels, y being a
vowel after a consonant. The shape of a beginning is the beginning of the shape, so it is made
once and cut along with the word. Every step is one projection, so that no step's expression is
repeated inside the next.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffix rules of steps 2, 3 and 4 of the published algorithm.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def shape(word: Column) -> Column:
    """c and v, a letter each."""

    def grown(seen: Column, letter: Column) -> Column:
        vowel = letter.isin(*"aeiou") | ((letter == "y") & seen.endswith("c"))
        return F.concat(seen, F.when(vowel, "v").otherwise("c"))

    return F.aggregate(F.split(word, ""), F.lit(""), grown)


def _some(shape: Column) -> Column:
    """At least one vowel-consonant sequence."""
    return shape.contains("vc")


def _many(shape: Column) -> Column:
    return shape.rlike("vc+v+c")


def _short_end(word: Column, shape: Column) -> Column:
    """Ends consonant-vowel-consonant, the last one not w, x or y."""
    return shape.endswith("cvc") & ~word.rlike("[wxy]$")


def _cut(text: Column, letters) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - letters)


def _suffix(word: Column, suffixes) -> Column:
    """The longest of the suffixes that the word ends with, or ''."""
    return F.regexp_extract(word, f"({'|'.join(suffixes)})$", 1)


def _step(df: DataFrame, *choices: tuple[Column, Column, Column]) -> DataFrame:
    """The first choice (when, word, shape) that holds; else both stay."""
    word, form = F.col("_word"), F.col("_shape")
    for when, new_word, new_shape in reversed(choices):
        word = F.when(when, new_word).otherwise(word)
        form = F.when(when, new_shape).otherwise(form)
    return df.withColumns({"_word": word, "_shape": form})


def _replaced(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The longest suffix gives way to its replacement after a vowel-consonant sequence."""
    w, s, end = F.col("_word"), F.col("_shape"), F.col("_end")
    df = df.withColumn("_end", _suffix(w, rules))
    new = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])[end]
    kept = _cut(s, F.length(end))
    # no replacement has a y, so its shape does not depend on what it follows
    form = F.translate(F.regexp_replace(new, "[^aeiou]", "c"), "aeiou", "vvvvv")
    return _step(df, ((end != "") & _some(kept), F.concat(_cut(w, F.length(end)), new), F.concat(kept, form)))


def with_stem(df: DataFrame, term: str, out: str = "stem") -> DataFrame:
    """`df` with the stem of a column of lower-case words; NULL stays, shorter than three letters too."""
    w, s, end = F.col("_word"), F.col("_shape"), F.col("_end")
    df = df.withColumns({"_word": F.col(term), "_shape": shape(F.col(term))})
    # plurals
    one = w.endswith("s") & ~w.endswith("ss")
    df = _step(df, (w.rlike("(sses|ies)$"), _cut(w, 2), _cut(s, 2)), (one, _cut(w, 1), _cut(s, 1)))
    # eed, ed, ing
    df = df.withColumn("_end", _suffix(w, ("eed", "ed", "ing")))
    eed = end == "eed"
    left = _cut(s, F.length(end))
    bare = ~eed & (end != "") & left.contains("v")
    df = df.withColumn("_bare", bare)
    df = _step(
        df, (eed & _some(_cut(s, 3)), _cut(w, 1), _cut(s, 1)),
        (F.col("_bare"), _cut(w, F.length(end)), left),
    )
    double = s.endswith("c") & (F.length(w) > 1) & (F.substring(w, -1, 1) == F.substring(w, -2, 1))
    grow = w.rlike("(at|bl|iz)$")
    drop = ~grow & double & ~w.rlike("[lsz]$")
    short = ~drop & _some(s) & ~_many(s) & _short_end(w, s)
    df = _step(
        df, (F.col("_bare") & drop, _cut(w, 1), _cut(s, 1)),
        (F.col("_bare") & (grow | short), F.concat(w, F.lit("e")), F.concat(s, F.lit("v"))),
    )
    # y after a vowel
    df = _step(
        df, (w.endswith("y") & _cut(s, 1).contains("v"), F.concat(_cut(w, 1), F.lit("i")), F.concat(_cut(s, 1), F.lit("v")))
    )
    df = _replaced(_replaced(df, STEP2), STEP3)
    # long suffixes
    df = df.withColumn("_end", _suffix(w, STEP4))
    left = _cut(s, F.length(end))
    ion = (end != "ion") | w.rlike("[st]ion$")
    df = _step(df, ((end != "") & _many(left) & ion, _cut(w, F.length(end)), left))
    # the last e, the last l of two
    left = _cut(s, 1)
    silent = _many(left) | (_some(left) & ~_short_end(_cut(w, 1), left))
    df = _step(df, (w.endswith("e") & silent, _cut(w, 1), left))
    df = _step(df, (w.endswith("ll") & _many(s), _cut(w, 1), _cut(s, 1)))
    return df.withColumn(out, F.when(F.length(F.col(term)) < 3, F.col(term)).otherwise(w)).drop("_word", "_shape", "_end", "_bare")


def _plain_shape(stem: str) -> str:
    out = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def _plain_measure(stem: str) -> int:
    return len(re.findall("v+c+", _plain_shape(stem)))


def _plain_short_end(stem: str) -> bool:
    return _plain_shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _plain_longest(word: str, suffixes) -> str | None:
    hits = [s for s in suffixes if word.endswith(s)]
    return max(hits, key=len) if hits else None


def _plain_tidy(word: str) -> str:
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    double = len(word) > 1 and word[-1] == word[-2] and _plain_shape(word)[-1] == "c"
    if double and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if _plain_measure(word) == 1 and _plain_short_end(word) else word


def porter(word: str) -> str:
    """The same rules for one word, letter by letter: what the expressions must equal."""
    if len(word) < 3:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if _plain_measure(word[:-3]) > 0 else word
    else:
        ending = _plain_longest(word, ("ed", "ing"))
        if ending and "v" in _plain_shape(word[: -len(ending)]):
            word = _plain_tidy(word[: -len(ending)])
    if word.endswith("y") and "v" in _plain_shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (STEP2, STEP3):
        suffix = _plain_longest(word, rules)
        if suffix and _plain_measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + rules[suffix]
    suffix = _plain_longest(word, STEP4)
    if suffix:
        stem = word[: -len(suffix)]
        if _plain_measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        m = _plain_measure(word[:-1])
        if m > 1 or (m == 1 and not _plain_short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _plain_measure(word) > 1:
        word = word[:-1]
    return word
