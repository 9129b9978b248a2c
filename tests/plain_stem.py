"""Porter's 1980 rules for one word, letter by letter: what the stem expressions must equal."""

from __future__ import annotations

import re

from simalign.functions.stem import STEP2, STEP3, STEP4


def shape(stem: str) -> str:
    out = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and out[-1:] == "c")
        out += "v" if vowel else "c"
    return out


def measure(stem: str) -> int:
    return len(re.findall("v+c+", shape(stem)))


def short_end(stem: str) -> bool:
    return shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def longest(word: str, suffixes) -> str | None:
    hits = [s for s in suffixes if word.endswith(s)]
    return max(hits, key=len) if hits else None


def tidy(word: str) -> str:
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    double = len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"
    if double and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if measure(word) == 1 and short_end(word) else word


def porter(word: str) -> str:
    if len(word) < 3:
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) > 0 else word
    else:
        ending = longest(word, ("ed", "ing"))
        if ending and "v" in shape(word[: -len(ending)]):
            word = tidy(word[: -len(ending)])
    if word.endswith("y") and "v" in shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (STEP2, STEP3):
        suffix = longest(word, rules)
        if suffix and measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + rules[suffix]
    suffix = longest(word, STEP4)
    if suffix:
        stem = word[: -len(suffix)]
        if measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        m = measure(word[:-1])
        if m > 1 or (m == 1 and not short_end(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and measure(word) > 1:
        word = word[:-1]
    return word
