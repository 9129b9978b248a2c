import random

from plain_stem import porter

from simalign.functions.stem import STEP2, STEP3, STEP4, with_stem

KNOWN = {
    "caresses": "caress", "ponies": "poni", "tennis": "tenni", "agreed": "agre", "feed": "feed", "plastered": "plaster",
    "motoring": "motor", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky",
    "relational": "relat", "conditional": "condit", "vietnamization": "vietnam", "hopefulness": "hope",
    "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control",
    "apple": "appl", "sing": "sing", "eed": "eed", "as": "as", "": "",
}


def _words(n):
    """Built from suffixes and the letters that the rules look at."""
    rng = random.Random(3)
    ends = ["", "s", "sses", "ies", "eed", "ed", "ing", "y", "e", "ll", "bling", "izing", *STEP2, *STEP3, *STEP4]
    for _ in range(n):
        start = "".join(rng.choices("aeiouyyybtlszwxn", k=rng.randint(0, 6)))
        yield start + rng.choice(ends) + rng.choice(ends) * rng.randint(0, 1)


def test_stems_equal_the_rules_letter_by_letter(spark):
    words = sorted({*KNOWN, *_words(20_000), "é", "éying", "größes", "a\U0001f600ing", "_ed", "1990s"})
    rows = spark.createDataFrame([(w,) for w in [*words, None]], "w string")
    got = {r.w: r.stem for r in with_stem(rows, "w").collect()}
    assert got.pop(None) is None
    assert {w: got[w] for w in KNOWN} == KNOWN
    assert {w: s for w, s in got.items() if s != porter(w)} == {}


def test_no_python_worker(spark):
    plan = with_stem(spark.range(9).selectExpr("cast(id AS string) AS w"), "w")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
