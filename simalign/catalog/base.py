"""Query registry: a Spark callable, its DuckDB check query and a declared result schema."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simalign.sources.files import dealt, read_table

DUCK_TYPES = {
    "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def duck_type(name: str) -> str:
    if name.startswith("array<"):
        return duck_type(name[6:-1]) + "[]"
    return DUCK_TYPES[name]


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    columns: dict[str, str]
    check: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.build(spark, sf_dir)
        return out.select(*[F.col(c).cast(t).alias(c) for c, t in self.columns.items()])

    def sql(self) -> str | None:
        if self.check is None:
            return None
        cols = ", ".join(f"CAST({c} AS {duck_type(t)}) AS {c}" for c, t in self.columns.items())
        return f"SELECT {cols} FROM (\n{self.check}\n) AS checked"


def cols(spec: str) -> dict[str, str]:
    """'doc_id long, text string' as a dict."""
    return dict(part.strip().rsplit(" ", 1) for part in spec.split(","))


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, check: str | None = None):
    """Register a query under `name`."""

    def add(build):
        QUERIES[name] = Query(build, cols(columns), check)
        return build

    return add


# ---- the given tables as corpora ------------------------------------------------------

# Class numbers of the four languages.
LANG_CODES = {"de": 0, "en": 1, "es": 2, "fr": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a quality label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id", "left_anti")


def by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, the language as class number."""
    code = F.lit(None).cast("int")
    for lang, number in LANG_CODES.items():
        code = F.when(F.col("lang") == lang, number).otherwise(code)
    return documents(spark, sf_dir).select("doc_id", "text", code.alias("label"))


# ---- building blocks of the check queries ---------------------------------------------

LABELLED = (
    "corpus AS (SELECT d.doc_id, d.text, l.quality AS label"
    " FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
)
BY_LANGUAGE = (
    "corpus AS (SELECT doc_id, text, CASE lang "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_CODES.items())
    + " END AS label FROM documents)"
)
UNLABELLED = (
    "unlabelled AS (SELECT doc_id, text FROM documents"
    " WHERE doc_id NOT IN (SELECT doc_id FROM labels))"
)
ALL_DOCS = "corpus AS (SELECT doc_id, text, lang FROM documents)"
RANKED = (
    "ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn,"
    " count(*) OVER () AS n FROM corpus)"
)


def holdout(fraction: float) -> str:
    return (
        f"train AS (SELECT 0 AS fold, doc_id, text, label FROM ranked WHERE rn > ceil(n * {fraction})),"
        f" test AS (SELECT 0 AS fold, doc_id, text, label FROM ranked WHERE rn <= ceil(n * {fraction}))"
    )


def folds(k: int) -> str:
    return (
        f"folded AS (SELECT *, ntile({k}) OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS own FROM corpus),"
        f" train AS (SELECT f.fold, doc_id, text, label FROM folded, range({k}) f(fold) WHERE own <> f.fold),"
        " test AS (SELECT own AS fold, doc_id, text, label FROM folded)"
    )


WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
SPLIT = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"


def neighbours(max_features: int | None = None, train_terms: str | None = None, test_terms: str | None = None) -> str:
    """`dist` and `near`: every test document of a fold against every training document."""
    raw = f"SELECT fold, doc_id, unnest({WORDS}) AS term FROM "
    train_terms = train_terms or raw + "train"
    test_terms = test_terms or raw + "test"
    limit = ""
    if max_features is not None:
        limit = (
            f", kept AS (SELECT fold, term FROM (SELECT fold, term, row_number() OVER (PARTITION BY fold"
            f" ORDER BY count(*) DESC, term) AS r FROM tr_raw GROUP BY fold, term) WHERE r <= {max_features})"
        )
    source = "kept" if max_features is not None else "tr_raw"
    return (
        f"tr_raw AS ({train_terms}){limit}, te_raw AS ({test_terms}),"
        f" tr_t AS (SELECT DISTINCT fold, doc_id, term FROM tr_raw WHERE (fold, term) IN (SELECT fold, term FROM {source})),"
        " te_t AS (SELECT DISTINCT fold, doc_id, term FROM te_raw WHERE (fold, term) IN (SELECT fold, term FROM tr_t)),"
        " tr_n AS (SELECT t.fold, t.doc_id, t.label, count(x.term) AS b FROM train t LEFT JOIN tr_t x"
        " ON t.fold = x.fold AND t.doc_id = x.doc_id GROUP BY ALL),"
        " te_n AS (SELECT t.fold, t.doc_id, t.label, count(x.term) AS a FROM test t LEFT JOIN te_t x"
        " ON t.fold = x.fold AND t.doc_id = x.doc_id GROUP BY ALL),"
        " inter AS (SELECT x.fold, x.doc_id AS test_id, y.doc_id AS train_id, count(*) AS i FROM te_t x JOIN tr_t y"
        " ON x.fold = y.fold AND x.term = y.term GROUP BY ALL),"
        " dist AS (SELECT e.fold, e.doc_id AS test_id, e.label AS test_label, r.doc_id AS train_id, r.label,"
        " CASE WHEN a + b = 0 THEN 0.0 ELSE 1.0 - CAST(coalesce(i, 0) AS DOUBLE) / (a + b - coalesce(i, 0)) END AS dist"
        " FROM te_n e JOIN tr_n r ON e.fold = r.fold LEFT JOIN inter q ON q.fold = e.fold"
        " AND q.test_id = e.doc_id AND q.train_id = r.doc_id),"
        " near AS (SELECT *, row_number() OVER (PARTITION BY fold, test_id ORDER BY dist, train_id) AS rank FROM dist)"
    )


def voted(source: str, by: str) -> str:
    """Majority label per `by`; ties to the smallest label."""
    return (
        f"SELECT {by}, label AS pred FROM (SELECT {by}, label, row_number() OVER (PARTITION BY {by}"
        f" ORDER BY count(*) DESC, label) AS r FROM {source} GROUP BY {by}, label) WHERE r = 1"
    )


ADAPTIVE_K = "CASE WHEN {n} < 225 THEN ceil(sqrt({n})) ELSE 15 END"


def macro_f1(source: str, by: str = "") -> str:
    """SELECT by, macro_f1 over `source` (by, label, pred)."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (
        f"SELECT {keys}avg(f1) AS macro_f1 FROM (SELECT {keys}cls, 2.0 * sum(hit) / (sum(truth) + sum(guess)) AS f1 FROM ("
        f"SELECT {keys}label AS cls, 1 AS truth, 0 AS guess, CASE WHEN label = pred THEN 1 ELSE 0 END AS hit FROM {source}"
        f" UNION ALL SELECT {keys}pred, 0, 1, 0 FROM {source}) GROUP BY {keys}cls) {group}"
    )
