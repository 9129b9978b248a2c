"""A training corpus from `documents`, stage by stage.

Every stage works on all that the stage before it kept, and its decisions take effect. All
but the last return the columns of `documents`; the last writes the token codes and returns
one row per written document, as read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simalign.llm import decontaminate, files, mixing, near_dups, quality_rules, token_codes
from simalign.session import stage
from simalign.sources.files import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fertility band of their language and the base rules; others go.

    NULL and empty texts go, repeated rows are judged alike, an empty table stays empty.
    """
    judged = quality_rules.assess(docs, prefix="_qr_")
    return judged.filter("_qr_kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id.

    Five-word shingles, a similarity of 0.8. Rows that repeat whole leave one; texts without
    words are no duplicates of each other; NULL ids come last; an empty table stays empty.
    """
    return near_dups.keep_one(docs, k=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is found in benchmark items.

    Texts without words stay, rows that repeat are judged alike, an empty table stays empty.
    """
    benchmark = read_table(spark, f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark, prefix="_dc_")
    bad = decontaminate.is_contaminated(F.col("_dc_n_words"), F.col("_dc_n_hit"))
    return found.filter(~bad).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times.

    Documents without words go; NULL is a source of its own; an empty table stays empty.
    """
    sized = docs.withColumn("_mix_size", mixing.word_count(F.col("text")))
    mixed = mixing.mix(sized, size_col="_mix_size", prefix="_mix_")
    return mixing.repeat_rows(mixed, docs.columns, "_mix_copies")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token codes of all documents in id order: (doc_id, start, n_tokens, ids_crc32), read back.

    A document that the mix repeats is written as often. A NULL text is the end id alone, NULL
    ids come first, an empty table writes nothing.
    """
    return token_codes.read_index(token_codes.write_codes(docs, files.new_folder(spark, "codes")))


STAGES = [
    ("quality rules", quality), ("near-duplicates", near_dedup), ("decontamination", decontamination),
    ("mixing", mixture), ("token codes", tokens),
]

#: Fertility, near-duplicate classes and the random mix have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = read_table(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
