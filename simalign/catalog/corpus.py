"""Sources, sinks, projections, row identity, splits and folds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from simalign.catalog.base import (
    ALL_DOCS, BY_LANGUAGE, LABELLED, RANKED, by_language, documents, labelled, query,
    table,
)
from simalign.functions import vectors
from simalign.operators import rank, split
from simalign.session import shared_dir
from simalign.sources import files


def scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_scan", "doc_id long, text string, lang string", "SELECT doc_id, text, lang FROM documents")
def csv_scan(spark, sf):
    path = scratch(spark, "corpus-csv")
    files.write_csv(documents(spark, sf), path)
    return files.read_csv(spark, path, "doc_id long, text string, lang string")


@query("csv_sink", "index long, id long, quality int",
       "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS index, doc_id AS id, quality FROM labels")
def csv_sink(spark, sf):
    path = scratch(spark, "labels-csv")
    rows = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), "quality")
    files.write_csv(rows, path, index_by="id")
    return files.read_csv(spark, path, "id long, quality int, index long")


@query("scan_first_n", "doc_id long, text string",
       "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 600")
def scan_first_n(spark, sf):
    return files.first_n(documents(spark, sf), 600, "doc_id")


@query("batch_scan", "doc_id long, batch_id int",
       "SELECT doc_id, floor((row_number() OVER (ORDER BY doc_id) - 1) / 50) AS batch_id FROM documents")
def batch_scan(spark, sf):
    return split.assign_batches(documents(spark, sf).select("doc_id"), 50)


@query("parse_series", "vec_id long, label int, series array<double>",
       "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS series FROM embeddings")
def parse_series(spark, sf):
    path = scratch(spark, "series-csv")
    values = F.col("embedding").cast("array<double>").cast("array<string>")
    literal = F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]"))
    source = table(spark, sf, "embeddings").select("vec_id", "label", literal.alias("series"))
    files.write_csv(source, path)
    back = files.read_csv(spark, path, "vec_id long, label int, series string")
    return back.withColumn("series", vectors.parse_series(F.col("series")))


@query("project_columns", "text string, label int", f"WITH {LABELLED} SELECT text, label FROM corpus")
def project_columns(spark, sf):
    return labelled(spark, sf).select("text", "label")


@query("fill_null_text", "conv_id long, turn long, text string",
       "SELECT conv_id, turn, coalesce(CASE WHEN role = 'user' THEN text END, ' ') AS text FROM conversations")
def fill_null_text(spark, sf):
    spoken = F.when(F.col("role") == "user", F.col("text"))
    return table(spark, sf, "conversations").withColumn("text", spoken).fillna(" ", subset=["text"])


@query("assign_row_ids", "row_id long, doc_id long",
       "SELECT row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS row_id, doc_id FROM documents")
def assign_row_ids(spark, sf):
    ranked = rank.hash_rank(documents(spark, sf).select("doc_id"), "doc_id")
    return ranked.select((F.col("rn") - 1).alias("row_id"), "doc_id")


@query("take_rows", "doc_id long, text string, lang string",
       "SELECT doc_id, text, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def take_rows(spark, sf):
    ids = table(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    return documents(spark, sf).join(ids, "doc_id", "left_semi")


@query("cast_predictions", "doc_id long, pred int",
       "SELECT doc_id, CAST(CAST(quality AS DOUBLE) AS INTEGER) AS pred FROM labels")
def cast_predictions(spark, sf):
    scored = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("pred"))
    return scored.withColumn("pred", F.col("pred").cast("int"))


@query("one_hot_labels", "doc_id long, vector array<double>",
       f"WITH {BY_LANGUAGE} SELECT doc_id, list_transform(range((SELECT max(label) FROM corpus) + 1),"
       " lambda i: CASE WHEN i = label THEN 1.0 ELSE 0.0 END) AS vector FROM corpus")
def one_hot_labels(spark, sf):
    docs = by_language(spark, sf).select("doc_id", "label")
    top = docs.agg(F.max("label").alias("max_label"))  # one row
    wide = docs.crossJoin(F.broadcast(top))
    return wide.select("doc_id", vectors.one_hot(F.col("label"), F.col("max_label")).alias("vector"))


@query("shuffle_seeded", "doc_id long, rn long", f"WITH {ALL_DOCS}, {RANKED} SELECT doc_id, rn FROM ranked")
def shuffle_seeded(spark, sf):
    return split.shuffle_seeded(documents(spark, sf).select("doc_id"))


@query("split_head_tail", "doc_id long, part string",
       f"WITH {ALL_DOCS}, {RANKED} SELECT doc_id, 'train' AS part FROM ranked WHERE rn <= 500"
       " UNION ALL SELECT doc_id, 'test' FROM ranked WHERE rn > n - 100")
def split_head_tail(spark, sf):
    train, test = split.split_head_tail(documents(spark, sf).select("doc_id"), 500, 100)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("split_fraction", "doc_id long, part string",
       f"WITH {ALL_DOCS}, {RANKED} SELECT doc_id, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM ranked")
def split_fraction(spark, sf):
    train, test = split.split_fraction(documents(spark, sf).select("doc_id"), 0.2)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("split_three_way", "doc_id long, part string",
       f"WITH {ALL_DOCS}, {RANKED} SELECT doc_id, CASE WHEN rn <= 80 THEN 'train' WHEN rn <= 100 THEN 'val' ELSE 'test' END AS part"
       " FROM ranked WHERE rn <= 110")
def split_three_way(spark, sf):
    return split.split_three_way(documents(spark, sf).select("doc_id"), 80, 20, 10)


@query("split_static", "doc_id long, part string",
       "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 150 THEN 'train_val' ELSE 'test' END AS part FROM documents")
def split_static(spark, sf):
    return split.split_static(documents(spark, sf).select("doc_id"), 150)


@query("kfold_assign", "doc_id long, fold int",
       "SELECT doc_id, ntile(5) OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS fold FROM documents")
def kfold_assign(spark, sf):
    return split.kfold_assign(documents(spark, sf).select("doc_id"), 5)


@query("subsample_n", "doc_id long, text string",
       f"WITH {ALL_DOCS}, {RANKED} SELECT doc_id, text FROM ranked WHERE rn <= 500")
def subsample_n(spark, sf):
    return split.subsample_n(documents(spark, sf), 500)
