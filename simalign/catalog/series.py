"""Series distances and dynamic time warping."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from simalign.catalog.base import documents, query, table
from simalign.catalog.corpus import scratch
from simalign.functions import vectors
from simalign.operators import dtw
from simalign.sources import files


def vector_pairs(spark, sf):
    """Embeddings as series of equal length, each beside the next."""
    rows = files.dealt(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id")
    return dtw.pair_by_offset(
        rows.withColumn("embedding", F.col("embedding").cast("array<double>")), "vec_id", "embedding"
    )


def sentence_pairs(spark, sf):
    """Sentence lengths of a document as a series of its own length, each beside the next."""
    parts = F.filter(F.split("text", "[.\n]+"), lambda s: F.trim(s) != "")
    lengths = F.transform(parts, lambda s: F.length(s).cast("double"))
    return dtw.pair_by_offset(
        documents(spark, sf).select("doc_id", lengths.alias("series")), "doc_id", "series"
    )


def word_pairs(spark, sf):
    """Word lengths of a benchmark text as a series, each beside the next."""
    words = F.filter(F.split("text", r"\s+"), lambda s: s != "")
    lengths = F.transform(words, lambda s: F.length(s).cast("double"))
    rows = table(spark, sf, "benchmark").select("item_id", lengths.alias("series"))
    return dtw.pair_by_offset(files.dealt(rows, "item_id"), "item_id", "series")


def _pairs_sql(source: str, key: str) -> str:
    return f"s AS ({source}), pairs AS (SELECT x.{key} AS id, x.v AS a, y.v AS b FROM s x JOIN s y ON y.{key} = x.{key} + 1)"


VECTORS = _pairs_sql("SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings", "vec_id")
SENTENCES = _pairs_sql(
    "SELECT doc_id, list_transform(list_filter(string_split_regex(text, '[.\\n]+'), lambda t: trim(t) <> ''),"
    " lambda t: length(t)::DOUBLE) AS v FROM documents", "doc_id")
WORDS = _pairs_sql(
    "SELECT item_id, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda t: t <> ''),"
    " lambda t: length(t)::DOUBLE) AS v FROM benchmark", "item_id")

LOCAL = {
    "abs": "abs(a[i] - b[d + 1 - i])",
    "sq": "(a[i] - b[d + 1 - i]) * (a[i] - b[d + 1 - i])",
    "sqrt": "sqrt(abs(a[i] - b[d + 1 - i]))",
}


def diagonals(cost: str = "abs", name: str = "diag") -> str:
    """One row per pair and anti-diagonal d = i + j: its costs c by i, and the two before."""
    return (
        f"{name} AS (SELECT id, len(a) AS n, len(b) AS m, a, b, 1 AS d,"
        " list_transform(range(0, len(a) + 1), lambda i: 'inf'::DOUBLE) AS c,"
        " list_transform(range(0, len(a) + 1), lambda i: CASE WHEN i = 0 THEN 0.0 ELSE 'inf'::DOUBLE END) AS p1,"
        " list_transform(range(0, len(a) + 1), lambda i: 'inf'::DOUBLE) AS p2"
        " FROM pairs WHERE len(a) > 0 AND len(b) > 0 UNION ALL"
        " SELECT id, n, m, a, b, d + 1, list_transform(range(0, n + 1), lambda i: CASE WHEN i >= 1 AND d + 1 - i BETWEEN 1 AND m"
        f" THEN {LOCAL[cost]} + least(p1[i], c[i], c[i + 1]) ELSE 'inf'::DOUBLE END), c, p1 FROM {name} WHERE d < n + m)"
    )


DIST = "SELECT id, c[n + 1] AS distance FROM diag WHERE d = n + m"
CELLS = (
    "flat AS (SELECT id, n, m, d, c, p1, p2, unnest(range(greatest(1, d - m), least(n, d - 1) + 1)) AS i FROM diag WHERE d >= 2),"
    " cells AS (SELECT id, n, m, i - 1 AS i, d - i - 1 AS j, c[i + 1] AS cost, CASE WHEN p2[i] <= p1[i] AND p2[i] <= p1[i + 1] THEN 0"
    " WHEN p1[i] <= p1[i + 1] THEN 1 ELSE 2 END AS dir FROM flat)"
)
PATH = (
    "walk AS (SELECT id, 0 AS step, i, j, dir FROM cells WHERE i = n - 1 AND j = m - 1 UNION ALL"
    " SELECT w.id, w.step + 1, c.i, c.j, c.dir FROM walk w JOIN cells c ON c.id = w.id"
    " AND c.i = w.i - CASE WHEN w.dir = 2 THEN 0 ELSE 1 END AND c.j = w.j - CASE WHEN w.dir = 1 THEN 0 ELSE 1 END"
    " WHERE w.i > 0 OR w.j > 0)"
)


@query("dtw_distance", "id long, distance double", f"WITH RECURSIVE {SENTENCES}, {diagonals()} {DIST}")
def dtw_distance(spark, sf):
    return dtw.dtw_distance(sentence_pairs(spark, sf))


@query("dtw_table", "id long, distance double", f"WITH RECURSIVE {VECTORS}, {diagonals()} {DIST}")
def dtw_table(spark, sf):
    """Pairs from a CSV of list literals; distances to a CSV."""
    def literal(c):
        return F.concat(F.lit("["), F.array_join(F.col(c).cast("array<string>"), ", "), F.lit("]")).alias(f"series_{c}")

    source, sink = scratch(spark, "pairs-csv"), scratch(spark, "distances-csv")
    files.write_csv(vector_pairs(spark, sf).select("id", literal("a"), literal("b")), source)
    back = files.read_csv(spark, source, "id long, series_a string, series_b string")
    parsed = back.select("id", *[vectors.parse_series(F.col(f"series_{c}")).alias(c) for c in "ab"])
    files.write_csv(dtw.dtw_distance(parsed), sink)
    return files.read_csv(spark, sink, "id long, distance double")


@query("dtw_cost_matrix", "id long, i int, j int, cost double, dir int",
       f"WITH RECURSIVE {WORDS}, {diagonals()}, {CELLS} SELECT id, i, j, cost, dir FROM cells")
def dtw_cost_matrix(spark, sf):
    return dtw.dtw_cost_matrix(word_pairs(spark, sf))


@query("dtw_path", "id long, step int, i int, j int",
       f"WITH RECURSIVE {VECTORS}, {diagonals()}, {CELLS}, {PATH} SELECT id, step, i, j FROM walk")
def dtw_path(spark, sf):
    return dtw.dtw_path(vector_pairs(spark, sf))


@query("dtw_matching", "id long, step int, i int, j int, x double, y double",
       f"WITH RECURSIVE {VECTORS}, {diagonals()}, {CELLS}, {PATH} SELECT w.id, step, i, j, a[i + 1] AS x, b[j + 1] AS y"
       " FROM walk w JOIN pairs p ON p.id = w.id")
def dtw_matching(spark, sf):
    return dtw.dtw_matching(vector_pairs(spark, sf))


@query("dtw_heatmap_rows", "id long, x int, y int, cost double",
       f"WITH RECURSIVE {WORDS}, {diagonals()}, {CELLS} SELECT id, j AS x, i AS y, cost FROM cells")
def dtw_heatmap_rows(spark, sf):
    return dtw.heatmap_rows(word_pairs(spark, sf))


@query("dtw_cost_variants", "id long, variant string, distance double",
       f"WITH RECURSIVE {VECTORS}, {diagonals('sq', 'diag')}, {diagonals('sqrt', 'diag2')}"
       " SELECT id, 'sq' AS variant, round(c[n + 1], 6) AS distance FROM diag WHERE d = n + m"
       " UNION ALL SELECT id, 'sqrt', round(c[n + 1], 6) FROM diag2 WHERE d = n + m")
def dtw_cost_variants(spark, sf):
    pairs = vector_pairs(spark, sf)
    both = [dtw.dtw_distance(pairs, v).withColumn("variant", F.lit(v)) for v in ("sq", "sqrt")]
    return both[0].unionByName(both[1]).withColumn("distance", F.round("distance", 6))


@query("truncate_overlap", "id long, b array<double>",
       f"WITH {SENTENCES} SELECT id, b[1 : least(len(a), len(b))] AS b FROM pairs")
def truncate_overlap(spark, sf):
    return sentence_pairs(spark, sf).select("id", vectors.truncate_overlap(F.col("b"), F.col("a")).alias("b"))


@query("l1_timestep", "id long, distance double",
       f"WITH {SENTENCES} SELECT id, list_sum(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: abs(a[i] - b[i])))"
       " AS distance FROM pairs")
def l1_timestep(spark, sf):
    a, b = F.col("a"), F.col("b")
    distance = vectors.l1_timestep(vectors.truncate_overlap(a, b), vectors.truncate_overlap(b, a))
    return sentence_pairs(spark, sf).select("id", distance.alias("distance"))


@query("dtw_vs_l1", "id long, distance double, l1 double",
       f"WITH RECURSIVE {VECTORS}, {diagonals()} SELECT id, round(c[n + 1], 6) AS distance,"
       " round(list_sum(list_transform(range(1, n + 1), lambda i: abs(a[i] - b[i]))), 6) AS l1 FROM diag WHERE d = n + m")
def dtw_vs_l1(spark, sf):
    pairs = vector_pairs(spark, sf).withColumn("l1", F.round(vectors.l1_timestep(F.col("a"), F.col("b")), 6))
    return dtw.dtw_distance(pairs, keep=("l1",)).withColumn("distance", F.round("distance", 6))


@query("pairwise_cost", "id long, variant string, i int, j int, cost double",
       f"WITH {WORDS}, xs AS (SELECT id, b, unnest(a) AS x, generate_subscripts(a, 1) - 1 AS i FROM pairs),"
       " ys AS (SELECT id, x, i, unnest(b) AS y, generate_subscripts(b, 1) - 1 AS j FROM xs)"
       " SELECT id, 'abs' AS variant, i, j, abs(x - y) AS cost FROM ys UNION ALL SELECT id, 'sq', i, j, (x - y) * (x - y) FROM ys"
       " UNION ALL SELECT id, 'sqrt', i, j, round(sqrt(abs(x - y)), 6) FROM ys")
def pairwise_cost(spark, sf):
    pairs, out = word_pairs(spark, sf), None
    for variant in ("abs", "sq", "sqrt"):
        cells = dtw.pairwise_cost_rows(pairs, partial(vectors.pairwise_cost, cost=variant))
        cells = cells.withColumn("variant", F.lit(variant)).withColumn("cost", F.round("cost", 6))
        out = cells if out is None else out.unionByName(cells)
    return out
