"""Registered queries of the dealt operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simalign.llm import (
    decontaminate, files, main_text, merkle, mixing, near_dups, ordinal, pii, quality_rules, shards, token_codes, url_rules,
    vector_codes, warc,
)
from simalign.session import stage
from simalign.sources.files import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB queries for the same rows, where SQL can express them.
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_token_codes")
def token_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_codes.read_index(token_codes.write_codes(docs, files.new_folder(spark, "codes")))


@query("op2_mix_sources")
def mix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    sized = stage(docs)  # counted once, read twice
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", taken, "source", "copies")


OP3_SQL = """
SELECT page_id, payload_bytes, payload_digest,
 CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN first <> page_id THEN first END AS refers_to
FROM (
 SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
 FROM (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
  sha256(coalesce(html, '')) AS payload_digest FROM pages)
)
"""


@query("op3_warc_chunks", OP3_SQL)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_archives(manifest, with_data=False).select(
        F.col("name").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )


@query("op7_shuffle_shards")
def shard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


OP9_SQL = r"""
WITH RECURSIVE w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
 SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 2), ' ') AS sh
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
 SELECT x, y FROM met JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM n UNION SELECT reach.doc_id, y FROM reach JOIN edges ON x = r),
least AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(r, w.doc_id) AS component_id, coalesce(r, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op9_odd_sketches", OP9_SQL)
def near_duplicate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dups.near_duplicates(docs, k=3, similarity=0.85)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)


OP4_SQL = r"""
WITH w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
 SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
 SELECT DISTINCT item_id, n, list_slice(w, i, i + n - 1) AS win
 FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM items),
places AS (
 SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
 FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, lengths WHERE len(w) >= n)
), found AS (
 SELECT p.doc_id, p.i, p.n, t.item_id FROM places p JOIN items t ON p.n = t.n AND p.win = t.win
), hits AS (
 SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), named AS (
 SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
 CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op4_prefix_join", OP4_SQL)
def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


@query("op10_fertility")
def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), keep=["doc_id"])


@query("op6_semi_markov")
def personal_data_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_added"
    )


@query("op8_block_rules")
def main_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages, keep=["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


#: A document is kept if it is at least of grade 1, that is not toxic, with this chance.
KEEP_CHANCE = 0.95


@query("op5_ordinal")
def ordinal_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("_id"), ordinal.grade(F.col("quality"), F.col("toxic")).alias("grade")
    )
    rated = docs.join(labels, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")
    model = ordinal.train(rated, "text", "grade", "doc_id", n_grades=3)
    scored = ordinal.score(docs, model, keep=["doc_id"])
    return scored.withColumn("kept", F.col("p_at_least_1") >= KEEP_CHANCE)


def _lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round as three tables: nearest entries, components by entry, moved entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, label, p, v, min({{'d': d, 'e': e}}) AS m FROM (SELECT vec_id, label, p, v, e,"
            f" CAST(list_sum(list_transform(range(1, len(v) + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT) AS d"
            f" FROM parts JOIN b{r} USING (p)) GROUP BY vec_id, label, p, v)"
        )
        if r == rounds:
            break
        steps.append(
            f"s{r} AS MATERIALIZED (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (SELECT p, m.e AS e, unnest(v) AS x,"
            f" unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY ALL)"
        )
        steps.append(
            f"b{r + 1} AS MATERIALIZED (SELECT b{r}.p, b{r}.e, coalesce(mean, c) AS c FROM b{r} LEFT JOIN (SELECT p, e,"
            f" list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS mean FROM s{r} GROUP BY p, e) x ON x.p = b{r}.p AND x.e = b{r}.e)"
        )
    return (
        "WITH whole AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v"
        " FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),"
        f" parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM whole, range({parts}) t(p)),"
        f" seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM whole ORDER BY vec_id LIMIT {entries}),"
        " b0 AS MATERIALIZED (SELECT p, e, v AS c FROM parts JOIN seeds USING (vec_id)), "
        + ", ".join(steps)
        + f", coded AS (SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error"
        f" FROM a{rounds} GROUP BY vec_id, label),"
        f" books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})"
        " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"
    )


@query("op11_active_lloyd", _lloyd_sql())
def vector_code_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    summed = vector_codes.add_total(coded, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", digest)


# The rules of the query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

OP12_SQL = (
    "WITH rules(h, p, v) AS (VALUES " + ", ".join(map(str, URL_RULES)) + r"""),
parts AS (
 SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
 FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), ranked AS (
 SELECT page_id, host, path, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS r
 FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM ranked WHERE r = 1
"""
)


@query("op12_url_rules", OP12_SQL)
def url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.apply_rules(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


DOCUMENT_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _merkle_sql(levels: int = 6, group_levels: int = 2, fanout: int = 8) -> str:
    """Trees level by level, for groups of up to fanout ** levels rows and fanout ** group_levels groups.

    `n` tables hold (tree, i, h) of a level; a tree that is down to one node stays as it is.
    """
    def up(name: str, below: str, tree: str) -> str:
        return (
            f"{name} AS MATERIALIZED (SELECT {tree} AS t, i // {fanout} AS i, CASE WHEN any_value(w) = 1 THEN any_value(h)"
            f" ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS w FROM {below}) GROUP BY {tree}, i // {fanout})"
        )

    def others(below: str, tree: str, place: str, alias: str) -> str:
        return (
            f"(SELECT coalesce(string_agg(x.h, '' ORDER BY x.i), '') FROM {below} x WHERE x.t = {tree} AND x.i // {fanout} = {place} // {fanout} AND x.i <> {place})"
            f" AS {alias}"
        )

    def fold(node: str, below: str, tree: str, place: str) -> str:
        return (
            f"(SELECT CASE WHEN (SELECT count(*) FROM {below} y WHERE y.t = {tree}) = 1 THEN {node} ELSE"
            f" sha256(string_agg(CASE WHEN x.i = {place} THEN {node} ELSE x.h END, '' ORDER BY x.i)) END"
            f" FROM {below} x WHERE x.t = {tree} AND x.i // {fanout} = {place} // {fanout})"
        )

    def value(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*[value(f"d.{c}") for c in DOCUMENT_COLUMNS[:-1]], value(text)]) + ")"

    # crc32: a byte at a time, each of its 8 shifts by the polynomial 0xEDB88320
    shift = "list_reduce(list_concat([xor(c, ascii(rest)::BIGINT)], range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    lower = "translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        "trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT lang FROM documents))",
        "digits AS (SELECT doc_id, 4294967295::BIGINT AS c, CAST(doc_id AS VARCHAR) AS rest FROM documents)",
        "crcs AS (SELECT doc_id, xor(c, 4294967295) AS crc FROM walk WHERE rest = '')",
        f"rows_ AS MATERIALIZED (SELECT d.doc_id, t, row_number() OVER (PARTITION BY t ORDER BY d.doc_id) - 1 AS i, {leaf('d.text')} AS h,"
        f" CASE WHEN crc % 3 = 0 THEN {leaf(lower)} ELSE {leaf('d.text')} END AS other"
        " FROM documents d JOIN trees ON d.lang IS NOT DISTINCT FROM trees.lang LEFT JOIN crcs ON crcs.doc_id = d.doc_id)",
        "n0 AS MATERIALIZED (SELECT t, i, h FROM rows_)",
    ]
    walk = (
        f"walk AS (SELECT * FROM digits UNION ALL SELECT doc_id, {shift}, rest[2:] FROM walk WHERE rest <> '')"
    )
    steps.insert(2, walk)
    for level in range(levels):
        steps.append(up(f"n{level + 1}", f"n{level}", "t"))
    steps.append(f"g0 AS MATERIALIZED (SELECT 0 AS t, t AS i, h FROM n{levels})")
    for level in range(group_levels):
        steps.append(up(f"g{level + 1}", f"g{level}", "t"))
    proof, last = [], "rows_"
    stages = [(f"n{k}", "t", "i", fanout**k) for k in range(levels)] + [(f"g{k}", "0", "t", fanout**k) for k in range(group_levels)]
    for number, (below, tree, place, span) in enumerate(stages):
        tree, place = (tree if tree == "0" else f"l.{tree}"), f"(l.{place} // {span})"
        steps.append(
            f"f{number} AS MATERIALIZED (SELECT l.* EXCLUDE (other), {fold('l.other', below, tree, place)} AS other, {others(below, tree, place, f'o{number}')} FROM {last} l)"
        )
        proof.append(f"o{number}")
        last = f"f{number}"
    return (
        "WITH RECURSIVE " + ", ".join(steps)
        + f" SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, other AS folded_root,"
        f" other = r.h AS verified FROM {last} l JOIN n{levels} s ON s.t = l.t, g{group_levels} r"
    )


@query("op13_merkle_butterfly", _merkle_sql())
def manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) & F.col("text").isNotNull()
    lowered = F.translate("text", url_rules.UPPER, url_rules.LOWER)
    first = [F.col(c) for c in DOCUMENT_COLUMNS[:-1]]
    leaves = docs.select(
        "doc_id", "lang", merkle.leaf_hash(*first, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.leaf_hash(*first, lowered)).alias("_other"),
    )
    listed = merkle.manifest(leaves, "leaf", "lang", "doc_id")
    found = listed.withColumn("folded_root", merkle.folded(F.coalesce("_other", "leaf"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
