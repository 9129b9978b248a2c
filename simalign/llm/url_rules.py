"""Block and allow lists of hosts and paths, applied to a table of URLs.

A rule names a host and the beginning of a path. It fits that host and all its subdomains, if
the path of the URL starts with the path of the rule. Of the rules that fit, the longest decides.

1.  A URL becomes expressions: every suffix of its host, label by label, with every prefix of
    its path that ends with a slash, and the empty one. Only as many labels and slashes as
    rules have are expanded, so a very long path makes no more expressions than a short one.
2.  A rule becomes one such expression: its host and its path up to the last slash.
3.  Expressions meet on the first 32 bits of their SHA-256. What meets is confirmed on the
    whole digest and on the rest of the rule's path; then the precedence decides.

Everything is Spark's own expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simalign.session import stage

#: Rule tables up to this many rows and bytes are broadcast; others are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16 << 20
#: URL expressions of one hash prefix that meet in one task of that shuffle.
HOT_ROWS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both are empty for NULL and without `://`.

    The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z as a-z; the
    path goes on from there up to `?`, `#` or the end.
    """
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _digest(host: Column, path: Column) -> Column:
    # a host holds no slash, so the two cannot be cut in another place
    return F.unhex(F.sha2(F.concat(host, path), 256))


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long")


def expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Array of digests of host suffixes with path prefixes, for rules of at most so many
    labels and slashes."""
    n_labels = F.least(_count(host, ".") + 1, F.lit(labels))
    n_slashes = F.least(_count(path, "/"), F.lit(slashes))
    hosts = F.transform(F.sequence(F.lit(1), n_labels), lambda i: _suffix(host, i))
    paths = F.transform(F.sequence(F.lit(0), n_slashes), lambda d: _head(path, d))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: _digest(h, p))))


def _suffix(host: Column, labels: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -labels)


def _head(path: Column, slashes: Column) -> Column:
    head = F.concat(F.call_function("substring_index", path, F.lit("/"), slashes), F.lit("/"))
    return F.when(slashes == 0, F.lit("")).otherwise(head)


def _prepared(rules: DataFrame) -> DataFrame:
    """(_uf_prefix, _uf_digest, _uf_path, _uf_rank) of the rules, with their labels and slashes."""
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    slashes = _count(path, "/")
    digest = _digest(host, _head(path, slashes))
    rank = F.struct(
        F.length(F.concat(host, path)).alias("length"), F.length(host).alias("host_length"),
        (F.col("verdict") == "block").alias("blocks"), F.concat(host, path).alias("rule"), F.col("verdict").alias("verdict"),
    )
    return (
        rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(digest.alias("_uf_digest"), path.alias("_uf_path"), rank.alias("_uf_rank"),
                (_count(host, ".") + 1).alias("_uf_labels"), slashes.alias("_uf_slashes"))
        .withColumn("_uf_prefix", _prefix(F.col("_uf_digest")))
    )


def apply_rules(
    urls: DataFrame, rules: DataFrame, url_col: str = "url", prefix: str = "", default: str = "allow",
    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`urls` with host, path, rule and verdict, one row per row.

    `rules` has (host, path, verdict), verdicts `allow` or `block`; rules with a NULL are left
    out, equal rules count once. The longest rule decides (host and path together), then the
    longer host, then `block` before `allow`. `rule` is NULL where none fits, and the verdict
    is then `default`. The new columns take `prefix`; earlier columns of these names go, all
    others are kept. NULL and empty URLs, and those without `://`, have an empty host and path;
    repeated rows are judged alike; empty tables give empty results or the default.

    The rows are written once, with a number each, so that what fits can be put together again
    by that number, which no two rows share. Rules are broadcast within `broadcast_rows`
    and a bound on their bytes. Beyond, they are joined by a shuffle; a hash prefix with more
    than `hot_rows` expressions (a host of a third of all URLs, say) is cut into pieces, and its
    few rules are repeated for each.
    """
    new = [prefix + c for c in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url_col))
    kept = [c for c in urls.columns if c not in new]
    numbered = stage(
        urls.withColumns({"_uf_host": host, "_uf_path_of": path, "_uf_row": F.monotonically_increasing_id()}).select(
            *kept, "_uf_host", "_uf_path_of", "_uf_row"
        )
    )

    ready = stage(_prepared(rules).distinct())
    size = ready.agg(
        F.count("*").alias("n"), F.sum(F.length("_uf_rank.rule") + F.lit(80)).alias("bytes"),
        F.max("_uf_labels").alias("labels"), F.max("_uf_slashes").alias("slashes"),
    ).first()
    fitting = None
    if size["n"]:
        every = expressions(F.col("_uf_host"), F.col("_uf_path_of"), size["labels"], size["slashes"])
        asked = numbered.select("_uf_row", "_uf_path_of", F.explode(every).alias("_uf_asked")).withColumn(
            "_uf_prefix", _prefix(F.col("_uf_asked"))
        )
        ready = ready.drop("_uf_labels", "_uf_slashes")
        if size["n"] <= broadcast_rows and size["bytes"] <= BROADCAST_BYTES:
            met = asked.join(F.broadcast(ready), "_uf_prefix")
        else:
            met = _salted(asked, ready, hot_rows)
        confirmed = (F.col("_uf_asked") == F.col("_uf_digest")) & F.startswith("_uf_path_of", F.col("_uf_path"))
        fitting = met.filter(confirmed).groupBy("_uf_row").agg(F.max("_uf_rank").alias("_uf_best"))
    if fitting is None:
        judged = numbered.withColumns({"_uf_rule": F.lit(None).cast("string"), "_uf_verdict": F.lit(default)})
    else:
        judged = numbered.join(fitting, "_uf_row", "left").withColumns(
            {"_uf_rule": F.col("_uf_best.rule"), "_uf_verdict": F.coalesce("_uf_best.verdict", F.lit(default))}
        )
    made = [F.col(c).alias(n) for c, n in zip(("_uf_host", "_uf_path_of", "_uf_rule", "_uf_verdict"), new, strict=True)]
    return judged.select(*kept, *made)


def _salted(asked: DataFrame, rules: DataFrame, hot_rows: int) -> DataFrame:
    """The join on hash prefixes by a shuffle, prefixes of very many expressions in pieces."""
    in_use = rules.select("_uf_prefix").distinct()
    # counted before the shuffle, so at most expressions / hot_rows prefixes are left
    hot = (
        asked.groupBy("_uf_prefix").agg(F.count("*").alias("_uf_n")).filter(F.col("_uf_n") > hot_rows)
        .join(in_use, "_uf_prefix", "left_semi")
        .select("_uf_prefix", F.ceil(F.col("_uf_n") / hot_rows).cast("int").alias("_uf_pieces"))
    )
    hot = stage(hot)
    pieces = F.coalesce("_uf_pieces", F.lit(1))
    left = asked.join(F.broadcast(hot), "_uf_prefix", "left").withColumn("_uf_piece", F.pmod(F.xxhash64("_uf_row"), pieces).cast("int"))
    right = rules.join(F.broadcast(hot), "_uf_prefix", "left").withColumn("_uf_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return left.drop("_uf_pieces").join(right.drop("_uf_pieces").hint("merge"), ["_uf_prefix", "_uf_piece"])
