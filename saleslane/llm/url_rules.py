"""URL filters: allow and block rules on hosts and paths, as a sort-merge range join.

A rule (host, path) fits a url if the url's host is the rule's or below it and the url's path
starts with the rule's.  A canonical key is the host with its labels reversed, a slash, and the
path.  A rule is the interval of keys that start with its own; a url has one key for each of its
host's endings (``a.b.org``: ``org``, ``org.b``, ``org.b.a``).

Intervals of prefixes are nested or apart.  The sweep sorts rule starts and url keys together and
carries the stack of rules that are active at the last start.  A url's innermost rule is the longest
member of that stack that its key starts with.  The stacks come from an equi-join of rule keys with
the prefixes of rule keys.

Urls are dealt out by a hash, so a host with a third of all rows spreads evenly; the rule starts are
repeated for each of ``salts`` parts.  Both the sweep and the choice among a url's keys then run in
the same partitions, so the whole is one shuffle of the urls.  Only DataFrame operations are used.

Cases: a null url or one without ``://`` has an empty host and path and fits no rule that names a
host.  Repeated rows are judged alike, one output row each; a null page_id is kept.  Of rules for
the same host and path a block wins; among fitting rules the longest host and path together wins,
then a block, then the first in order.  Rules with a null in any column are skipped.  Columns of
pages besides the id and url are ignored.  Empty pages give no rows; without rules every verdict is
the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What stands between the host and the next ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_starts(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule's key and all rules whose interval holds it, itself included."""
    host = ascii_lower(F.col("host"))
    known = (
        rules.select(host.alias("host"), "path", "verdict")
        .na.drop()
        .groupBy("host", "path")
        .agg(F.max(F.col("verdict") == "block").alias("blocks"), F.min("verdict").alias("verdict"))
        .select(
            F.concat(F.array_join(_labels(F.col("host")), "."), F.lit("/"), "path").alias("key"),
            F.concat("host", "path").alias("rule"),
            F.when(F.col("blocks"), "block").otherwise(F.col("verdict")).alias("verdict"),
        )
    )
    prefixes = known.select(
        F.col("key").alias("of"),
        F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("key"),
    )
    return (
        prefixes.join(known, "key")
        .groupBy(F.col("of").alias("key"))
        .agg(F.collect_list(F.struct(F.length("rule").alias("size"), "key", "rule", "verdict")).alias("stack"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule (null if none fits) and verdict."""
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    url = F.coalesce("url", F.lit(""))
    seen = pages.select(
        F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("salt"),
        "page_id",
        "url",
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.monotonically_increasing_id().alias("row"),
    )
    labels = _labels(F.col("host"))
    keys = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit("/"), F.col("path")),
    )
    urls = seen.select(
        "salt", "row", "page_id", "host", "path", F.explode(keys).alias("key"),
        F.lit(None).cast("array<struct<size:int,key:string,rule:string,verdict:string>>").alias("stack"),
    )
    none = {c: F.lit(None).cast(urls.schema[c].dataType).alias(c) for c in ("row", "page_id", "host", "path")}
    starts = _rule_starts(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        *none.values(),
        "key",
        F.col("stack").cast("array<struct<size:int,key:string,rule:string,verdict:string>>").alias("stack"),
    )
    sweep = Window.partitionBy("salt").orderBy("key", F.col("row").isNotNull())
    active = F.filter(
        F.last("stack", ignorenulls=True).over(sweep.rowsBetween(Window.unboundedPreceding, 0)),
        lambda r: F.startswith(F.col("key"), r["key"]),
    )
    best = F.array_max(
        F.transform(active, lambda r: F.struct(r["size"].alias("size"), (r["verdict"] == "block").alias("block"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))
    )
    chosen = (
        urls.unionByName(starts)
        .withColumn("best", best)
        .filter("row is not null")
        .groupBy("salt", "row", "page_id", "host", "path")
        .agg(F.max("best").alias("best"))
    )
    return chosen.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
