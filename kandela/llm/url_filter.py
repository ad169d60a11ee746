"""URL rules as a sort-merge range join; built-in functions only.

A rule fits its host with all subdomains and every path that starts with its own. Written with the labels
of the host reversed (``net.example.``), a rule's hosts are all keys that start with its key: one interval
in byte order. Intervals of prefixes nest or are apart, so while sorted keys pass by, the rules that hold
form a stack: a rule's first key pushes it, its end pops it. Both are put into the sorted stream as break
points that carry the whole stack, and a running ``last`` hands it to the keys that follow. The stream is
range-partitioned; what holds where a range begins comes from one row per range.

Two sweeps run: one over the different hosts, one over the different (rule host, path) pairs that the
first one found. A host or page that holds a third of all rows is therefore one key in the sweeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kandela.llm.text import ascii_lower
from kandela.session import materialise

AFTER_ALL = b"\xff"  # no UTF-8 text holds this byte, so prefix + byte ends the prefix's interval


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``key, stack``: for each different key of ``points`` the keys of ``rules`` it starts with, shortest first."""
    spark = points.sparkSession
    prefixes = rules.select("key").distinct()
    heads = prefixes.select("key", F.explode(F.sequence(F.lit(1), F.char_length("key"))).alias("n")).select(
        "key", F.substring("key", F.lit(1), F.col("n")).alias("head"))
    nested = (heads.join(prefixes.select(F.col("key").alias("head")), "head")
              .groupBy("key").agg(F.sort_array(F.collect_list(F.struct(F.char_length("head").alias("n"), "head"))).alias("s"))
              .select("key", F.col("s.head").alias("stack")))
    raw = F.col("key").cast("binary")
    push = nested.select(raw.alias("at"), F.lit(0).alias("is_point"), F.lit(None).cast("string").alias("key"), "stack")
    pop = nested.select(F.concat(raw, F.lit(AFTER_ALL)).alias("at"), F.lit(0).alias("is_point"),
                        F.lit(None).cast("string").alias("key"),
                        F.slice("stack", F.lit(1), F.size("stack") - 1).alias("stack"))
    keys = points.select("key").distinct().select(
        raw.alias("at"), F.lit(1).alias("is_point"), "key", F.lit(None).cast("array<string>").alias("stack"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = materialise(push.unionByName(pop).unionByName(keys).repartitionByRange(parts, "at")
                         .withColumn("range", F.spark_partition_id()), "sweep")

    ends = stream.groupBy("range").agg(F.max_by("stack", F.when(F.col("is_point") == 0, F.col("at"))).alias("end"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    entering = ends.select("range", F.last("end", ignorenulls=True).over(before).alias("entering"))  # one row per range
    within = Window.partitionBy("range").orderBy("at", "is_point").rowsBetween(Window.unboundedPreceding, 0)
    swept = stream.withColumn("held", F.last("stack", ignorenulls=True).over(within)).where("is_point = 1")
    return swept.join(entering, "range").select(
        "key", F.coalesce("held", "entering", F.array().cast("array<string>")).alias("stack"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id",
               url_column: str = "url") -> DataFrame:
    """``id, host, path, rule, verdict``: one row per page, repeated rows included.

    ``rules`` has host, path and verdict; the longest that fits wins (length of host and path, then of the
    host; of equal rules with different verdicts ``block``). A rule without host or verdict is left out,
    a null path is empty. A page without a fitting rule gets a null rule and ``default``. Null and
    malformed urls have empty host and path. Other columns of ``pages`` are not read.
    """
    known = (rules.where("host IS NOT NULL AND host <> '' AND verdict IS NOT NULL")
             .select(ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
             .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
             .withColumn("host_key", reversed_host(F.col("rule_host"))))
    host, path = url_parts(F.col(url_column))
    urls = materialise(pages.select(F.col(id_column), host.alias("host"), path.alias("path")), "url-parts")
    places = urls.select("host", "path").distinct()

    hosts = urls.select("host").distinct().withColumn("key", reversed_host(F.col("host")))
    fitting = sweep(hosts, known.select(F.col("host_key").alias("key"))).where(F.size("stack") > 0)
    ruled = hosts.join(fitting, "key").select("host", F.explode("stack").alias("host_key"))
    pairs = places.join(ruled, "host").select("host", "path", "host_key", _place("host_key", "path").alias("key"))
    best = sweep(pairs, known.select(_place("host_key", "rule_path").alias("key")))
    top = best.where(F.size("stack") > 0).select("key", F.try_element_at("stack", F.lit(-1)).alias("rule_key"))
    named = known.select(_place("host_key", "rule_path").alias("rule_key"), F.concat("rule_host", "rule_path").alias("rule"),
                         F.char_length("rule_host").alias("host_length"), "verdict")
    longest = (pairs.join(top, "key").join(named, "rule_key").groupBy("host", "path")
               .agg(F.max(F.struct(F.char_length("rule").alias("n"), "host_length", "rule", "verdict")).alias("won")))
    longest = materialise(longest, "url-rules")  # stored, so that the join can split a hot page
    # It grows with the pages, so it is merged, never broadcast.
    judged = urls.join(longest.hint("merge"), ["host", "path"], "left")
    return judged.select(id_column, "host", "path", F.col("won.rule").alias("rule"),
                         F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


def _place(host_key: str, path: str) -> Column:
    return F.concat(F.col(host_key), F.lit("\x00"), F.col(path))
