"""Allow and block rules on URLs by a sorted sweep over canonical keys.

A rule names a host, with all its subdomains, and a path prefix. A URL stands at one point per suffix of its
host that has rules; a point's key is the reversed host and the path, so the rules of a host are intervals
of keys, nested or disjoint. Points and rules are sorted together; the last rule at or before a point carries
the stack of the rules around it, and the longest of the stack that holds the point fits. The longest rule
over all suffixes (host and path together, then the longer host) wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points that one task sweeps; hosts with more are split.
POINTS_PER_TASK = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z only, and path; both empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per host and path: ``rhost, path, stack``, the rules of the host whose path begins its path,
    shortest first. Each rule's path is met with all its own prefixes by an equality join."""
    own = rules.groupBy(_reversed(F.translate("host", UPPER, LOWER)).alias("rhost"), "path").agg(
        F.min("verdict").alias("verdict")  # equal rules that disagree: allow
    )
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.substring("path", 1, n)))
    inner = own.select("rhost", F.col("path").alias("inner"), prefix.alias("path"))
    return (
        inner.join(own, ["rhost", "path"])
        .groupBy("rhost", F.col("inner").alias("path"))
        .agg(F.array_sort(F.collect_list(F.struct(F.length("path").alias("n"), "path", "verdict"))).alias("stack"))
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    points_per_task: int = POINTS_PER_TASK,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``; rules: ``host, path, verdict``.

    A URL that no rule fits gets ``default``. Null URLs and URLs without ``://`` have empty host and path.
    Rows that repeat come back as often as they came; a null id is an id. No rules: all default.
    Host suffixes without rules leave before the sort, and hosts with many points are split by a salt; the
    rules of such a host, which the rule list bounds, are copied to each of its parts.
    """
    host, path = host_and_path(F.col(url))
    base = pages.select(F.col(page_id).alias("_id"), host.alias("_host"), path.alias("_path"))
    labels = F.reverse(F.split("_host", r"\.", -1))
    suffixes = F.explode(F.transform(F.sequence(F.lit(1), F.size("_l")), lambda n: F.array_join(F.slice("_l", 1, n), ".")))
    stacks = rule_stacks(rules)
    points = base.withColumn("_l", labels).select("_id", "_host", "_path", suffixes.alias("rhost"))
    hosts = stacks.select("rhost").distinct()
    parts = (
        points.groupBy("rhost").count().join(hosts, "rhost")
        .select("rhost", F.ceil(F.col("count") / points_per_task).cast("int").alias("parts"))
    )
    salt = F.pmod(F.xxhash64("_id", "_host", "_path"), F.col("parts")).cast("int")
    no_stack = F.lit(None).cast("array<struct<n:int,path:string,verdict:string>>")
    both = points.join(parts, "rhost").select(
        "rhost", salt.alias("salt"), F.col("_path").alias("key"), F.lit(1).alias("kind"), no_stack.alias("stack"), "_id", "_host"
    ).unionByName(
        stacks.join(parts, "rhost").select(
            "rhost", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("path").alias("key"), F.lit(0).alias("kind"), "stack"
        ),
        allowMissingColumns=True,
    )
    # one column, as a sort by host and salt would be met by the join's shuffle on the host alone
    both = both.withColumn("cell", F.concat_ws("/", F.col("salt").cast("string"), "rhost"))
    sweep = Window.partitionBy("cell").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    hit = swept.where(F.col("stack").isNotNull()).withColumn("_r", F.try_element_at(F.filter("stack", lambda r: F.startswith(F.col("key"), r["path"])), F.lit(-1)))
    rule_host = _reversed(F.col("rhost"))
    found = hit.where(F.col("_r").isNotNull()).select(
        "_id", "_host", F.col("key").alias("_path"), F.lit(0).alias("_n"),
        F.struct(
            (F.length(rule_host) + F.col("_r.n")).alias("length"), F.length(rule_host).alias("host"),
            F.concat(rule_host, F.col("_r.path")).alias("rule"), F.col("_r.verdict").alias("verdict"),
        ).alias("_hit"),
    )
    none = F.lit(None).cast("struct<length:int,host:int,rule:string,verdict:string>")
    rows = base.withColumn("_n", F.lit(1)).withColumn("_hit", none).unionByName(found)
    judged = rows.groupBy("_id", "_host", "_path").agg(F.sum("_n").cast("int").alias("_n"), F.max("_hit").alias("_hit"))
    return judged.select(
        F.col("_id").alias(page_id), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_hit.rule").alias("rule"), F.coalesce("_hit.verdict", F.lit(default)).alias("verdict"), "_n",
    ).withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).drop("_n")


def rule_rows(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")
