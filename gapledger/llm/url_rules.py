"""Host and path rules by a sort-merge sweep over reversed hosts.

``news.example.net`` becomes ``net.example.news.``. The hosts under a rule's host
are then one interval of the sort order, the strings that start with the rule's
own key, and such intervals nest or are disjoint. Rules and urls are sorted
together; along the order, the stack of open intervals after a rule is that rule
and the rules it lies in. Each rule row carries that stack, so the sweep is a
running ``last`` over rows that bring one; what no longer covers the url's key is
popped by a prefix test.

The urls are dealt by hash into slices that are swept side by side, so a host with
a third of all urls is spread like any other. Every slice sweeps all rules: the rule
rows are ``slices * rules``, which is small for any rule list that a person or a
feed maintains, and they are never collected or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapledger.llm.text import lower_ascii


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """Lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from last to first, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_stacks(spark: SparkSession, rules: Iterable[UrlRule]) -> DataFrame:
    """``_key, _stack``: for each rule host the rules of it and of the hosts it lies under, the longest first."""
    by_host: dict[str, list[UrlRule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    rows = []
    for host in by_host:
        labels = host.split(".")
        above = [".".join(labels[i:]) for i in range(len(labels))]
        stack = [r for h in above for r in by_host.get(h, [])]
        # The longest rule wins; of equal ones the deeper host, then block.
        stack.sort(key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))
        reverse = lambda h: ".".join(reversed(h.split("."))) + "."
        rows.append((reverse(host), [(reverse(r.host), r.path, r.text, r.verdict) for r in stack]))
    schema = "_key string, _stack array<struct<key:string,path:string,rule:string,verdict:string>>"
    return spark.createDataFrame(rows, schema)


def judge_urls(
    pages: DataFrame, rules: Iterable[UrlRule], id_column: str = "page_id", url_column: str = "url",
    default: str = "allow", slices: int | None = None,
) -> DataFrame:
    """``<id>, host, path, rule, verdict`` for each row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The longest rule wins; without one, ``rule`` is null and the verdict is
    ``default``. A null url or one without ``://`` has empty host and path and so
    fits no rule. Repeated rows give repeated rows, an empty table an empty one, and
    other columns of ``pages`` are not read.
    """
    spark = pages.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(F.col(id_column).alias("_id"), F.col(url_column).cast("string").alias("_url"))
    urls = urls.select(
        F.lit(False).alias("_is_rule"), "_id", url_host(F.col("_url")).alias("host"),
        url_path(F.col("_url")).alias("path"),
        F.pmod(F.xxhash64("_id", "_url"), F.lit(slices)).cast("int").alias("_slice"),
    ).withColumn("_key", host_key(F.col("host")))
    stacks = rule_stacks(spark, rules).select(
        F.lit(True).alias("_is_rule"), "_key", "_stack",
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"),
    )
    swept = urls.unionByName(stacks, allowMissingColumns=True)
    # At one key the rule comes first, since the interval includes its start.
    sweep = Window.partitionBy("_slice").orderBy("_key", F.col("_is_rule").desc())
    sweep = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumn("_open", F.last("_stack", ignorenulls=True).over(sweep)).filter(~F.col("_is_rule"))
    fits = F.filter("_open", lambda r: F.col("_key").startswith(r["key"]) & F.col("path").startswith(r["path"]))
    return swept.withColumn("_rule", F.get(fits, F.lit(0))).select(
        F.col("_id").alias(id_column), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.lit(default)).alias("verdict"),
    )
