"""Block and allow rules on urls by a sort-merge range join.

A host is read backwards, label by label (``a.example.net`` is
``net.example.a.``), so a rule's host and all its subdomains are one interval
of such keys: from ``net.example.`` up to, without, ``net.example/`` ("/" comes
next after "."). Host intervals are disjoint or nested. Rules and urls are
sorted together by key; along that order a stack of the open intervals is kept
(one slot for each level of nesting, holding the rules of the interval opened
last at that level), and a url sees the slots up to the current depth. Among
their rules whose path starts the url's path the longest wins (the longer host
on a tie, then the smaller rule text).

Scale: urls are dealt into ``buckets`` by hash, so a host with a third of all
rows is spread evenly; each bucket is swept on its own with a copy of the
rules' interval ends. That is one shuffle of (row, host, path) and a sort, with
two small rows per rule and bucket; the window keeps the slots only.

Edge cases: a null url or one without "://" has empty host and path and no rule;
a rule without a host is an error; of equal rules block wins; an empty rule
list leaves every url to the default verdict; repeated rows are judged row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vesseltrack.operators.joins import maybe_broadcast
from vesseltrack.session import materialize

from .common import ASCII_LOWER, ASCII_UPPER

# The rules of the query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
DEFAULT = "allow"
BROADCAST_HOSTS = 100_000


RULE_LIST = "array<struct<path:string,rule:string,verdict:string>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url as the contract defines them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    rest = F.regexp_extract(rest, r"^[^?#]*", 0)
    slash = F.instr(rest, "/")
    host = F.when(slash > 0, F.substr(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))
    return (F.coalesce(F.translate(host, ASCII_UPPER, ASCII_LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def host_key(host: Column) -> Column:
    """``a.example.net`` as ``net.example.a.``; an empty host has an empty key."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def rule_table(spark, rules=None) -> DataFrame:
    """rule (host and path), verdict."""
    return spark.createDataFrame(RULES if rules is None else rules, "rule string, verdict string")


def intervals(rules: DataFrame) -> DataFrame:
    """One row per rule host: key, level (1 outermost) and its rules."""
    r = rules.groupBy("rule").agg(F.max("verdict").alias("verdict")).select(  # "block" > "allow"
        "rule", "verdict", F.substring_index("rule", "/", 1).alias("host"))
    r = r.withColumn("path", F.expr("substr(rule, length(host) + 1)")).withColumn("key", host_key(F.col("host")))
    r = r.withColumn("key", F.when(F.col("host") == "", F.raise_error(F.concat(F.lit("rule without host: "), "rule"))).otherwise(F.col("key")))
    hosts = r.groupBy("key", "host").agg(F.collect_list(F.struct("path", "rule", "verdict")).alias("rules"))
    # level: how many rule hosts are label prefixes of this one, itself included
    labels = F.split(F.expr("substr(key, 1, length(key) - 1)"), r"\.")
    ups = hosts.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)),
                                                    lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))).alias("up"))
    level = ups.join(hosts.select(F.col("key").alias("up")), "up").groupBy("key").agg(F.count("*").cast("int").alias("level"))
    return hosts.join(level, "key")


def host_stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host and its rules (path, rule, verdict), of the different hosts that lie in a rule's interval."""
    opened = materialize(intervals(rules), "url-rules")
    depth = opened.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]
    if not depth:
        return hosts.select("host", F.lit(None).cast(RULE_LIST).alias("stack")).limit(0)
    none = F.lit(None).cast(RULE_LIST)
    # order at one key: intervals close (inner first), then open (outer first), then come the hosts
    opens = opened.select("key", F.lit(1).alias("kind"), "level", "rules")
    closes = opened.select(F.expr("concat(substr(key, 1, length(key) - 1), '/')").alias("key"), F.lit(0).alias("kind"), "level", none.alias("rules"))
    seen = hosts.distinct().select(host_key(F.col("host")).alias("key"), F.lit(2).alias("kind"), "host")
    events = opens.unionByName(closes).unionByName(seen, allowMissingColumns=True)
    # rows of one key share a range; a range's number is written with its rows
    ranged = materialize(events.repartitionByRange("key").withColumn("range", F.spark_partition_id()), "url-ranges")
    first = ranged.groupBy("range").agg(F.min("key").alias("first"))
    # open before a range and not closed before it: the strict prefixes of its first key, and what that key itself closes
    ends = F.sequence(F.lit(0), F.length("first") - 1)
    above = F.filter(F.transform(ends, lambda n: F.substring("first", F.lit(1), n)), lambda p: F.endswith(p, F.lit(".")))
    closed = F.when(F.endswith("first", F.lit("/")), F.array(F.expr("concat(substr(first, 1, length(first) - 1), '.')"))).otherwise(F.array())
    prefix = F.when(F.col("first") != "", F.concat(above, closed))
    carried = first.select("range", F.explode(prefix).alias("up")).join(opened, F.col("up") == F.col("key")).select(
        "range", F.lit("").alias("key"), F.lit(1).alias("kind"), "level", "rules", F.lit(None).cast("string").alias("host"))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)
    slots = [F.last(F.when((F.col("kind") == 1) & (F.col("level") == n), F.col("rules")), ignorenulls=True).over(sweep).alias(f"slot{n}")
             for n in range(1, depth + 1)]
    swept = ranged.unionByName(carried).select("kind", "host", F.sum(step).over(sweep).alias("depth"), *slots).where("kind = 2 and depth > 0")
    stack = F.flatten(F.filter(F.array(*[F.when(F.col("depth") >= n, F.col(f"slot{n}")) for n in range(1, depth + 1)]), lambda s: s.isNotNull()))
    return swept.select("host", stack.alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    stacks = materialize(host_stacks(urls.select("host"), rules), "url-stacks")
    both = urls.join(maybe_broadcast(stacks, broadcast_hosts), "host", "left")
    fits = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    longest = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(r["rule"]).alias("n"), (-F.length(r["path"])).alias("p"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return both.withColumn("best", longest).select(
        "page_id", "host", "path", F.col("best")["rule"].alias("rule"), F.coalesce(F.col("best")["verdict"], F.lit(default)).alias("verdict"))


ORACLE_JUDGE = r"""
WITH r(rule, rhost, rpath, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                              ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT page_id, host, path, rule, v FROM p LEFT JOIN r
      ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(v, length(rule)), 'allow') AS verdict
FROM m GROUP BY page_id, host, path
"""
