"""URL filter by host and path rules: a sort-merge range join over reversed-host keys.

A rule (host, path, action) fits its host and all subdomains if the path starts with the rule's
path. Written with its labels reversed (``com.example.``), a host's subdomains lie in one interval,
and a path prefix is an interval of the strings that begin with it. A url therefore asks at each
ancestor host that has rules, and there meets the rules in one sorted sweep. The sweep carries, from
the last rule start that it passed, the stack of the rules nested around that start. Any rule around
the url is on that stack (between a prefix of a string and that string there are only strings with
the prefix), and what has ended meanwhile is taken off by comparing prefixes.

Only DataFrame functions. Hot hosts are dealt over as many salts as they have urls for, with the
host's rules repeated in each; equal urls are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskstream.llm.common import written

#: Urls of one host that share a sweep, unless the host has so many rules that repeating them would
#: cost more than the urls: then ten urls for each rule.
SWEEP = 128


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(labels: Column, depth: Column) -> Column:
    """Canonical key of the last ``depth`` labels, outermost first, each ended by a dot."""
    return F.concat(F.array_join(F.slice(F.reverse(labels), F.lit(1), depth), "."), F.lit("."))


def nested_rules(rules: DataFrame) -> DataFrame:
    """(anchor, path, stack): each rule start with all rules of its host whose path begins it.

    Rules without host are ignored, a missing path is empty, any action but ``allow`` blocks. Of
    equal rules the blocking one stays.
    """
    labels = F.split("host", "\\.", -1)
    clean = (rules.select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                          F.coalesce(F.lower("action") == "allow", F.lit(False)).alias("allow"))
             .where("host <> ''").groupBy("host", "path").agg(F.min("allow").alias("allow"))
             .select(host_key(labels, F.size(labels)).alias("anchor"), "host", "path", "allow"))
    lengths = clean.groupBy("anchor").agg(F.collect_set(F.length("path")).alias("lengths"))
    starts = (clean.join(lengths, "anchor").select("anchor", "path", F.explode("lengths").alias("n"))
              .where("n <= length(path)")
              .select("anchor", F.col("path").alias("start"), F.expr("left(path, n)").alias("path")))
    return (starts.join(clean, ["anchor", "path"])
            .groupBy("anchor", "start")
            .agg(F.collect_list(F.struct(
                (F.length("host") + F.length("path")).alias("n"), F.length("host").alias("host_n"),
                F.concat("host", "path").alias("rule"), "path", "allow")).alias("stack"))
            .withColumnRenamed("start", "path"))


def judge_urls(spark: SparkSession, pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages`` (page_id, url).

    The longest fitting rule (host and path together; then the longer host) decides; ``rule`` is its
    host and path, null where none fits, and then ``default`` is the verdict. A null url or one
    without ``://`` has empty host and path and so no rule. Other columns of ``pages`` are ignored,
    repeated rows stay, an empty table or no rules at all are allowed.
    """
    stacks = written(nested_rules(rules), "rules")
    depth = rules.agg(F.max(F.size(F.split("host", "\\.", -1)))).first()[0] or 0
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = F.split("host", "\\.", -1)
    probes = (urls.select("host", "path").where("host <> ''").distinct()
              .select("host", "path", labels.alias("labels"))
              .select("host", "path", "labels",
                      F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size("labels"), F.lit(depth))))).alias("d"))
              .select("host", "path", host_key(F.col("labels"), F.col("d")).alias("anchor")))
    ruled = written(stacks.groupBy("anchor").agg(F.count("*").alias("rules")), "ruled")
    probes = probes.join(ruled, "anchor")

    most = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = written(
        probes.groupBy("anchor").agg(F.count("*").alias("n"), F.first("rules").alias("r"))
        .select("anchor", F.least(F.lit(most), F.ceil(F.col("n") / F.greatest(F.lit(SWEEP), 10 * F.col("r")))).cast("int").alias("salts")), "salts")
    asked = (probes.join(salts, "anchor")
             .select("anchor", F.pmod(F.xxhash64("host", "path"), F.col("salts")).cast("int").alias("salt"),
                     "path", F.lit(1).alias("kind"), "host", F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack")))
    given = (stacks.join(salts, "anchor")
             .select("anchor", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                     "path", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack"))
    sweep = (Window.partitionBy("anchor", "salt").orderBy("path", "kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    active = F.filter(F.last("stack", ignorenulls=True).over(sweep), lambda r: F.col("path").startswith(r["path"]))
    fits = (given.unionByName(asked).withColumn("active", active).where("kind = 1 and size(active) > 0")
            .groupBy("host", "path").agg(F.max(F.array_max("active")).alias("best"))
            .select("host", "path", "best.rule", "best.allow"))
    verdict = (F.when(F.col("rule").isNull(), default).when(F.col("allow"), "allow").otherwise("block"))
    return (urls.join(fits, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", verdict.alias("verdict")))
