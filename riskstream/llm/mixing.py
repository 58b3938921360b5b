"""Mixing sources to target weights with hash-threshold histograms.

Each document has a hash. A source's budget is met by the documents whose hash lies below a
threshold, once for each copy that the budget pays for; the thresholds of the copies are nested, and
all but one of a source are trivial (all or none of it). The threshold is found digit by digit: sizes
are summed by source and next hash digits, the bucket in which the running sum passes the budget is
the boundary, and only its documents are summed by further digits, until one hash is left in it. The
result is a filter; no document is sorted, moved or gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskstream.llm.common import WORD, written

#: Weights of the sources by rank, share of all sizes, and most copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Hex digits of a hash: 2 per round give 256 buckets a source, whatever the size of the input.
DIGITS, PER_ROUND = 32, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_hash(doc_id: Column, text: Column) -> Column:
    """32 hex digits; equal only for rows equal in id and text, which are thus taken together."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit(""))))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> the same with target: ``SHARE`` of all sizes, dealt by the weights in
    code point order of the sources (null last), none above ``MOST`` times its size, the excess
    reshared by weight until none is above.

    The end of that resharing is one level per unit of weight: sources in order of size per weight
    fill up until the level of the rest fits under the next. One row per source, so one task.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (rank % len(WEIGHTS) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", rank.alias("rank"), weight.alias("w"),
                          (F.col("source_size") * float(MOST)).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    levels = ranked.withColumn("level", level).withColumn("at", F.row_number().over(order))
    first = F.min_by("level", F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("at"))).over(everything)
    return (levels.withColumn("first", F.when(F.col("cap") > 0, first))
            .select("source", "source_size",
                    F.coalesce(F.least(F.col("cap"), F.col("first") * F.col("w")), F.lit(0.0)).alias("target")))


def _summed(rows: DataFrame, at: int) -> DataFrame:
    return (rows.groupBy("source", F.substring("h", at + 1, PER_ROUND).alias("digit"))
            .agg(F.sum("size").alias("size"), F.min("h").alias("lo"), F.max("h").alias("hi")))


def _boundary(histogram: DataFrame, budgets: DataFrame) -> DataFrame:
    """The bucket in which each source's running sum passes its budget. Sources that stay below have none."""
    running = Window.partitionBy("source").orderBy("digit")
    passed = F.col("upto") > F.col("budget")
    return (histogram.withColumn("upto", F.sum("size").over(running))
            .join(budgets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .where(passed & (F.col("upto") - F.col("size") <= F.col("budget")) & (F.col("size") > 0))
            .select("source", "digit", "lo", "hi", (F.col("budget") - F.col("upto") + F.col("size")).alias("left"),
                    "size"))


def mix_plan(docs: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, cut, with_cut) per source: every document is taken
    ``copies`` times, and once more if its hash is below ``cut`` (or equal, where ``with_cut``; no cut
    means none is). The documents that share the last hash go in if that comes nearer to the target.

    Missing texts have size 0; a missing source is a source of its own, the last one. An empty table
    gives no rows.
    """
    narrow = written(docs.select("source", word_count(F.col("text")).alias("size"),
                                 mix_hash(F.col("doc_id"), F.col("text")).alias("h")), "mix")
    histogram = written(_summed(narrow, 0), "mix")
    targets = source_targets(histogram.groupBy("source").agg(F.sum("size").alias("source_size")))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = written(targets.withColumn("copies", copies.cast("int"))
                      .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")), "mix")
    one = F.col("lo") == F.col("hi")
    done = None
    budgets = targets.where("budget > 0").select("source", "budget")
    for at in range(0, DIGITS, PER_ROUND):
        found = written(_boundary(histogram, budgets), "mix")
        ended = (found.where(one).select("source", F.col("lo").alias("cut"),
                                         (F.col("size") - F.col("left") < F.col("left")).alias("with_cut")))
        done = ended if done is None else done.union(ended)
        going = found.where(~one)
        if going.isEmpty():
            break
        budgets = going.select("source", F.col("left").alias("budget"))
        prefix = going.select(F.col("source").alias("s"), F.substring("lo", 1, at + PER_ROUND).alias("p"))
        inside = narrow.join(prefix, F.col("source").eqNullSafe(F.col("s")) & F.col("h").startswith(F.col("p")))
        histogram = written(_summed(inside.select("source", "size", "h"), at + PER_ROUND), "mix")
    plan = targets.join(done.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    return written(plan.select("source", "source_size", "target", "copies", "cut", "with_cut"), "mix")


def _copies(h: Column) -> Column:
    more = F.coalesce((h < F.col("cut")) | ((h == F.col("cut")) & F.col("with_cut")), F.lit(False))
    return F.col("copies") + more.cast("int")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs`` (doc_id, text, source)."""
    plan = mix_plan(docs).withColumnRenamed("source", "s")
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       mix_hash(F.col("doc_id"), F.col("text")).alias("h"))
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(F.col("h"))).alias("taken")))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs`` (doc_id, text, source, ...), each as often as it is taken, with all
    their columns, whatever their names. Documents without words weigh nothing and come as often as their
    hash says. An empty table gives an empty one."""
    plan = mix_plan(docs).withColumnRenamed("source", "s")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col("source").alias("of"),
                       mix_hash(F.col("doc_id"), F.col("text")).alias("h"))
    return (rows.join(plan, F.col("of").eqNullSafe(F.col("s")), "left")
            .select("row", F.explode(F.array_repeat(F.lit(1), _copies(F.col("h")))).alias("copy"))
            .select("row.*"))
