"""Helpers of the training-data operators: written intermediate tables, free column names,
connected components, and components of items that meet in buckets."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.session import fresh_folder, remove_folder

#: A word is a run of anything but blank, tab, newline, vertical tab, form feed, carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of rows that go to Python and back at once.
BATCH_BYTES = 4 << 20
#: Members of a bucket that all others are held against first.
CENTRES = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lets at most ``BATCH_BYTES`` of rows go to Python at once from here on in this session, unless it has a setting of
    its own: a task holds such a batch several times over, in the JVM and in each of its Python workers."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared folder and read it back: later plans start from files that
    survive a lost executor and whose size the optimizer knows. Removed when the session ends."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    _remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    for made in _scratch[-1:]:
        made.append(path)


#: The tables written inside each running ``result_only``.
_scratch: list[list[str]] = []


def result_only(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``written(make())``; the tables that ``make`` has written on the way are removed once that is done."""
    _scratch.append([])
    try:
        df = make()
        spark, path = df.sparkSession, fresh_folder(df.sparkSession, label)
        df.write.parquet(path)
    finally:
        made = _scratch.pop()
    for folder in made:
        remove_folder(spark, folder)
    _remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    return stored(df, label)[0]


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """``written``, dealt by ``column`` into as many buckets as a shuffle has partitions: later joins on
    that column alone do not move these rows again. The catalog entry goes at once, the files at the
    end of the session. Rows equal in ``column`` lie in one bucket, which no join splits."""
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_folder(spark, label)
    name = f"{label}_{uuid.uuid4().hex}"
    dealt = df.repartition(count, column)
    dealt.write.bucketBy(count, column).option("path", path).format("parquet").saveAsTable(name)
    _remove_at_exit(spark, path)
    kept = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return kept


def free_name(wanted: str, df: DataFrame) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def connected_components(links: DataFrame) -> DataFrame:
    """Components of the undirected graph ``links`` (a, b: long), as (id, component): every id that
    occurs, and the smallest id it reaches. Nulls and self-links are ignored.

    Alternating large-star and small-star rounds (Kiveris et al. 2014): each is one pre-aggregated
    minimum per node and one join, whose hot nodes adaptive execution splits. No neighbour list is
    ever gathered; each round is a written table.
    """
    spark = links.sparkSession
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges, path = stored(links.where("a <> b").select(high, low).distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(below, "a")
                 .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        old = path
        edges, path = stored(small, "links")
        remove_folder(spark, old)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def shared_buckets(buckets: DataFrame, describe: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Of (bucket, id), as a stored table, the distinct rows of buckets with more than one id, with the
    columns that ``describe`` adds.

    The first pass moves a bucket's smallest and largest id only, so that buckets of one item, nearly
    all of them, end there.
    """
    many = (buckets.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
            .where("lo <> hi").select("bucket"))
    rows = buckets.join(written(many, "shared"), "bucket").distinct()
    return written(describe(rows), "buckets")


def bucket_components(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
                      near: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]) -> DataFrame:
    """Components of the graph whose links are the id pairs that share a bucket and pass ``verify``.

    ``buckets`` comes from ``shared_buckets``. ``near`` is a test that no link fails, of the columns of
    two rows; it filters inside the joins. ``verify`` keeps the true links of a table of distinct pairs
    (a, b), a < b. Returns (id, component) of the linked ids.

    A group of near copies makes as many pairs as the square of its size, so pairs are never listed
    per bucket. First each member meets at most ``CENTRES`` centres of its bucket. Then only pairs whose
    ends still lie in different components are looked at, each with at least one end outside the
    bucket's largest component. A pair left out is either tested as a centre's pair or already
    connected, so the components are those of all pairs.
    """
    columns = [c for c in buckets.columns if c != "bucket"]

    def renamed(df: DataFrame, prefix: str, *more: Column) -> DataFrame:
        return df.select("bucket", *more, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])

    def close() -> Column:
        return near(lambda c: F.col(f"x_{c}"), lambda c: F.col(f"y_{c}"))

    pair = [F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")]
    item = F.struct("id", *[c for c in columns if c != "id"])
    centre = F.array_distinct(F.array(F.min(item), F.max(item),
                                      *[F.min_by(item, F.xxhash64(F.col("id"), F.lit(n))) for n in range(CENTRES - 2)]))
    shared = written(buckets.groupBy("bucket").agg(F.count("*").alias("n"), centre.alias("centres")), "centres")
    stars = (renamed(buckets, "x").join(shared.select("bucket", F.explode("centres").alias("y")), "bucket")
             .withColumns({f"y_{c}": F.col(f"y.{c}") for c in columns})
             .where("x_id <> y_id").where(close()).select(*pair).distinct())
    first = written(connected_components(verify(stars)), "components")

    open_buckets = shared.where(F.col("n") - F.size("centres") >= 2).select("bucket")
    members = written(buckets.join(open_buckets, "bucket").join(first, "id", "left")
                      .select("bucket", *columns, F.coalesce("component", "id").alias("c")), "members")
    mixed = (members.groupBy("bucket", "c").agg(F.count("*").alias("n"))
             .groupBy("bucket").agg(F.max_by("c", "n").alias("main"), F.count("*").alias("cs"))
             .where("cs > 1").select("bucket", "main"))
    inside = members.join(written(mixed, "mixed"), "bucket")
    left = renamed(inside, "x", F.col("c").alias("xc"), F.col("main"))
    right = renamed(inside.where("c <> main"), "y", F.col("c").alias("yc"))
    rest = (left.join(right, "bucket").where("xc <> yc and (xc = main or x_id < y_id)").where(close())
            .select(*pair).distinct())
    at = first.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    bt = first.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    joined = (verify(rest).join(at, "a", "left").join(bt, "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct())
    joined = written(joined, "late")
    second = connected_components(joined).toDF("component", "root")
    known = first.union(joined.select("a", "a")).union(joined.select("b", "b")).distinct()
    return known.join(second, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
