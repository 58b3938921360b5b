"""Bounded inputs: training and replay files, the day-partitioned archive."""

from __future__ import annotations

import csv
import datetime as dt
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.schema import TRAINING_CSV_SCHEMA, UNNAMED_CSV_INDEX_COLUMN


def csv_headers(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, list[str]]:
    """Header line -> files that begin with it, under ``path``.

    One scan of the text finds them: a header is a line that holds the name of every column. Lines and
    files reach the driver, as file listings do.
    """
    line = F.col("value")
    named = reduce(lambda a, b: a & b, [line.contains(f.name) for f in schema])
    found = (spark.read.text(path).where((F.col("_metadata.file_block_start") == 0) & named)
             .select(line.alias("header"), F.input_file_name().alias("file")).distinct())
    groups: dict[str, list[str]] = {}
    for row in found.toLocalIterator():
        groups.setdefault(row.header, []).append(row.file)
    return groups


def read_training_csv(spark: SparkSession, path: str, schema: T.StructType = TRAINING_CSV_SCHEMA,
                      bad_rows: str | None = None) -> DataFrame:
    """Header CSV under a pinned schema, so no inference pass and no numeric card numbers.

    Columns are taken by header name, file by file: files are grouped by their own header, and each group
    is read under the schema in its order, so an index column, named or not, and another order of columns
    are read correctly beside each other. A file without a header that has every column is an error.
    Further columns are text; one that only some files have is null in the others. A cell that does not
    fit its type is null; ``bad_rows`` names a column to add, with the text of rows that hold one.
    """
    groups = csv_headers(spark, path, schema)
    files = {f for found in groups.values() for f in found}
    strange = [f for f in spark.read.text(path).inputFiles() if f not in files]
    if strange or not groups:
        raise ValueError(f"{path}: no header with the columns {schema.names} in {strange[:5] or 'any file'}")
    by_name = {f.name: f for f in schema}
    order: list[str] = []
    parts = []
    for header in sorted(groups):
        # An unnamed column gets the name that Spark gives it.
        names = [name.strip() or UNNAMED_CSV_INDEX_COLUMN for name in next(csv.reader([header]))]
        order += [n for n in names if n not in order]
        full = T.StructType([by_name.get(n, T.StructField(n, T.StringType())) for n in names])
        # Naming a null marker keeps a quoted empty text apart from an absent value.
        reader = spark.read.options(header=True, nullValue=r"\N", enforceSchema=True)
        if bad_rows:
            full = full.add(bad_rows, T.StringType())
            reader = reader.option("columnNameOfCorruptRecord", bad_rows)
        parts.append(reader.schema(full).csv([unquote(f) for f in groups[header]]))  # names come as URIs
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*order, *([bad_rows] if bad_rows else []))


def read_archive(spark: SparkSession, path: str, first_day: dt.date | None = None,
                 last_day: dt.date | None = None) -> DataFrame:
    """Archived transactions, both days inclusive; the day bounds prune whole folders."""
    archive = spark.read.parquet(path)
    if "batch" in archive.columns:  # folders of a joint stream
        archive = archive.drop("batch")
    if first_day is not None:
        archive = archive.filter(F.col("date") >= F.lit(first_day))
    if last_day is not None:
        archive = archive.filter(F.col("date") <= F.lit(last_day))
    return archive
