"""Bridges between records, plans and counties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import norm
from ..sources.staging import stage

#: The key of a record: its file and its place there. Every operator takes the file as text (its SHA-256) or as the number
#: that ``encode`` gives it, as long as all relations do alike.
RECORD = ("source_sha256", "record_idx")


def surrogate_keys(rows: DataFrame, column: str, key: str) -> DataFrame:
    """(column, key): the distinct values but null, numbered from 0 in their order.

    Values are range-partitioned and numbered within partitions; offsets come from one count per partition, so no single
    task sees all of them. Their places are a table before they are counted, as ranges that are sampled again could differ.
    """
    values = rows.select(column).where(F.col(column).isNotNull()).distinct()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(values.repartitionByRange(parts, column).withColumn("_p", F.spark_partition_id()), "ranges")
    placed = placed.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(column)))
    sizes = placed.groupBy("_p").count()
    before = sizes.alias("a").join(F.broadcast(sizes.alias("b")), F.col("b._p") < F.col("a._p"), "left").groupBy("a._p").agg(F.coalesce(F.sum("b.count"), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_p").select(column, (F.col("_before") + F.col("_n") - 1).alias(key))


def _swap(rows: DataFrame, pairs: DataFrame, column: str, old: str, new: str) -> DataFrame:
    own = pairs.select(F.col(old).alias("_old"), F.col(new).alias("_new"))  # names of its own, so a self join stays apart
    joined = rows.join(own, rows[column] == own["_old"], "left")
    return joined.select(*[own["_new"].alias(c) if c == column else rows[c] for c in rows.columns])


def encode(rows: DataFrame, numbers: DataFrame, column: str, key: str) -> DataFrame:
    """``rows`` with the key of ``numbers`` (column, key) in place of the column's values. Null stays null; a value that has no
    number becomes null, so number the values of all relations that are to meet."""
    return _swap(rows, numbers, column, column, key)


def decode(rows: DataFrame, numbers: DataFrame, column: str, key: str) -> DataFrame:
    """The values of the column in place of their numbers."""
    return _swap(rows, numbers, column, key, column)


def by_records(rows: DataFrame) -> DataFrame:
    """``rows``, which grow with the records or the registry, as the right side of a join: sorted and merged, never broadcast.

    Spark takes the size of a table's compressed files for that of its rows, and a few columns of them for their share. Eight million
    rows of evidence in 29 MB count as less than the 10 MB that it collects on the driver to broadcast, and fill its memory.
    """
    return rows.hint("merge")


def attach(plans: DataFrame, year: str = "2026") -> DataFrame:
    """Distinct (record, scid) of well-formed HIOS plans that name no year or this one."""
    own = plans.where(F.upper("plan_id_type").like("HIOS%") & (F.col("years").isNull() | F.col("years").contains(year)))
    return own.select(*RECORD, norm.scid(F.col("plan_id")).alias("scid")).where("scid is not null").distinct()


def record_counties(addresses: DataFrame, zip_county: DataFrame) -> DataFrame:
    """Distinct (record, county) by the first five digits of each address's ZIP code; a ZIP code may lie in many counties."""
    own = addresses.select(*RECORD, F.substring(norm.digits(F.col("zip")), 1, 5).alias("zip"))
    return own.join(zip_county, "zip").select(*RECORD, F.col("county_fips").alias("county")).distinct()
