"""The sample of a phone study: cells of good and poor grade, and the numbers to call in them.

All random orders are orders of MD5 sums, so every engine draws the same sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import norm
from .compact import RECORD, by_records

CELLS_PER_ARM = 40


def _first(rows: DataFrame, by: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each group."""
    name = rank or "_rank"
    out = rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def _md5(*columns: str) -> Column:
    return F.md5(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def candidates(scores: DataFrame, least: int = 30) -> DataFrame:
    """At most one bh cell of each issuer and arm (A against D and F), at most 40 of an arm."""
    own = scores.where((F.col("scope") == "bh") & (F.col("n") >= least) & F.col("grade").isin("A", "D", "F"))
    own = own.select("scid", "county", "state", "grade", F.substring("scid", 1, 5).alias("issuer_id"), F.when(F.col("grade") == "A", "good").otherwise("poor").alias("arm"))
    one = _first(own, ["arm", "issuer_id"], [_md5("scid", "county"), F.col("scid"), F.col("county")])
    return _first(one, ["arm"], [_md5("issuer_id", "county"), F.col("scid")], CELLS_PER_ARM)


def call_roster(cells: DataFrame, roster: DataFrame, providers: DataFrame, addresses: DataFrame) -> DataFrame:
    """The cells' bh records with their first address's phone and what can be said of it."""
    members = roster.where("is_bh").select(*RECORD, "scid", "county").join(F.broadcast(cells), ["scid", "county"])  # 80 cells at most
    name = F.coalesce(F.concat_ws(" ", F.when(F.col("name_last").isNotNull(), F.col("name_first")), F.when(F.col("name_first").isNotNull(), F.col("name_last"))), F.lit(""))
    name = F.when(name != "", name).otherwise(F.coalesce("facility_name", F.lit("")))
    people = providers.select(*RECORD, "npi", "specialties", "accepting", name.alias("provider_name"))
    first = addresses.where("addr_idx = 0").select(*RECORD, "phone", "address", "city", "zip", norm.digits(F.col("phone")).alias("d"))
    rows = members.join(by_records(people), list(RECORD)).join(by_records(first), list(RECORD), "left").withColumn("d", F.coalesce("d", F.lit("")))
    return rows.withColumns({"dialable": norm.dialable(F.col("d")), "toll_free": norm.toll_free(F.col("d")), "nameless": F.trim("provider_name") == ""})


def cell_inventory(rows: DataFrame) -> DataFrame:
    usable = F.col("dialable") & ~F.col("nameless")
    return rows.groupBy("arm", "grade", "scid", "county", "state", "issuer_id").agg(
        F.count("*").alias("roster_n"),
        F.count(F.when(F.col("dialable"), 1)).alias("dialable_n"),
        F.count(F.when(F.col("nameless"), 1)).alias("nameless_n"),
        F.count_distinct(F.when(usable, F.col("d"))).alias("distinct_numbers"),
    )


def chosen_cells(inventory: DataFrame, per_cell: int, cells_per_arm: int) -> DataFrame:
    """Cells with enough numbers: one of a state and arm, F before D, then so many of an arm."""
    ok = inventory.where(F.col("distinct_numbers") >= per_cell)
    worst = F.when(F.col("grade") == "F", 0).otherwise(1)
    one = _first(ok, ["arm", "state"], [worst, _md5("scid"), F.col("scid"), F.col("county")])
    return _first(one, ["arm"], [worst, _md5("scid", "state"), F.col("scid"), F.col("county")], cells_per_arm)


def study_rows(rows: DataFrame, chosen: DataFrame, per_cell: int) -> DataFrame:
    """Calls to make: one per number in a cell, then per number, then per NPI, then so many of a cell."""
    own = rows.where("dialable and not nameless").join(F.broadcast(chosen.select("scid", "county")), ["scid", "county"], "left_semi")
    tie = [F.col("source_sha256"), F.col("record_idx"), F.col("scid"), F.col("county")]
    own = _first(own, ["scid", "county", "d"], [_md5("npi", "d"), *tie])
    own = _first(own, ["d"], [_md5("npi", "scid"), *tie])
    own = _first(own, ["npi"], [_md5("d", "scid"), *tie])
    own = _first(own, ["scid", "county"], [_md5("npi", "d", "scid"), *tie], per_cell, "rank")
    return own.select("arm", "grade", "scid", "county", "state", "provider_name", "npi", "phone", "toll_free", "rank")
