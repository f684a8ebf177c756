"""Comparison of two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("issuer_id", "metric", "subcode", "npi")
_BY_PLAN = "metric = 'M7_OUT_OF_AREA_LISTING'"


def previous_snapshot(snapshots: DataFrame, snapshot: str) -> DataFrame:
    return snapshots.where(F.col("snapshot") < snapshot).agg(F.max("snapshot").alias("previous"))


def by_issuer(evidence: DataFrame, file_issuers: DataFrame) -> DataFrame:
    """Evidence rows under every issuer that publishes their file; M7 rows once, under the issuer of their plan."""
    files = evidence.where(f"NOT ({_BY_PLAN})").join(file_issuers, "source_sha256")
    return files.unionByName(evidence.where(_BY_PLAN).withColumn("issuer_id", F.substring("plan_id", 1, 5)))


def flag_status(before: DataFrame, now: DataFrame) -> DataFrame:
    """Findings (issuer, metric, subcode, NPI) that are new, persist or are resolved."""

    def keys(rows, mark):
        return rows.where("npi is not null and metric <> 'M7_OUT_OF_AREA_LISTING'").select(*KEY).distinct().withColumn(mark, F.lit(1))

    both = keys(before, "b").join(keys(now, "n"), list(KEY), "full")
    return both.select(*KEY, F.when(F.col("b").isNull(), "new").when(F.col("n").isNull(), "resolved").otherwise("persisting").alias("status"))


def count_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Changes in the number of findings that have no NPI, and of M7 findings, per issuer and metric."""

    def counts(rows, name):
        own = rows.where("npi is null or metric = 'M7_OUT_OF_AREA_LISTING'")
        return own.groupBy("issuer_id", "metric").agg(F.count("*").alias(name))

    both = counts(before, "n_before").join(counts(now, "n_now"), ["issuer_id", "metric"], "full").na.fill(0, ["n_before", "n_now"])
    return both.withColumn("delta", F.col("n_now") - F.col("n_before"))


def grade_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Cells whose grade is another, with both scores; improved and declined count bh cells that have both grades."""
    key = ["scid", "county", "scope"]
    old, new = (rows.select(*key, F.col("grade").alias(f"grade_{name}"), F.col("score").alias(f"score_{name}")) for rows, name in ((before, "before"), (now, "now")))
    both = old.join(new, key, "full")
    moved = both.where(F.coalesce("grade_before", F.lit("")) != F.coalesce("grade_now", F.lit("")))
    improved = F.col("grade_now") < F.col("grade_before")
    return moved.withColumn("move", F.when((F.col("scope") == "bh") & improved.isNotNull(), F.when(improved, "improved").otherwise("declined")))
