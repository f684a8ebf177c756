"""Which issuer answers for a finding: the one whose plans the record is in, or every publisher of its file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import norm
from .compact import RECORD, by_records


def record_owners(attached: DataFrame) -> DataFrame:
    """Distinct (record, issuer) from the plans that a record is in."""
    return attached.select(*RECORD, F.substring("scid", 1, 5).alias("issuer_id")).distinct()


def owned(evidence: DataFrame, owners: DataFrame) -> DataFrame:
    return evidence.join(by_records(owners), list(RECORD))


def orphans(evidence: DataFrame, owners: DataFrame, file_issuers: DataFrame) -> DataFrame:
    """Findings on records in no plan, under every publisher of the file."""
    return evidence.join(by_records(owners), list(RECORD), "left_anti").join(file_issuers, "source_sha256")


def issuer_summary(evidence: DataFrame, m7: DataFrame, attached: DataFrame, file_issuers: DataFrame) -> DataFrame:
    """Per issuer: findings on its records, on orphans of its files, and the share of its attachments out of area (null
    where there are none out of area)."""
    owners = record_owners(attached)
    direct = owned(evidence, owners).groupBy("issuer_id").agg(F.count("*").alias("n_findings"), F.count_distinct(F.struct(*RECORD)).alias("n_records"))
    loose = orphans(evidence, owners, file_issuers).groupBy("issuer_id").agg(F.count("*").alias("n_orphans"))
    all_attached = attached.groupBy(F.substring("scid", 1, 5).alias("issuer_id")).agg(F.count("*").alias("n_attached"))
    out = m7.groupBy(F.substring("plan_id", 1, 5).alias("issuer_id")).agg(F.count("*").alias("n_out_of_area"))
    parts = [file_issuers.select("issuer_id").distinct(), direct, loose, all_attached, out]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, "issuer_id", "left")
    filled = joined.na.fill(0, ["n_findings", "n_records", "n_orphans", "n_attached", "n_out_of_area"])
    share = norm.rounded(F.try_divide(F.col("n_out_of_area").cast("double"), F.col("n_attached")), 4)
    return filled.withColumn("out_of_area_rate", F.when(F.col("n_out_of_area") > 0, share))


def co_publishers(file_issuers: DataFrame) -> DataFrame:
    """Per issuer the other issuers that publish one of its files, sorted and comma-separated."""
    other = file_issuers.select("source_sha256", F.col("issuer_id").alias("other"))
    pairs = file_issuers.join(other, "source_sha256").where("other <> issuer_id").select("issuer_id", "other").distinct()
    return pairs.groupBy("issuer_id").agg(F.array_join(F.array_sort(F.collect_list("other")), ",").alias("co_publishers"), F.count("*").alias("n"))
