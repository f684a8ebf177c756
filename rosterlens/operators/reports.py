"""The data of the public pages, one DataFrame each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import norm
from .compact import RECORD


def state_map(scores: DataFrame) -> DataFrame:
    """Per state: graded bh cells, their mean score and grade, D and F cells, thin cells."""
    bh = scores.where("scope = 'bh'")
    graded = F.col("grade").isNotNull()
    out = bh.groupBy("state").agg(
        F.count(F.when(graded, 1)).alias("graded"),
        norm.rounded(F.avg(F.when(graded, F.col("score"))), 1).alias("avg_score"),
        F.count(F.when(F.col("grade").isin("D", "F"), 1)).alias("poor"),
        F.count(F.when(F.col("thin_roster"), 1)).alias("thin"),
        F.coalesce(F.min(F.when(F.col("scope") == "bh", F.col("grade"))), F.lit("-")).alias("best_grade"),
    )
    return out.withColumn("band", F.when(F.col("avg_score").isNotNull(), norm.grade(F.col("avg_score"))))


def national(scores: DataFrame, providers: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row of totals."""
    cells = scores.where("scope = 'bh'").agg(F.count("*").alias("cells"), F.count(F.when(F.col("thin_roster"), 1)).alias("thin_cells"), F.count(F.when(F.col("grade") == "F", 1)).alias("f_cells"))
    records = providers.agg(F.count("*").alias("records"), F.count_distinct("source_sha256").alias("files"))
    deactivated = evidence.where("subcode = 'DEACTIVATED'").agg(F.count_distinct("npi").alias("deactivated"))
    return cells.crossJoin(records).crossJoin(deactivated)  # a row each


def league(scores: DataFrame, least_cells: int = 50, top: int = 15) -> DataFrame:
    """Issuers with the lowest mean bh score, of those with enough graded cells of 30 or more records."""
    own = scores.where("scope = 'bh' and grade is not null and not low_sample")
    per = own.groupBy(F.substring("scid", 1, 5).alias("issuer_id")).agg(F.count("*").alias("cells"), norm.rounded(F.avg("score"), 2).alias("avg_score"))
    return per.where(F.col("cells") >= least_cells).orderBy("avg_score", "issuer_id").limit(top)


def threshold_sweep(providers: DataFrame, addresses: DataFrame, fetch_date: str) -> DataFrame:
    """How many records each threshold of age and of addresses would flag: (kind, threshold, n)."""
    date = F.col("last_updated_on")
    usable = date.between("2014-01-01", fetch_date)
    ages = providers.agg(*[F.count(F.when(usable & (date < norm.days_before(fetch_date, d)), 1)).alias(str(d)) for d in (90, 180, 365)])
    place = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in ("address", "city", "state")])
    counts = addresses.groupBy(*RECORD).agg(F.count_distinct(place).alias("n")).join(providers.where("type = 'INDIVIDUAL'"), list(RECORD), "left_semi")
    many = counts.agg(*[F.count(F.when(F.col("n") > k, 1)).alias(str(k)) for k in (5, 10, 25)], F.max("n").alias("-1"))

    def rows(one, kind):
        names = one.columns
        each = F.explode(F.array(*[F.struct(F.lit(int(c)).alias("threshold"), F.col(f"`{c}`").alias("n")) for c in names])).alias("x")
        return one.select(each).select(F.lit(kind).alias("kind"), F.col("x.threshold").alias("threshold"), F.col("x.n").cast("long").alias("n"))

    return rows(ages, "days").unionByName(rows(many, "addresses"))


def unauditable(plan_county: DataFrame, scores: DataFrame) -> DataFrame:
    """Issuers on sale without any scored cell, with their plans and counties (grade X)."""
    issuer = F.substring("plan_id", 1, 5).alias("issuer_id")
    scored = scores.select(F.substring("scid", 1, 5).alias("issuer_id")).distinct()
    own = plan_county.select(issuer, "plan_id", "fips", "issuer_name").join(scored, "issuer_id", "left_anti")
    return own.groupBy("issuer_id").agg(F.min("issuer_name").alias("issuer_name"), F.count_distinct("plan_id").alias("plans"), F.count_distinct("fips").alias("counties"))


def plan_fold(scores: DataFrame) -> DataFrame:
    """Per plan: mean bh score over cells that are not thin, mean uniform score, thin and poor cells."""
    bh = F.col("scope") == "bh"
    thick = bh & ~F.col("thin_roster")
    out = scores.groupBy("scid").agg(
        norm.rounded(F.avg(F.when(thick, F.col("score"))), 1).alias("avg_bh"),
        norm.rounded(F.avg(F.when(thick, F.col("score_uniform"))), 1).alias("avg_uniform"),
        F.count(F.when(bh & F.col("thin_roster"), 1)).alias("thin"),
        F.count(F.when(bh & F.col("grade").isin("D", "F"), 1)).alias("poor"),
        F.count(F.when(bh & (F.col("out_of_area_rate") > 0.1), 1)).alias("far"),
    )
    return out.withColumn("band", F.when(F.col("avg_bh").isNotNull(), norm.grade(F.col("avg_bh"))))


def county_cells(scores: DataFrame) -> DataFrame:
    """One row per plan and county, scopes side by side."""
    def of(scope, c):
        return F.max(F.when(F.col("scope") == scope, F.col(c)))

    return scores.groupBy("scid", "county").agg(*[of(s, c).alias(f"{c}_{s}") for s in ("all", "bh") for c in ("n", "score", "grade")])


def issuer_metric_mix(evidence: DataFrame, file_issuers: DataFrame, providers: DataFrame) -> DataFrame:
    """Per issuer (by file) and metric: the flagged share of its files' records, and whether another issuer shares a file."""
    shared = file_issuers.groupBy("source_sha256").agg(F.count("*").alias("k"))
    sizes = providers.groupBy("source_sha256").agg(F.count("*").alias("records"))
    totals = file_issuers.join(sizes, "source_sha256").join(shared, "source_sha256").groupBy("issuer_id").agg(F.sum("records").alias("records"), (F.max("k") > 1).alias("shared"))
    flagged = evidence.select(*RECORD, "metric").distinct().groupBy("source_sha256", "metric").agg(F.count("*").alias("flagged")).join(file_issuers, "source_sha256")
    per = flagged.groupBy("issuer_id", "metric").agg(F.sum("flagged").alias("flagged"))
    return per.join(totals, "issuer_id").withColumn("percent", norm.rounded(100.0 * F.col("flagged") / F.col("records"), 2))


def zip_index(zip_county: DataFrame, scores: DataFrame) -> DataFrame:
    """ZIP codes and the scored counties they lie in, sorted and comma-separated."""
    covered = scores.select(F.col("county").alias("county_fips")).distinct()
    own = zip_county.join(covered, "county_fips", "left_semi").distinct()
    return own.groupBy("zip").agg(F.array_join(F.array_sort(F.collect_list("county_fips")), ",").alias("counties"))


def m7_by_plan(m7: DataFrame, rates: DataFrame) -> DataFrame:
    return m7.groupBy(F.col("plan_id").alias("scid")).agg(F.count("*").alias("n_rows")).join(rates, "scid")


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly n rows (or all), in the order of the MD5 of a key: the same sample in any engine."""
    return rows.withColumn("_o", F.md5(F.col(key).cast("string"))).orderBy("_o", key).limit(n).drop("_o")
