"""Penalties of records, rosters of plan and county cells, and cell scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import norm, specialty
from .compact import RECORD, by_records
from .metrics import bh_npis

OUT_OF_AREA_WEIGHT = 0.8
CELL = ("scid", "county")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def record_penalties(evidence: DataFrame) -> DataFrame:
    """Penalty of each flagged record: the heaviest flag and a quarter of the others, at most 1; also without E3 flags
    (pen_a) and with equal flags (pen_u). M7 concerns plans and is left out."""
    w, plain = F.col("weight"), F.when(F.col("evidence_strength") != "E3", F.col("weight"))

    def capped(x):
        top = F.coalesce(F.max(x), F.lit(0.0))
        return F.least(F.lit(1.0), top + 0.25 * (F.coalesce(F.sum(x), F.lit(0.0)) - top))

    own = evidence.where("metric <> 'M7_OUT_OF_AREA_LISTING'")
    return own.groupBy(*RECORD).agg(capped(w).alias("pen"), capped(plain).alias("pen_a"), F.least(F.lit(1.0), 0.6 + 0.15 * (F.count("*") - 1)).alias("pen_u"))


def bh_records(providers: DataFrame, nppes: DataFrame, rules: specialty.Rules = specialty.Rules()) -> DataFrame:
    """Records whose NPI has a behavioral-health taxonomy or whose specialty is one."""
    by_code = providers.join(by_records(bh_npis(nppes)), "npi", "left_semi").select(*RECORD)
    by_name = providers.join(specialty.verdicts(providers, rules).where("verdict = 'bh'"), "specialties", "left_semi").select(*RECORD)
    return by_code.unionByName(by_name).distinct()


def cells(plan_county: DataFrame) -> DataFrame:
    return plan_county.groupBy(F.substring("plan_id", 1, 14).alias("scid"), F.lpad(norm.digits(F.col("fips")), 5, "0").alias("county")).agg(F.min("state").alias("state"))


def roster(cells: DataFrame, attached: DataFrame, record_counties: DataFrame, bh: DataFrame) -> DataFrame:
    """Attached records in the counties where their plan is sold, one row per cell and record."""
    sold = attached.join(cells.select("scid").distinct(), "scid", "left_semi")  # before counties multiply the rows
    here = sold.join(by_records(record_counties), list(RECORD)).join(cells, list(CELL))
    return here.join(by_records(bh.withColumn("is_bh", F.lit(True))), list(RECORD), "left").withColumn("is_bh", F.coalesce("is_bh", F.lit(False)))


def out_of_area_rates(attached: DataFrame, record_counties: DataFrame, m7: DataFrame) -> DataFrame:
    """Of each plan's attached records that have a county, how many are out of its area."""
    mappable = attached.join(by_records(record_counties.select(*RECORD).distinct()), list(RECORD), "left_semi")
    out = m7.select(*RECORD, F.col("plan_id").alias("scid")).distinct().withColumn("out", F.lit(1))
    joined = mappable.join(by_records(out), [*RECORD, "scid"], "left").groupBy("scid").agg(F.count("*").alias("n_attached"), F.count("out").alias("n_out_of_area"))
    return joined.withColumn("ooa_rate", F.col("n_out_of_area").cast("double") / F.col("n_attached"))


def cell_scores(roster: DataFrame, penalties: DataFrame, rates: DataFrame) -> DataFrame:
    """Scores of every cell in the scopes all and bh; a cell without behavioral health has a bh row with n = 0.

    Both scopes come from one aggregation, so the roster is read and shuffled once.
    """
    joined = roster.join(by_records(penalties), list(RECORD), "left")
    bh = F.col("is_bh")

    def mean(c, cond=None):
        value = F.coalesce(c, F.lit(0.0))
        return F.coalesce(F.avg(value if cond is None else F.when(cond, value)), F.lit(0.0))

    flagged = F.when(F.col("pen").isNotNull(), 1.0)
    per_cell = joined.groupBy(*CELL, "state").agg(
        *[
            F.struct(
                F.lit(scope).alias("scope"),
                F.count(F.lit(1) if cond is None else F.when(cond, 1)).alias("n"),
                mean(F.col("pen"), cond).alias("mean_pen"),
                mean(F.col("pen_a"), cond).alias("mean_pen_a"),
                mean(F.col("pen_u"), cond).alias("mean_pen_u"),
                mean(flagged, cond).alias("flag_rate"),
            ).alias(scope)
            for scope, cond in (("all", None), ("bh", bh))
        ]
    )
    per_scope = per_cell.select(*CELL, "state", F.explode(F.array("all", "bh")).alias("s")).select(*CELL, "state", "s.*")
    n, rate = F.col("n").cast("double"), F.col("flag_rate")
    own = per_scope.join(rates.select("scid", "ooa_rate"), "scid", "left")
    own = own.withColumn("comp_a", 100 * (1 - F.col("mean_pen"))).withColumn("comp_b", 100 * (1 - OUT_OF_AREA_WEIGHT * F.coalesce("ooa_rate", F.lit(0.0))))
    own = own.withColumn("raw", 0.8 * F.col("comp_a") + 0.2 * F.col("comp_b"))
    own = own.withColumn("final", F.greatest("raw", 80 * (1 - F.col("mean_pen_a")) + 0.2 * F.col("comp_b") - 20))
    half = 1.96 * F.sqrt(F.try_divide(rate * (1 - rate), n) + F.try_divide(F.lit(0.9604), n * n)) / (1 + F.try_divide(F.lit(3.8416), n))
    low = (F.col("n") >= 10) & (F.col("n") < 30)
    return own.select(
        *CELL,
        "state",
        "scope",
        "n",
        norm.rounded("comp_a", 1).alias("component_a"),
        norm.rounded("comp_b", 1).alias("component_b"),
        norm.rounded("ooa_rate", 4).alias("out_of_area_rate"),
        norm.rounded("raw", 1).alias("score_weighted"),
        norm.rounded("final", 1).alias("score"),
        norm.rounded(80 * (1 - F.col("mean_pen_u")) + 0.2 * F.col("comp_b"), 1).alias("score_uniform"),
        norm.grade(F.col("final"), F.col("n")).alias("grade"),
        low.alias("low_sample"),
        (low & F.coalesce(2 * half * 100 > 25, F.lit(False))).alias("numeric_suppressed"),
        (F.col("n") < 10).alias("thin_roster"),
    )


def published(scores: DataFrame, plan_county: DataFrame) -> DataFrame:
    """Scores with the plans' and counties' names."""
    names = plan_county.groupBy(F.substring("plan_id", 1, 14).alias("scid"), F.col("fips").alias("county")).agg(*[F.min(c).alias(c) for c in ("issuer_name", "plan_marketing_name", "metal_level", "county_name")])
    return scores.join(names, list(CELL), "left").withColumnRenamed("county", "county_fips")
