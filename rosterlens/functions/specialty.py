"""Which specialties and taxonomy codes are behavioral health.

Rules are data: a verdict for each normalized specialty, a pattern that makes unseen ones ambiguous, and code rules.
The small sets here are what is publicly pinned down; pass larger ones in ``Rules``.
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values.
INCLUDE = ("psychiatry", "psychology", "psychologist", "counselor")
EXCLUDE = ("physical therapy", "diagnostic radiology")
AMBIGUOUS = ("psychiatry & neurology",)
UNSEEN = r"(?i)(?<!develop)mental|psych|behavior|counsel|social work|addiction|substance|\btherapist\b|marriage|lcsw|lmft|lpc|lmhc|lcmhc|licsw|lmsw|lgsw"
CODE_PREFIXES = ("101Y", "1041", "364SP08")
CODES = ("2084P0800X", "363LP0808X", "225XM0800X")
CODES_EXCLUDED = ("2084N0400X",)


@dataclass(frozen=True)
class Rules:
    include: tuple[str, ...] = INCLUDE
    exclude: tuple[str, ...] = EXCLUDE
    ambiguous: tuple[str, ...] = AMBIGUOUS
    unseen: str = UNSEEN


def normalize(part: str) -> str:
    """Entities, compatibility forms, quotes, white space, closing punctuation and case are levelled."""
    text = unicodedata.normalize("NFKC", html.unescape(part)).replace("‘", "'").replace("’", "'")
    return re.sub(r"\s+", " ", text).strip().rstrip(";.,: ").casefold()


def _normalized(parts: pd.Series) -> pd.Series:
    return parts.map(normalize, na_action="ignore")


def verdicts(specialties: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(specialties, verdict) for each distinct non-null value of the column ``specialties``.

    Parts are cut at | and ; first. The strongest part decides: bh, then ambiguous, not_bh, unknown. Only distinct parts
    are normalized in Python.
    """
    spark = specialties.sparkSession
    own = specialties.select("specialties").where("specialties is not null").distinct()
    parts = own.select("specialties", F.explode(F.split("specialties", "[|;]")).alias("part"))
    named = parts.select("part").distinct().withColumn("name", F.pandas_udf(_normalized, "string")("part")).where("name <> ''")
    table = spark.createDataFrame([(v, r) for r, vs in ((0, rules.include), (1, rules.ambiguous), (2, rules.exclude)) for v in vs], "name string, rank int")
    ranked = named.join(F.broadcast(table), "name", "left").select("part", F.coalesce("rank", F.when(F.col("name").rlike(rules.unseen), 1), F.lit(3)).alias("rank"))
    best = parts.join(ranked, "part", "left").groupBy("specialties").agg(F.min("rank").alias("rank"))
    names = F.array(*map(F.lit, ("bh", "ambiguous", "not_bh", "unknown")))
    return best.select("specialties", F.element_at(names, F.coalesce("rank", F.lit(3)) + 1).alias("verdict"))


def bh_code(code: Column) -> Column:
    starts = F.lit(False)
    for prefix in CODE_PREFIXES:
        starts |= code.startswith(prefix)
    return ~code.isin(*CODES_EXCLUDED) & (starts | code.isin(*CODES))
