"""Dead feeds from a stream of fetches: an extension of the monthly check.

A feed is dead once it has failed twice, at least 72 hours apart, without a success in between.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources import schemas

APART = pd.Timedelta(hours=72)


def fetches(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.MANIFEST).json(path)


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(batches).sort_values("at", kind="stable")
    first, reported = state.get if state.exists else (None, False)
    out = []
    for at, ok in zip(rows["at"], rows["ok"], strict=True):
        at = int(pd.Timestamp(at).value // 1000)
        if ok:
            first, reported = None, False
        elif first is None:
            first = at
        elif not reported and at - first >= APART.value // 1000:
            reported = True
            out.append((key[0], pd.Timestamp(first, unit="us"), pd.Timestamp(at, unit="us")))
    state.update((first, reported))
    yield pd.DataFrame(out, columns=["url", "first_failure", "last_failure"])


def dead_feeds(rows: DataFrame) -> DataFrame:
    """(url, first_failure, last_failure) of feeds that die, from fetches of indexes as they come."""
    own = rows.where("role = 'index'").select("url", F.to_timestamp("fetched_at").alias("at"), F.col("sha256").isNotNull().alias("ok")).withWatermark("at", "72 hours")
    return own.groupBy("url").applyInPandasWithState(_step, "url string, first_failure timestamp, last_failure timestamp", "first long, reported boolean", "append", GroupStateTimeout.NoTimeout)


def fetch_counts(rows: DataFrame) -> DataFrame:
    """Fetches and failures per day and role; late fetches count until 72 hours have passed."""
    own = rows.select("role", F.to_timestamp("fetched_at").alias("at"), F.col("sha256").isNull().alias("failed")).withWatermark("at", "72 hours")
    return own.groupBy(F.window("at", "1 day"), "role").agg(F.count("*").alias("n"), F.count(F.when(F.col("failed"), 1)).alias("n_failed"))
