"""Where results go. Every writer is a Spark job with Spark's commit protocol."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame


def evidence_table(evidence: DataFrame, path: str) -> None:
    """Parquet, a folder for each snapshot and metric."""
    evidence.write.mode("overwrite").partitionBy("snapshot", "metric").option("compression", "zstd").parquet(path)


def parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def ordered_csv(rows: DataFrame, path: str, *order: str) -> None:
    """Compressed CSV files with headers; their rows are ordered within and across files."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True, compression="gzip")


def plain_csv(rows: DataFrame, path: str, *order: str) -> None:
    """Like ``ordered_csv``, not compressed."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("overwrite").csv(path, header=True)


def per_key(rows: DataFrame, path: str, key: str, *order: str) -> None:
    """A folder of CSV files for each key; a key with many rows gets many files instead of one task, in order across them."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order).write.mode("overwrite").partitionBy(key).option("maxRecordsPerFile", 1_000_000).csv(path, header=True, compression="gzip")


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def summary(one_row: DataFrame) -> str:
    """A table of one row as JSON text."""
    return json.dumps(one_row.first().asDict(recursive=True), default=str)
