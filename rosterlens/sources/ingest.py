"""From published JSON files to tables.

A file is one document, an array of records or an object that wraps it, and is parsed as a whole; files beyond an
executor's memory must be split into lines first. Bytes that are not UTF-8 become U+FFFD. A record's index is its place
in the array, whatever the elements before it are; elements that are not objects yield nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .staging import stage


def blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, source_sha256, text): one row per distinct content."""
    files = spark.read.format("binaryFile").load(path)
    text = F.call_function("make_valid_utf8", F.col("content").cast("string"))
    return files.select("path", F.sha2("content", 256).alias("source_sha256"), text.alias("text")).dropDuplicates(["source_sha256"])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).json(path)


def unparsed(files: DataFrame, parsed: DataFrame) -> DataFrame:
    """Files that an earlier run has not parsed."""
    return files.join(parsed.select("source_sha256").distinct(), "source_sha256", "left_anti")


def _records(files: DataFrame, wrapper: str) -> DataFrame:
    body = F.trim("text")
    array = F.when(body.startswith("["), body).otherwise(F.get_json_object(body, f"$.{wrapper}"))
    each = files.select("source_sha256", F.posexplode(F.from_json(array, "array<string>")).alias("record_idx", "raw"))
    return each.where(F.ltrim("raw").startswith("{"))


def _list(c: Column) -> Column:
    """A list of texts that may be published as a single one; null stays null."""
    return F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>")).when(c.isNotNull(), F.array(c))


def _joined(c: Column) -> Column:
    return F.array_join(F.filter(_list(c), lambda x: x.isNotNull()), "|")


def _count(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def parse_errors(files: DataFrame, wrapper: str = "providers") -> DataFrame:
    """Files whose document is not valid JSON of the expected form."""
    body = F.trim("text")
    array = F.when(body.startswith("["), body).otherwise(F.get_json_object(body, f"$.{wrapper}"))
    return files.where(F.from_json(array, "array<string>").isNull()).select("source_sha256", "path")


def providers(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, their addresses and their plans."""
    read = _records(files, "providers").select("source_sha256", F.col("record_idx").cast("long").alias("record_idx"), F.from_json("raw", schemas.PROVIDER).alias("r"))
    read = read.select("source_sha256", "record_idx", "r.*").withColumns({"_a": F.from_json("addresses", schemas.ADDRESS), "_p": F.from_json("plans", schemas.MEMBERSHIP)})
    records = read.select(
        "source_sha256",
        "record_idx",
        "npi",
        "type",
        *[F.col(f"name.{c}").alias(f"name_{c}") for c in ("first", "middle", "last", "suffix")],
        "facility_name",
        _joined(F.col("facility_type")).alias("facility_types"),
        F.coalesce("gender", "sex").alias("gender"),
        "accepting",
        "last_updated_on",
        _joined(F.col("specialty")).alias("specialties"),
        _count(_list(F.col("specialty"))).alias("specialty_count"),
        _joined(F.col("languages")).alias("languages"),
        _count(F.col("_a")).alias("addresses_count"),
        _count(F.col("_p")).alias("plans_count"),
    )
    key = ["source_sha256", "record_idx"]
    addresses = read.select(*key, F.posexplode("_a").alias("addr_idx", "x")).where("x is not null").select(*key, "addr_idx", "x.*")
    plans = read.select(*key, F.posexplode("_p").alias("plan_idx", "x")).where("x is not null")
    return records, addresses, plans.select(*key, "plan_idx", "x.plan_id_type", "x.plan_id", "x.network_tier", _joined(F.col("x.years")).alias("years"))


def plans(files: DataFrame) -> DataFrame:
    read = _records(files, "plans").select("source_sha256", F.col("record_idx").cast("long").alias("record_idx"), F.from_json("raw", schemas.PLAN).alias("r")).select("source_sha256", "record_idx", "r.*")
    return read.withColumn("network_tiers", F.array_join("network.network_tier", "|")).drop("network")


def index_urls(files: DataFrame) -> DataFrame:
    """(source_sha256, role, url) of the files that an index names."""
    read = files.select("source_sha256", F.from_json("text", "provider_urls array<string>, plan_urls array<string>").alias("i"))
    each = [read.select("source_sha256", F.lit(role).alias("role"), F.explode(f"i.{role}_urls").alias("url")) for role in ("provider", "plan")]
    return each[0].unionByName(each[1]).distinct()


def feeds(seed: DataFrame, hosts: DataFrame) -> DataFrame:
    """Seed rows (url, issuer_id, state) by URL, with the class of the URL's host; unknown hosts are medical."""
    own = seed.groupBy("url").agg(F.array_sort(F.collect_set("issuer_id")).alias("issuer_ids"), F.array_sort(F.collect_set("state")).alias("states"))
    return own.withColumn("host", F.lower(F.expr("try_parse_url(url, 'AUTHORITY')"))).join(hosts, "host", "left").withColumn("scope", F.coalesce("scope", F.lit("medical")))


def empty_as_null(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.nullif(F.trim(c), F.lit("")).alias(c.lower()) for c in rows.columns])


def csv_table(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Named columns of a CSV file with a header, as text; blanks are null; a missing column is an error."""
    rows = spark.read.csv(path, header=True, sep=sep, quote='"', escape='"')
    known = {c.strip().lower(): c for c in rows.columns}
    if missing := [c for c in columns if c.lower() not in known]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    return empty_as_null(rows.select(*[F.col(f"`{known[c.lower()]}`").alias(c) for c in columns]))


def primary_taxonomy(codes: Column, switches: Column) -> Column:
    """The first code whose switch is Y, else the first code."""
    pairs = F.filter(F.arrays_zip(codes.alias("code"), switches.alias("sw")), lambda x: F.coalesce(x["code"], F.lit("")) != "")
    chosen = F.filter(pairs, lambda x: x["sw"] == "Y")
    return F.coalesce(F.get(chosen, 0)["code"], F.get(pairs, 0)["code"])


def adjacency(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of county codes: the first and the last five-digit number of each line."""
    codes = F.regexp_extract_all("value", F.lit(r"\b(\d{5})\b"), F.lit(1))
    found = spark.read.text(path).select(codes.alias("c")).where("size(c) >= 2")
    return found.select(F.col("c")[0].alias("county_fips"), F.element_at("c", -1).alias("adjacent_fips")).distinct()


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """Published corrections, latest first; invalid ones are an error."""
    rows = spark.read.schema(schemas.CORRECTION).json(path, multiLine=True)
    bad = rows.where("id is null or issuer_id is null or date is null or coalesce(trim(statement), '') = '' or coalesce(status, '') not in ('open', 'accepted', 'rejected') or (status <> 'open' and coalesce(trim(response), '') = '')")
    twice = rows.groupBy("id").count().where("count > 1")
    if not bad.isEmpty() or not twice.isEmpty():
        raise ValueError(f"{path}: corrections need an unique id, an issuer, a date, a statement, a known status and, once closed, a response")
    return rows.orderBy(F.desc("date"), "id")


def parse_snapshot(files: DataFrame, folder: str, limit: int | None = None) -> None:
    """Parse the files that ``folder`` does not hold yet (``limit`` of them, in order of their digests), and log the others.

    Tables grow by appending: providers, addresses, plans, and a log row (source_sha256, path, error) for each file that is no
    valid document. A file is done once it is in the log or its digest in ``done``; a run that was cut short repeats nothing that
    is done, and what it wrote without a digest in ``done`` is overlooked by ``parsed``.
    """
    spark = files.sparkSession
    done = parsed_digests(spark, folder)
    todo = files if done is None else unparsed(files, done)
    if limit is not None:
        todo = todo.orderBy("source_sha256").limit(limit)
    run = uuid.uuid4().hex
    todo = stage(todo, "todo")
    for name, rows in zip(("providers", "addresses", "plans"), providers(todo), strict=True):
        rows.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{folder}/{name}")
    parse_errors(todo).select("source_sha256", "path", F.lit("not a list of records").alias("error")).write.mode("append").json(f"{folder}/log")
    todo.select("source_sha256", F.lit(run).alias("run")).write.mode("append").parquet(f"{folder}/done")


def parsed_digests(spark: SparkSession, folder: str) -> DataFrame | None:
    """(source_sha256, run) of the files that are done; None before the first run."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/done")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("source_sha256 string, run string").parquet(f"{folder}/done")


def parsed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table that ``parse_snapshot`` wrote, without what runs left behind that did not end."""
    runs = spark.read.schema("source_sha256 string, run string").parquet(f"{folder}/done").select("source_sha256", "run")
    return spark.read.parquet(f"{folder}/{name}").join(runs, ["source_sha256", "run"], "left_semi").drop("run")
