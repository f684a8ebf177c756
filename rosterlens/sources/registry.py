"""Federal reference files as they are published: CSV files and workbooks inside zip archives.

A zip member is one deflate stream, so one task expands it. A CSV member becomes part files below a shared folder, cut
between records, which Spark then reads in parallel; a workbook's first sheet becomes rows of texts. Archives are
reached through pyarrow's file systems and never held whole.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import primary_taxonomy
from .staging import new_folder, stage

PART_BYTES = 1 << 26
ROWS = 10_000
#: The registry's columns and the names that they get.
NPPES = {
    "NPI": "npi",
    "Entity Type Code": "entity_type",
    "Provider Organization Name (Legal Business Name)": "org_name",
    "Provider Last Name (Legal Name)": "last_name",
    "Provider First Name": "first_name",
    "Provider Business Practice Location Address City Name": "practice_city",
    "Provider Business Practice Location Address State Name": "practice_state",
    "Provider Business Practice Location Address Postal Code": "practice_zip",
    "Provider Business Practice Location Address Telephone Number": "practice_phone",
    "NPI Deactivation Date": "deactivation_date",
    "NPI Reactivation Date": "reactivation_date",
    "Last Update Date": "last_update",
}
TAXONOMY, SWITCH, TAXONOMIES = "Healthcare Provider Taxonomy Code_{}", "Healthcare Provider Primary Taxonomy Switch_{}", 15
#: Columns of the plan files, and parts of the landscape's headers with the names that they get.
PLAN_ATTRIBUTES = ("BusinessYear", "StateCode", "IssuerId", "StandardComponentId", "PlanId", "PlanMarketingName", "MetalLevel", "DentalOnlyPlan", "ServiceAreaId", "MarketCoverage", "PlanType")
SERVICE_AREA = ("BusinessYear", "StateCode", "IssuerId", "ServiceAreaId", "ServiceAreaName", "CoverEntireState", "County", "PartialCounty", "ZipCodes", "MarketCoverage")
LANDSCAPE = {"State": "state", "County Name": "county_name", "FIPS": "fips", "Issuer Name": "issuer_name", "Plan ID": "plan_id", "Metal Level": "metal_level", "Plan Marketing Name": "plan_marketing_name", "Plan Type": "plan_type"}

_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _open(uri: str) -> zipfile.ZipFile:
    system, path = fs.FileSystem.from_uri(uri)
    return zipfile.ZipFile(system.open_input_file(path))


def _member(archive: zipfile.ZipFile, pattern: str) -> str:
    found = [n for n in archive.namelist() if re.search(pattern, n)]
    if not found:
        raise ValueError(f"no member like {pattern}")
    return found[0]


def cut_records(stream: io.BufferedIOBase, size: int) -> Iterator[bytes]:
    """Blocks of whole CSV records, of about ``size`` bytes; line feeds between quotes do not end a record."""
    rest = b""
    while block := stream.read(size):
        rest += block
        end = len(rest)
        while (end := rest.rfind(b"\n", 0, end)) >= 0 and rest.count(b'"', 0, end) % 2:
            pass
        if end >= 0:
            yield rest[: end + 1]
            rest = rest[end + 1 :]
    if rest:
        yield rest


def unpack_csv(spark: SparkSession, uri: str, pattern: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of a CSV member, all columns as text. Rows with another number of fields than the header are dropped."""
    folder = new_folder(spark, "unpacked")

    def expand(batches):
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(root, recursive=True)
        for batch in batches:
            for one in batch.column("uri").to_pylist():
                with _open(one) as archive, archive.open(_member(archive, pattern)) as stream:
                    header = stream.readline().removeprefix(b"\xef\xbb\xbf")
                    for block in cut_records(stream, part_bytes):
                        name = f"{uuid.uuid4().hex}.csv"
                        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                            out.write(header + block)
                        yield pa.RecordBatch.from_pylist([{"part": f"{folder.rstrip('/')}/{name}", "header": header}], pa.schema([("part", pa.string()), ("header", pa.binary())]))

    # only parts of tasks that returned count: one that ran again has written others
    parts = stage(spark.createDataFrame([(uri,)], "uri string").mapInArrow(expand, "part string, header binary"), "parts")
    found = parts.collect()  # a row for each part
    if not found:
        raise ValueError(f"{uri}: no rows")
    names = next(csv.reader(io.StringIO(found[0].header.decode("utf-8", "replace"))))
    schema = ", ".join(f"`{n.strip()}` string" for n in names) + ", `_corrupt` string"
    rows = spark.read.schema(schema).csv([r.part for r in found], header=True, quote='"', escape='"', multiLine=True, columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
    return rows.where("_corrupt is null").drop("_corrupt")


def _named(rows: DataFrame, columns: dict[str, str], what: str) -> list[Column]:
    if missing := [c for c in columns if c not in rows.columns]:
        raise ValueError(f"{what}: no column {', '.join(missing)}; the layout has changed")
    return [F.nullif(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in columns.items()]


def nppes(spark: SparkSession, uri: str) -> DataFrame:
    """The registry's monthly file: twelve columns, the primary taxonomy and all taxonomies."""
    rows = unpack_csv(spark, uri, r"npidata_pfile(?!.*fileheader).*\.csv$")
    pairs = {x.format(i): x.format(i) for i in range(1, TAXONOMIES + 1) for x in (TAXONOMY, SWITCH)}
    _named(rows, pairs, uri)
    codes, switches = (F.array(*[F.col(f"`{x.format(i)}`") for i in range(1, TAXONOMIES + 1)]) for x in (TAXONOMY, SWITCH))
    every = F.array_join(F.filter(codes, lambda c: F.coalesce(c, F.lit("")) != ""), "|")
    return rows.select(*_named(rows, NPPES, uri), primary_taxonomy(codes, switches).alias("taxonomy_primary"), F.nullif(every, F.lit("")).alias("taxonomies"))


def plan_file(spark: SparkSession, uri: str, columns: tuple[str, ...]) -> DataFrame:
    """A public use file's columns, in lower case (``PLAN_ATTRIBUTES``, ``SERVICE_AREA``)."""
    rows = unpack_csv(spark, uri, r"(?i)\.csv$")
    return rows.select(*_named(rows, {c: c.lower() for c in columns}, uri))


def sheet_rows(workbook: bytes) -> Iterator[list[str | None]]:
    """The rows of a workbook's first sheet, as texts."""
    with zipfile.ZipFile(io.BytesIO(workbook)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            for _, item in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
                if item.tag == f"{_SHEET}si":
                    shared.append("".join(t.text or "" for t in item.iter(f"{_SHEET}t")))
                    item.clear()
        first = min((n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for _, row in ElementTree.iterparse(book.open(first)):
            if row.tag != f"{_SHEET}row":
                continue
            out: list[str | None] = []
            for cell in row.iter(f"{_SHEET}c"):
                letters = re.match(r"[A-Z]*", cell.get("r") or "")[0]
                at = len(out)
                if letters:
                    at = 0
                    for letter in letters:
                        at = at * 26 + ord(letter) - 64
                    at -= 1
                out += [None] * (at + 1 - len(out))
                value = cell.find(f"{_SHEET}v")
                if cell.get("t") == "inlineStr":
                    out[at] = "".join(t.text or "" for t in cell.iter(f"{_SHEET}t"))
                elif value is not None:
                    out[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
            row.clear()
            yield out


def unpack_sheet(spark: SparkSession, uri: str) -> DataFrame:
    """(number, cells): the trimmed texts of the first sheet of the workbook in an archive. The workbook is read by one task."""

    def rows(batches):
        kinds = pa.schema([("number", pa.int64()), ("cells", pa.list_(pa.string()))])
        for batch in batches:
            for one in batch.column("uri").to_pylist():
                with _open(one) as archive:
                    raw = archive.read(_member(archive, r"\.xlsx$"))
                held = []
                for number, cells in enumerate(sheet_rows(raw)):
                    held.append({"number": number, "cells": [None if c is None else c.strip() for c in cells]})
                    if len(held) >= ROWS:
                        yield pa.RecordBatch.from_pylist(held, kinds)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, kinds)

    return stage(spark.createDataFrame([(uri,)], "uri string").mapInArrow(rows, "number long, cells array<string>"), "sheet")


def deactivations(spark: SparkSession, uri: str) -> DataFrame:
    """(npi, deactivation_date): rows below the header whose first cell has ten digits."""
    rows = unpack_sheet(spark, uri)
    header = rows.where(F.upper(F.get("cells", F.lit(0))) == "NPI").agg(F.min("number")).first()[0]
    if header is None:
        raise ValueError(f"{uri}: no header")
    return rows.where((F.col("number") > header) & F.get("cells", F.lit(0)).rlike(r"^[0-9]{10}\z")).select(F.get("cells", F.lit(0)).alias("npi"), F.get("cells", F.lit(1)).alias("deactivation_date"))


def landscape(spark: SparkSession, uri: str) -> DataFrame:
    """Plans and the counties where they are sold; columns are found by part of their header, plans have 14 characters at least."""
    rows = unpack_sheet(spark, uri)
    headers = rows.where(F.exists("cells", lambda c: F.coalesce(c.contains("Plan ID"), F.lit(False)))).orderBy("number").limit(1).collect()
    if not headers:
        raise ValueError(f"{uri}: no header")
    header = [(c or "").lower() for c in headers[0].cells]

    def place(part: str) -> int:
        found = [i for i, name in enumerate(header) if part.lower() in name]
        if not found:
            raise ValueError(f"{uri}: no column like {part}")
        return found[0]

    own = rows.where(F.col("number") > headers[0].number).select(*[F.get("cells", F.lit(place(part))).alias(name) for part, name in LANDSCAPE.items()])
    return own.where("length(plan_id) >= 14")
