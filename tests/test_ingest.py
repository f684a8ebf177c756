import json
import time

import pytest

from rosterlens.operators import pages
from rosterlens.sources import ingest, sinks
from rosterlens.streaming import feeds

PERSON = {"npi": "1700000005", "type": "INDIVIDUAL", "name": {"first": "A", "last": "B"}, "sex": "F", "accepting": "accepting", "specialty": ["Cardiology", "Sleep Medicine"], "languages": "Basque", "addresses": [{"address": "1 St", "zip": 60601}, {"address": "2 St"}], "plans": [{"plan_id_type": "HIOS-PLAN-ID", "plan_id": "54321IL0070002", "years": [2026]}, {"plan_id": "x", "years": 2025}]}


def test_provider_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([PERSON, 7, {"npi": "2", "type": "FACILITY", "facility_name": "C"}]))
    (tmp_path / "b.json").write_bytes(b'{"providers": [{"npi": "3\xff", "specialty": "Counselor"}]}')
    (tmp_path / "c.json").write_text("{broken")
    files = ingest.blobs(spark, str(tmp_path))
    records, addresses, plans = ingest.providers(files)
    rows = {r.npi: r for r in records.collect()}
    assert set(rows) == {"1700000005", "2", "3�"}
    one = rows["1700000005"]
    assert (one.specialties, one.specialty_count, one.addresses_count, one.plans_count, one.gender, one.languages) == ("Cardiology|Sleep Medicine", 2, 2, 2, "F", "Basque")
    assert (rows["2"].record_idx, rows["2"].addresses_count) == (2, 0) and rows["3�"].specialties == "Counselor"
    assert [(r.addr_idx, r.address, r.zip) for r in addresses.orderBy("addr_idx").collect()] == [(0, "1 St", "60601"), (1, "2 St", None)]
    assert [(r.plan_id, r.years) for r in plans.orderBy("plan_idx").collect()] == [("54321IL0070002", "2026"), ("x", "2025")]
    assert ingest.parse_errors(files).count() == 1
    assert ingest.unparsed(files, records).count() == 1


def test_plan_and_index_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"plan_id_type": "HIOS-PLAN-ID", "plan_id": "1", "marketing_name": "Gold", "network": [{"network_tier": "A"}, {"network_tier": "B"}]}]))
    assert [(r.plan_id, r.network_tiers) for r in ingest.plans(ingest.blobs(spark, str(tmp_path / "p.json"))).collect()] == [("1", "A|B")]
    (tmp_path / "i.json").write_text(json.dumps({"provider_urls": ["u1", "u1", "u2"], "plan_urls": ["v"]}))
    assert ingest.index_urls(ingest.blobs(spark, str(tmp_path / "i.json"))).count() == 3


def test_reference_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Code|Grouping|Other\n2084P0800X|G|\n|x|y\n")
    assert [tuple(r) for r in ingest.csv_table(spark, str(tmp_path / "t.csv"), ["Code", "Grouping"], "|").collect()] == [("2084P0800X", "G"), (None, "x")]
    (tmp_path / "a.txt").write_text('"Autauga, AL"|01001|"Chilton, AL"|01021\nno codes\n')
    assert [tuple(r) for r in ingest.adjacency(spark, str(tmp_path / "a.txt")).collect()] == [("01001", "01021")]
    seed = spark.createDataFrame([("https://a.com/i.json", "1", "AL"), ("https://a.com/i.json", "2", "TX"), ("https://Dental.com/i.json", "3", "AL")], "url string, issuer_id string, state string")
    hosts = spark.createDataFrame([("dental.com", "dental")], "host string, scope string")
    assert {(r.host, r.scope, tuple(r.issuer_ids)) for r in ingest.feeds(seed, hosts).collect()} == {("a.com", "medical", ("1", "2")), ("dental.com", "dental", ("3",))}


def test_a_parse_resumes_and_logs(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in range(4):
        (source / f"{k}.json").write_text(json.dumps([PERSON | {"npi": str(k)}]) if k else "{broken")
    files = ingest.blobs(spark, str(source))
    ingest.parse_snapshot(files, out, limit=2)
    assert ingest.parsed_digests(spark, out).count() == 2
    ingest.parse_snapshot(files, out)
    ingest.parse_snapshot(files, out)
    assert sorted(r.npi for r in ingest.parsed(spark, out, "providers").collect()) == ["1", "2", "3"]
    assert ingest.parsed(spark, out, "addresses").count() == 6
    assert [r.error for r in spark.read.json(f"{out}/log").collect()] == ["not a list of records"]


def test_corrections(spark, tmp_path):
    rows = [{"id": "1", "issuer_id": "10000", "date": "2026-08-01", "status": "open", "statement": "x"}, {"id": "2", "issuer_id": "10000", "date": "2026-08-03", "status": "accepted", "statement": "y", "response": "z"}]
    (tmp_path / "c.json").write_text(json.dumps(rows))
    got = ingest.corrections(spark, str(tmp_path / "c.json"))
    assert [r.id for r in got.collect()] == ["2", "1"]
    assert [tuple(r) for r in pages.corrections_by_issuer(got).collect()] == [("10000", 2, 1, "2026-08-03")]
    (tmp_path / "d.json").write_text(json.dumps([rows[0], rows[0]]))
    with pytest.raises(ValueError):
        ingest.corrections(spark, str(tmp_path / "d.json"))


def test_primary_taxonomy(spark):
    rows = spark.createDataFrame([(["A", "B"], ["N", "Y"]), (["A", "B"], ["N", "N"]), (["", "B"], ["Y", "N"]), ([], [])], "codes array<string>, switches array<string>")
    assert [r[0] for r in rows.select(ingest.primary_taxonomy(rows.codes, rows.switches)).collect()] == ["B", "A", "B", None]


def test_receipt_and_labels(spark):
    people = spark.createDataFrame([("f1", 0, "Psychology", "Accepting", "1900-01-01"), ("f0", 1, "Cardiology", "accepting", "1900-01-01"), ("f0", 2, "PSYCHIATRY", "accepting", "1900-01-01")], "source_sha256 string, record_idx long, specialties string, accepting string, last_updated_on string")
    places = spark.createDataFrame([(f, i, 0, "NULL", "X", "AL", "99999", "9999999999") for f, i in (("f1", 0), ("f0", 1))] + [("f0", 2, 0, "1 Main St", "X", "AL", "99999", "9999999999")], "source_sha256 string, record_idx long, addr_idx int, address string, city string, state string, zip string, phone string")
    manifest = spark.createDataFrame([("f1", "https://a.example.com/x.json")], "sha256 string, url string")
    assert [(r.sha_short, r.specialties, r.host) for r in pages.receipt(people, places, manifest).collect()] == [("f1", "Psychology", "a.example.com")]
    labels = pages.snapshot_labels(spark.createDataFrame([("2026-08",), ("2026-12",)], "snapshot string")).collect()
    assert [tuple(r) for r in labels] == [("2026-08", "August 2026", "early September 2026"), ("2026-12", "December 2026", "early January 2027")]
    feeds_ = spark.createDataFrame([("a", ["1", "2"], ["AL"]), ("a", ["3"], ["AL", "TX"]), ("b", ["4"], ["TX"])], "scope string, issuer_ids array<string>, states array<string>")
    assert {tuple(r) for r in pages.seed_scopes(feeds_).collect()} == {("a", 2, 3, 2), ("b", 1, 1, 1)}


def test_sinks_write_what_they_are_given(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"k{i % 2}", "2026-08", "M4") for i in range(50)], "n int, k string, snapshot string, metric string")
    sinks.evidence_table(rows, str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).where("metric = 'M4'").count() == 50
    sinks.parquet(rows, str(tmp_path / "p"))
    sinks.append_log(rows, str(tmp_path / "l"))
    sinks.append_log(rows, str(tmp_path / "l"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 50 and spark.read.json(str(tmp_path / "l")).count() == 100
    for write, place in ((sinks.ordered_csv, "o"), (sinks.plain_csv, "c")):
        write(rows, str(tmp_path / place), "n")
        files = sorted(str(p) for p in (tmp_path / place).glob("part-*"))
        assert [int(r.n) for f in files for r in spark.read.csv(f, header=True).collect()] == list(range(50))
    sinks.per_key(rows, str(tmp_path / "k"), "k", "n")
    for k in (0, 1):
        files = sorted(str(p) for p in (tmp_path / "k" / f"k=k{k}").glob("part-*"))
        assert [int(r.n) for f in files for r in spark.read.csv(f, header=True).collect()] == list(range(k, 50, 2))


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"k{i % 3}") for i in range(20)], "n int, k string")
    sinks.ordered_csv(rows, str(tmp_path / "o"), "n")
    assert spark.read.csv(str(tmp_path / "o"), header=True).count() == 20
    sinks.per_key(rows, str(tmp_path / "k"), "k", "n")
    assert {p.name for p in (tmp_path / "k").glob("k=*")} == {"k=k0", "k=k1", "k=k2"}
    assert json.loads(sinks.summary(rows.groupBy().count())) == {"count": 20}


def test_dead_feeds_in_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [("i1", "2026-08-01T00:00:00", None), ("i1", "2026-08-04T00:00:00", None), ("i2", "2026-08-01T00:00:00", None), ("i2", "2026-08-02T00:00:00", "x"), ("i2", "2026-08-05T00:00:00", None)]
    (source / "a.json").write_text("\n".join(json.dumps({"role": "index", "url": u, "fetched_at": t, "sha256": s}) for u, t, s in rows))
    query = feeds.dead_feeds(feeds.fetches(spark, str(source))).writeStream.format("memory").queryName("dead").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        time.sleep(0.1)
        assert [r.url for r in spark.table("dead").collect()] == ["i1"]
    finally:
        query.stop()
