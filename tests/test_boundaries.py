"""Both sides of every threshold, on rows made for it."""

import pytest
from pyspark.sql import functions as F

from rosterlens.functions import norm, specialty
from rosterlens.operators import attribution, compact, diff, metrics, scoring

DAY, SNAPSHOT = "2026-08-21", "2026-08"
PROVIDER = "source_sha256 string, record_idx long, npi string, type string, accepting string, last_updated_on string, specialties string"
ADDRESS = "source_sha256 string, record_idx long, addr_idx int, address string, city string, state string, zip string, phone string"


def people(spark, *rows):
    base = {"source_sha256": "f", "record_idx": 0, "npi": "1255010732", "type": "INDIVIDUAL", "accepting": "accepting", "last_updated_on": DAY, "specialties": None}
    return spark.createDataFrame([tuple((base | {"record_idx": i} | r).values()) for i, r in enumerate(rows)], PROVIDER)


def places(spark, *rows):
    base = {"source_sha256": "f", "record_idx": 0, "addr_idx": 0, "address": "1 Main St", "city": "X", "state": "AL", "zip": "10000", "phone": "(212) 555-1234"}
    return spark.createDataFrame([tuple((base | {"record_idx": i} | r).values()) for i, r in enumerate(rows)], ADDRESS)


def codes(rows):
    return {(r.record_idx, r.subcode) for r in rows.collect()}


def test_stale(spark):
    dates = ["2026-02-22", "2026-02-23", "2025-08-21", "2025-08-22", "2014-01-01", "2013-12-31", None]
    got = codes(metrics.stale_attestations(people(spark, *[{"last_updated_on": d} for d in dates]), DAY, SNAPSHOT))
    assert got == {(0, "STALE_180"), (2, "STALE_365"), (3, "STALE_180"), (4, "STALE_365")}


def test_placeholder_dates(spark):
    dates = ["2013-12-31", "2026-08-22", "2026-08-21T00:00:00", "08/01/2026", "2026-08-21", None]
    got = codes(metrics.placeholder_values(people(spark, *[{"last_updated_on": d} for d in dates]), places(spark).limit(0), DAY, SNAPSHOT))
    assert got == {(i, "DATE") for i in range(4)}


@pytest.mark.parametrize(
    ("column", "code", "bad", "good"),
    [
        ("phone", "PHONE", [None, "", "999999999", "0", "1111111111"], ["(555) 123-4567", "15551234567"]),
        ("zip", "ZIP", ["99999", "00000", "4730", None], ["47304-1234", "99999-9999"]),
        ("address", "ADDRESS", [None, "", "NULL", "N/A", "na", "Unknown"], [" "]),
    ],
)
def test_placeholders(spark, column, code, bad, good):
    rows = places(spark, *[{column: x} for x in bad + good])
    got = metrics.placeholder_values(people(spark, *[{}] * len(bad + good)), rows, DAY, SNAPSHOT)
    assert codes(got) == {(i, code) for i in range(len(bad))}


def test_call_center(spark):
    common, rare = {"phone": "8005550000"}, {"phone": "8005550001"}
    rows = [common] * 50 + [rare] * 49 + [common | {"record_idx": 200}, {"record_idx": 200, "phone": "2125550199", "addr_idx": 1}]
    nppes = spark.createDataFrame([], "npi string, practice_phone string")
    got = metrics.call_center_only(people(spark, *[{}] * 99), places(spark, *rows), nppes, SNAPSHOT)
    assert codes(got) == {(i, "CALL_CENTER_ONLY") for i in range(50)}


def test_inflation(spark):
    kinds = [("INDIVIDUAL", 10, None), ("INDIVIDUAL", 11, None), ("INDIVIDUAL", 26, None), ("INDIVIDUAL", 101, None), ("INDIVIDUAL", 79, "Diagnostic Radiology"), ("GROUP", 25, None), ("GROUP", 26, None), ("GROUP", 101, None), ("Individual", 11, None), ("Individual", 26, None), (None, 26, None)]
    rows = [{"record_idx": i, "address": f"{k} St"} for i, (_, n, _) in enumerate(kinds) for k in range(n)]
    got = metrics.address_inflation(people(spark, *[{"type": t, "specialties": s} for t, _, s in kinds]), places(spark, *rows), SNAPSHOT)
    assert {(r.record_idx, r.subcode, r.weight) for r in got.collect()} == {
        (1, "INDIVIDUAL_GT10", 0.4), (2, "INDIVIDUAL_GT25", 0.6), (3, "INDIVIDUAL_GT25", 0.6), (6, "ORG_GT25", 0.4), (7, "ORG_GT100", 0.6), (9, "ORG_GT25", 0.4), (10, "ORG_GT25", 0.4),
    }


def test_accepting(spark):
    rows = [("INDIVIDUAL", None), ("INDIVIDUAL", ""), ("INDIVIDUAL", "Unknown"), ("FACILITY", None), ("INDIVIDUAL", "not accepting")]
    got = metrics.accepting_unknown(people(spark, *[{"type": t, "accepting": a} for t, a in rows]), SNAPSHOT)
    assert {i for i, _ in codes(got)} == {0, 1, 2}


def test_registry(spark):
    npis = [None, "123", "1234567890\n", "1255010732", "1255010733", "1000000004", "1000000012"]
    nppes = spark.createDataFrame([("1000000004", None), ("1000000012", "1")], "npi string, entity_type string")
    gone = spark.createDataFrame([("1000000004", "01/15/2020"), ("1000000012", "01/15/2020")], "npi string, deactivation_date string")
    got = metrics.npi_registry_status(people(spark, *[{"npi": n} for n in npis]), nppes, gone, SNAPSHOT)
    assert codes(got) == {(0, "MISSING_OR_MALFORMED"), (1, "MISSING_OR_MALFORMED"), (2, "MISSING_OR_MALFORMED"), (4, "LUHN_INVALID"), (5, "DEACTIVATED")}


def test_out_of_area(spark):
    attached = spark.createDataFrame([("f", i, s) for i, s in enumerate(["10000AL0000001", "10000AL0000001", "10000AL0000001", "10000AL0000001", "10000AL0000009", "10000AL0000002"])], "source_sha256 string, record_idx long, scid string")
    where = spark.createDataFrame([("f", 0, "01001"), ("f", 1, "01003"), ("f", 2, "01005"), ("f", 4, "01005"), ("f", 5, "01005")], "source_sha256 string, record_idx long, county string")
    area = spark.createDataFrame([("10000", "AL", "S0", "No", "01001"), ("10000", "AL", "S1", "Yes", None)], "issuerid string, statecode string, serviceareaid string, coverentirestate string, county string")
    plans = spark.createDataFrame([("10000AL0000001", "10000", "S0"), ("10000AL0000002", "10000", "S1")], "standardcomponentid string, issuerid string, serviceareaid string")
    counties = spark.createDataFrame([(c, "AL") for c in ("01001", "01003", "01005")], "county_fips string, state string")
    near = spark.createDataFrame([("01001", "01003"), ("01003", "01005")], "county_fips string, adjacent_fips string")
    allowed = metrics.allowed_counties(area, plans, counties, near)
    assert {i for i, _ in codes(metrics.out_of_area(people(spark, *[{}] * 6), attached, where, allowed, SNAPSHOT))} == {2}


def test_attach(spark):
    rows = [("HIOS-PLAN-ID", "28856IN0220001-01", None), ("HIOS-PLAN-ID", "28856IN0220002", "2025"), ("hios-plan-id", "28856IN0220003", "2025|2026"), ("OTHER", "28856IN0220004", None), ("HIOS-PLAN-ID", "bad", None), ("HIOS-PLAN-ID", None, None)]
    plans = spark.createDataFrame([("f", i, *r) for i, r in enumerate(rows)], "source_sha256 string, record_idx long, plan_id_type string, plan_id string, years string")
    assert {(r.record_idx, r.scid) for r in compact.attach(plans).collect()} == {(0, "28856IN0220001"), (2, "28856IN0220003")}


def test_penalties(spark):
    cases = [[(0.5, "E1")], [(0.5, "E1"), (0.3, "E1")], [(0.6, "E2"), (0.5, "E3")], [(0.7, "E3")], [(1.0, "E1"), (0.7, "E1")], [(0.1, "E1")] * 4]
    rows = [("f", i, "M", w, e) for i, case in enumerate(cases) for w, e in case] + [("f", 99, "M7_OUT_OF_AREA_LISTING", 0.8, "E2")]
    got = scoring.record_penalties(spark.createDataFrame(rows, "source_sha256 string, record_idx long, metric string, weight double, evidence_strength string"))
    want = [(0.5, 0.5, 0.6), (0.575, 0.575, 0.75), (0.725, 0.6, 0.75), (0.7, 0, 0.6), (1, 1, 0.75), (0.175, 0.175, 1.0)]
    assert {r.record_idx: (round(r.pen, 9), round(r.pen_a, 9), round(r.pen_u, 9)) for r in got.collect()} == dict(enumerate(want))


def test_cells_without_behavioral_health(spark):
    roster = spark.createDataFrame([("10000AL0000001", "01001", "AL", "f", i, False) for i in range(12)], "scid string, county string, state string, source_sha256 string, record_idx long, is_bh boolean")
    penalties = spark.createDataFrame([], "source_sha256 string, record_idx long, pen double, pen_a double, pen_u double")
    rates = spark.createDataFrame([("10000AL0000001", 0.5)], "scid string, ooa_rate double")
    got = {r.scope: r for r in scoring.cell_scores(roster, penalties, rates).collect()}
    assert (got["all"].n, got["all"].score, got["all"].grade, got["all"].low_sample) == (12, 92.0, "A", True)
    assert (got["bh"].n, got["bh"].score, got["bh"].grade, got["bh"].thin_roster, got["bh"].numeric_suppressed) == (0, 92.0, None, True, False)


def test_grades(spark):
    rows = spark.createDataFrame([(90.0, 10), (89.99, 10), (80.0, 10), (70.0, 10), (55.0, 10), (54.99, 10), (99.0, 9)], "s double, n int")
    assert [r[0] for r in rows.select(norm.grade(F.col("s"), F.col("n"))).collect()] == ["A", "B", "B", "C", "D", "F", None]


def test_specialties(spark):
    rows = ["Psychiatry", "PSYCHIATRY", "Psychologist|Psychology", "Physical Therapy", "Zebra Mental Wellness Consultant", "Developmental Disabilities Aide", None, "Psychiatry &amp; Neurology, Psychiatry", ""]
    got = {r.specialties: r.verdict for r in specialty.verdicts(spark.createDataFrame([(x,) for x in rows], "specialties string")).collect()}
    assert got["Psychiatry"] == got["PSYCHIATRY"] == got["Psychologist|Psychology"] == "bh"
    assert got["Physical Therapy"] == "not_bh" and got["Zebra Mental Wellness Consultant"] == "ambiguous"
    assert got["Developmental Disabilities Aide"] == "unknown" and got["Psychiatry &amp; Neurology, Psychiatry"] in ("bh", "ambiguous")


def test_codes(spark):
    rows = spark.createDataFrame([(c,) for c in ("2084P0800X", "101YM0800X", "2084N0400X", "225100000X")], "code string")
    assert [r[0] for r in rows.select(specialty.bh_code(F.col("code"))).collect()] == [True, True, False, False]


def test_feeds(spark):
    rows = [("index", "i1", None, "x"), ("index", "i2", None, None)] + [("provider", f"p{k}", "i1", "x" if k == 0 else None) for k in range(4)] + [("index", "i3", None, "x"), ("provider", "q0", "i3", "x"), ("provider", "q1", "i3", None)]
    got = metrics.feed_flags(spark.createDataFrame(rows, "role string, url string, index_url string, sha256 string"), SNAPSHOT, ("i3",))
    assert {(r.subcode, r.url) for r in got.collect()} == {("INDEX_UNREACHABLE", "i2"), ("MAJORITY_FILES_FAILED", "i1"), ("BROWSER_UA_ONLY", "i3")}


def test_diff(spark):
    schema = "issuer_id string, metric string, subcode string, npi string"
    before = spark.createDataFrame([("1", "M3", "PHONE", "a"), ("1", "M3", "PHONE", "b"), ("1", "M3", "ZIP", None)], schema)
    now = spark.createDataFrame([("1", "M3", "PHONE", "a"), ("1", "M3", "PHONE", "c")], schema)
    assert {(r.npi, r.status) for r in diff.flag_status(before, now).collect()} == {("a", "persisting"), ("b", "resolved"), ("c", "new")}
    assert [(r.metric, r.delta) for r in diff.count_changes(before, now).collect()] == [("M3", -1)]
    snapshots = spark.createDataFrame([("2026-06",), ("2026-07",)], "snapshot string")
    assert diff.previous_snapshot(snapshots, "2026-07").first().previous == "2026-06" and diff.previous_snapshot(snapshots, "2026-06").first().previous is None


def test_out_of_area_counts_go_to_the_issuer_of_the_plan(spark):
    rows = spark.createDataFrame([("f", "M7_OUT_OF_AREA_LISTING", "X", "a", "22222AL0000001"), ("f", "M3", "X", None, None)], "source_sha256 string, metric string, subcode string, npi string, plan_id string")
    found = diff.by_issuer(rows, spark.createDataFrame([("f", "11111"), ("f", "22222")], "source_sha256 string, issuer_id string"))
    got = {(r.issuer_id, r.metric): r.delta for r in diff.count_changes(found.limit(0), found).collect()}
    assert got == {("22222", "M7_OUT_OF_AREA_LISTING"): 1, ("11111", "M3"): 1, ("22222", "M3"): 1}


def test_orphans(spark):
    evidence = spark.createDataFrame([("f", 0), ("f", 1)], "source_sha256 string, record_idx long")
    owners = spark.createDataFrame([("f", 0, "10000")], "source_sha256 string, record_idx long, issuer_id string")
    files = spark.createDataFrame([("f", "10000"), ("f", "20000")], "source_sha256 string, issuer_id string")
    assert {(r.record_idx, r.issuer_id) for r in attribution.orphans(evidence, owners, files).collect()} == {(1, "10000"), (1, "20000")}
