"""What the national, state and issuer pages, the feed of changes and the open files show, one DataFrame each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm, specialty
from .compact import RECORD, by_records
from .metrics import bh_npis

#: What an exhibit's record must show.
EXHIBIT_PHONES = ("999999999", "9999999999", "0000000000")
EXHIBIT_ADDRESSES = ("null", "n/a", "")
EXHIBIT_DATE = "1900-01-01"


def _issuer() -> Column:
    return F.substring("scid", 1, 5).alias("issuer_id")


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def cells_by_grade(scores: DataFrame) -> DataFrame:
    return scores.groupBy("scope", F.coalesce("grade", F.lit("thin")).alias("grade")).agg(F.count("*").alias("n"))


def national_detail(scores: DataFrame, providers: DataFrame, evidence: DataFrame, month: str) -> DataFrame:
    """One row: what is on sale and thin, NPIs, the mean share out of area of plans (each plan once), the median months since a
    deactivation, and files whose newest date is more than a year before the month."""
    first = F.lit(f"{month}-01").cast("date")
    bh = F.col("scope") == "bh"
    on_sale = scores.where(bh).agg(F.count_distinct("scid").alias("plans"), F.count_distinct("county").alias("counties"), F.count_distinct("state").alias("states"), F.count("*").alias("bh_cells"), _count(F.col("thin_roster")).alias("thin_bh"))
    plans = scores.where("scope = 'all' and out_of_area_rate is not null").groupBy("scid").agg(F.max("out_of_area_rate").alias("rate"))
    away = plans.agg(norm.rounded(100 * F.avg("rate"), 1).alias("avg_ooa_pct"))
    npis = providers.agg(F.count_distinct("npi").alias("npis"))
    day = F.to_date(F.try_to_timestamp(F.get_json_object("observed", "$.deactivation_date"), F.lit("M/d/yyyy")))
    gone = evidence.where("subcode = 'DEACTIVATED'").groupBy("npi").agg(F.min(day).alias("day")).where("day is not null")
    months = 12 * (F.year(first) - F.year("day")) + F.month(first) - F.month("day")
    ages = gone.agg(F.round(F.median(months)).cast("int").alias("deact_median_months"))
    newest = providers.groupBy("source_sha256").agg(F.max(F.col("last_updated_on").try_cast("date")).alias("newest"))
    stale = newest.agg(_count(F.col("newest") < F.date_sub(first, 365)).alias("stale_files"))
    out = on_sale
    for one in (away, npis, ages, stale):
        out = out.crossJoin(one)  # a row each
    return out.withColumn("thin_bh_pct", norm.rounded(100.0 * F.col("thin_bh") / F.greatest("bh_cells", F.lit(1)), 1))


def worst_phone_file(providers: DataFrame, evidence: DataFrame, least: int = 500) -> DataFrame:
    """Of files of so many records, nine in ten of them individuals: the one with most placeholder phones, and its share
    that accepts patients."""
    files = providers.groupBy("source_sha256").agg(F.count("*").alias("n"), _count(F.col("accepting") == "accepting").alias("accepting"), _count(F.col("type") == "INDIVIDUAL").alias("people"))
    bad = evidence.where("metric = 'M3_PLACEHOLDER_VALUE' and subcode = 'PHONE'").select(*RECORD).distinct().groupBy("source_sha256").agg(F.count("*").alias("bad"))
    own = files.where((F.col("n") >= least) & (F.col("people") >= 0.9 * F.col("n"))).join(bad, "source_sha256")
    own = own.orderBy(F.desc(F.col("bad") / F.col("n")), F.desc("n"), "source_sha256").limit(1)
    return own.select("source_sha256", F.round(100.0 * F.col("bad") / F.col("n")).alias("phone_pct"), F.round(100.0 * F.col("accepting") / F.col("n")).alias("accepting_pct"))


def receipt(providers: DataFrame, addresses: DataFrame, manifest: DataFrame, date: str = EXHIBIT_DATE, specialty_like: str = "%psych%") -> DataFrame:
    """The first record that shows every placeholder at once and says it takes patients, with its file's host; no name, no NPI."""
    shown = addresses.where(F.col("phone").isin(*EXHIBIT_PHONES) & F.lower(F.coalesce("address", F.lit("null"))).isin(*EXHIBIT_ADDRESSES) & norm.digits(F.col("zip")).isin(*norm.PLACEHOLDER_ZIPS))
    people = providers.where((F.col("last_updated_on") == date) & (F.lower("accepting") == "accepting") & F.col("specialties").ilike(specialty_like))
    own = people.join(shown, list(RECORD)).orderBy(*RECORD, "addr_idx").limit(1)
    source = manifest.where("sha256 is not null").groupBy(F.col("sha256").alias("source_sha256")).agg(F.regexp_extract(F.min("url"), "//([^/]+)/", 1).alias("host"))
    return own.join(source, "source_sha256", "left").select(F.substring("source_sha256", 1, 12).alias("sha_short"), "specialties", "accepting", "last_updated_on", "address", "city", "state", "zip", "phone", "host")


def issuer_names(published: DataFrame) -> DataFrame:
    own = published.where("issuer_name is not null").groupBy(_issuer()).agg(F.min("issuer_name").alias("name"), F.array_sort(F.collect_set("state")).alias("states"))
    return own.withColumn("states", F.array_join("states", ","))


def issuer_pages(scores: DataFrame, names: DataFrame, hosts: DataFrame, feed: DataFrame) -> DataFrame:
    """Per named issuer: bh cells by grade, their mean score (thin ones too), the mean share out of area, hosts, feed flags.

    ``hosts``: (issuer_id, url); ``feed``: (issuer_id, subcode).
    """
    bh = F.col("scope") == "bh"
    grades = [_count(bh & (F.coalesce("grade", F.lit("thin")) == g)).alias(f"n_{g.lower()}") for g in ("A", "B", "C", "D", "F", "thin")]
    mix = scores.groupBy(_issuer()).agg(_count(bh).alias("cells"), *grades, norm.rounded(F.avg(F.when(bh, F.col("score"))), 1).alias("avg_bh"), norm.rounded(100 * F.avg(F.when(~bh, F.col("out_of_area_rate"))), 1).alias("ooa_pct"))
    places = hosts.groupBy("issuer_id").agg(F.array_join(F.array_sort(F.collect_set(F.regexp_extract("url", "//([^/]+)/", 1))), ",").alias("hosts"))
    flags = feed.groupBy("issuer_id").agg(F.array_join(F.array_sort(F.collect_set("subcode")), ",").alias("feed"))
    return names.join(mix, "issuer_id", "left").join(places, "issuer_id", "left").join(flags, "issuer_id", "left")


def issuer_evidence(evidence: DataFrame, m7: DataFrame, file_issuers: DataFrame) -> DataFrame:
    """Record findings under every publisher of their file, and one row per plan with its listings out of area."""
    key = ("issuer_id", "metric", "subcode", "evidence_strength", "source_sha256", "record_idx", "npi", "plan_id", "observed")
    records = evidence.join(file_issuers, "source_sha256").select(*key)
    per_plan = m7.groupBy("plan_id").agg(F.count("*").alias("n")).select(
        F.substring("plan_id", 1, 5).alias("issuer_id"), F.lit("M7_OUT_OF_AREA_SUMMARY").alias("metric"), F.lit("PER_PLAN_TOTAL").alias("subcode"), F.lit("E2").alias("evidence_strength"),
        F.lit(None).cast("string").alias("source_sha256"), F.lit(None).cast("long").alias("record_idx"), F.lit(None).cast("string").alias("npi"), "plan_id", norm.json_of(out_of_area_attachments=F.col("n")).alias("observed"),
    )
    return records.unionByName(per_plan)


def state_pages(scores: DataFrame) -> DataFrame:
    """Per state and county: the worst bh grade, thin and poor cells, and how many issuers sell there."""
    bh = scores.where("scope = 'bh'")
    return bh.groupBy("state", "county").agg(F.max("grade").alias("worst_grade"), _count(F.col("thin_roster")).alias("thin"), _count(F.col("grade").isin("D", "F")).alias("poor"), F.count_distinct(F.substring("scid", 1, 5)).alias("issuers"))


def thin_rosters(published: DataFrame) -> DataFrame:
    return published.where("scope = 'bh' and thin_roster").select("scid", "county_fips", "county_name", "state", "issuer_name", "plan_marketing_name", "n")


def capped(rows: DataFrame, cap: int = 250_000) -> DataFrame:
    """All rows, or as many as the cap in the order of their MD5 sums: the same sample in any engine."""
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(rows.columns)]))
    return rows.withColumn("_o", key).orderBy("_o").limit(cap).drop("_o")


def diff_summary(flag_status: DataFrame, grade_changes: DataFrame) -> DataFrame:
    """One row: findings by status and bh grades that moved."""
    status = flag_status.agg(*[_count(F.col("status") == s).alias(s) for s in ("new", "resolved", "persisting")])
    return status.crossJoin(grade_changes.agg(*[_count(F.col("move") == m).alias(m) for m in ("improved", "declined")]))  # a row each


def top_resolvers(flag_status: DataFrame, top: int = 10) -> DataFrame:
    return flag_status.where("status = 'resolved'").groupBy("issuer_id").agg(F.count("*").alias("resolved")).orderBy(F.desc("resolved"), "issuer_id").limit(top)


def snapshot_labels(snapshots: DataFrame) -> DataFrame:
    """(snapshot, label, next_update): the month's name, and the month after it."""
    day = F.to_date(F.concat("snapshot", F.lit("-01")))
    return snapshots.select("snapshot", F.date_format(day, "MMMM yyyy").alias("label"), F.concat(F.lit("early "), F.date_format(F.add_months(day, 1), "MMMM yyyy")).alias("next_update"))


def change_feed(summaries: DataFrame) -> DataFrame:
    """(snapshot, label, description), latest first, of (snapshot, previous, resolved, new, improved, declined); no previous: the first."""
    day = F.to_date(F.concat("snapshot", F.lit("-01")))
    first = F.concat(F.lit("First snapshot: baseline for "), F.date_format(day, "MMMM yyyy"))
    later = F.format_string("%d findings resolved, %d new; %d grades improved, %d declined since %s", *[F.col(c) for c in ("resolved", "new", "improved", "declined", "previous")])
    return summaries.select("snapshot", F.date_format(day, "MMMM yyyy").alias("label"), F.when(F.col("previous").isNull(), first).otherwise(later).alias("description")).orderBy(F.desc("snapshot"))


def fetch_status(manifest: DataFrame) -> DataFrame:
    """Per role: fetches, successes, failures."""
    return manifest.groupBy("role").agg(F.count("*").alias("fetches"), F.count("sha256").alias("ok"), _count(F.col("sha256").isNull()).alias("failures"))


def seed_scopes(feeds: DataFrame) -> DataFrame:
    """Per scope: indexes, issuer rows, states (of ``ingest.feeds``)."""
    return feeds.groupBy("scope").agg(F.count("*").alias("indexes"), F.sum(F.size("issuer_ids")).alias("issuers"), F.size(F.array_distinct(F.flatten(F.collect_list("states")))).alias("states"))


def corrections_by_issuer(corrections: DataFrame) -> DataFrame:
    return corrections.groupBy("issuer_id").agg(F.count("*").alias("n"), _count(F.col("status") == "open").alias("open"), F.max("date").alias("latest"))


def fused_verdicts(providers: DataFrame, nppes: DataFrame, rules: specialty.Rules = specialty.Rules()) -> DataFrame:
    """(record, verdict): bh_taxonomy if its NPI has such a code, bh_string if its specialty is one, else the specialty's verdict."""
    by_name = providers.join(specialty.verdicts(providers, rules), "specialties", "left")
    own = by_name.join(by_records(bh_npis(nppes).withColumn("_code", F.lit(True))), "npi", "left")
    return own.select(*RECORD, F.when(F.col("_code"), "bh_taxonomy").when(F.col("verdict") == "bh", "bh_string").otherwise(F.coalesce("verdict", F.lit("unknown"))).alias("verdict"))


def profile(providers: DataFrame) -> DataFrame:
    """Per file: records, how many have each field, valid NPIs, kinds, and the range of dates."""
    has = [_count(F.coalesce(F.trim(c), F.lit("")) != "").alias(f"has_{c}") for c in ("npi", "specialties", "accepting", "last_updated_on")]
    valid = _count(norm.well_formed_npi(F.col("npi")) & norm.luhn_npi(F.when(norm.well_formed_npi(F.col("npi")), F.col("npi"))))
    return providers.groupBy("source_sha256").agg(F.count("*").alias("records"), *has, valid.alias("valid_npis"), F.count_distinct("type").alias("kinds"), F.min("last_updated_on").alias("oldest"), F.max("last_updated_on").alias("newest"))


def common_phones(addresses: DataFrame, top: int = 8) -> DataFrame:
    """The phones on most records."""
    own = addresses.select(*RECORD, norm.digits(F.col("phone")).alias("phone")).where("length(phone) >= 10").distinct()
    return own.groupBy("phone").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "phone").limit(top)


def phone_audit(providers: DataFrame, addresses: DataFrame, target: str) -> DataFrame:
    """Records by type and by whether they have only this number, it and others, only others, or none."""
    pd = F.when(F.length(norm.digits(F.col("phone"))) >= 10, norm.digits(F.col("phone")))
    phones = addresses.groupBy(*RECORD).agg(F.array_sort(F.collect_set(pd)).alias("phones"))
    has = F.array_contains("phones", target)
    bucket = F.when(F.coalesce(F.size("phones"), F.lit(0)) <= 0, "no_phone").when(has & (F.size("phones") == 1), "only_target").when(has, "target_plus_other").otherwise("other_only")
    return providers.join(phones, list(RECORD), "left").groupBy("type", bucket.alias("bucket")).agg(F.count("*").alias("n"))
