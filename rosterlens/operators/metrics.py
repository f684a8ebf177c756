"""The integrity checks. Each takes relations and returns evidence rows: a record, a subcode, a strength, a weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import norm, specialty
from ..sources.staging import stage
from .compact import RECORD, by_records

RULE_VERSION = "1"
EVIDENCE = ("snapshot", "metric", "subcode", "evidence_strength", "weight", "source_sha256", "record_idx", "npi", "plan_id", "observed", "rule_version")
#: Specialties whose practitioners work at many sites.
MANY_SITES = "radiolog|patholog|anesthesiolog|emergency medicine|hospitalist"
#: Owners of shared numbers, and hosts that refuse programs.
PHONE_OWNERS = {
    "8663892727": ("CVS MinuteClinic national booking line (1-866-389-ASAP)", "provider-org-central-line"),
    "8008132000": ("Kaiser Permanente member services line", "plan-line"),
    "8084320000": ("Kaiser Permanente Hawaii appointment line", "plan-line"),
}
RESTRICTED_HOSTS = ("www.uhc.com", "public-cdn.wellmark.com", "www.mercycarehealthplans.com")


def evidence(rows: DataFrame, metric: str, subcode: Column | str, strength: Column | str, weight: Column | float, observed: Column, snapshot: str, plan_id: Column | None = None) -> DataFrame:
    def column(x):
        return x if isinstance(x, Column) else F.lit(x)

    return rows.select(
        F.lit(snapshot).alias("snapshot"),
        F.lit(metric).alias("metric"),
        column(subcode).alias("subcode"),
        column(strength).alias("evidence_strength"),
        column(weight).cast("double").alias("weight"),
        *RECORD,
        "npi",
        (plan_id if plan_id is not None else F.lit(None).cast("string")).alias("plan_id"),
        observed.alias("observed"),
        F.lit(RULE_VERSION).alias("rule_version"),
    )


def placeholder_values(providers: DataFrame, addresses: DataFrame, fetch_date: str, snapshot: str) -> DataFrame:
    """M3: phones, ZIP codes and addresses that cannot be real (any bad address suffices), and impossible dates.

    One pass over the addresses counts all three kinds.
    """
    kinds = {"PHONE": (norm.bad_phone, "phone"), "ZIP": (norm.bad_zip, "zip"), "ADDRESS": (norm.bad_address, "address")}
    counts = []
    for kind, (bad, c) in kinds.items():
        counts += [F.count(F.when(bad(F.col(c)), 1)).alias(f"{kind}_n"), F.min(F.when(bad(F.col(c)), F.coalesce(F.col(c), F.lit("")))).alias(f"{kind}_example")]
    per_record = addresses.groupBy(*RECORD).agg(*counts)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("subcode"), F.col(f"{k}_n").alias("rows"), F.col(f"{k}_example").alias("example")) for k in kinds])).alias("x")
    found = per_record.select(*RECORD, each).select(*RECORD, "x.*").where("rows > 0").join(by_records(providers.select(*RECORD, "npi")), list(RECORD), "left")
    by_address = evidence(found, "M3_PLACEHOLDER_VALUE", F.col("subcode"), "E1", 1.0, norm.json_of(example=F.col("example"), addr_rows=F.col("rows")), snapshot)
    date = F.col("last_updated_on")
    impossible = providers.where((date < "2014-01-01") | (date > fetch_date))
    return by_address.unionByName(evidence(impossible, "M3_PLACEHOLDER_VALUE", "DATE", "E1", 0.7, norm.json_of(last_updated_on=date), snapshot))


def stale_attestations(providers: DataFrame, fetch_date: str, snapshot: str) -> DataFrame:
    """M4: last updated 180 days ago or earlier, and 365."""
    date = F.col("last_updated_on")
    old = providers.where((date >= "2014-01-01") & (date < norm.days_before(fetch_date, 180)))
    year = date < norm.days_before(fetch_date, 365)
    return evidence(old, "M4_STALE_ATTESTATION", F.when(year, "STALE_365").otherwise("STALE_180"), "E2", F.when(year, 0.8).otherwise(0.5), norm.json_of(last_updated_on=date), snapshot)


def concentrated_phones(addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct usable phones of each record, and the numbers on at least 50 and 1 % of a file's records with a phone."""
    phones = addresses.select(*RECORD, norm.digits(F.col("phone")).alias("pd")).where(F.length("pd") >= 10).distinct()
    files = phones.select(*RECORD).distinct().groupBy("source_sha256").agg(F.count("*").alias("n"))
    shared = phones.groupBy("source_sha256", "pd").agg(F.count("*").alias("on_records")).join(files, "source_sha256").where(F.col("on_records") >= F.greatest(F.lit(50.0), 0.01 * F.col("n")))
    return phones, shared.select("source_sha256", "pd", "on_records")


def call_center_only(providers: DataFrame, addresses: DataFrame, nppes: DataFrame, snapshot: str, owners: dict[str, tuple[str, str]] = PHONE_OWNERS) -> DataFrame:
    """M5: records all of whose phones are shared by many records of their file.

    The shared numbers are few (each is on 1 % of a file's records) but are the hot keys: they are a table before they are joined,
    so that Spark knows their size, broadcasts them if they are small and else splits the numbers that most records have.
    """
    phones, shared = concentrated_phones(addresses)
    shared = stage(shared, "shared-phones")
    flagged = (
        phones.join(shared.withColumn("hit", F.lit(1)), ["source_sha256", "pd"], "left")
        .groupBy(*RECORD)
        .agg(F.count("*").alias("n"), F.count("hit").alias("hits"), F.min(F.when(F.col("hit") == 1, F.col("pd"))).alias("phone"), F.max("on_records").alias("on_records"))
        .where("n = hits")
    )
    owner = addresses.sparkSession.createDataFrame([(k, *v) for k, v in owners.items()], "phone string, owner string, owner_class string")
    registry = nppes.groupBy("npi").agg(F.min(norm.digits(F.col("practice_phone"))).alias("registered"))
    rows = flagged.join(by_records(providers.select(*RECORD, "npi")), list(RECORD), "left").join(F.broadcast(owner), "phone", "left").join(by_records(registry), "npi", "left")
    none = F.lit("unattributed")
    seen = norm.json_of(
        concentration_phone=F.col("phone"),
        shared_with_records=F.col("on_records"),
        owner=F.coalesce("owner", none),
        owner_class=F.coalesce("owner_class", none),
        nppes_divergent_phone=F.coalesce((F.length("registered") >= 10) & (F.col("registered") != F.col("phone")), F.lit(False)),
    )
    return evidence(rows, "M5_CALL_CENTER_ONLY", "CALL_CENTER_ONLY", "E2", 0.6, seen, snapshot)


def address_inflation(providers: DataFrame, addresses: DataFrame, snapshot: str) -> DataFrame:
    """M6: more distinct addresses than one practitioner (10) or organisation (25) would have."""
    place = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in ("address", "city", "state")])
    counts = addresses.groupBy(*RECORD).agg(F.count_distinct(place).alias("n"), F.count_distinct("state").alias("states"))
    one = F.coalesce(F.col("type") == "INDIVIDUAL", F.lit(False))
    many_sites = F.lower(F.coalesce("specialties", F.lit(""))).rlike(MANY_SITES)
    rows = counts.where("n > 10").join(by_records(providers.select(*RECORD, "npi", "type", "specialties")), list(RECORD)).where((one & ~many_sites) | (~one & (F.col("n") > 25)))
    n = F.col("n")
    code = F.when(one & (n > 25), "INDIVIDUAL_GT25").when(one, "INDIVIDUAL_GT10").when(n > 100, "ORG_GT100").otherwise("ORG_GT25")
    strong = (one & (n > 25)) | (n > 100)
    return evidence(rows, "M6_ADDRESS_INFLATION", code, "E2", F.when(strong, 0.6).otherwise(0.4), norm.json_of(unique_addresses=n, states=F.col("states"), type=F.col("type")), snapshot)


def allowed_counties(service_area: DataFrame, plan_attributes: DataFrame, counties: DataFrame, adjacency: DataFrame) -> DataFrame:
    """(scid, allowed): the counties of each plan's service area and those next to them, as an array."""
    whole = (F.upper("coverentirestate") == "YES") | F.col("county").isNull()
    area = service_area.withColumn("whole", whole)
    named = area.where(~F.col("whole")).select("issuerid", "serviceareaid", "county")
    states = area.where("whole").select("issuerid", "serviceareaid", F.col("statecode").alias("state")).join(counties, "state").select("issuerid", "serviceareaid", F.col("county_fips").alias("county"))
    plans = plan_attributes.select(F.col("standardcomponentid").alias("scid"), F.col("issuerid"), F.col("serviceareaid")).distinct()
    own = plans.join(named.unionByName(states).distinct(), ["issuerid", "serviceareaid"]).select("scid", "county")
    near = own.join(adjacency, own["county"] == adjacency["county_fips"]).select("scid", F.col("adjacent_fips").alias("county"))
    return own.unionByName(near).groupBy("scid").agg(F.collect_set("county").alias("allowed"))


def out_of_area(providers: DataFrame, attached: DataFrame, record_counties: DataFrame, allowed: DataFrame, snapshot: str) -> DataFrame:
    """M7: (record, plan) where no county of the record is in or next to the plan's area.

    Counties become an array per record and per plan (there are some 3,200 counties), so a pair is compared once. The plans' arrays
    are a table before they are joined: broadcast if small, else Spark splits a plan that very many records are in.
    """
    allowed = stage(allowed, "allowed-counties")
    places = record_counties.groupBy(*RECORD).agg(F.collect_set("county").alias("here"))
    pairs = attached.join(by_records(places), list(RECORD)).join(allowed, "scid").where(~F.arrays_overlap("here", "allowed"))
    rows = pairs.join(by_records(providers.select(*RECORD, "npi")), list(RECORD), "left")
    seen = norm.json_of(plan_state=F.substring("scid", 6, 2), counties=F.size("here"))
    return evidence(rows, "M7_OUT_OF_AREA_LISTING", "OUT_OF_AREA", "E2", 0.8, seen, snapshot, F.col("scid"))


def accepting_unknown(providers: DataFrame, snapshot: str) -> DataFrame:
    """M8: practitioners who do not say whether they take patients."""
    rows = providers.where((F.col("type") == "INDIVIDUAL") & F.lower(F.coalesce("accepting", F.lit(""))).isin("", "unknown"))
    return evidence(rows, "M8_ACCEPTING_UNKNOWN", "ACCEPTING_UNKNOWN", "E1", 0.3, norm.json_of(accepting=F.col("accepting")), snapshot)


def npi_registry_status(providers: DataFrame, nppes: DataFrame, deactivated: DataFrame, snapshot: str) -> DataFrame:
    """M9: NPIs that are missing or malformed, fail their check digit, or are deactivated (and have no active row)."""
    metric, npi = "M9_NPI_REGISTRY_STATUS", F.col("npi")
    formed = norm.well_formed_npi(npi)
    code = F.when(~formed, "MISSING_OR_MALFORMED").when(~norm.luhn_npi(npi), "LUHN_INVALID")
    invalid = evidence(providers.withColumn("code", code).where("code is not null"), metric, F.col("code"), "E1", 1.0, norm.json_of(npi=npi), snapshot)
    active = nppes.where("entity_type is not null").select("npi")
    gone = providers.join(by_records(deactivated), "npi").join(by_records(active), "npi", "left_anti")
    return invalid.unionByName(evidence(gone, metric, "DEACTIVATED", "E3", 0.7, norm.json_of(npi=npi, deactivation_date=F.col("deactivation_date")), snapshot))


def bh_npis(nppes: DataFrame) -> DataFrame:
    """NPIs with a behavioral-health taxonomy."""
    return nppes.select("npi", F.explode(F.split("taxonomies", r"\|")).alias("code")).where(specialty.bh_code(F.col("code"))).select("npi").distinct()


def taxonomy_mismatch(providers: DataFrame, nppes: DataFrame, snapshot: str, rules: specialty.Rules = specialty.Rules()) -> DataFrame:
    """M10: a behavioral-health specialty whose NPI has taxonomies, but none of behavioral health."""
    verdict = specialty.verdicts(providers, rules).where("verdict = 'bh'").select("specialties")
    known = nppes.where("taxonomies is not null").select("npi", "taxonomies")
    bh = providers.join(verdict, "specialties", "left_semi")  # not an inner join, as that would broadcast the records if their files are small
    rows = bh.join(by_records(known), "npi").join(by_records(bh_npis(nppes)), "npi", "left_anti")
    return evidence(rows, "M10_TAXONOMY_MISMATCH", "BH_STRING_NOT_BH_TAXONOMY", "E3", 0.5, norm.json_of(specialties=F.col("specialties"), nppes_taxonomies=F.col("taxonomies")), snapshot)


def feed_flags(manifest: DataFrame, snapshot: str, hosts: tuple[str, ...] = RESTRICTED_HOSTS) -> DataFrame:
    """M1 and M2 for index URLs: never fetched, most files failed, or on a host that refuses programs."""
    ok = manifest.where("sha256 is not null").select("url").distinct()
    index = manifest.where("role = 'index'").select("url").distinct()
    files = manifest.where("role in ('provider', 'plan') and index_url is not null").select("index_url", "url").distinct().join(ok.withColumn("ok", F.lit(1)), "url", "left")
    failed = files.groupBy(F.col("index_url").alias("url")).agg(F.count("*").alias("total"), F.count("ok").alias("n_ok")).where("n_ok < 0.5 * total").select("url")
    refused = F.lit(False)
    for host in hosts:
        refused |= F.col("url").contains(host)
    parts = (("M1_DEAD_FEED", "INDEX_UNREACHABLE", index.join(ok, "url", "left_anti")), ("M1_DEAD_FEED", "MAJORITY_FILES_FAILED", index.join(failed, "url", "left_semi")), ("M2_ACCESS_RESTRICTED", "BROWSER_UA_ONLY", index.where(refused)))
    out = None
    for metric, code, rows in parts:
        one = rows.select(F.lit(snapshot).alias("snapshot"), F.lit(metric).alias("metric"), F.lit(code).alias("subcode"), F.lit("E1").alias("evidence_strength"), "url", F.lit(RULE_VERSION).alias("rule_version"))
        out = one if out is None else out.unionByName(one)
    return out
