"""The directory's queries: every operator over the whole corpus, with the oracle of each."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import specialty
from ..operators import attribution, callsheet, compact, diff, metrics, pages, reports, scoring
from ..operators.compact import RECORD
from ..sources import corpus
from ..sources.corpus import FETCH_DATE, SNAPSHOT
from ..sources.staging import stage, stage_union
from .oracle_steps import query

_KEY = "metric, subcode, evidence_strength, weight, source_sha256, record_idx, npi"


#: Relations whose rows belong to a file.
_OF_FILES = ("providers", "providers_before", "provider_addresses", "provider_plans", "file_issuers")


class _Numbered:
    """The corpus with numbers in place of the files' SHA-256 sums.

    Each relation is numbered once, as a table: a plan that numbers what it reads sends the files' numbers to the driver and back for
    every place where it reads a relation. Plan memberships are read once, by ``attached``, and are numbered there.
    """

    def __init__(self, audit: Audit):
        self.audit = audit
        self.tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        rows = self.audit.raw[name]
        if name not in _OF_FILES:
            return rows
        if name not in self.tables:
            numbered = compact.encode(rows, self.audit.files, "source_sha256", "file")
            self.tables[name] = numbered if name == "provider_plans" else stage(numbered, name.replace("_", "-"))
        return self.tables[name]


class Audit:
    """The relations of one run, each built once and lazily.

    The bridges, the evidence and the scores are staged: an audit's steps hand tables on, and many reports start from them.
    Files are numbers (``c``) from the scan on, so that joins, sorts and shuffles carry eight bytes for 64 characters; ``named`` gives
    the rows of a result their SHA-256 sums back. ``raw`` is the corpus as it was read.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = corpus.load(spark, sf_dir)
        self.c = _Numbered(self)

    @cached_property
    def files(self) -> DataFrame:
        """(source_sha256, file): staged, so Spark knows its size and broadcasts it only if it is small (thousands of files)."""
        sums = [self.raw[name].select("source_sha256").distinct() for name in _OF_FILES]
        return stage(compact.surrogate_keys(scoring.union(sums), "source_sha256", "file"), "files")

    def named(self, rows: DataFrame) -> DataFrame:
        numbers = "source_sha256" in rows.columns and rows.schema["source_sha256"].dataType.typeName() == "long"
        return compact.decode(rows, self.files, "source_sha256", "file") if numbers else rows

    @cached_property
    def attached(self) -> DataFrame:
        return stage(compact.attach(self.c["provider_plans"]))

    @cached_property
    def record_counties(self) -> DataFrame:
        return stage(compact.record_counties(self.c["provider_addresses"], self.c["zip_county"]))

    @cached_property
    def m3(self) -> DataFrame:
        return metrics.placeholder_values(self.c["providers"], self.c["provider_addresses"], FETCH_DATE, SNAPSHOT)

    @cached_property
    def m4(self) -> DataFrame:
        return metrics.stale_attestations(self.c["providers"], FETCH_DATE, SNAPSHOT)

    @cached_property
    def m5(self) -> DataFrame:
        return metrics.call_center_only(self.c["providers"], self.c["provider_addresses"], self.c["nppes"], SNAPSHOT)

    @cached_property
    def m6(self) -> DataFrame:
        return metrics.address_inflation(self.c["providers"], self.c["provider_addresses"], SNAPSHOT)

    @cached_property
    def m7(self) -> DataFrame:
        allowed = metrics.allowed_counties(self.c["service_area"], self.c["plan_attributes"], self.c["counties"], self.c["county_adjacency"])
        return stage(metrics.out_of_area(self.c["providers"], self.attached, self.record_counties, allowed, SNAPSHOT))

    @cached_property
    def m8(self) -> DataFrame:
        return metrics.accepting_unknown(self.c["providers"], SNAPSHOT)

    @cached_property
    def m9(self) -> DataFrame:
        return metrics.npi_registry_status(self.c["providers"], self.c["nppes"], self.c["nppes_deactivated"], SNAPSHOT)

    @cached_property
    def m10(self) -> DataFrame:
        return metrics.taxonomy_mismatch(self.c["providers"], self.c["nppes"], SNAPSHOT)

    @cached_property
    def evidence(self) -> DataFrame:
        return stage_union([self.m3, self.m4, self.m5, self.m6, self.m8, self.m9, self.m10])

    def small_evidence(self, suffix: str) -> DataFrame:
        """The checks that look at the records alone, for the snapshot before ('_before') or this one ('')."""
        p = self.c[f"providers{suffix}"]
        dates = metrics.placeholder_values(p, self.c["provider_addresses"].limit(0), FETCH_DATE, SNAPSHOT)
        parts = [dates, metrics.stale_attestations(p, FETCH_DATE, SNAPSHOT), metrics.accepting_unknown(p, SNAPSHOT), metrics.npi_registry_status(p, self.c["nppes"], self.c["nppes_deactivated"], SNAPSHOT)]
        return diff.by_issuer(scoring.union(parts), self.c["file_issuers"])

    @cached_property
    def evidence_before(self) -> DataFrame:
        """The keyed checks on the earlier snapshot's records, with the addresses and the registry that both share."""
        p, a, n = self.c["providers_before"], self.c["provider_addresses"], self.c["nppes"]
        parts = [
            metrics.placeholder_values(p, a, FETCH_DATE, SNAPSHOT),
            metrics.stale_attestations(p, FETCH_DATE, SNAPSHOT),
            metrics.call_center_only(p, a, n, SNAPSHOT),
            metrics.address_inflation(p, a, SNAPSHOT),
            metrics.accepting_unknown(p, SNAPSHOT),
            metrics.npi_registry_status(p, n, self.c["nppes_deactivated"], SNAPSHOT),
            metrics.taxonomy_mismatch(p, n, SNAPSHOT),
        ]
        return stage_union(parts)

    @cached_property
    def m7_before(self) -> DataFrame:
        allowed = metrics.allowed_counties(self.c["service_area"], self.c["plan_attributes"], self.c["counties"], self.c["county_adjacency"])
        return stage(metrics.out_of_area(self.c["providers_before"], self.attached, self.record_counties, allowed, SNAPSHOT))

    def findings(self, before: bool) -> DataFrame:
        """All evidence of one snapshot, M7 included, under its issuers."""
        parts = [self.evidence_before, self.m7_before] if before else [self.evidence, self.m7]
        return diff.by_issuer(scoring.union(parts), self.c["file_issuers"])

    @cached_property
    def penalties(self) -> DataFrame:
        return scoring.record_penalties(self.evidence)

    @cached_property
    def bh(self) -> DataFrame:
        return stage(scoring.bh_records(self.c["providers"], self.c["nppes"]), "bh-records")

    @cached_property
    def roster(self) -> DataFrame:
        return scoring.roster(scoring.cells(self.c["plan_county"]), self.attached, self.record_counties, self.bh)

    @cached_property
    def rates(self) -> DataFrame:
        return scoring.out_of_area_rates(self.attached, self.record_counties, self.m7)

    @cached_property
    def scores(self) -> DataFrame:
        """What the scores meet is staged one by one: in one plan all of it would run at once, and fill the driver's memory."""
        rates, penalties = stage(self.rates, "rates"), stage(self.penalties, "penalties")
        return stage(scoring.cell_scores(self.roster, penalties, rates), "scores")

    @cached_property
    def scores_before(self) -> DataFrame:
        """Scores of the earlier snapshot's records, on the plans, addresses and registry that both share; county 01001 was not sold."""
        bh = stage(scoring.bh_records(self.c["providers_before"], self.c["nppes"]), "bh-records")
        cells = scoring.cells(self.c["plan_county"].where("fips <> '01001'"))
        roster = scoring.roster(cells, self.attached, self.record_counties, bh)
        rates = stage(scoring.out_of_area_rates(self.attached, self.record_counties, self.m7_before), "rates")
        return stage(scoring.cell_scores(roster, stage(scoring.record_penalties(self.evidence_before), "penalties"), rates), "scores")

    @cached_property
    def status_all(self) -> DataFrame:
        return stage(diff.flag_status(self.findings(True), self.findings(False)))

    @cached_property
    def published(self) -> DataFrame:
        return stage(scoring.published(self.scores, self.c["plan_county"]))

    @cached_property
    def calls(self) -> DataFrame:
        """Staged: the inventory of the cells and the rows of the chosen ones both start from it."""
        return stage(callsheet.call_roster(callsheet.candidates(self.scores), self.roster, self.c["providers"], self.c["provider_addresses"]))

    @cached_property
    def chosen(self) -> DataFrame:
        return callsheet.chosen_cells(callsheet.cell_inventory(self.calls), 5, 5)


_AUDITS: dict[tuple[str, str], Audit] = {}


def audit(spark: SparkSession, sf_dir: str) -> Audit:
    """The audit of these tables, one for each application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _AUDITS:
        _AUDITS[key] = Audit(spark, sf_dir)
    return _AUDITS[key]


def _fields(rows: DataFrame, **paths: str) -> DataFrame:
    """Evidence columns, and fields of ``observed``: name = kind."""
    own = [c.strip() for c in _KEY.split(",")]
    return rows.select(*own, *[F.get_json_object("observed", f"$.{k}").cast(v).alias(k) for k, v in paths.items()])


_TARGET = "8005550003"


def _hosts(a: Audit) -> DataFrame:
    own = a.raw["manifest"].where("sha256 is not null").select(F.col("sha256").alias("source_sha256"), "url")
    return own.join(a.raw["file_issuers"], "source_sha256").select("issuer_id", "url")


def _feed(a: Audit) -> DataFrame:
    flags = metrics.feed_flags(a.c["manifest"], SNAPSHOT, (*metrics.RESTRICTED_HOSTS, "host2.com")).select(F.col("url").alias("index_url"), "subcode")
    files = a.raw["manifest"].where("sha256 is not null").select("index_url", F.col("sha256").alias("source_sha256")).join(a.raw["file_issuers"], "source_sha256")
    return files.join(flags, "index_url").select("issuer_id", "subcode").distinct()


def _summaries(a: Audit) -> DataFrame:
    changes = pages.diff_summary(a.status_all, diff.grade_changes(a.scores_before, a.scores))
    now = changes.select(F.lit(SNAPSHOT).alias("snapshot"), F.lit("2026-07").alias("previous"), "resolved", "new", "improved", "declined")
    return now.unionByName(now.select(F.lit("2026-07").alias("snapshot"), F.lit(None).cast("string").alias("previous"), *[F.lit(0).cast("long").alias(c) for c in ("resolved", "new", "improved", "declined")]))


_SCORES = "scid, county, state, scope, n, component_a, component_b, out_of_area_rate, score_weighted, score, score_uniform, grade, low_sample, numeric_suppressed, thin_roster"
_ISSUER = "substr(scid, 1, 5)"

#: name: (what it computes from an audit, the oracle's select)
DOMAIN = {
    "compact_attach": (lambda a: a.attached, "SELECT * FROM attach"),
    "compact_rec_county": (lambda a: a.record_counties, "SELECT * FROM rec_county"),
    "m3_placeholder": (lambda a: _fields(a.m3, example="string", addr_rows="long"), f"SELECT {_KEY}, example, n AS addr_rows FROM m3"),
    "m4_stale": (lambda a: _fields(a.m4, last_updated_on="string"), f"SELECT {_KEY}, last_updated_on FROM m4"),
    "m5_call_center": (
        lambda a: _fields(a.m5, concentration_phone="string", shared_with_records="long", owner_class="string", nppes_divergent_phone="boolean"),
        f"SELECT {_KEY}, phone AS concentration_phone, on_records AS shared_with_records, owner_class, divergent AS nppes_divergent_phone FROM m5",
    ),
    "m6_inflation": (lambda a: _fields(a.m6, unique_addresses="long", states="long"), f"SELECT {_KEY}, n AS unique_addresses, states FROM m6"),
    "m7_out_of_area": (lambda a: a.m7.select(*_KEY.split(", "), "plan_id", F.get_json_object("observed", "$.counties").cast("long").alias("counties")), f"SELECT {_KEY}, plan_id, counties FROM m7"),
    "m8_accepting": (lambda a: _fields(a.m8), f"SELECT {_KEY} FROM m8"),
    "m9_registry": (lambda a: _fields(a.m9, deactivation_date="string"), f"SELECT {_KEY}, deactivation_date FROM m9"),
    "m10_taxonomy": (lambda a: _fields(a.m10, specialties="string", nppes_taxonomies="string"), f"SELECT {_KEY}, specialties, taxonomies AS nppes_taxonomies FROM m10"),
    "specialty_normalize_classify": (lambda a: specialty.verdicts(a.c["providers"]), "SELECT specialties, verdict FROM specialty_verdicts"),
    "m1_m2_feed": (lambda a: metrics.feed_flags(a.c["manifest"], SNAPSHOT, (*metrics.RESTRICTED_HOSTS, "host2.com")).select("metric", "subcode", "url"), "SELECT metric, subcode, url FROM feed"),
    "evidence_union": (lambda a: a.evidence.groupBy("metric", "subcode").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 3).alias("weight")), "SELECT metric, subcode, count(*) AS n, round(sum(weight), 3) AS weight FROM evidence GROUP BY 1, 2"),
    "record_penalty": (
        lambda a: a.penalties.select(*RECORD, *[F.round(c, 6).alias(c) for c in ("pen", "pen_a", "pen_u")]),
        "SELECT source_sha256, record_idx, round(pen, 6) AS pen, round(pen_a, 6) AS pen_a, round(pen_u, 6) AS pen_u FROM penalties",
    ),
    "roster": (
        lambda a: a.roster.groupBy("scid", "county", "state").agg(F.count("*").alias("n"), F.count(F.when(F.col("is_bh"), 1)).alias("n_bh")),
        "SELECT scid, county, state, count(*) AS n, count(*) FILTER (WHERE is_bh) AS n_bh FROM roster GROUP BY 1, 2, 3",
    ),
    "component_b": (lambda a: a.rates.withColumn("ooa_rate", F.round("ooa_rate", 6)), "SELECT scid, n_attached, n_out_of_area, round(ooa_rate, 6) AS ooa_rate FROM rates"),
    "cell_scores": (lambda a: a.scores, f"SELECT {_SCORES} FROM scores"),
    "score_publish": (
        lambda a: scoring.published(a.scores, a.c["plan_county"]).select("scid", "county_fips", "scope", "score", "issuer_name", "plan_marketing_name", "metal_level", "county_name"),
        "SELECT s.scid, s.county AS county_fips, scope, score, min(issuer_name) AS issuer_name, min(plan_marketing_name) AS plan_marketing_name, min(metal_level) AS metal_level, min(county_name) AS county_name FROM scores s LEFT JOIN plan_county p ON substr(p.plan_id, 1, 14) = s.scid AND p.fips = s.county GROUP BY 1, 2, 3, 4",
    ),
    "flag_status": (
        lambda a: diff.flag_status(a.small_evidence("_before"), a.small_evidence("")),
        "SELECT coalesce(b.issuer_id, n.issuer_id) AS issuer_id, coalesce(b.metric, n.metric) AS metric, coalesce(b.subcode, n.subcode) AS subcode, coalesce(b.npi, n.npi) AS npi, CASE WHEN b.npi IS NULL THEN 'new' WHEN n.npi IS NULL THEN 'resolved' ELSE 'persisting' END AS status FROM (SELECT DISTINCT issuer_id, metric, subcode, npi FROM evidence_before JOIN file_issuers USING (source_sha256) WHERE npi IS NOT NULL) b FULL JOIN (SELECT DISTINCT issuer_id, metric, subcode, npi FROM evidence_small JOIN file_issuers USING (source_sha256) WHERE npi IS NOT NULL) n ON b.issuer_id = n.issuer_id AND b.metric = n.metric AND b.subcode = n.subcode AND b.npi = n.npi",
    ),
    "count_changes": (
        lambda a: diff.count_changes(a.small_evidence("_before"), a.small_evidence("")),
        "SELECT issuer_id, metric, coalesce(n_before, 0) AS n_before, coalesce(n_now, 0) AS n_now, coalesce(n_now, 0) - coalesce(n_before, 0) AS delta FROM (SELECT issuer_id, metric, count(*) AS n_before FROM evidence_before JOIN file_issuers USING (source_sha256) WHERE npi IS NULL GROUP BY 1, 2) b FULL JOIN (SELECT issuer_id, metric, count(*) AS n_now FROM evidence_small JOIN file_issuers USING (source_sha256) WHERE npi IS NULL GROUP BY 1, 2) n USING (issuer_id, metric)",
    ),
    "flag_status_all": (
        lambda a: a.status_all,
        "SELECT issuer_id, metric, subcode, npi, CASE WHEN max(now) = 0 THEN 'resolved' WHEN min(now) = 1 THEN 'new' ELSE 'persisting' END AS status FROM (SELECT metric, subcode, npi, source_sha256, 1 AS now FROM evidence UNION ALL SELECT metric, subcode, npi, source_sha256, 0 FROM all_before) JOIN file_issuers USING (source_sha256) WHERE npi IS NOT NULL GROUP BY 1, 2, 3, 4",
    ),
    "count_changes_all": (
        lambda a: diff.count_changes(a.findings(True), a.findings(False)),
        "SELECT issuer_id, metric, CAST(sum(1 - now) AS BIGINT) AS n_before, CAST(sum(now) AS BIGINT) AS n_now, CAST(sum(2 * now - 1) AS BIGINT) AS delta FROM (SELECT issuer_id, metric, 1 AS now FROM evidence JOIN file_issuers USING (source_sha256) WHERE npi IS NULL UNION ALL SELECT issuer_id, metric, 0 FROM all_before JOIN file_issuers USING (source_sha256) WHERE npi IS NULL UNION ALL SELECT substr(plan_id, 1, 5), metric, 1 FROM m7 UNION ALL SELECT substr(plan_id, 1, 5), metric, 0 FROM m7_before) GROUP BY 1, 2",
    ),
    "grade_changes": (lambda a: diff.grade_changes(a.scores_before, a.scores), "SELECT * FROM grade_moves"),
    "cells_by_grade": (lambda a: pages.cells_by_grade(a.scores), "SELECT scope, CASE WHEN grade IS NULL THEN 'thin' ELSE grade END AS grade, count(*) AS n FROM scores GROUP BY ALL"),
    "national_detail": (
        lambda a: pages.national_detail(a.scores, a.c["providers"], a.evidence, SNAPSHOT),
        f"""SELECT len(list_distinct(list(scid))) AS plans, len(list_distinct(list(county))) AS counties, len(list_distinct(list(state))) AS states, count(*) AS bh_cells, count_if(thin_roster)::BIGINT AS thin_bh, round(round(100.0 * count_if(thin_roster) / count(*), 9), 1) AS thin_bh_pct,
 (SELECT round(round(100 * avg(r), 9), 1) FROM (SELECT DISTINCT scid, out_of_area_rate AS r FROM scores WHERE r IS NOT NULL)) AS avg_ooa_pct, (SELECT count(DISTINCT npi) FROM providers) AS npis,
 (SELECT CAST(round(median(date_diff('month', TRY_STRPTIME(deactivation_date, '%m/%d/%Y'), DATE '{SNAPSHOT}-01'))) AS INT) FROM (SELECT npi, min(deactivation_date) AS deactivation_date FROM m9 WHERE subcode = 'DEACTIVATED' GROUP BY 1)) AS deact_median_months,
 (SELECT count_if(newest < DATE '{SNAPSHOT}-01' - 365)::BIGINT FROM (SELECT max(TRY_CAST(last_updated_on AS DATE)) AS newest FROM providers GROUP BY source_sha256)) AS stale_files FROM scores WHERE scope = 'bh'""",
    ),
    "worst_phone_file": (
        lambda a: pages.worst_phone_file(a.c["providers"].where("type <> 'GROUP'"), a.evidence, 3),
        "SELECT source_sha256, round(100.0 * bad / n) AS phone_pct, round(100.0 * accepting / n) AS accepting_pct FROM (SELECT source_sha256, count(*) AS n, sum((accepting = 'accepting')::INT) AS accepting, avg((type = 'INDIVIDUAL')::INT) AS people FROM providers WHERE type <> 'GROUP' GROUP BY 1) JOIN (SELECT source_sha256, count(*) AS bad FROM bad_records WHERE subcode = 'PHONE' GROUP BY 1) USING (source_sha256) WHERE n >= 3 AND people >= 0.9 ORDER BY bad / n DESC, n DESC, source_sha256 LIMIT 1",
    ),
    "issuer_names": (lambda a: pages.issuer_names(a.published), f"SELECT {_ISSUER} AS issuer_id, 'Issuer ' || {_ISSUER} AS name, string_agg(DISTINCT state, ',' ORDER BY state) AS states FROM scores GROUP BY 1, 2"),
    "issuer_pages": (
        lambda a: pages.issuer_pages(a.scores, pages.issuer_names(a.published), _hosts(a), _feed(a)),
        "SELECT issuer_id, name, states, cells, n_a, n_b, n_c, n_d, n_f, n_thin, avg_bh, ooa_pct, hosts, feed FROM (SELECT substr(scid, 1, 5) AS issuer_id, 'Issuer ' || substr(scid, 1, 5) AS name, string_agg(DISTINCT state, ',' ORDER BY state) AS states, "
        + "count(*) FILTER (WHERE scope = 'bh') AS cells, " + "".join(f"count(*) FILTER (WHERE scope = 'bh' AND grade = '{g}') AS n_{g.lower()}, " for g in "ABCDF")
        + "count(*) FILTER (WHERE scope = 'bh' AND grade IS NULL) AS n_thin, round(round(avg(score) FILTER (WHERE scope = 'bh'), 9), 1) AS avg_bh, round(round(100 * avg(out_of_area_rate) FILTER (WHERE scope = 'all'), 9), 1) AS ooa_pct FROM scores GROUP BY 1, 2) "
        + "LEFT JOIN (SELECT issuer_id, string_agg(DISTINCT split_part(url, '/', 3), ',' ORDER BY split_part(url, '/', 3)) AS hosts FROM manifest JOIN file_issuers ON sha256 = source_sha256 GROUP BY 1) USING (issuer_id) "
        + "LEFT JOIN (SELECT issuer_id, string_agg(DISTINCT subcode, ',' ORDER BY subcode) AS feed FROM manifest f JOIN file_issuers ON sha256 = source_sha256 JOIN feed ON feed.url = f.index_url GROUP BY 1) USING (issuer_id)",
    ),
    "issuer_evidence": (
        lambda a: pages.issuer_evidence(a.evidence, a.m7, a.c["file_issuers"]).select("issuer_id", "metric", "subcode", "source_sha256", "record_idx", "npi", "plan_id", F.get_json_object("observed", "$.out_of_area_attachments").cast("long").alias("n")),
        "SELECT issuer_id, metric, subcode, source_sha256, record_idx, npi, NULL AS plan_id, NULL AS n FROM evidence JOIN file_issuers USING (source_sha256) UNION ALL SELECT substr(plan_id, 1, 5), 'M7_OUT_OF_AREA_SUMMARY', 'PER_PLAN_TOTAL', NULL, NULL, NULL, plan_id, count(*) FROM m7 GROUP BY plan_id",
    ),
    "state_pages": (lambda a: pages.state_pages(a.scores), f"SELECT state, county, max(grade) AS worst_grade, count(*) FILTER (WHERE thin_roster) AS thin, count(*) FILTER (WHERE grade IN ('D', 'F')) AS poor, count(DISTINCT {_ISSUER}) AS issuers FROM scores WHERE scope = 'bh' GROUP BY 1, 2"),
    "thin_rosters": (lambda a: pages.thin_rosters(a.published), "SELECT scid, county AS county_fips, 'County ' || county AS county_name, state, 'Issuer ' || substr(scid, 1, 5) AS issuer_name, 'Plan ' || scid AS plan_marketing_name, n FROM scores WHERE scope = 'bh' AND n < 10"),
    "capped_export": (lambda a: pages.capped(a.named(a.m4.select("source_sha256", "record_idx", "subcode")), 40), "SELECT source_sha256, record_idx, subcode FROM m4 ORDER BY md5(record_idx || '|' || source_sha256 || '|' || subcode) LIMIT 40"),
    "diff_summary": (
        lambda a: pages.diff_summary(a.status_all, diff.grade_changes(a.scores_before, a.scores)),
        "SELECT (SELECT count(*) FROM all_status WHERE was = 0) AS new, (SELECT count(*) FROM all_status WHERE is_now = 0) AS resolved, (SELECT count(*) FROM all_status WHERE was + is_now = 2) AS persisting, (SELECT count(*) FROM grade_moves WHERE move = 'improved') AS improved, (SELECT count(*) FROM grade_moves WHERE move = 'declined') AS declined",
    ),
    "top_resolvers": (lambda a: pages.top_resolvers(a.status_all), "SELECT issuer_id, count(*) AS resolved FROM all_status WHERE is_now = 0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "change_feed": (
        lambda a: pages.change_feed(_summaries(a)),
        "SELECT '2026-07' AS snapshot, 'July 2026' AS label, 'First snapshot: baseline for July 2026' AS description UNION ALL SELECT '2026-08', 'August 2026', (SELECT count(*) FROM all_status WHERE is_now = 0) || ' findings resolved, ' || (SELECT count(*) FROM all_status WHERE was = 0) || ' new; ' || (SELECT count(*) FROM grade_moves WHERE move = 'improved') || ' grades improved, ' || (SELECT count(*) FROM grade_moves WHERE move = 'declined') || ' declined since 2026-07'",
    ),
    "fetch_status": (lambda a: pages.fetch_status(a.c["manifest"]), "SELECT role, count(*) AS fetches, sum((sha256 IS NOT NULL)::INT)::BIGINT AS ok, sum((sha256 IS NULL)::INT)::BIGINT AS failures FROM manifest GROUP BY 1"),
    "fused_verdicts": (
        lambda a: pages.fused_verdicts(a.c["providers"], a.c["nppes"]),
        "SELECT source_sha256, record_idx, CASE WHEN npi IN (SELECT npi FROM bh_npi) THEN 'bh_taxonomy' WHEN verdict IS NULL THEN 'unknown' WHEN verdict = 'bh' THEN 'bh_string' ELSE verdict END AS verdict FROM providers LEFT JOIN specialty_verdicts USING (specialties)",
    ),
    "file_profile": (
        lambda a: pages.profile(a.c["providers"]),
        "SELECT p.source_sha256, count(*) AS records, " + ", ".join(f"count(nullif(trim({c}), '')) AS has_{c}" for c in ("npi", "specialties", "accepting", "last_updated_on"))
        + ", count(*) FILTER (WHERE regexp_full_match(coalesce(npi, ''), '[0-9]{10}') AND (source_sha256, record_idx) NOT IN (SELECT (source_sha256, record_idx) FROM m9 WHERE subcode = 'LUHN_INVALID')) AS valid_npis, count(DISTINCT type) AS kinds, min(last_updated_on) AS oldest, max(last_updated_on) AS newest FROM providers p GROUP BY 1",
    ),
    "common_phones": (lambda a: pages.common_phones(a.c["provider_addresses"]), "SELECT pd AS phone, count(*) AS records FROM phones GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"),
    "phone_audit": (
        lambda a: pages.phone_audit(a.c["providers"], a.c["provider_addresses"], _TARGET),
        f"SELECT type, CASE WHEN k IS NULL THEN 'no_phone' WHEN hit = 0 THEN 'other_only' WHEN k = 1 THEN 'only_target' ELSE 'target_plus_other' END AS bucket, count(*) AS n FROM providers LEFT JOIN (SELECT source_sha256, record_idx, count(*) AS k, count_if(pd = '{_TARGET}') AS hit FROM phones GROUP BY 1, 2) USING (source_sha256, record_idx) GROUP BY ALL",
    ),
    "owner_attribution": (
        lambda a: attribution.owned(a.evidence, attribution.record_owners(a.attached)).groupBy("issuer_id", "metric").agg(F.count("*").alias("n")),
        "SELECT issuer_id, metric, count(*) AS n FROM (SELECT metric, unnest(issuers) AS issuer_id FROM evidence NATURAL JOIN (SELECT source_sha256, record_idx, list(DISTINCT substr(scid, 1, 5)) AS issuers FROM attach GROUP BY ALL)) GROUP BY ALL",
    ),
    "orphan_rows": (
        lambda a: attribution.orphans(a.evidence, attribution.record_owners(a.attached), a.c["file_issuers"]).groupBy("issuer_id", "metric").agg(F.count("*").alias("n")),
        "SELECT issuer_id, metric, count(*) AS n FROM evidence LEFT JOIN (SELECT DISTINCT source_sha256, record_idx, true AS owned FROM attach) USING (source_sha256, record_idx) JOIN file_issuers USING (source_sha256) WHERE owned IS NULL GROUP BY ALL",
    ),
    "notify_rollup": (
        lambda a: attribution.issuer_summary(a.evidence, a.m7, a.attached, a.c["file_issuers"]),
        "SELECT i.issuer_id, coalesce(d.n, 0) AS n_findings, coalesce(d.r, 0) AS n_records, coalesce(o.n, 0) AS n_orphans, coalesce(t.n, 0) AS n_attached, coalesce(m.n, 0) AS n_out_of_area, CASE WHEN m.n > 0 THEN round(round(m.n::DOUBLE / t.n, 9), 4) END AS out_of_area_rate FROM (SELECT DISTINCT issuer_id FROM file_issuers) i LEFT JOIN (SELECT issuer_id, count(*) AS n, count(DISTINCT source_sha256 || '/' || record_idx) AS r FROM evidence JOIN owners USING (source_sha256, record_idx) GROUP BY 1) d USING (issuer_id) LEFT JOIN (SELECT issuer_id, count(*) AS n FROM evidence ANTI JOIN owners USING (source_sha256, record_idx) JOIN file_issuers USING (source_sha256) GROUP BY 1) o USING (issuer_id) LEFT JOIN (SELECT substr(scid, 1, 5) AS issuer_id, count(*) AS n FROM attach GROUP BY 1) t USING (issuer_id) LEFT JOIN (SELECT substr(plan_id, 1, 5) AS issuer_id, count(*) AS n FROM m7 GROUP BY 1) m USING (issuer_id)",
    ),
    "co_publishers": (
        lambda a: attribution.co_publishers(a.c["file_issuers"]),
        "SELECT issuer_id, string_agg(other, ',' ORDER BY other) AS co_publishers, count(*) AS n FROM (SELECT DISTINCT a.issuer_id, b.issuer_id AS other FROM file_issuers a JOIN file_issuers b ON a.source_sha256 = b.source_sha256 AND a.issuer_id <> b.issuer_id) GROUP BY 1",
    ),
    "state_map": (
        lambda a: reports.state_map(a.scores),
        "SELECT *, CASE WHEN avg_score IS NOT NULL THEN CASE WHEN avg_score >= 90 THEN 'A' WHEN avg_score >= 80 THEN 'B' WHEN avg_score >= 70 THEN 'C' WHEN avg_score >= 55 THEN 'D' ELSE 'F' END END AS band FROM (SELECT state, count(grade) AS graded, round(round(avg(score) FILTER (WHERE grade IS NOT NULL), 9), 1) AS avg_score, count(*) FILTER (WHERE grade IN ('D', 'F')) AS poor, count(*) FILTER (WHERE thin_roster) AS thin, coalesce(min(grade), '-') AS best_grade FROM scores WHERE scope = 'bh' GROUP BY 1)",
    ),
    "national": (
        lambda a: reports.national(a.scores, a.c["providers"], a.evidence),
        "SELECT (SELECT count(*) FROM scores WHERE scope = 'bh') AS cells, (SELECT count(*) FROM scores WHERE scope = 'bh' AND thin_roster) AS thin_cells, (SELECT count(*) FROM scores WHERE scope = 'bh' AND grade = 'F') AS f_cells, (SELECT count(*) FROM providers) AS records, (SELECT count(DISTINCT source_sha256) FROM providers) AS files, (SELECT count(DISTINCT npi) FROM evidence WHERE subcode = 'DEACTIVATED') AS deactivated",
    ),
    "league": (
        lambda a: reports.league(a.scores, 5),
        f"SELECT {_ISSUER} AS issuer_id, count(*) AS cells, round(round(avg(score), 9), 2) AS avg_score FROM scores WHERE scope = 'bh' AND grade IS NOT NULL AND NOT low_sample GROUP BY 1 HAVING count(*) >= 5 ORDER BY avg_score, issuer_id LIMIT 15",
    ),
    "threshold_sweep": (
        lambda a: reports.threshold_sweep(a.c["providers"], a.c["provider_addresses"], FETCH_DATE),
        " UNION ALL ".join(f"SELECT 'days' AS kind, {d} AS threshold, count(*) AS n FROM providers WHERE last_updated_on BETWEEN '2014-01-01' AND '{FETCH_DATE}' AND last_updated_on < CAST(DATE '{FETCH_DATE}' - INTERVAL {d} DAY AS VARCHAR)" for d in (90, 180, 365))
        + "".join(f" UNION ALL SELECT 'addresses', {k}, count(*) FROM address_counts JOIN providers USING (source_sha256, record_idx) WHERE type = 'INDIVIDUAL' AND n > {k}" for k in (5, 10, 25))
        + " UNION ALL SELECT 'addresses', -1, max(n) FROM address_counts JOIN providers USING (source_sha256, record_idx) WHERE type = 'INDIVIDUAL'",
    ),
    "unauditable": (
        lambda a: reports.unauditable(a.c["plan_county"], a.scores),
        "SELECT substr(plan_id, 1, 5) AS issuer_id, min(issuer_name) AS issuer_name, count(DISTINCT plan_id) AS plans, count(DISTINCT fips) AS counties FROM plan_county WHERE substr(plan_id, 1, 5) NOT IN (SELECT substr(scid, 1, 5) FROM scores) GROUP BY 1",
    ),
    "plan_fold": (
        lambda a: reports.plan_fold(a.scores),
        "SELECT *, CASE WHEN avg_bh IS NOT NULL THEN CASE WHEN avg_bh >= 90 THEN 'A' WHEN avg_bh >= 80 THEN 'B' WHEN avg_bh >= 70 THEN 'C' WHEN avg_bh >= 55 THEN 'D' ELSE 'F' END END AS band FROM (SELECT scid, round(round(avg(score) FILTER (WHERE scope = 'bh' AND NOT thin_roster), 9), 1) AS avg_bh, round(round(avg(score_uniform) FILTER (WHERE scope = 'bh' AND NOT thin_roster), 9), 1) AS avg_uniform, count(*) FILTER (WHERE scope = 'bh' AND thin_roster) AS thin, count(*) FILTER (WHERE scope = 'bh' AND grade IN ('D', 'F')) AS poor, count(*) FILTER (WHERE scope = 'bh' AND out_of_area_rate > 0.1) AS far FROM scores GROUP BY 1)",
    ),
    "county_cells": (
        lambda a: reports.county_cells(a.scores),
        "SELECT scid, county, " + ", ".join(f"max(CASE WHEN scope = '{s}' THEN {c} END) AS {c}_{s}" for s in ("all", "bh") for c in ("n", "score", "grade")) + " FROM scores GROUP BY 1, 2",
    ),
    "issuer_metric_mix": (
        lambda a: reports.issuer_metric_mix(a.evidence, a.c["file_issuers"], a.c["providers"]),
        "SELECT issuer_id, metric, flagged, records, shared, round(round(100.0 * flagged / records::DOUBLE, 9), 2) AS percent FROM (SELECT issuer_id, metric, count(DISTINCT source_sha256 || '/' || record_idx) AS flagged FROM evidence JOIN file_issuers USING (source_sha256) GROUP BY 1, 2) JOIN (SELECT issuer_id, CAST(sum(n) AS BIGINT) AS records, max(k) > 1 AS shared FROM file_issuers JOIN (SELECT source_sha256, count(*) AS n FROM providers GROUP BY 1) USING (source_sha256) JOIN (SELECT source_sha256, count(*) AS k FROM file_issuers GROUP BY 1) USING (source_sha256) GROUP BY 1) USING (issuer_id)",
    ),
    "zip_index": (
        lambda a: reports.zip_index(a.c["zip_county"], a.scores),
        "SELECT zip, string_agg(county_fips, ',' ORDER BY county_fips) AS counties FROM zip_county WHERE county_fips IN (SELECT county FROM scores) GROUP BY 1",
    ),
    "m7_by_plan": (
        lambda a: reports.m7_by_plan(a.m7, a.rates).withColumn("ooa_rate", F.round("ooa_rate", 6)),
        "SELECT r.scid, n_rows, n_attached, n_out_of_area, round(ooa_rate, 6) AS ooa_rate FROM (SELECT plan_id AS scid, count(*) AS n_rows FROM m7 GROUP BY 1) x JOIN rates r USING (scid)",
    ),
    "callsheet_cells": (lambda a: callsheet.cell_inventory(a.calls), "SELECT * FROM inventory"),
    "callsheet_rows": (
        lambda a: callsheet.study_rows(a.calls, a.chosen, 5),
        'SELECT arm, grade, scid, county, state, provider_name, npi, phone, toll_free, CAST(row_number() OVER (PARTITION BY scid, county ORDER BY md5(coalesce(npi, \'\') || d || scid), source_sha256, record_idx, scid, county) AS INT) AS rank FROM d3 QUALIFY rank <= 5',
    ),
}


def _built(a: Audit, build) -> DataFrame:
    return a.named(build(a))


QUERIES = {name: (lambda spark, sf_dir, build=build: _built(audit(spark, sf_dir), build)) for name, (build, _) in DOMAIN.items()}
ORACLES = {name: query(select) for name, (_, select) in DOMAIN.items()}
