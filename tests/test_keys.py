"""Numbers in place of files' SHA-256 sums, and how tables meet by them."""

import re

import pytest

from rosterlens.operators import attribution, callsheet, compact, pages, scoring
from rosterlens.plans import domain
from rosterlens.sources import corpus, staging


def test_numbers_follow_the_order_of_the_values(spark):
    rows = spark.createDataFrame([(f"{i % 700:04d}",) for i in range(3000)] + [(None,)], "s string")
    got = {r.s: r.n for r in compact.surrogate_keys(rows, "s", "n").collect()}
    assert got == {f"{i:04d}": i for i in range(700)}


def test_values_come_back(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 1), (None, 3), ("", 4)], "s string, _new int")
    numbers = compact.surrogate_keys(rows, "s", "n")
    numbered = compact.encode(rows, numbers, "s", "n")
    assert numbered.columns == rows.columns and dict(numbered.dtypes)["s"] == "bigint"
    assert sorted(compact.decode(numbered, numbers, "s", "n").collect(), key=repr) == sorted(rows.collect(), key=repr)


def test_unknown_values_and_empty_tables(spark):
    rows = spark.createDataFrame([("z",)], "s string")
    numbers = compact.surrogate_keys(rows.limit(0), "s", "n")
    assert numbers.count() == 0
    assert [r.s for r in compact.encode(rows, numbers, "s", "n").collect()] == [None]


def test_the_audit_joins_on_numbers(spark):
    a = domain.audit(spark, "/root/testdata/sf0.001")
    for rows in (a.attached, a.record_counties, a.evidence, a.m7, a.roster):
        assert dict(rows.dtypes)["source_sha256"] == "bigint"
    assert dict(a.named(a.evidence).dtypes)["source_sha256"] == "string"
    plan = a.c["provider_plans"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


JOINED_BY_RECORD = {
    "rates": lambda a: a.rates,
    "roster": lambda a: a.roster,
    "scores": lambda a: scoring.cell_scores(a.roster, a.penalties, a.rates),
    "m5": lambda a: a.m5,
    "m9": lambda a: a.m9,
    "m10": lambda a: a.m10,
    "verdicts": lambda a: pages.fused_verdicts(a.c["providers"], a.c["nppes"]),
    "owned": lambda a: attribution.owned(a.evidence, attribution.record_owners(a.attached)),
    "orphans": lambda a: attribution.orphans(a.evidence, attribution.record_owners(a.attached), a.c["file_issuers"]),
}


@pytest.mark.parametrize("name", JOINED_BY_RECORD)
def test_rows_that_grow_with_the_records_or_the_registry_are_not_broadcast(spark, name):
    plan = JOINED_BY_RECORD[name](domain.audit(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # a table as small as this one's providers may meet the specialties' verdicts by being broadcast: its size is never underrated
    sent = re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert "SortMergeJoin" in plan and not [x for x in sent if ("record_idx" in x or "npi" in x) and "specialties" not in x]


@pytest.mark.parametrize("name", ["m6", "m10"])
def test_checks_never_broadcast_records(spark, name):
    plan = getattr(domain.audit(spark, "/root/testdata/sf0.001"), name)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert "SortMergeJoin" in plan and not [x for x in sent if "record_idx" in x], sent


def test_customers_are_not_broadcast_to_orders_and_plans(spark, monkeypatch):
    plans = {}

    def staged(df, tag="stage", folder=None):
        plans[df.columns[2]] = df._jdf.queryExecution().executedPlan().toString()
        return df

    monkeypatch.setattr(staging, "stage", staged)
    own = corpus.Corpus(spark, "/root/testdata/sf0.001")
    assert own["provider_addresses"].count() and own["provider_plans"].count()
    for name in ("addr_idx", "plan_id_type"):
        assert "SortMergeJoin" in plans[name] and "BroadcastExchange" not in plans[name]


def test_records_are_not_broadcast_to_the_call_roster(spark):
    a = domain.audit(spark, "/root/testdata/sf0.001")
    rows = callsheet.call_roster(callsheet.candidates(a.scores), a.roster, a.c["providers"], a.c["provider_addresses"])
    plan = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    sent = re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[(.*)\]", plan)
    # as above, a table as small as this one's providers may meet the specialties' verdicts
    assert sent and not [x for x in sent if "record_idx" in x and ("specialties" not in x or "provider_name" in x)], sent


def test_the_call_roster_is_computed_once(spark):
    a = domain.audit(spark, "/root/testdata/sf0.001")
    assert a.calls is a.calls and "Join" not in a.calls._jdf.queryExecution().executedPlan().toString()


def test_relations_are_numbered_once(spark):
    a = domain.audit(spark, "/root/testdata/sf0.001")
    for name in ("providers", "providers_before", "provider_addresses", "file_issuers"):
        assert a.c[name] is a.c[name] and "Join" not in a.c[name]._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["scores", "scores_before"])
def test_scores_start_from_tables_of_what_they_meet(spark, monkeypatch, name):
    a = domain.Audit(spark, "/root/testdata/sf0.001")
    read = {}

    def staged(df, tag="stage", folder=None):
        read[tag] = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        return staging.stage(df, tag, folder)

    monkeypatch.setattr(domain, "stage", staged)
    assert getattr(a, name).count()
    # plan memberships, counties of records and of plans, and a table each of behavioral health, penalties and rates
    assert len(read["scores" if "scores" in read else "stage"]) == 6
