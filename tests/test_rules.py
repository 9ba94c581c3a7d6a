"""Rules, derived columns and duplicates; cases come from the contract and from seeded generators."""

from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from flights_rows import clean_row, raw

from snapstrata.contract import REJECTED, VALID
from snapstrata.contracts.flights import CATEGORICAL_GAPS, FLIGHTS, STOP_CODES
from snapstrata.functions import rules as R
from snapstrata.operators.faults import faults_of
from snapstrata.operators.standardize import standardize
from snapstrata.operators.validate import judge, reason_breakdown, reason_counts
from snapstrata.plans.refine import accepted_rows, refine, rejected_rows, valid_rows

FAULTS = faults_of(FLIGHTS.rules)


def reasons(spark, *overrides, contract=FLIGHTS):
    judged = judge(standardize(raw(spark, *overrides), contract), contract.rules)
    return [r["rejection_reasons"] for r in judged.collect()]


def test_drawn_rows_break_nothing(spark):
    assert reasons(spark, *[clean_row(k) for k in range(40)]) == [[]] * 40


def test_every_rule_has_a_reason_and_a_fault_of_its_own():
    named = [r.reason for r in FLIGHTS.rules]
    assert len(named) == len(set(named)) == 18
    assert {f.reason for f in FAULTS} == set(named)


def test_each_fault_breaks_its_rule_alone(spark):
    assert reasons(spark, *[f.values for f in FAULTS]) == [[f.reason] for f in FAULTS]


def test_ends_of_ranges_are_inside(spark):
    ends = []
    for rule in FLIGHTS.rules:
        if isinstance(rule, R.Between):
            ends += [{rule.column: rule.low}, {rule.column: rule.high}]
        elif isinstance(rule, R.AtMostWhen):
            ends.append({rule.when_column: rule.equals, rule.column: rule.high})
    assert reasons(spark, *ends) == [[]] * len(ends)


def test_pairs_of_faults_are_told_in_rule_order(spark):
    order = [r.reason for r in FLIGHTS.rules]
    rng = random.Random(8)
    pairs = [rng.sample(FAULTS, 2) for _ in range(60)]
    pairs = [p for p in pairs if not set(p[0].values) & set(p[1].values)]
    got = reasons(spark, *[{**a.values, **b.values} for a, b in pairs])
    for (a, b), told in zip(pairs, got):
        assert {a.reason, b.reason} <= set(told)
        assert told == sorted(told, key=order.index)


def test_derived_columns(spark):
    for label, code in STOP_CODES.items():
        given = {**clean_row(code), "stops": label, "duration": 2.25}
        row = standardize(raw(spark, given), FLIGHTS).first()
        assert (row["stops_count"], row["is_nonstop"]) == (code, code == 0)
        assert row["route"] == f"{given['source_city']}-{given['destination_city']}"
        assert (row["duration_minutes"], row["price_inr"]) == (135, Decimal(given["price"]))


def test_padding_and_case_are_cleaned_before_judging(spark):
    plain = clean_row()
    padded = {k: f"  {v} " for k, v in plain.items() if k in FLIGHTS.trims}
    shouted = {k: str(plain[k]).upper() for k in ("class", "stops")}
    expected = [plain[k] for k in FLIGHTS.trims]
    for messy in (padded, shouted):
        assert reasons(spark, messy) == [[]]
        row = standardize(raw(spark, messy), FLIGHTS).first()
        assert [row[k] for k in FLIGHTS.trims] == expected


def test_keys_follow_the_key_columns_and_nothing_else(spark):
    plain, other = clean_row(0), clean_row(99)
    for name in plain:
        rows = standardize(raw(spark, {}, {name: other[name]}), FLIGHTS)
        differs = plain[name] != other[name]
        for key, columns in (("flight_quote_sk", FLIGHTS.business_key), ("quote_group_sk", FLIGHTS.group_key)):
            assert rows.select(key).distinct().count() == 1 + (differs and name in columns), (name, key)


def test_blank_text_is_missing_and_not_accepted(spark):
    assert reasons(spark, {"airline": ""}) == [["null_airline", "invalid_airline"]]
    assert reasons(spark, {"flight": "  "}) == [["null_flight"]]


def test_null_categoricals_pass_unless_asked_for(spark):
    gaps = {r.columns[0]: None for r in CATEGORICAL_GAPS}
    assert reasons(spark, gaps) == [[]]
    strict = FLIGHTS.with_options(rules=FLIGHTS.rules + CATEGORICAL_GAPS)
    assert reasons(spark, gaps, contract=strict) == [[r.reason for r in CATEGORICAL_GAPS]]


def test_malformed_record_rule(spark):
    df = spark.createDataFrame([(1, None), (2, "x,y")], "id int, _corrupt_record string")
    rule = R.Absent("malformed_record", "_corrupt_record")
    got = {r["id"]: r["rejection_reasons"] for r in judge(df, (rule,)).collect()}
    assert got == {1: [], 2: ["malformed_record"]}


def test_no_rules_means_all_valid(spark):
    assert [r["is_valid"] for r in judge(raw(spark), ()).collect()] == [True]


@pytest.mark.parametrize("prefer_valid", [False, True])
def test_duplicates_against_brute_force(spark, prefer_valid):
    """Random repeats of a few quotes: newest ingest first, then the lowest source row; one row stays."""
    rng = random.Random(6)
    rows = []
    for number in range(60):
        row = clean_row(rng.randrange(7))
        # the airline is no part of the key, so broken rows compete as well
        broken = {"airline": "no such value"} if rng.random() < 0.5 else {}
        later = row["_ingested_at"] + timedelta(hours=rng.randrange(4))
        rows.append({**row, **broken, "_ingested_at": later, "_source_row": number})
    contract = FLIGHTS.with_options(prefer_valid=prefer_valid)

    def place(row):
        good = "no such value" != row["airline"]
        return (not good if prefer_valid else 0, -row["_ingested_at"].timestamp(), row["_source_row"])

    best = {}
    for row in rows:
        best[row["flight"]] = min(best.get(row["flight"], row), row, key=place)
    out = refine(raw(spark, *rows), contract)
    winners = {r["_source_row"] for r in best.values()}
    kept = {r["_source_row"] for r in valid_rows(out, contract).collect()}
    assert kept == {r["_source_row"] for r in accepted_rows(raw(spark, *rows), contract).collect()}
    assert kept == {r["_source_row"] for r in best.values() if r["airline"] != "no such value"}
    told = {r["_source_row"]: r["rejection_reason"] for r in rejected_rows(out, contract).collect()}
    assert set(told) == set(range(60)) - kept
    for number, reason in told.items():
        assert reason == ("invalid_airline" if number in winners else "duplicate_business_key")
    assert {r["outcome"] for r in out.select("outcome").distinct().collect()} == {VALID, REJECTED}
    assert out.where("(outcome = 'valid') <> (rejection_reason is null)").isEmpty()


def test_losing_duplicate_can_keep_its_own_reasons(spark):
    contract = FLIGHTS.with_options(prefer_valid=True, keep_duplicate_reasons=True)
    rows = raw(spark, {"_source_row": 1, "airline": "no such value"}, {"_source_row": 2})
    lost = rejected_rows(refine(rows, contract), contract).first()
    assert lost["rejection_reason"] == "invalid_airline,duplicate_business_key"


def test_reason_reports_hold_every_reason(spark):
    rows = [{**clean_row(k), **f.values} for k, f in enumerate(FAULTS) for _ in range(1)]
    out = refine(raw(spark, *rows), FLIGHTS)
    rejected = rejected_rows(out, FLIGHTS)
    combined = {r[0]: r[1] for r in reason_breakdown(rejected).collect()}
    single = {r["reason"]: r["n"] for r in reason_counts(out).collect()}
    assert combined == single and sum(single.values()) == len(FAULTS) and set(single) == {f.reason for f in FAULTS}
    assert reason_breakdown(rejected, top=3).count() == 3
