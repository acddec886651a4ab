"""The scoring contract on batches of records: what passes, and the error of every kind of bad value."""

import pytest

from tessera import config as C
from tessera.operators.quality import apply_contract
from tessera.operators.score import contract_then_score, envelope_of

from .records import frame, record

MONTH = next(f for f in C.CONTRACT_DEFAULTED_FLAGS if f.endswith("month_to_month"))


def score(spark, records, **kw):
    scored, rejected = contract_then_score(frame(spark, records, **kw), keep=("rid",))
    env = envelope_of(scored, "rid", "7", "rules", keep=("rid",))
    return {r.rid: r for r in env.collect()}, {r.rid: r._errors for r in rejected.collect()}


def test_bounds_themselves_are_allowed(spark):
    upper = {f: hi for f, (_, hi) in C.CONTRACT_RANGES.items() if hi is not None}
    env, rejected = score(spark, [record(), record(**upper)])
    assert not rejected and set(env) == {"rec0", "rec1"}
    for r in env.values():
        assert r.output_ok == 1 and (r.model_version, r.model_name) == ("7", "rules") and len(r.request_id) == 16


def test_one_violation_per_field(spark):
    bad, want = [], {}
    for field, (low, high) in C.CONTRACT_RANGES.items():
        for value, error in ((None, "missing"), (low - 1, "out of range"), *(((high + 1, "out of range"),) if high is not None else ())):
            want[f"rec{len(bad)}"] = f"{field}: {error}"
            bad.append(record(**{field: value}))
    for field in C.CONTRACT_REQUIRED_FLAGS + C.CONTRACT_DEFAULTED_FLAGS:
        want[f"rec{len(bad)}"] = f"{field}: not in (0, 1)"
        bad.append(record(**{field: 3}))
    env, rejected = score(spark, bad)
    assert not env and {k: len(v) for k, v in rejected.items()} == dict.fromkeys(want, 1)
    assert all(rejected[k][0].startswith(w) for k, w in want.items())


def test_several_violations_are_all_named(spark):
    _, rejected = score(spark, [record(tenure_months=None, monthly_charges=-0.5, partner=9)])
    assert [e.split(":")[0] for e in rejected["rec0"]] == ["tenure_months", "monthly_charges", "partner"]


@pytest.mark.parametrize("field,value,error", [
    ("tenure_months", "abc", "tenure_months: not a number"), ("tenure_months", "12.5", "tenure_months: not an integer"),
    ("monthly_charges", "NaN", "monthly_charges: not a number"), ("total_charges", "Infinity", "total_charges: not a number"),
    ("avg_charge_per_month", "", "avg_charge_per_month: not a number"), ("partner", "yes", "partner: not in (0, 1)"),
    (MONTH, "0.5", f"{MONTH}: not in (0, 1)")])
def test_wrongly_typed_text_rejects_its_row_only(spark, field, value, error):
    env, rejected = score(spark, [record(**{field: value}), record()], text=True)
    assert rejected == {"rec0": [error]} and set(env) == {"rec1"}


def test_numbers_that_are_none(spark):
    _, rejected = score(spark, [record(monthly_charges=float("nan")), record(total_charges=float("inf"))])
    assert rejected == {"rec0": ["monthly_charges: not a number"], "rec1": ["total_charges: not a number"]}


def test_missing_one_hot_is_zero_and_rule_follows_tenure(spark):
    rows = apply_contract(frame(spark, [record(**{MONTH: None})])).collect()
    assert rows[0]["_errors"] == [] and rows[0][MONTH] == 0
    env, _ = score(spark, [record(tenure_months=t, **{f: int(f == MONTH) for f in C.CONTRACT_DEFAULTED_FLAGS if f.startswith("contract_type_")}) for t in (0, 11, 12)])
    assert [env[f"rec{i}"].prediction for i in range(3)] == [1, 1, 0]
