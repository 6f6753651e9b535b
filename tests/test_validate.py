import pytest
from pyspark.sql import functions as F

from dimloom.operators import validate
from dimloom.plans.registry import Rule, default_registry

SCHEMA = ("stg_status string, stg_action string, stg_reject_reason string, a string, b string, n int")


def staged(spark, *rows):
    return spark.createDataFrame([("PENDING", None, None, *r) for r in rows], SCHEMA)


NOT_NULL_A = Rule(1, 1, "A_REQUIRED", "NOT_NULL", "A")
DERIVED_B = Rule(2, 1, "B_REQUIRED", "DERIVED", "B", "CASE WHEN a = 'x' THEN 'from a' END")
CHECK_N = Rule(3, 1, "N_POSITIVE", "CHECK", "N", "n > 0")
CHECK_B = Rule(4, 1, "B_KNOWN", "CHECK", "B", "b IN ('from a', 'given')")


def test_first_failure_wins(spark):
    out = validate.validate_rules(staged(spark, (None, "given", -1)), [NOT_NULL_A, CHECK_N]).first()
    assert (out.stg_status, out.stg_reject_reason, out.stg_rule_id) == ("REJECTED", " [A_REQUIRED: A IS NULL]", 1)


def test_derived_fills_or_rejects(spark):
    rows = validate.validate_rules(staged(spark, ("x", None, 1), ("y", None, 1), ("y", "given", 1)), [DERIVED_B]).collect()
    assert [(r.b, r.stg_status, r.stg_reject_reason) for r in rows] == [
        ("from a", "PENDING", None), (None, "REJECTED", " [DERIVED:B could not be derived]"), ("given", "PENDING", None)]


def test_a_rejected_row_is_not_filled(spark):
    rules = [CHECK_N, Rule(9, 1, "B_REQUIRED", "DERIVED", "B", "a")]
    out = validate.validate_rules(staged(spark, ("x", None, -1)), rules).first()
    assert (out.b, out.stg_rule_id) == (None, 3)


def test_later_rules_see_the_filled_value(spark):
    out = validate.validate_rules(staged(spark, ("x", None, 1), ("x", "else", 1)), [DERIVED_B, CHECK_B]).collect()
    assert [r.stg_status for r in out] == ["PENDING", "REJECTED"]


def test_not_null_before_derived_sees_the_missing_value(spark):
    rules = [Rule(1, 1, "B_GIVEN", "NOT_NULL", "B"), DERIVED_B]
    assert validate.validate_rules(staged(spark, ("x", None, 1)), rules).first().stg_rule_id == 1


def test_unknown_check_passes_unless_told(spark):
    rows = staged(spark, ("x", "given", None))
    assert validate.validate_rules(rows, [CHECK_N]).first().stg_status == "PENDING"
    assert validate.validate_rules(rows, [CHECK_N], null_fails=True).first().stg_status == "REJECTED"


def test_other_rows_are_left_alone(spark):
    rows = staged(spark, (None, None, -1)).withColumn("stg_status", F.lit("LOADED"))
    out = validate.validate_rules(rows, [NOT_NULL_A, DERIVED_B, CHECK_N]).first()
    assert (out.stg_status, out.stg_rule_id, out.stg_reject_reason) == ("LOADED", None, None)


def test_no_rules(spark):
    assert validate.validate_rules(staged(spark, ("x", "y", 1)), []).first().stg_status == "PENDING"


def test_fail_rule_raises_in_rule_order():
    rules = [Rule(1, 1, "A", "NOT_NULL", "A"), Rule(2, 1, "B", "CHECK", "B", "b > 0", "FAIL"),
             Rule(3, 1, "C", "NOT_NULL", "C", None, "FAIL")]
    with pytest.raises(validate.ValidationFailed) as failure:
        validate.raise_on_fail_rules(rules, {1: 5, 2: 2, 3: 1})
    assert failure.value.code == -20032 and failure.value.rows == 2
    validate.raise_on_fail_rules(rules, {1: 5, 2: 0})


def test_custom_rules_are_refused():
    with pytest.raises(ValueError):
        validate.broken(Rule(1, 1, "X", "CUSTOM", "A"))


def test_messages():
    assert validate.message(NOT_NULL_A, 3) == "rule A_REQUIRED rejects 3 row(s): A must have a value"
    assert validate.message(CHECK_N, 1).endswith("must satisfy: n > 0")
    long = Rule(1, 1, "X" * 900, "CHECK", "N", "n <> 1 AND " * 500 + "n > 0")
    assert long.derived_sql in validate.message(long, 1) and long.rule_name in validate.reason(long)


def test_filters_over_many_rules_keep_the_plan_small(spark):
    """A filter is pushed through the rule projection; conditions must not multiply."""
    rules = [Rule(i, 1, f"R{i}", "CHECK", "N", f"n <> {i}") for i in range(1, 25)]
    out = validate.rejection_counts(validate.validate_rules(staged(spark, ("x", "y", 7)), rules))
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    assert [tuple(r) for r in out.collect()] == [(7, 1)]


def test_shipped_rules_accept_and_reject(spark):
    """Each shipped CHECK predicate holds for a good value, fails for a bad one, and passes NULL."""
    columns = ("schedule_type string, schedule_status string, schedule_start_date date, schedule_end_date date, "
               "allocated_hours decimal(18,4), period_start_date date, period_end_date date, cost_category string, "
               "curve_type string")
    values = {
        "SCHEDULE_TYPE_CHECK": ("'Exempt'", "'Casual'"), "SCHEDULE_STATUS_CHECK": ("'Open'", "'open'"),
        "SCHEDULE_DATE_ORDER": None, "ALLOCATED_HOURS_NON_NEGATIVE": ("0", "-1"), "PERIOD_DATE_ORDER": None,
        "COST_CATEGORY_CHECK": ("'company'", "'Partner'"), "CURVE_TYPE_VALUE_CHECK": ("'ACTUAL'", "'actual'")}
    checks = [r for r in default_registry().rules if r.rule_type == "CHECK"]
    assert len(checks) == len(values)
    empty = spark.createDataFrame([tuple([None] * 9)], columns)
    for rule in checks:
        assert not empty.select(validate.broken(rule)).first()[0]
        column = rule.column_name.lower()
        if values[rule.rule_name] is None:
            end = column.replace("start", "end")
            good = empty.withColumns({column: F.lit("2024-01-02").cast("date"), end: F.lit("2024-01-02").cast("date")})
            bad = good.withColumn(end, F.lit("2024-01-01").cast("date"))
        else:
            good, bad = (empty.withColumn(column, F.expr(v)) for v in values[rule.rule_name])
        assert [f.select(validate.broken(rule)).first()[0] for f in (good, bad)] == [False, True], rule.rule_name
