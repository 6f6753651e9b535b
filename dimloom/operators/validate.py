"""Rule validation of staged rows, in one projection.

Rules run in order and only rows still pending see the next rule, so the first
failing rule gives the reason.  A DERIVED rule first fills the missing value of
rows still pending; later rules see the filled value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.plans.registry import Rule

# Fixed values.
ERROR_CODES = {"NOT_NULL": "VAL_NOT_NULL", "DERIVED": "VAL_DERIVED_NULL", "CHECK": "VAL_CHECK_FAILED"}
FAIL_CODES = {"NOT_NULL": -20030, "DERIVED": -20031, "CHECK": -20032}


class ValidationFailed(Exception):
    """A rule with action FAIL met at least one row."""

    def __init__(self, rule: Rule, rows: int):
        self.rule, self.rows, self.code = rule, rows, FAIL_CODES[rule.rule_type]
        super().__init__(f"{self.code}: {rows} row(s) break rule {rule.rule_name}, which stops the load")


def broken(rule: Rule, null_fails: bool = False) -> Column:
    """True where the row breaks the rule.

    A CHECK predicate that is unknown passes, unless ``null_fails`` is set.
    """
    if rule.rule_type in ("NOT_NULL", "DERIVED"):
        return F.col(rule.column_name).isNull()
    if rule.rule_type == "CHECK":
        holds = F.expr(rule.derived_sql)
        return ~F.coalesce(holds, F.lit(not null_fails))
    raise ValueError(f"rule type {rule.rule_type} of {rule.rule_name} is not supported")


def reason(rule: Rule) -> str:
    texts = {
        "NOT_NULL": f" [{rule.rule_name}: {rule.column_name} IS NULL]",
        "DERIVED": f" [DERIVED:{rule.column_name} could not be derived]",
        "CHECK": f" [{rule.rule_name}: {rule.column_name} check failed]",
    }
    return texts[rule.rule_type]


def _first_broken(rules: list[Rule], null_fails: bool) -> Column:
    """Id of the first rule the row breaks: one flat CASE, so every condition stands in the plan once."""
    found = F
    for rule in rules:
        found = found.when(broken(rule, null_fails), F.lit(rule.rule_id).cast("bigint"))
    return found


def _segments(rules: list[Rule]) -> list[list[Rule]]:
    """Cut the rule list before each rule that fills a column."""
    parts: list[list[Rule]] = [[]]
    for rule in rules:
        if rule.rule_type == "DERIVED" and rule.derived_sql:
            parts.append([])
        parts[-1].append(rule)
    return [p for p in parts if p]


def validate_rules(staged: DataFrame, rules: list[Rule], null_fails: bool = False) -> DataFrame:
    """Set ``stg_status``, ``stg_reject_reason`` and ``stg_rule_id`` (the failing rule) on staged rows.

    Rows that are not PENDING on entry are left as they are.
    """
    names = {c.lower(): c for c in staged.columns}
    pending = F.col("stg_status") == "PENDING"
    out, found = staged, []
    for number, part in enumerate(_segments(rules)):
        first = part[0]
        if first.rule_type == "DERIVED" and first.derived_sql:
            column = names[first.column_name.lower()]
            waiting = pending
            for earlier in found:
                waiting = waiting & F.col(earlier).isNull()
            filled = F.when(waiting, F.expr(first.derived_sql)).cast(staged.schema[column].dataType)
            out = out.withColumn(column, F.coalesce(F.col(column), filled))
        found.append(f"_broken_{number}")
        out = out.withColumn(found[-1], _first_broken(part, null_fails))
    rule_id = F.coalesce(*[F.col(c) for c in found]) if found else F.lit(None).cast("bigint")
    out = out.withColumn("stg_rule_id", F.when(pending, rule_id)).drop(*found)
    if not rules:
        return out
    texts = F.create_map(*[F.lit(v) for r in rules for v in (r.rule_id, reason(r))])
    failed = F.col("stg_rule_id").isNotNull()
    return out.withColumns({
        "stg_reject_reason": F.coalesce(F.try_element_at(texts, F.col("stg_rule_id").cast("int")),
                                        F.col("stg_reject_reason")),
        "stg_status": F.when(failed, F.lit("REJECTED")).otherwise(F.col("stg_status")),
    })


def rejection_counts(validated: DataFrame) -> DataFrame:
    """Rejected rows per rule."""
    return validated.filter(F.col("stg_rule_id").isNotNull()).groupBy(
        F.col("stg_rule_id").alias("rule_id")).agg(F.count(F.lit(1)).alias("rejected_rows"))


def message(rule: Rule, rows: int) -> str:
    """Error log text of one rule: what it asks, in full, and how many staged rows do not meet it."""
    asks = {"NOT_NULL": f"{rule.column_name} must have a value",
            "DERIVED": f"{rule.column_name} must have a value or one from: {rule.derived_sql}",
            "CHECK": f"{rule.column_name} must satisfy: {rule.derived_sql}"}
    return f"rule {rule.rule_name} rejects {rows} row(s): {asks[rule.rule_type]}"


def raise_on_fail_rules(rules: list[Rule], counts: dict[int, int]) -> None:
    """Abort on the first FAIL rule, in rule order, that met a row."""
    for rule in rules:
        if rule.error_action == "FAIL" and counts.get(rule.rule_id, 0) > 0:
            raise ValidationFailed(rule, counts[rule.rule_id])
