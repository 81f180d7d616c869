"""Data-quality rules: drop-on-fail expectations, pass/fail reports and
constraint validation with reasons.

A rule is a SQL predicate string.  A NULL predicate counts as failing (it is
what a SQL ``WHERE`` does).  Reports are one aggregation pass, so their cost
is a single partial/final hash aggregate regardless of the number of rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave import config as C

# Rule sets of the silver layer.
TRANSACTION_RULES = {"valid_amount": "amount > 0", "valid_user": "user_id IS NOT NULL"}
LOGIN_RULES = {"valid_login_id": "login_id IS NOT NULL"}


def _all_pass(rules: dict[str, str]) -> Column:
    # A filter already drops rows whose predicate is NULL, so the bare rules
    # are used: simple comparisons then reach the Parquet reader as pushed filters.
    return reduce(lambda a, b: a & b, [F.expr(r) for r in rules.values()])


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Keep rows for which every rule holds (pushes down to the scan when it can)."""
    if not rules:
        return df
    return df.filter(_all_pass(rules))


def quality_report(df: DataFrame, rules: dict[str, str], dataset: str = "dataset") -> DataFrame:
    """One row per rule: (dataset, rule, passed, failed), from a single scan."""
    aggs = []
    for name, rule in rules.items():
        ok = F.coalesce(F.expr(rule), F.lit(False))
        aggs += [F.count_if(ok).alias(f"{name}__pass"), F.count_if(~ok).alias(f"{name}__fail")]
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"{name}__pass").alias("passed"),
                 F.col(f"{name}__fail").alias("failed"))
        for name in rules]))
    return wide.select(F.lit(dataset).alias("dataset"), stacked.alias("r")).select(
        "dataset", "r.rule", "r.passed", "r.failed")


# ---------------------------------------------------------------------------
# Review-queue constraints
# ---------------------------------------------------------------------------

def _triage_checks() -> list[tuple[str, Column]]:
    return [
        ("transaction_id_null", F.col("transaction_id").isNull()),
        ("user_id_null", F.col("user_id").isNull()),
        ("amount_null", F.col("amount").isNull()),
        ("risk_score_null", F.col("risk_score").isNull()),
        ("risk_score_range", ~F.coalesce(F.col("risk_score").between(0, C.SCORE_CAP), F.lit(True))),
        ("risk_level_invalid", ~F.coalesce(F.col("risk_level").isin(*C.RISK_LEVELS), F.lit(False))),
        ("action_invalid", ~F.coalesce(F.col("automated_action").isin(*C.ACTIONS), F.lit(False))),
        ("decision_invalid", F.col("analyst_decision").isNotNull()
         & ~F.col("analyst_decision").isin(*C.DECISIONS)),
    ]


TRIAGE_CONSTRAINTS = ("transaction_id_null", "user_id_null", "amount_null", "risk_score_null", "risk_score_range",
                      "risk_level_invalid", "action_invalid", "decision_invalid")


def triage_violations() -> Column:
    """Array of violated constraint names (empty when the row is valid)."""
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in _triage_checks()]),
                    lambda x: x.isNotNull())


def validate_triage(df: DataFrame) -> DataFrame:
    """Rows with ``violations`` (array) and ``is_valid``; split with a filter."""
    v = triage_violations()
    return df.withColumns({"violations": v, "is_valid": F.size(v) == 0})


def validate_decisions(df: DataFrame, col: str = "decision") -> DataFrame:
    """Mark decisions whose value is one of the four allowed."""
    return df.withColumn("is_valid", F.coalesce(F.col(col).isin(*C.DECISIONS), F.lit(False)))
