"""Grades of finished audits.

``episodes``: episode_id, gt_compliance, verdict, budget_remaining, total_budget.
``gt`` and ``flags``: episode_id, pos (list position), type, severity.
Counts, weights and penalties are summed as whole numbers; the score itself is
one double expression at the end.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.numeric import round_half_even
from callsift.operators.replay import ENDING_COLUMNS


def _by_severity(values: dict[str, int], default: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in values.items())
    return f"CASE severity {cases} ELSE {default} END"


_WEIGHT = _by_severity(fv.SEVERITY_WEIGHT, fv.DEFAULT_SEVERITY_WEIGHT)
_PENALTY = _by_severity(fv.FALSE_POSITIVE_CENTS, fv.DEFAULT_FALSE_POSITIVE_CENTS)

# Per (episode, type). Severities are compared by hash, so that every buffer has
# a fixed width and the grouping stays in generated code.
_TYPE_SUMS = {
    "n_gt": "count_if(real)",
    "n_flag": "count_if(NOT real)",
    "n_high": "count_if(real AND severity = 'high')",
    "n_medium": "count_if(real AND severity = 'medium')",
    "n_low": "count_if(real AND severity = 'low')",
    "gt_weight": f"coalesce(sum(IF(real, {_WEIGHT}, 0)), 0)",
    "claim_cents": f"coalesce(sum(IF(NOT real, {_PENALTY}, 0)), 0)",
    "gt_mark": "max_by(xxhash64(severity), IF(real, pos, NULL))",
    "flag_mark": "max_by(xxhash64(severity), IF(NOT real, pos, NULL))",
    "hit_weight": f"max_by({_WEIGHT}, IF(real, pos, NULL))",
}
_TYPE_COUNTS = {
    "tp": "least(n_gt, n_flag)",
    "fp": "n_flag - least(n_gt, n_flag)",
    "fn": "n_gt - least(n_gt, n_flag)",
    "tp_weight": "least(n_gt, n_flag) * coalesce(hit_weight, 0)",
    "severity_matches": "IF(gt_mark = flag_mark, least(n_gt, n_flag), 0)",
    "absent_flags": "IF(n_gt = 0, n_flag, 0)",
    "penalty_cents": "IF(n_gt = 0, claim_cents, 0)",
    "missed_rows": "IF(n_flag = 0, n_gt, 0)",
    "high_type": "IF(n_high > 0, 1, 0)",
    "high_caught": "IF(n_high > 0 AND n_flag > 0, 1, 0)",
}
_SUMMED = ["n_gt", "n_flag", "n_high", "n_medium", "n_low", "gt_weight", *_TYPE_COUNTS]


def _claims(rows: DataFrame, real: bool, *more: str) -> DataFrame:
    return rows.select(
        "episode_id",
        "type",
        F.col("pos").cast("long").alias("pos"),
        F.coalesce("severity", F.lit("low")).alias("severity"),
        F.lit(real).alias("real"),
        *more,
    )


def _per_type(rows: DataFrame, carried: list[str]) -> DataFrame:
    sums = [F.expr(f"{sql} AS {name}") for name, sql in _TYPE_SUMS.items()]
    kept = [F.max(c).alias(c) for c in carried]
    grouped = rows.groupBy("episode_id", "type").agg(*sums, *kept)
    return grouped.selectExpr(
        "*", *[f"CAST({sql} AS BIGINT) AS {name}" for name, sql in _TYPE_COUNTS.items()]
    )


def grade_match(gt: DataFrame, flags: DataFrame) -> DataFrame:
    """Truth and flags matched by type: one row per (episode, type).

    Both sides go through one grouping with map-side sums, so an episode with
    very many flags reaches the reducers as at most a few rows per task.
    """
    return _per_type(_claims(gt, True).unionByName(_claims(flags, False)), [])


def _missed_high() -> Column:
    return (F.col("high_type") > 0) & (F.col("high_caught") == 0)


def grade_counts(episodes: DataFrame, gt: DataFrame, flags: DataFrame) -> DataFrame:
    """Episode totals; an episode without truth and flags keeps zeros."""
    sums = (
        grade_match(gt, flags)
        .groupBy("episode_id")
        .agg(*[F.sum(c).alias(c) for c in _SUMMED])
    )
    joined = episodes.join(sums, "episode_id", "left").fillna(0, _SUMMED)
    return joined.withColumn("missed_high", _missed_high())


def audit_counts(audit: DataFrame, gt: DataFrame) -> DataFrame:
    """Episode totals straight from the rows of a replay, read once.

    The ending of an episode rides along as a row of its own, so neither the
    replay nor a join has to be repeated for it.
    """
    claims = _claims(audit, False, *ENDING_COLUMNS).withColumn(
        "real", F.expr("IF(type IS NULL, NULL, false)")
    )
    rows = claims.unionByName(_claims(gt, True), allowMissingColumns=True)
    totals = (
        _per_type(rows, ENDING_COLUMNS)
        .groupBy("episode_id")
        .agg(
            *[F.sum(c).alias(c) for c in _SUMMED],
            *[F.max(c).alias(c) for c in ENDING_COLUMNS],
        )
    )
    # Labelled calls that were never audited have no ending and no grade.
    return totals.where(F.col("verdict").isNotNull()).withColumn(
        "missed_high", _missed_high()
    )


_PRECISION = "(CAST(tp_weight AS DOUBLE) / CAST(tp_weight + fp AS DOUBLE))"
_RECALL = "(CAST(tp_weight AS DOUBLE) / CAST(gt_weight AS DOUBLE))"
# Severity-weighted F1; a wrong flag weighs one in precision.
_F1 = f"""CASE
    WHEN n_flag = 0 THEN IF(gt_weight = 0, 1D, 0D)
    WHEN gt_weight = 0 OR tp_weight = 0 THEN 0D
    ELSE 2D * {_PRECISION} * {_RECALL} / ({_PRECISION} + {_RECALL}) END"""
_SHARE = "CAST(budget_remaining AS DOUBLE) / CAST(total_budget AS DOUBLE)"

# Each group of columns builds on the one before.
_SCORE_STEPS = [
    {
        "f1": _F1,
        "verdict_score": f"IF(verdict = gt_compliance, {fv.VERDICT_POINTS}D, 0D)",
        "efficiency_score": (
            f"{fv.EFFICIENCY_POINTS}D * IF(total_budget > 0, {_SHARE}, 0D)"
        ),
        "calibration_bonus": (
            f"{fv.CALIBRATION_POINTS}D * CAST(severity_matches AS DOUBLE)"
        ),
        "fp_penalty": "CAST(penalty_cents AS DOUBLE) / 100D",
    },
    {"violation_score": f"{fv.VIOLATION_POINTS}D * f1"},
    {
        "raw_total": "verdict_score + violation_score + efficiency_score "
        "+ calibration_bonus - fp_penalty"
    },
    {
        "clamped": "greatest(0D, least(1D, "
        f"IF(missed_high, least(raw_total, {fv.AUTO_FAIL_CAP}D), raw_total)))"
    },
    {
        "total": f"CASE clamped WHEN 1D THEN {fv.PERFECT_SCORE_SHOWN_AS}D "
        f"WHEN 0D THEN {fv.ZERO_SCORE_SHOWN_AS}D ELSE clamped END"
    },
]


def grade_episodes(episodes: DataFrame, gt: DataFrame, flags: DataFrame) -> DataFrame:
    return score(grade_counts(episodes, gt, flags))


def score(counts: DataFrame) -> DataFrame:
    """Score components, the unrounded ``total`` and ``final_score``.

    ``counts`` comes from one of the two functions above and must carry
    ``gt_compliance``.
    """
    scored = counts
    for columns in _SCORE_STEPS:
        scored = scored.withColumns({n: F.expr(sql) for n, sql in columns.items()})
    return scored.withColumn("final_score", round_half_even("total", 3)).drop("clamped")


def grade_breakdown(graded: DataFrame) -> DataFrame:
    """The two nested blocks of a graded result: ``breakdown`` and ``details``."""

    def shown(column: str, alias: str) -> Column:
        return round_half_even(column, 3).alias(alias)

    breakdown = F.struct(
        shown("verdict_score", "compliance_correct"),
        shown("violation_score", "violation_f1_weighted"),
        shown("efficiency_score", "efficiency_bonus"),
        shown("calibration_bonus", "severity_calibration_bonus"),
        shown("fp_penalty", "false_positive_penalty"),
        F.col("missed_high").alias("auto_fail_applied"),
    )
    details = F.struct(
        F.col("tp").alias("true_positives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("severity_matches"),
        F.col("n_gt").alias("ground_truth_count"),
        F.col("n_flag").alias("agent_flagged_count"),
        F.col("budget_remaining"),
        F.col("total_budget"),
        F.col("missed_high").alias("missed_high_severity"),
    )
    return graded.select(
        "episode_id",
        "final_score",
        breakdown.alias("breakdown"),
        details.alias("details"),
    )
