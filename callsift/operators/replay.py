"""Replay of action logs under a compute budget.

An episode ends at its first submitted report or at the first action it cannot
pay for; later actions do not count. Until that row every action was paid, so a
running sum of prices is the money spent, and the whole replay is running sums
over the ordered episode: one shuffle, no loop.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.numeric import percent
from callsift.functions.text import sql_text
from callsift.operators.actions import error_text, price_actions, reward_cents
from callsift.operators.scan import ordered_groups

def total_budget() -> Column:
    return (
        F.lit(fv.BUDGET_BASE) + F.lit(fv.BUDGET_PER_TURN) * F.col("n_turns")
    ).cast("long")


def with_forced_submission(actions: DataFrame, calls: DataFrame | None) -> DataFrame:
    """Append a failing report to every episode, after all its own actions.

    Where the episode has ended before, replay drops the added row like any
    other late action, so nothing has to find the open episodes first.
    """
    if calls is None:
        calls = actions.select("episode_id", "n_turns").distinct()
    given = {
        "episode_id": F.col("episode_id"),
        "n_turns": F.col("n_turns"),
        "action_type": F.lit("submit_report"),
        "compliance_pass": F.lit(False),
    }
    forced = calls.select(
        *[
            given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in actions.schema
        ],
        F.lit(True).alias("forced"),
    )
    return actions.withColumn("forced", F.lit(False)).unionByName(forced)


def replay(
    actions: DataFrame,
    calls: DataFrame | None = None,
    force_submit: bool = True,
    order: tuple[str, ...] = ("seq",),
    short_episodes: bool = False,
    target_rows: int | None = None,
) -> DataFrame:
    """One row per counted step, with budget, counters and ``done``.

    ``order`` names the whole-number columns that order an episode, along which
    very long episodes are cut. ``short_episodes`` tells that there are none, so
    that nothing has to be counted.

    ``calls`` (episode_id, n_turns) may be left out if the actions carry
    ``n_turns`` themselves.
    """
    if calls is not None and "n_turns" not in actions.columns:
        actions = actions.join(calls.select("episode_id", "n_turns"), "episode_id")
    if force_submit:
        actions = with_forced_submission(actions, calls)
    else:
        actions = actions.withColumn("forced", F.lit(False))
    priced = price_actions(actions).withColumn("total_budget", total_budget())
    episodes = ordered_groups(
        priced,
        ["episode_id"],
        [F.col(c).asc_nulls_last() for c in order],
        [F.col(c) for c in order],
        target_rows,
        count=not short_episodes,
    )
    submits = F.col("action_type") == "submit_report"
    too_dear = ~submits & (F.col("spent") > F.col("total_budget"))
    counted = (
        episodes.running(spent=F.col("cost"))
        .with_columns(exhausted=too_dear)
        .with_columns(done=F.col("exhausted") | submits)
        .running(endings=F.col("done").cast("int"))
        .where(F.col("endings") == F.col("done").cast("int"))
        .with_columns(
            recorded_action=F.when(
                F.col("exhausted"), fv.AUTO_SUBMIT_NAME
            ).otherwise(F.col("action_type")),
            reward_cents=F.when(F.col("done"), F.lit(0).cast("long")).otherwise(
                reward_cents()
            ),
            remaining=F.col("total_budget")
            - F.col("spent")
            + F.when(F.col("exhausted"), F.col("cost")).otherwise(F.lit(0)),
            verdict=F.when(
                F.col("done"),
                ~F.col("exhausted") & F.coalesce("compliance_pass", F.lit(True)),
            ),
        )
    )
    return (
        counted.running(
            step=F.lit(1),
            metadata_calls=_ones("get_call_metadata"),
            sentiment_calls=_ones("get_sentiment_timeline"),
            transcript_chunks_read=_ones("read_transcript_chunk"),
            turns_analyzed=_ones("analyze_turn"),
            violations_flagged=_recorded_flag().cast("int"),
            paid_cents=F.col("reward_cents"),
        )
        .rows()
        .drop("spent", "endings")
    )


def _ones(action: str) -> Column:
    return (F.col("recorded_action") == action).cast("int")


def _recorded_flag() -> Column:
    return (F.col("recorded_action") == "flag_violation") & F.col("error_code").isNull()


# --- Views over the steps -----------------------------------------------------


def checklist(steps: DataFrame) -> DataFrame:
    return steps.select(
        "episode_id",
        "step",
        (F.col("metadata_calls") > 0).alias("metadata_reviewed"),
        (F.col("sentiment_calls") > 0).alias("sentiment_checked"),
        "transcript_chunks_read",
        "turns_analyzed",
        "violations_flagged",
        F.col("done").alias("report_submitted"),
        percent("remaining", "total_budget").alias("budget_remaining_pct"),
        F.col("remaining").alias("budget_remaining_units"),
        "total_budget",
    )


def audit_rows(steps: DataFrame) -> DataFrame:
    """What grading needs of a replay: its recorded flags and its last step.

    Flag rows carry ``type``, last-step rows carry the ending; the other columns
    are null. Both kinds come from one pass over the steps.
    """
    flag = {
        "type": F.col("violation_type"),
        "pos": F.col("violations_flagged") - 1,
        "turn_index": F.col("turn_index"),
        "severity": F.coalesce("violation_severity", F.lit("low")),
    }
    ending = {
        "verdict": F.col("verdict"),
        "budget_remaining": F.col("remaining"),
        "total_budget": F.col("total_budget"),
        "exhausted": F.col("exhausted"),
        "forced": F.col("forced"),
        "steps": F.col("step"),
    }
    is_flag = _recorded_flag()
    return steps.where(is_flag | F.col("done")).select(
        "episode_id",
        *[F.when(is_flag, c).alias(n) for n, c in flag.items()],
        *[F.when(F.col("done"), c).alias(n) for n, c in ending.items()],
    )


ENDING_COLUMNS = [
    "verdict",
    "budget_remaining",
    "total_budget",
    "exhausted",
    "forced",
    "steps",
]


def flags_of(audit: DataFrame) -> DataFrame:
    """Recorded violations with their place in the order of flagging."""
    return audit.where(F.col("type").isNotNull()).select(
        "episode_id", "pos", "type", "turn_index", "severity"
    )


def endings_of(audit: DataFrame) -> DataFrame:
    """One row per finished episode: verdict and what is left of the budget."""
    return audit.where(F.col("verdict").isNotNull()).select("episode_id", *ENDING_COLUMNS)


_DONE_TEXT = {
    "get_call_metadata": sql_text(fv.FEEDBACK_METADATA),
    "get_sentiment_timeline": sql_text(fv.FEEDBACK_SENTIMENT),
    "get_transcript_length": sql_text(fv.FEEDBACK_LENGTH),
    "read_transcript_chunk": (
        f"format_string({sql_text(fv.FEEDBACK_READ)}, start_turn, end_turn)"
    ),
    "analyze_turn": f"format_string({sql_text(fv.FEEDBACK_ANALYZE)}, turn_index)",
    "flag_violation": sql_text(fv.FEEDBACK_FLAG),
    "submit_report": sql_text(fv.FEEDBACK_SUBMIT),
}


def feedback() -> Column:
    """The feedback line of a step that carries ``short_error``."""
    done_cases = " ".join(f"WHEN '{a}' THEN {text}" for a, text in _DONE_TEXT.items())
    text = f"""CASE
        WHEN exhausted
            THEN format_string({sql_text(fv.FEEDBACK_EXHAUSTED)}, remaining, cost)
        WHEN error_code IS NOT NULL
            THEN format_string({sql_text(fv.FEEDBACK_ERROR)}, short_error)
        ELSE CASE action_type {done_cases}
            ELSE format_string({sql_text(fv.FEEDBACK_UNKNOWN)}, action_type) END END"""
    # Invalid reads are turned away before the budget is looked at.
    warning = f"""CASE
        WHEN done OR remaining >= {fv.LOW_BUDGET_BELOW}
            OR (action_type = 'read_transcript_chunk' AND error_code IS NOT NULL) THEN ''
        WHEN remaining >= {fv.ACTION_COST["flag_violation"]}
            THEN {sql_text(fv.WARNING_FLAG_ONLY)}
        ELSE {sql_text(fv.WARNING_SUBMIT_NOW)} END"""
    return F.expr(f"concat({text}, {warning})")


def rewarded_steps(steps: DataFrame, grades: DataFrame) -> DataFrame:
    """Steps with ``reward``, ``cumulative_reward``, ``error`` and ``feedback``.

    The last step earns the unrounded grade, less a fixed penalty if the budget
    ran out. Earlier rewards are summed as whole hundredths. The grade is joined
    by episode and step, as only the last step needs it, so the steps of a long
    episode stay spread out.
    """
    last = grades.select(
        "episode_id",
        F.col("steps").alias("step"),
        F.col("total").alias("grade"),
        "final_score",
    )
    joined = steps.join(last, ["episode_id", "step"], "left")
    reward = f"""CASE WHEN NOT done THEN reward_cents / 100D
        WHEN exhausted THEN grade - {fv.EXHAUSTED_PENALTY}D ELSE grade END"""
    return (
        joined.withColumns(
            {
                "reward": F.expr(reward),
                "error": error_text(),
                "short_error": error_text(short=True),
            }
        )
        .withColumns(
            {
                "cumulative_reward": F.expr("paid_cents / 100D + IF(done, reward, 0D)"),
                "feedback": feedback(),
            }
        )
        .drop("short_error")
    )


def episode_state(steps: DataFrame) -> DataFrame:
    """One row per episode: counters and rewards at its last step, ordered lists.

    ``steps`` carry ``cumulative_reward``. An episode pays for its steps from its
    budget, which bounds the lists by the length of its call; only reads turned away
    are free.
    """
    action = F.struct("step", F.col("recorded_action").alias("action"))
    flag = F.when(
        _recorded_flag(),
        F.struct(
            "step",
            F.col("violation_type").alias("type"),
            "turn_index",
            F.coalesce("violation_severity", F.lit("low")).alias("severity"),
        ),
    )
    return (
        steps.groupBy("episode_id")
        .agg(
            F.max("step").alias("step_count"),
            F.max("total_budget").alias("total_budget"),
            F.min("remaining").alias("budget_remaining"),
            F.max("done").alias("done"),
            F.max_by("cumulative_reward", "step").alias("cumulative_reward"),
            F.array_sort(F.collect_list(action)).alias("actions"),
            F.array_sort(F.collect_list(flag)).alias("flags"),
        )
        .withColumn("actions", F.transform("actions", lambda a: a["action"]))
    )


def budget_exhausted(steps: DataFrame) -> DataFrame:
    """Spending per episode and how it ended."""
    return endings_of(audit_rows(steps)).select(
        "episode_id",
        "steps",
        "total_budget",
        (F.col("total_budget") - F.col("budget_remaining")).alias("spent"),
        "budget_remaining",
        "exhausted",
        "forced",
    )


def reset_view(calls: DataFrame) -> DataFrame:
    """What an auditor sees when an episode opens."""
    return calls.withColumn("total_budget", total_budget()).select(
        "call_id",
        F.format_string(
            fv.MSG_LOADED,
            F.col("call_id").cast("string"),
            F.col("n_turns"),
            F.col("department"),
            F.col("total_budget"),
        ).alias("result"),
        F.lit(fv.FEEDBACK_RESET).alias("feedback"),
        "total_budget",
    )
