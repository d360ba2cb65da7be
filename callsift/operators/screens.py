"""Rule screens that cover every call.

The screens turn the rubric's wording into candidates for review. They read
flat turns and need no labels.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions import text as tx
from callsift.operators.transcript import turn_context


def screen_hold_gaps(
    turns: DataFrame, threshold: float = fv.NATURAL_PAUSE_SECONDS
) -> DataFrame:
    """Silences that may be an unannounced hold, with a severity.

    Medium if the customer's turn after the silence shows confusion or the
    silence is long; low if it is short and draws no complaint. A silence is no
    candidate if the customer asked for it in the turn before, or if the agent asked
    for a hold there. An agent who comes back with an apology points to a hold.
    """
    gap = F.col("silence_gap_before_seconds")
    customer_now = F.when(F.col("speaker") == "customer", F.col("text"))
    customer_next = F.when(F.col("after_speaker") == "customer", F.col("after_text"))
    reply = F.lower(F.coalesce(customer_now, customer_next, F.lit("")))
    confused = reply.rlike(fv.SCREEN_CONFUSED)
    long = gap >= fv.HOLD_GAP_SECONDS
    earlier = F.lower("before_text")
    agreed = F.coalesce(
        (F.col("before_speaker") == "customer") & earlier.rlike(fv.SCREEN_CUSTOMER_PAUSE)
        | (F.col("before_speaker") == "agent") & earlier.rlike(fv.SCREEN_HOLD_ASKED),
        F.lit(False),
    )
    apologised = (F.col("speaker") == "agent") & _phrase(fv.SCREEN_APOLOGY)
    return (
        turn_context(turns)
        .where((gap >= threshold) & ~agreed)
        .select(
            "call_id",
            "pos",
            gap.alias("gap_seconds"),
            confused.alias("customer_confused"),
            apologised.alias("agent_apologised"),
            F.when(confused | long, "medium").otherwise("low").alias("severity"),
        )
    )


def _phrase(pattern: str) -> Column:
    return F.lower("text").rlike(pattern)


def screen_rubric(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """Per call: the first turn of every phrase screen, null if none.

    ``calls`` holds (call_id, department). A Collections call also lacks its disclosure
    if the agent's first turn does not tell of the debt; that is null for others.
    Everything is a minimum or a count, so a long call is summed up before it
    is shuffled.
    """
    agent = F.col("speaker") == "agent"
    customer = F.col("speaker") == "customer"
    # The agent's first turn carries what it lacks in its lowest bits.
    opening = F.when(
        agent,
        F.col("pos").cast("long") * 4
        + F.when(_phrase(fv.SCREEN_DISCLOSURE), 0).otherwise(1)
        + F.when(_phrase(fv.SCREEN_DEBT_DISCLOSURE), 0).otherwise(2),
    )

    def first(condition: Column) -> Column:
        return F.min(F.when(condition, F.col("pos")))

    found = turns.groupBy("call_id").agg(
        F.min(opening).alias("opening"),
        first(customer & _phrase(fv.SCREEN_SUPERVISOR_REQUEST)).alias(
            "supervisor_request_pos"
        ),
        first(agent & _phrase(fv.SCREEN_DEFLECTION)).alias("deflection_pos"),
        first(
            agent & _phrase(fv.SCREEN_COMMITMENT) & ~_phrase(fv.SCREEN_HEDGE)
        ).alias("commitment_pos"),
        first(
            agent & _phrase(fv.SCREEN_FULL_SSN) & ~_phrase(fv.SCREEN_LAST_FOUR)
        ).alias("full_ssn_pos"),
        first(
            agent & _phrase(fv.SCREEN_DISCOUNT) & ~_phrase(fv.SCREEN_DISCOUNT_OK)
        ).alias("discount_pos"),
    )
    lacks = F.col("opening") % 4
    collecting = F.col("department") == fv.COLLECTIONS
    return found.join(calls.select("call_id", "department"), "call_id", "left").select(
        "call_id",
        (lacks % 2 == 1).alias("disclosure_missing"),
        F.when(collecting, lacks >= 2).alias("debt_disclosure_missing"),
        "supervisor_request_pos",
        "deflection_pos",
        "commitment_pos",
        "full_ssn_pos",
        "discount_pos",
    )


def pii_census(texts: DataFrame, by: list[str]) -> DataFrame:
    """PII matches per kind and group over a ``text`` column.

    Each kind is counted on the text as the kinds before it have left it, one
    projection per kind, so that no replacement runs twice.
    """
    staged = texts.select(*by, tx.redactable(F.col("text")).alias("left"))
    for kind, pattern, token in tx.STAGES:
        staged = staged.withColumns(
            {
                kind: F.regexp_count("left", F.lit(pattern)),
                "left": F.regexp_replace("left", pattern, token),
            }
        )
    counts = [
        F.coalesce(F.sum(kind), F.lit(0)).cast("long").alias(kind)
        for kind, _, _ in tx.STAGES
    ]
    return staged.groupBy(*by).agg(*counts)
