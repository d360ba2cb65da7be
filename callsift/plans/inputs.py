"""Audit inputs derived from the given tables.

The tables hold no call transcripts, so calls, actions, truth, completions and
run results are derived row by row from ``conversations`` and ``events`` with
whole-number rules that any SQL engine can repeat. Work grows with the tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.operators.scan import ordered_groups

# Sentences placed in front of the invented prose, so that names, personal data
# and rubric phrases occur in calls.
PLANTS = [
    "My name is Dana Whitfield.",
    "I'm Omar, thanks for holding.",
    "Good day, this is Priya Nair.",
    "I am Tom.",
    "My name is Tom Reed and I need help.",
    "This is Acme Financial, good morning.",
    "My social is 219-09-9999.",
    "The last four of my SSN is 4407.",
    "Reach me at (212) 555-0147 or 212.555.0148.",
    "The account is 4000-1234-5678.",
    "Write to ann.lee@example.org please.",
    "This call may be recorded for quality.",
    "I want to speak to a supervisor now.",
    "A supervisor would tell you the same thing.",
    "I guarantee the fee is gone.",
    "Rates are typically lower, but I promise nothing.",
    "Can you give me your Social Security number?",
    "Give me your Social Security number, only the last four.",
    "I'll give you 50% off for a year.",
    "I can check if any promotions are available to give you 10% off.",
    "Hello? Are you still there?",
    "Thanks Dana, the annual fee is $45.99 at 3.95%.",
    "I'm Ann, and Tom Reed is on the line, this is not Omar.",
    "This is an attempt to collect a debt, and this call is being recorded.",
    "Sorry about that, where were we?",
    "May I place you on a brief hold?",
    "One moment, let me grab my account number.",
    "",
]
DIFFICULTIES = ["easy", "medium", "hard"]
DEPARTMENTS = ["Billing", "Collections", "Lending", "Cards"]
REASONS = ["fee dispute", "rate question", "address change"]
MOODS = ["frustrated", "angry", "calm"]
FLAG_TYPES = [*fv.VIOLATION_TYPES, "rude_tone"]
ENV, MODEL = "audit", "replayed"
# Models and runs of each; one more of both is expected and never found.
MODELS, RUNS = 3, 3
# Entries per stored record of a call or a run.
PART_ROWS = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """The value at a 0-based index; null entries are allowed."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


# --- Calls from conversations --------------------------------------------------


def turns(spark: SparkSession, folder: str, target_rows: int | None = None) -> DataFrame:
    """Three conversations in a row make one call."""
    conv, turn = F.col("conv_id"), F.col("turn")
    plant = pick(PLANTS, (conv * 5 + turn) % len(PLANTS))
    speaker = (
        F.when(F.col("role") == "assistant", "agent")
        .when(F.col("role") == "user", "customer")
        .otherwise("system")
    )
    said = table(spark, folder, "conversations").select(
        F.floor(conv / F.lit(3)).alias("call_id"),
        conv.alias("conv_id"),
        turn.cast("int").alias("turn_index"),
        speaker.alias("speaker"),
        F.when(plant == "", F.col("text"))
        .otherwise(F.concat(plant, F.lit(" "), F.col("text")))
        .alias("text"),
        (F.lit(10) + F.length("text") % 400).alias("dur"),
    )
    ordered = ordered_groups(
        said,
        ["call_id"],
        [F.col("conv_id"), F.col("turn_index")],
        [F.col("conv_id"), F.col("turn_index")],
        target_rows,
    )
    pos = F.col("nth") - 1
    gap = F.when(pos == 0, F.lit(0).cast("long")).otherwise(
        ((F.col("call_id") * 7 + pos * 13) % 40) * 10 + pos % 10
    )
    return (
        ordered.running(nth=F.lit(1))
        .with_columns(gap=gap)
        .running(end=F.col("gap") + F.col("dur"))
        .rows()
        .select(
            "call_id",
            pos.alias("pos"),
            "turn_index",
            "speaker",
            "text",
            ((F.col("end") - F.col("dur")).cast("double") / 10.0).alias("ts_start"),
            (F.col("end").cast("double") / 10.0).alias("ts_end"),
        )
    )


def departments(spark: SparkSession, folder: str) -> DataFrame:
    """(call_id, department), from the conversations' ids alone."""
    call = F.floor(F.col("conv_id") / F.lit(3)).alias("call_id")
    ids = table(spark, folder, "conversations").select(call).distinct()
    return ids.select("call_id", pick(DEPARTMENTS, F.col("call_id") % 4).alias("department"))


def calls(turns_df: DataFrame) -> DataFrame:
    """Metadata per call; two of five calls carry sentiment markers."""
    call = F.col("call_id")
    marks = F.transform(
        F.sequence(F.lit(1), (call % 3 + 1).cast("int")),
        lambda i: F.create_map(
            F.lit("turn_index"),
            (i * 2).cast("string"),
            F.lit("to"),
            pick(MOODS, (call + i) % 3),
        ),
    )
    reason = pick(REASONS, call % 3)
    return (
        turns_df.groupBy("call_id")
        .agg(
            F.count("*").cast("int").alias("n_turns"),
            F.max("ts_end").alias("call_duration_seconds"),
        )
        .select(
            "call_id",
            "n_turns",
            pick(DIFFICULTIES, call % 3).alias("difficulty"),
            pick(DEPARTMENTS, call % 4).alias("department"),
            reason.alias("call_reason"),
            "call_duration_seconds",
            F.concat(F.lit("Call about a "), reason).alias("call_summary"),
            F.when(call % 5 < 2, marks).alias("sentiment_shifts"),
            (call % 4 == 0).alias("gt_compliance"),
        )
    )


def read_requests(turns_df: DataFrame) -> DataFrame:
    """One range request per turn, valid and invalid ones."""
    call, pos = F.col("call_id"), F.col("pos")
    start = F.when((call + pos) % 11 != 0, (pos - call % 3).cast("int"))
    return turns_df.select(
        (call * 2**32 + pos).alias("request_id"),
        "call_id",
        start.alias("start_turn"),
        (pos + (call * 3 + pos * 7) % 8 - 2).cast("int").alias("end_turn"),
    )


def analyze_requests(turns_df: DataFrame) -> DataFrame:
    """One turn analysis per turn, some out of range, with a policy or none."""
    call, pos = F.col("call_id"), F.col("pos")
    policy = pick([*FLAG_TYPES, None, ""], (call + pos) % (len(FLAG_TYPES) + 2))
    asked = (
        F.when((call + pos) % 13 == 0, F.lit(None).cast("int"))
        .when((call + pos) % 13 == 1, F.lit(-1))
        .when((call + pos) % 13 == 2, (pos + 100).cast("int"))
        .otherwise(pos.cast("int"))
    )
    return turns_df.select(
        (call * 2**32 + pos).alias("request_id"),
        "call_id",
        asked.alias("turn_index"),
        policy.alias("policy_hypothesis"),
    )


# --- Action logs from events -----------------------------------------------------

ORDER = ("at", "event_id")


def actions(spark: SparkSession, folder: str) -> DataFrame:
    """One audit action per event; a user's events are one episode."""
    return as_actions(table(spark, folder, "events"))


def as_actions(events: DataFrame) -> DataFrame:
    """The action of each event, for tables and streams alike."""
    fields = events.selectExpr(
        "user_id AS episode_id",
        f"{_MICROS} AS at",
        "event_id",
        "CAST(20 + user_id % 30 AS INT) AS n_turns",
        "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )
    return fields.selectExpr("episode_id", *ORDER, "n_turns", *_ACTION_COLUMNS)


# Microseconds since 1970 of a wall-clock time, in any session time zone.
_MICROS = """(datediff(CAST(ts AS DATE), DATE '1970-01-01') * 86400L
    + hour(ts) * 3600 + minute(ts) * 60) * 1000000L
    + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT)"""


def _pick_sql(values: list[str | None], index: str) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({items}), CAST({index} AS INT))"


_ACTION_COLUMNS = [
    """CASE WHEN event_type = 'view' THEN 'read_transcript_chunk'
        WHEN event_type = 'click' THEN 'analyze_turn'
        WHEN event_type = 'signup' AND k % 2 = 0 THEN 'get_call_metadata'
        WHEN event_type = 'signup' THEN 'get_sentiment_timeline'
        WHEN event_type = 'error' THEN 'flag_violation'
        WHEN k % 10 = 0 THEN 'submit_report' WHEN k % 10 = 1 THEN 'noop'
        ELSE 'get_transcript_length' END AS action_type""",
    """CASE WHEN event_type = 'click' THEN k
        WHEN event_type = 'error' AND event_id % 3 > 0 THEN k % n_turns END
        AS turn_index""",
    """CASE WHEN event_type <> 'view' OR event_id % 13 = 0 THEN NULL
        WHEN event_id % 13 = 1 THEN -1 ELSE k % n_turns END AS start_turn""",
    """CASE WHEN event_type = 'view'
        THEN CAST(k % n_turns + event_id % 7 - 1 AS INT) END AS end_turn""",
    f"""CASE WHEN event_type = 'error'
        THEN {_pick_sql(FLAG_TYPES, "k % 7")} END AS violation_type""",
    f"""CASE WHEN event_type = 'error'
        THEN {_pick_sql([*fv.SEVERITIES, None], "event_id % 4")} END
        AS violation_severity""",
    """CASE WHEN event_type = 'purchase' AND k % 10 = 0 AND event_id % 3 > 0
        THEN k % 20 = 0 END AS compliance_pass""",
    f"""CASE WHEN event_type = 'click' AND k % 2 = 0
        THEN {_pick_sql(FLAG_TYPES, "k % 7")} END AS policy_hypothesis""",
]


def truth(ids: DataFrame, label: Column | None = None) -> DataFrame:
    """Labelled violations of ``episode_id``, by ``label`` if several share labels."""
    eid, i = F.col("label"), F.col("pos")
    labelled = ids.withColumn("label", F.col("episode_id") if label is None else label)
    return (
        labelled.where(eid % 4 > 0)
        .select(
            "episode_id",
            "label",
            F.explode(F.sequence(F.lit(0), (eid % 4 - 1).cast("int"))).alias("pos"),
        )
        .select(
            "episode_id",
            "pos",
            pick(fv.VIOLATION_TYPES, (eid + i * 3) % 6).alias("type"),
            pick(fv.SEVERITIES, (eid + i) % 3).alias("severity"),
            F.when(
                (eid + i) % 5 > 0,
                F.concat(F.lit("Seen in episode "), eid.cast("string")),
            ).alias("description"),
            (eid * 3 + i).cast("int").alias("turn_index"),
        )
    )


def episode_ids(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .select(F.col("user_id").alias("episode_id"))
        .distinct()
    )


def truth_compliance() -> Column:
    return (F.col("episode_id") % 4 == 0).alias("gt_compliance")


def tool_call_json(spark: SparkSession, folder: str) -> DataFrame:
    """The same actions as JSON arguments, some malformed or loosely typed."""
    acts = actions(spark, folder)
    eid = F.col("event_id")

    def text(field: str) -> Column:
        return F.coalesce(F.col(field).cast("string"), F.lit("null"))

    quoted = F.concat(F.lit('"'), text("turn_index"), F.lit('"'))
    verdict = (
        F.when(eid % 4 == 0, F.lit('"yes"'))
        .when(eid % 4 == 1, F.lit('"1"'))
        .when(eid % 4 == 2, F.lit("true"))
        .otherwise(F.lit('"no"'))
    )
    args = F.concat(
        F.lit('{"turn_index": '),
        F.when(eid % 3 == 0, quoted).otherwise(text("turn_index")),
        F.lit(', "start_turn": '),
        F.when(eid % 5 == 0, F.lit('"None"')).otherwise(text("start_turn")),
        F.lit(', "end_turn": '),
        F.when(eid % 7 == 0, F.lit('"soon"')).otherwise(text("end_turn")),
        F.lit(', "violation_type": "'),
        F.coalesce("violation_type", F.lit("")),
        F.lit('", "compliance_pass": '),
        verdict,
        F.when(eid % 17 == 0, F.lit("")).otherwise(F.lit("}")),
    )
    return acts.select(
        "event_id", F.col("action_type").alias("fn_name"), args.alias("args")
    )


def completions(spark: SparkSession, folder: str) -> DataFrame:
    """One completion text per event, holding several tool calls."""
    acts = actions(spark, folder)
    eid = F.col("event_id")

    def shown(field: str) -> Column:
        return F.coalesce(F.col(field).cast("string"), F.lit("2"))

    text = F.concat(
        F.lit("First get_call_metadata() then "),
        F.lit("read_transcript_chunk(start_turn="),
        shown("start_turn"),
        F.lit(", end_turn = "),
        shown("end_turn"),
        F.lit(") and flag_violation(violation_type='"),
        F.coalesce("violation_type", pick(fv.VIOLATION_TYPES, eid % 6)),
        F.lit("', violation_severity=\""),
        pick(fv.SEVERITIES, eid % 3),
        F.lit('")'),
        F.when(eid % 5 == 0, F.lit(' flag_violation(type="x")')).otherwise(F.lit("")),
        F.when(eid % 7 == 0, F.lit(" analyze_turn(turn_index=two)")).otherwise(
            F.lit(" analyze_turn(turn_index=1,policy_hypothesis=failed_escalation)")
        ),
        F.when(eid % 3 == 0, F.lit(" submit_report(compliance_pass=True)"))
        .when(eid % 3 == 1, F.lit(" submit_report(compliance_pass=False) get_call_metadata()"))
        .otherwise(F.lit(" done")),
    )
    return acts.select(
        eid.alias("completion_id"),
        (eid % 12).alias("task"),
        "n_turns",
        text.alias("text"),
    )


# --- Graded results as model runs --------------------------------------------------


def as_runs(graded: DataFrame) -> DataFrame:
    """Graded episodes dealt out to models and runs; the seconds are invented."""
    eid = F.col("episode_id")
    seconds = (F.lit(58) + (eid * 37) % 682).cast("double") / 10.0
    return graded.select(
        F.concat(F.lit("model_"), (eid % MODELS).cast("string")).alias("model"),
        (F.floor(eid / MODELS) % RUNS + 1).cast("int").alias("run"),
        F.concat(F.lit("call_"), eid.cast("string")).alias("task_id"),
        pick(DIFFICULTIES, F.floor(eid / 5) % 3).alias("difficulty"),
        F.col("final_score").alias("score"),
        seconds.alias("time_seconds"),
    )
