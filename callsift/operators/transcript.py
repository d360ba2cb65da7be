"""Operators over calls and their turns.

``turns``: call_id, pos (0-based list position), turn_index (as stored), speaker,
text, ts_start, ts_end. ``calls`` adds metadata and ``n_turns`` per call.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions import text as tx
from callsift.functions.numeric import round_half_even
from callsift.operators.actions import error_text, rule_code
from callsift.sources.dims import rubric_dim

# Turns of a long call are windowed in parts of this many.
PART_TURNS = 4096


def call_lengths(turns: DataFrame) -> DataFrame:
    return turns.groupBy("call_id").agg(F.count("*").cast("int").alias("n_turns"))


def call_metadata(calls: DataFrame) -> DataFrame:
    """Call context without any transcript content."""
    return calls.select(
        "call_id",
        "difficulty",
        "department",
        "call_reason",
        "call_duration_seconds",
        "call_summary",
        F.col("n_turns").alias("total_turns"),
    )


def list_tasks(calls: DataFrame) -> DataFrame:
    return calls.select(F.col("call_id").alias("task_id"), "difficulty")


def transcript_length(calls: DataFrame) -> DataFrame:
    last = F.col("n_turns") - 1
    return calls.select(
        "call_id",
        F.col("n_turns").alias("total_turns"),
        F.format_string(fv.MSG_LENGTH_RANGE, last).alias("valid_turn_indices"),
        F.lit(fv.MAX_CHUNK_TURNS).alias("max_chunk_size"),
    )


def sentiment_timeline(calls: DataFrame) -> DataFrame:
    """One row per shift marker; a call without markers keeps one empty row."""
    shifts = F.coalesce(
        F.col("sentiment_shifts"), F.array().cast("array<map<string,string>>")
    )
    return calls.select("call_id", F.posexplode_outer(shifts).alias("shift_pos", "shift"))


def episode_budget(calls: DataFrame) -> DataFrame:
    budget = F.lit(fv.BUDGET_BASE) + F.lit(fv.BUDGET_PER_TURN) * F.col("n_turns")
    return calls.select("call_id", "n_turns", budget.alias("total_budget"))


# --- Names ------------------------------------------------------------------


def _intros(pattern: str, rank: int) -> Column:
    """All names one pattern finds in a turn, with the pattern's rank."""
    names = F.regexp_extract_all(F.col("text"), F.lit("(?U)" + pattern), 1)
    return F.transform(
        names,
        lambda name, i: F.struct(
            F.lit(rank).alias("rank"), i.alias("nth"), name.alias("name")
        ),
    )


def extract_entities(turns: DataFrame) -> DataFrame:
    """Names introduced in the opening turns: call_id, name, token, inserted.

    A full introduction always sets the token of its name (the last one counts);
    the first word of a name is set only where nothing was set before.
    """
    found = F.concat(_intros(fv.INTRO_SELF, 0), _intros(fv.INTRO_THIS_IS, 1))
    intros = (
        turns.where(F.col("pos") < fv.INTRO_TURNS)
        .select(
            "call_id",
            "pos",
            (F.col("speaker") == "agent").alias("by_agent"),
            F.explode(found).alias("hit"),
        )
        .where(~F.col("hit.name").isin(fv.NOT_A_NAME))
    )
    first_word = F.regexp_extract("hit.name", r"^(\S+)", 1)
    entries = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("hit.name").alias("name")),
        F.struct(F.lit(1).alias("kind"), first_word.alias("name")),
    )
    turn_rank = F.col("pos").cast("long") * 2 + F.col("hit.rank")
    events = (
        intros.select(
            "call_id",
            "by_agent",
            ((turn_rank * 2**31 + F.col("hit.nth")) * 2).alias("at"),
            F.explode(entries).alias("entry"),
        )
        .select(
            "call_id",
            "by_agent",
            F.col("entry.name").alias("name"),
            F.col("entry.kind").alias("kind"),
            (F.col("at") + F.col("entry.kind")).alias("at"),
        )
        .where((F.col("kind") == 0) | ~F.col("name").isin(fv.NOT_A_NAME))
    )
    full_at = F.when(F.col("kind") == 0, F.col("at"))
    by_agent = F.coalesce(
        F.max_by(F.when(F.col("kind") == 0, F.col("by_agent")), full_at),
        F.min_by("by_agent", "at"),
    )
    token = F.when(F.col("by_agent"), fv.TOKEN_AGENT).otherwise(fv.TOKEN_CUSTOMER)
    return (
        events.groupBy("call_id", "name")
        .agg(by_agent.alias("by_agent"), F.min("at").alias("inserted"))
        .select("call_id", "name", token.alias("token"), "inserted")
    )


def names_per_call(entities: DataFrame) -> DataFrame:
    """The ordered name list of each call; at most the names of eight turns."""
    entry = F.struct(
        (-F.length("name")).alias("by_length"),
        F.col("inserted"),
        F.col("name"),
        F.col("token"),
    )
    return entities.groupBy("call_id").agg(
        F.array_sort(F.collect_list(entry)).alias("names")
    )


def redact_turns(turns: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """The turns with text redacted, names by what their own call introduces."""
    if entities is None:
        entities = extract_entities(turns)
    joined = turns.join(names_per_call(entities), "call_id", "left")
    return joined.withColumn("text", tx.redact_pii(F.col("text"), F.col("names"))).drop(
        "names"
    )


# --- Turn context -----------------------------------------------------------


def turn_context(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Each turn with its neighbours, silence before it and place in the call.

    Long calls are windowed in parts. The rows next to a cut are also sent to
    the neighbouring part, so one shuffle is enough and no part needs the
    length of the call: a turn is near the end if no turn follows three later.
    """
    own = F.floor(F.col("pos") / F.lit(part_turns))
    offset = F.col("pos") % F.lit(part_turns)
    homes = F.filter(
        F.array(
            own,
            F.when(offset == part_turns - 1, own + 1),
            F.when((offset < 3) & (own > 0), own - 1),
        ),
        lambda part: part.isNotNull(),
    )
    frame = Window.partitionBy("call_id", "_part").orderBy("pos")

    def neighbour(shift: int, column: str, alias: str) -> Column:
        return F.lag(column, shift).over(frame).alias(alias)

    # Spelled out, because input that is already split by call alone would do for
    # the window and leave a very long call in one task.
    spread = (
        turns.withColumn("_own", own)
        .withColumn("_part", F.explode(homes))
        .repartition("call_id", "_part")
    )
    seen = spread.select(
        "*",
        neighbour(1, "turn_index", "before_turn_index"),
        neighbour(1, "speaker", "before_speaker"),
        neighbour(1, "text", "before_text"),
        neighbour(1, "ts_end", "before_ts_end"),
        neighbour(-1, "turn_index", "after_turn_index"),
        neighbour(-1, "speaker", "after_speaker"),
        neighbour(-1, "text", "after_text"),
        neighbour(-1, "ts_start", "after_ts_start"),
        neighbour(-3, "pos", "_third_after"),
    ).where(F.col("_part") == F.col("_own"))
    gap = round_half_even("(ts_start - before_ts_end)", 1)
    place = (
        F.when(F.col("pos") <= 2, "opening")
        .when(F.col("_third_after").isNull(), "closing")
        .otherwise("mid-call")
    )
    return seen.withColumns(
        {
            "silence_gap_before_seconds": F.coalesce(gap, F.lit(0.0)),
            "speaker_turn_position": place,
        }
    ).drop("_own", "_part", "_third_after")


def silence_gaps(turns: DataFrame) -> DataFrame:
    return turn_context(turns).select("call_id", "pos", "silence_gap_before_seconds")


def turn_position(turns: DataFrame) -> DataFrame:
    return turn_context(turns).select("call_id", "pos", "speaker_turn_position")


# --- Requests ---------------------------------------------------------------


def validate_reads(requests: DataFrame, lengths: DataFrame) -> DataFrame:
    """``requests`` (request_id, call_id, start_turn, end_turn) with ``error``."""
    checked = requests.join(lengths, "call_id").withColumn(
        "error_code", rule_code("read_transcript_chunk")
    )
    return checked.withColumns(
        {
            "error": error_text("read_transcript_chunk"),
            "is_valid": F.col("error_code").isNull(),
        }
    ).drop("error_code")


def read_chunks(
    requests: DataFrame, turns: DataFrame, entities: DataFrame | None = None
) -> DataFrame:
    """The redacted turns of every valid request.

    A valid request spans at most five turns, so it becomes at most five
    positions, and the range join is an equality join on call and position.
    """
    valid = validate_reads(requests, call_lengths(turns)).where("is_valid")
    wanted = valid.select(
        "request_id",
        "call_id",
        "start_turn",
        "end_turn",
        F.col("n_turns").alias("total_turns"),
        F.explode(
            F.sequence(F.col("start_turn").cast("long"), F.col("end_turn").cast("long"))
        ).alias("pos"),
    )
    return wanted.join(redact_turns(turns, entities), ["call_id", "pos"])


def rubric_lookup(requests: DataFrame) -> DataFrame:
    """Rubric columns for ``policy_hypothesis``; an unknown one gets an error."""
    asked = F.col("policy_hypothesis")
    given = asked.isNotNull() & (asked != "")
    valid = "[" + ", ".join(f"'{t}'" for t in fv.VIOLATION_TYPES) + "]"
    rubric = F.broadcast(rubric_dim(requests.sparkSession))
    error = F.when(
        given & F.col("policy").isNull(),
        F.format_string(fv.MSG_POLICY_UNKNOWN, asked, F.lit(valid)),
    )
    return requests.join(rubric, asked == F.col("policy"), "left").withColumn(
        "compliance_rubric_error", error
    )


def analyze_turns(
    requests: DataFrame, turns: DataFrame, entities: DataFrame | None = None
) -> DataFrame:
    """Context, signals and rubric for (request_id, call_id, turn_index, policy)."""
    checked = (
        requests.join(call_lengths(turns), "call_id")
        .withColumn("error_code", rule_code("analyze_turn"))
        .withColumns(
            {
                "error": error_text("analyze_turn"),
                "pos": F.expr("IF(error_code IS NULL, turn_index, NULL)"),
            }
        )
        .withColumnRenamed("turn_index", "asked_index")
    )
    context = turn_context(redact_turns(turns, entities))
    return rubric_lookup(checked.join(context, ["call_id", "pos"], "left"))
