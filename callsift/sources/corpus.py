"""Call corpora stored as JSON, and their flat tables.

A record is one call with nested turns and truth. A call may be spread over several
records: ``part`` numbers them, ``parts`` counts them, and ``first`` is the list
position of a record's first turn. A call in a single record may leave them out.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.scan import BROADCAST_ROWS
from callsift.sources.json_array import read_array
from callsift.sources.shared_dir import written
from callsift.sources.splits import read_pieces

CALL_SCHEMA = """
    id string, part int, parts int, first int, difficulty string,
    metadata struct<department string, call_reason string,
                    call_duration_seconds double, call_summary string>,
    turns array<struct<turn_index int, speaker string, text string,
                       timestamp_start double, timestamp_end double>>,
    ground_truth struct<
        disclaimer_present boolean, disclaimer_turn_index int,
        escalation_required boolean, escalation_performed boolean,
        customer_sentiment_shifts array<map<string,string>>,
        violations array<struct<type string, description string,
                                turn_index int, severity string>>,
        overall_compliance_pass boolean>
"""


def read_calls(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Records of JSON arrays (``multiline``) or of JSON lines; both are read in parallel.

    Of records with the same id the last one in file order is kept, with the other
    parts that it counts in ``parts``. Which these are is told from ids and places alone;
    transcripts are parsed afterwards, where they stand, and of current records only.
    Records without id, and text that is no record, are left out.
    """
    if multiline:
        records = read_array(spark, path)
    else:
        lines = read_pieces(spark, path).where(F.trim("value") != "")
        records = lines.select("source", "chunk", F.col("place").alias("nth"), F.col("value").alias("text"))
    head = F.from_json("text", "id string, part int, parts int").alias("head")
    named = records.select(*_PLACE, head).where("head.id IS NOT NULL")
    places = written(
        named.select(*_PLACE, "head.id", F.coalesce("head.part", F.lit(0)).alias("part"), "head.parts"),
        "call-places",
    )
    superseded = written(_superseded(places), "superseded-calls")
    if superseded.count() <= BROADCAST_ROWS:
        superseded = F.broadcast(superseded)
    current = records.join(superseded, _PLACE, "left_anti")
    call = current.select(F.from_json("text", CALL_SCHEMA).alias("call")).where("call.id IS NOT NULL")
    part = F.coalesce("call.part", F.lit(0)).alias("part")
    return call.select("call.id", part, *[f"call.{c}" for c in _FIELDS])


_PLACE = ["source", "chunk", "nth"]


def _superseded(places: DataFrame) -> DataFrame:
    """Places of records that a later one replaces, or does not count as a part."""
    place = F.struct(*_PLACE)
    newest = places.groupBy("id").agg(
        F.coalesce(F.max_by("parts", place), F.lit(1)).alias("counted")
    )
    last = places.groupBy("id", "part").agg(F.max(place).alias("last"))
    kept = last.join(newest, "id").where(F.col("part") < F.col("counted"))
    return places.join(kept.select("last.*"), _PLACE, "left_anti").select(*_PLACE)


_FIELDS = ["first", "difficulty", "metadata", "turns", "ground_truth"]


def turns_of(calls: DataFrame) -> DataFrame:
    """One row per turn with its list position."""
    return calls.select(
        F.col("id").alias("call_id"),
        F.coalesce("first", F.lit(0)).alias("first"),
        F.posexplode("turns").alias("at", "turn"),
    ).select(
        "call_id",
        (F.col("first") + F.col("at")).alias("pos"),
        F.col("turn.turn_index").alias("turn_index"),
        F.col("turn.speaker").alias("speaker"),
        F.col("turn.text").alias("text"),
        F.col("turn.timestamp_start").alias("ts_start"),
        F.col("turn.timestamp_end").alias("ts_end"),
    )


def truth_of(calls: DataFrame) -> DataFrame:
    """One row per labelled violation with its list position."""
    violations = calls.where(F.col("part") == 0).select(
        F.col("id").alias("episode_id"),
        F.posexplode("ground_truth.violations").alias("pos", "v"),
    )
    return violations.select(
        "episode_id", "pos", "v.type", "v.severity", "v.description", "v.turn_index"
    )


def calls_of(calls: DataFrame) -> DataFrame:
    """Flat metadata per call, without reading any transcript text."""
    size = F.coalesce("first", F.lit(0)) + F.size("turns")
    sized = calls.groupBy("id").agg(F.max(size).alias("n_turns"))
    first = calls.where(F.col("part") == 0).select(
        "id",
        "difficulty",
        "metadata.*",
        F.col("ground_truth.customer_sentiment_shifts").alias("sentiment_shifts"),
        F.col("ground_truth.overall_compliance_pass").alias("gt_compliance"),
    )
    return first.join(sized, "id").withColumnRenamed("id", "call_id")


def nest_calls(
    turns: DataFrame, calls: DataFrame, gt: DataFrame, part_turns: int
) -> DataFrame:
    """Flat tables back to records of at most ``part_turns`` turns.

    ``gt`` holds the labelled violations of each call; the list goes into the
    first record.
    """
    entry = F.struct(
        "pos",
        "turn_index",
        "speaker",
        "text",
        F.col("ts_start").alias("timestamp_start"),
        F.col("ts_end").alias("timestamp_end"),
    )
    part = F.floor(F.col("pos") / F.lit(part_turns)).cast("int").alias("part")
    records = turns.groupBy("call_id", part).agg(
        F.array_sort(F.collect_list(entry)).alias("turns")
    )
    violation = F.struct("pos", "type", "description", "turn_index", "severity")
    truth = gt.groupBy(F.col("episode_id").alias("call_id")).agg(
        F.array_sort(F.collect_list(violation)).alias("violations")
    )
    parts = records.groupBy("call_id").agg((F.max("part") + 1).alias("parts"))
    joined = (
        records.join(parts, "call_id")
        .join(calls, "call_id")
        .join(truth, "call_id", "left")
    )
    return joined.select(
        F.col("call_id").cast("string").alias("id"),
        "part",
        "parts",
        (F.col("part") * F.lit(part_turns)).alias("first"),
        "difficulty",
        F.struct(
            "department", "call_reason", "call_duration_seconds", "call_summary"
        ).alias("metadata"),
        F.transform("turns", lambda t: t.dropFields("pos")).alias("turns"),
        F.struct(
            F.col("sentiment_shifts").alias("customer_sentiment_shifts"),
            F.transform(
                F.coalesce("violations", F.array()), lambda v: v.dropFields("pos")
            ).alias("violations"),
            F.col("gt_compliance").alias("overall_compliance_pass"),
        ).alias("ground_truth"),
    )


def write_calls(records: DataFrame, path: str) -> None:
    records.write.json(path)
