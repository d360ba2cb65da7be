"""Run result files: one JSON document per (model, run), nested results."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.operators.dashboard import run_summary
from callsift.operators.scan import join_checked

_RESULT = """
    task_id string, difficulty string, score double, time_seconds double,
    breakdown struct<compliance_correct double, violation_f1_weighted double,
        efficiency_bonus double, severity_calibration_bonus double,
        false_positive_penalty double, auto_fail_applied boolean>,
    details struct<true_positives bigint, false_positives bigint,
        false_negatives bigint, severity_matches bigint, ground_truth_count bigint,
        agent_flagged_count bigint, budget_remaining bigint, total_budget bigint,
        missed_high_severity boolean>
"""
RUN_SCHEMA = f"""
    model string, benchmark string, timestamp string, part int,
    results array<struct<{_RESULT}>>,
    summary struct<easy_avg double, medium_avg double, hard_avg double,
                   overall_avg double, total_time double>
"""


def _from_path(path: Column, group: int) -> Column:
    """Name or number of a run from ``<name>_run<n>.json`` or its folders."""
    by_file = F.regexp_extract(path, r"([^/]+)_run(\d+)\.json$", group)
    by_folder = F.regexp_extract(path, r"display=([^/]+)/run=(\d+)/", group)
    return F.when(by_file != "", by_file).otherwise(by_folder)


def read_run_files(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row per run document, with the name and number its path gives."""
    raw = spark.read.schema(RUN_SCHEMA).json(path, multiLine=multiline)
    place = F.url_decode(F.col("_metadata.file_path"))
    return raw.withColumns(
        {"display": _from_path(place, 1), "run": _from_path(place, 2).cast("int")}
    )


def results_of(run_files: DataFrame) -> DataFrame:
    """One row per graded task."""
    return run_files.select(
        "display", "run", "model", F.explode("results").alias("result")
    ).select("display", "run", "model", "result.*")


def nest_runs(
    results: DataFrame, benchmark: str, timestamp: Column, part_results: int
) -> DataFrame:
    """Graded tasks as run documents with their summary.

    A run is dealt by a hash of its tasks to documents of about ``part_results``
    tasks, so that no row holds an unbounded list. ``part`` numbers them from 0.
    """
    sizes = results.groupBy("model", "run").agg(
        F.ceil(F.count("*") / F.lit(part_results)).alias("parts")
    )
    summaries = run_summary(results)
    runs = summaries.count()
    part = F.pmod(F.xxhash64("task_id"), F.col("parts")).cast("int").alias("part")
    entry = F.struct(
        "task_id", "difficulty", "score", "time_seconds", "breakdown", "details"
    )
    spread = join_checked(results, sizes, ["model", "run"], runs).select(
        "model", "run", part, entry.alias("result")
    )
    listed = spread.groupBy("model", "run", "part").agg(
        F.array_sort(F.collect_list("result")).alias("results")
    )
    summary = summaries.select(
        "model",
        "run",
        F.struct(
            "easy_avg", "medium_avg", "hard_avg", "overall_avg", "total_time"
        ).alias("summary"),
    )
    return join_checked(listed, summary, ["model", "run"], runs).select(
        "model",
        F.lit(benchmark).alias("benchmark"),
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        "part",
        "results",
        "summary",
        F.col("model").alias("display"),
        "run",
    )


def write_run_files(runs: DataFrame, path: str) -> None:
    """JSON lines below ``display=<name>/run=<n>/``."""
    runs.write.partitionBy("display", "run").json(path)
