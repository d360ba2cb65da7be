"""Score dashboards over graded results.

``results``: model, run, task_id, difficulty, score (three decimals) and
time_seconds (one decimal). Sums run over whole thousandths and tenths, so a
total does not depend on the order in which tasks finish.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv

_TIERS = ["easy", "medium", "hard"]


def _milli() -> Column:
    return F.rint(F.col("score") * F.lit(1000.0)).cast("long")


def _tenths() -> Column:
    return F.rint(F.col("time_seconds") * F.lit(10.0)).cast("long")


def _mean(milli: Column, count: Column) -> Column:
    thousandths = F.lit(1000.0)
    mean = milli.cast("double") / thousandths / count.cast("double")
    return F.when(count > 0, mean)


def tier_dashboard(results: DataFrame) -> DataFrame:
    """Per model: one row per difficulty and one for all of them."""
    per_tier = results.groupBy("model", "difficulty").agg(
        F.count("*").alias("tasks"),
        F.sum(_milli()).alias("milli"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.sum(_tenths()).alias("tenths"),
    )
    return (
        per_tier.rollup("model", "difficulty")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("tasks").alias("tasks"),
            F.sum("milli").alias("milli"),
            F.min("min_score").alias("min_score"),
            F.max("max_score").alias("max_score"),
            F.sum("tenths").alias("tenths"),
        )
        .where(F.col("level") < 3)
        .select(
            "model",
            F.coalesce("difficulty", F.lit("overall")).alias("difficulty"),
            "tasks",
            _mean(F.col("milli"), F.col("tasks")).alias("avg_score"),
            "min_score",
            "max_score",
            (F.col("tenths").cast("double") / F.lit(10.0)).alias("total_time"),
        )
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Averages per run and tier; a tier without tasks counts as 0."""
    milli, tier = _milli(), F.col("difficulty")
    sums = {}
    for name in _TIERS:
        sums[name] = F.sum(F.when(tier == name, milli)).alias(f"{name}_milli")
        sums[name + "_n"] = F.count_if(tier == name).alias(f"{name}_n")
    grouped = results.groupBy("model", "run").agg(
        *sums.values(),
        F.sum(milli).alias("overall_milli"),
        F.count("*").alias("overall_n"),
        F.sum(_tenths()).alias("tenths"),
    )
    means = [
        F.coalesce(
            _mean(F.col(f"{name}_milli"), F.col(f"{name}_n")), F.lit(0.0)
        ).alias(f"{name}_avg")
        for name in [*_TIERS, "overall"]
    ]
    total = (F.col("tenths").cast("double") / F.lit(10.0)).alias("total_time")
    return grouped.select("model", "run", *means, total)


def episode_success(episodes: DataFrame) -> DataFrame:
    """Per episode: whether it reaches the passing score, and steps taken."""
    passed = F.col("final_score") >= fv.SUCCESS_SCORE
    return episodes.select(
        "episode_id", "difficulty", "final_score", passed.alias("success"), "steps"
    )


def success_rate(episodes: DataFrame) -> DataFrame:
    """Share of episodes that reach the passing score, and steps taken."""
    passed = F.col("final_score") >= fv.SUCCESS_SCORE
    return episodes.groupBy("difficulty").agg(
        F.count("*").alias("episodes"),
        F.count_if(passed).alias("successes"),
        F.sum("steps").alias("steps"),
    )


def model_run_summary(
    models: DataFrame, runs_per_model: int, summaries: DataFrame
) -> DataFrame:
    """Every expected (model, run), with a failure row where no result exists."""
    runs = F.explode(F.sequence(F.lit(1), F.lit(runs_per_model))).alias("run")
    expected = models.select("model", runs)
    found = summaries.withColumn("success", F.lit(True))
    missing = F.when(F.col("success").isNull(), "output file not generated")
    return expected.join(found, ["model", "run"], "left").withColumns(
        {"error": missing, "success": F.coalesce("success", F.lit(False))}
    )
