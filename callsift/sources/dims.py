"""Small fixed tables: rubric, action costs, severity weights, tasks."""

from pyspark.sql import DataFrame, SparkSession

from callsift import fixed_values as fv


def rubric_dim(spark: SparkSession) -> DataFrame:
    rows = [
        (policy, fv.VIOLATION_CATEGORY[policy], definition, found, guide, excused)
        for policy, definition, found, guide, excused in fv.RUBRIC
    ]
    return spark.createDataFrame(
        rows,
        "policy string, category string, definition string, indicators array<string>, "
        "severity_guide string, common_false_positives array<string>",
    )


def cost_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(fv.ACTION_COST.items()), "action_type string, base_cost int"
    )


def severity_dim(spark: SparkSession) -> DataFrame:
    rows = [
        (s, fv.SEVERITY_WEIGHT[s], fv.FALSE_POSITIVE_CENTS[s]) for s in fv.SEVERITIES
    ]
    return spark.createDataFrame(rows, "severity string, weight int, penalty_cents int")


def task_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.TASKS, "task_id string, difficulty string")
