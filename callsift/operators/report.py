"""Draft incident reports for human review.

Reports follow the labelled truth; the auditor's flags only decide what counts
as detected. A report is one row per episode. Its lists stay short, because every
flag is paid from the budget of the call.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv

def _friendly(kind: Column) -> Column:
    return F.initcap(F.replace(kind, F.lit("_"), F.lit(" ")))


def report_findings(gt: DataFrame, flags: DataFrame) -> DataFrame:
    """Truth rows in order, then flags whose type is not in the truth."""
    flagged = flags.select("episode_id", "type").distinct().withColumn("hit", F.lit(True))
    true_types = gt.select("episode_id", "type").distinct()
    severity = F.upper(F.coalesce("severity", F.lit("low"))).alias("severity")
    detected = F.coalesce("hit", F.lit(False))
    real = gt.join(flagged, ["episode_id", "type"], "left").select(
        "episode_id",
        F.lit(0).alias("section"),
        F.col("pos").cast("long").alias("pos"),
        _friendly(F.col("type")).alias("finding"),
        severity,
        detected.alias("detected"),
        F.coalesce("description", F.lit(fv.TEXT_NO_DESCRIPTION)).alias("detail"),
        F.when(detected, "DETECTED").otherwise("MISSED").alias("status"),
    )
    invented = flags.join(true_types, ["episode_id", "type"], "left_anti").select(
        "episode_id",
        F.lit(1).alias("section"),
        F.col("pos").cast("long").alias("pos"),
        _friendly(F.col("type")).alias("finding"),
        severity,
        F.lit(False).alias("detected"),
        F.lit(fv.TEXT_FALSE_POSITIVE).alias("detail"),
        F.lit("FALSE POSITIVE").alias("status"),
    )
    return real.unionByName(invented)


def rationale() -> Column:
    parts = [
        F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {severity}-severity")))
        for n, severity in [
            (F.col("n_high"), "high"),
            (F.col("n_medium"), "medium"),
            (F.col("n_low"), "low"),
        ]
    ]
    return F.when(F.col("gt_compliance"), fv.TEXT_CLEAN).otherwise(
        F.format_string(fv.TEXT_RATIONALE, F.col("n_gt"), F.concat_ws(", ", *parts))
    )


def recommended_action() -> Column:
    return (
        F.when(~F.col("gt_compliance") & (F.col("n_high") > 0), fv.ROUTE_ESCALATE)
        .when(~F.col("gt_compliance"), fv.ROUTE_REVIEW)
        .otherwise(fv.ROUTE_ARCHIVE)
    )


def review_minutes() -> Column:
    return F.when(F.col("gt_compliance"), F.lit(0).cast("long")).otherwise(
        F.lit(fv.REVIEW_BASE_MINUTES)
        + F.lit(fv.REVIEW_MINUTES_PER_VIOLATION) * F.col("n_gt")
    )


def efficiency_pct() -> Column:
    share = F.col("budget_remaining").cast("double") / F.col("total_budget").cast("double")
    return F.when(
        F.col("total_budget") > 0, F.rint(share * F.lit(100.0)).cast("long")
    ).otherwise(F.lit(0).cast("long"))


def report_routing(graded: DataFrame) -> DataFrame:
    """Verdict, route, minutes and rationale per episode."""
    return graded.select(*_routing())


def _routing() -> list[Column]:
    return [
        F.col("episode_id"),
        F.when(F.col("gt_compliance"), "PASS").otherwise("FAIL").alias("verdict"),
        (F.col("verdict") == F.col("gt_compliance")).alias("agent_verdict_correct"),
        rationale().alias("verdict_rationale"),
        recommended_action().alias("recommended_action"),
        efficiency_pct().alias("triage_efficiency_pct"),
        review_minutes().alias("estimated_human_review_minutes"),
    ]


def report_recommendations(graded: DataFrame, findings: DataFrame) -> DataFrame:
    """Ordered advice per episode: missed types, verdict, precision, or praise."""
    return graded.join(_lists(findings), "episode_id", "left").select(
        "episode_id", _advice(F.col("missed")).alias("recommendations")
    )


def draft_reports(graded: DataFrame, findings: DataFrame) -> DataFrame:
    """The whole report per episode."""
    return graded.join(_lists(findings), "episode_id", "left").select(
        *_routing(),
        F.coalesce("findings", F.array()).alias("findings"),
        _advice(F.col("missed")).alias("recommendations"),
    )


def _lists(findings: DataFrame) -> DataFrame:
    entry = F.struct(
        "section", "pos", "finding", "severity", "detected", "detail", "status"
    )
    listed = findings.groupBy("episode_id").agg(
        F.array_sort(F.collect_list(entry)).alias("findings")
    )
    missed = F.transform(
        F.filter("findings", lambda f: f["status"] == "MISSED"),
        lambda f: F.format_string(fv.REC_MISSED, f["finding"]),
    )
    return listed.withColumn("missed", missed)


def _advice(missed: Column) -> Column:
    verdict = F.when(
        ~F.col("verdict") & F.col("gt_compliance"), fv.REC_TOO_STRICT
    ).when(F.col("verdict") & ~F.col("gt_compliance"), fv.REC_TOO_LAX)
    precision = F.when(F.col("absent_flags") > 0, fv.REC_PRECISION)
    praise = F.when(
        (F.col("missed_rows") == 0)
        & (F.col("absent_flags") == 0)
        & (F.col("verdict") == F.col("gt_compliance")),
        fv.REC_NONE,
    )
    own = F.filter(F.array(verdict, precision, praise), lambda r: r.isNotNull())
    return F.concat(F.coalesce(missed, F.array().cast("array<string>")), own)


def review_queue(routing: DataFrame) -> DataFrame:
    """Calls and minutes waiting per route."""
    return routing.groupBy("recommended_action").agg(
        F.count("*").alias("calls"),
        F.sum("estimated_human_review_minutes").alias("review_minutes"),
    )


def type_confusion(findings: DataFrame, by: list[str]) -> DataFrame:
    """Support, detections and false positives per violation type."""
    status = F.col("status")
    return findings.groupBy(*by, "finding").agg(
        F.count_if(status != "FALSE POSITIVE").alias("support"),
        F.count_if(status == "DETECTED").alias("detected"),
        F.count_if(status == "FALSE POSITIVE").alias("false_positives"),
    )
