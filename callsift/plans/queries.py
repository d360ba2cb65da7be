"""Registered queries: every operator over inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions import text as tx
from callsift.operators import actions as act
from callsift.operators import dashboard, grading, report, screens, transcript
from callsift.operators import replay as rp
from callsift.plans import inputs
from callsift.sources import corpus, dims, results, runlog
from callsift.sources.shared_dir import new_folder, written
from callsift.streaming import meter, redact_stream, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- Shared starting points ------------------------------------------------------


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    return rp.replay(inputs.actions(spark, folder), order=inputs.ORDER)


def _truth(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.truth(inputs.episode_ids(spark, folder))


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return rp.audit_rows(_steps(spark, folder))


def _grade(audit: DataFrame, gt: DataFrame) -> DataFrame:
    counts = grading.audit_counts(audit, gt)
    return grading.score(
        counts.withColumn("gt_compliance", inputs.truth_compliance())
    )


def _graded(spark: SparkSession, folder: str) -> DataFrame:
    return _grade(_audit(spark, folder), _truth(spark, folder))


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    audit = written(_audit(spark, folder), "audit")
    return report.report_findings(_truth(spark, folder), rp.flags_of(audit))


def _graded_and_findings(
    spark: SparkSession, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Both from one replay, whose flags and endings are written once."""
    audit, gt = written(_audit(spark, folder), "audit"), _truth(spark, folder)
    return _grade(audit, gt), report.report_findings(gt, rp.flags_of(audit))


def _rewarded(spark: SparkSession, folder: str) -> DataFrame:
    """Steps and grades are written once, so that one replay serves every reader."""
    steps = written(_steps(spark, folder), "steps")
    grades = written(_grade(rp.audit_rows(steps), _truth(spark, folder)), "grades")
    return rp.rewarded_steps(steps, grades)


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.calls(inputs.turns(spark, folder))


def _difficulty() -> Column:
    return inputs.pick(inputs.DIFFICULTIES, F.floor(F.col("episode_id") / 5) % 3)


# --- Sources and fixed tables -----------------------------------------------------


@query
def turns_base(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.turns(spark, folder)


@query
def gt_base(spark: SparkSession, folder: str) -> DataFrame:
    return _truth(spark, folder)


@query
def src_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls written as nested JSON records, read back and flattened."""
    return corpus.turns_of(_stored_calls(spark, folder))


@query
def src_truth(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled violations of the stored calls."""
    return corpus.truth_of(_stored_calls(spark, folder))


@query
def src_call_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of the stored calls, with the number of mood shifts."""
    shifts = F.coalesce(F.size("sentiment_shifts"), F.lit(0)).alias("n_shifts")
    found = corpus.calls_of(_stored_calls(spark, folder))
    return found.select("*", shifts).drop("sentiment_shifts")


def _stored_calls(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.turns(spark, folder)
    calls = inputs.calls(turns)
    gt = inputs.truth(calls.select(F.col("call_id").alias("episode_id")))
    path = new_folder(spark, "calls")
    corpus.write_calls(corpus.nest_calls(turns, calls, gt, inputs.PART_ROWS), path)
    return corpus.read_calls(spark, path, multiline=False)


@query
def src_run_results(spark: SparkSession, folder: str) -> DataFrame:
    """Run documents written as JSON, read back to one row per graded task."""
    path = _written_runs(spark, folder)
    found = results.results_of(results.read_run_files(spark, path, multiline=False))
    return found.select(
        "display",
        "run",
        "task_id",
        "difficulty",
        "score",
        "time_seconds",
        F.col("breakdown.violation_f1_weighted").alias("violation_f1_weighted"),
        F.col("breakdown.auto_fail_applied").alias("auto_fail_applied"),
        F.col("details.true_positives").alias("true_positives"),
        F.col("details.budget_remaining").alias("budget_remaining"),
    )


@query
def sink_run_results(spark: SparkSession, folder: str) -> DataFrame:
    """The summary block each written run document carries."""
    path = _written_runs(spark, folder)
    return (
        results.read_run_files(spark, path, multiline=False)
        .select("model", "benchmark", "run", F.size("results").alias("n"), "summary.*")
        .groupBy(
            "model",
            "benchmark",
            "run",
            "easy_avg",
            "medium_avg",
            "hard_avg",
            "overall_avg",
            "total_time",
        )
        .agg(F.sum("n").alias("tasks"))
    )


def _written_runs(spark: SparkSession, folder: str) -> str:
    graded = written(_graded(spark, folder), "graded")
    nested = grading.grade_breakdown(graded)
    rows = inputs.as_runs(graded.select("episode_id", "final_score"))
    task = F.concat(F.lit("call_"), F.col("episode_id").cast("string"))
    full = rows.join(
        nested.select(task.alias("task_id"), "breakdown", "details"), "task_id"
    )
    path = new_folder(spark, "runs")
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    nested_runs = results.nest_runs(full, inputs.ENV, stamp, inputs.PART_ROWS)
    results.write_run_files(nested_runs, path)
    return path


@query
def dim_rubric(spark: SparkSession, folder: str) -> DataFrame:
    """The rubric with how often each policy was flagged."""
    flagged = (
        act.validate_flags(inputs.actions(spark, folder))
        .where(F.col("error").isNull())
        .groupBy(F.col("violation_type").alias("policy"))
        .agg(F.count("*").alias("flags"))
    )
    return (
        dims.rubric_dim(spark)
        .join(flagged, "policy", "left")
        .select(
            "policy",
            "category",
            "definition",
            "severity_guide",
            F.array_join("indicators", "|").alias("indicators"),
            F.array_join("common_false_positives", "|").alias("common_false_positives"),
            F.coalesce("flags", F.lit(0)).alias("flags"),
        )
    )


@query
def dim_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Price list joined to the actions, unknown actions at the default price."""
    price = F.broadcast(dims.cost_dim(spark))
    return (
        inputs.actions(spark, folder)
        .join(price, "action_type", "left")
        .groupBy(
            "action_type",
            F.coalesce("base_cost", F.lit(fv.UNKNOWN_ACTION_COST)).alias("base_cost"),
        )
        .agg(F.count("*").alias("actions"))
    )


@query
def dim_severity(spark: SparkSession, folder: str) -> DataFrame:
    """Weight and penalty per severity with how often it was claimed."""
    claimed = (
        act.validate_flags(inputs.actions(spark, folder))
        .where(F.col("error").isNull())
        .groupBy("severity")
        .agg(F.count("*").alias("flags"))
    )
    return (
        dims.severity_dim(spark)
        .join(claimed, "severity", "left")
        .fillna(0, ["flags"])
    )


@query
def dim_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Tasks and their difficulty with the completions that answer them."""
    answered = inputs.completions(spark, folder).groupBy(
        F.format_string("call_%03d", F.col("task") + 1).alias("task_id")
    )
    counts = answered.agg(F.count("*").alias("completions"))
    return dims.task_dim(spark).join(counts, "task_id", "left").fillna(0, ["completions"])


# --- Calls ----------------------------------------------------------------------


@query
def call_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.call_metadata(_calls(spark, folder))


@query
def list_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.list_tasks(_calls(spark, folder))


@query
def sentiment_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.sentiment_timeline(_calls(spark, folder)).select(
        "call_id",
        "shift_pos",
        F.col("shift")["turn_index"].alias("turn_index"),
        F.col("shift")["to"].alias("to_mood"),
    )


@query
def transcript_length(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.transcript_length(_calls(spark, folder))


@query
def episode_budget(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.episode_budget(_calls(spark, folder))


@query
def episode_start(spark: SparkSession, folder: str) -> DataFrame:
    return rp.reset_view(_calls(spark, folder))


@query
def validate_reads(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.turns(spark, folder)
    return transcript.validate_reads(
        inputs.read_requests(turns), transcript.call_lengths(turns)
    )


@query
def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.turns(spark, folder)
    return transcript.read_chunks(inputs.read_requests(turns), turns)


@query
def turn_context(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.turn_context(inputs.turns(spark, folder)).drop("text")


@query
def silence_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.silence_gaps(inputs.turns(spark, folder))


@query
def turn_position(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.turn_position(inputs.turns(spark, folder))


@query
def analyze_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = inputs.turns(spark, folder)
    return transcript.analyze_turns(inputs.analyze_requests(turns), turns).select(
        "request_id",
        "call_id",
        "asked_index",
        "error",
        "speaker",
        "text",
        "before_text",
        "after_text",
        "silence_gap_before_seconds",
        "speaker_turn_position",
        "policy",
        "compliance_rubric_error",
    )


@query
def rubric_lookup(spark: SparkSession, folder: str) -> DataFrame:
    requests = inputs.analyze_requests(inputs.turns(spark, folder))
    return transcript.rubric_lookup(requests).select(
        "request_id",
        "policy_hypothesis",
        "definition",
        "severity_guide",
        F.array_join("indicators", "|").alias("indicators"),
        "compliance_rubric_error",
    )


@query
def screen_hold_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return screens.screen_hold_gaps(inputs.turns(spark, folder))


@query
def screen_rubric(spark: SparkSession, folder: str) -> DataFrame:
    return screens.screen_rubric(
        inputs.turns(spark, folder), inputs.departments(spark, folder)
    )


# --- Redaction --------------------------------------------------------------------


@query
def redact_structured(spark: SparkSession, folder: str) -> DataFrame:
    """Structured redaction of whole documents and whole pages."""
    documents = inputs.table(spark, folder, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text"
    )
    pages = inputs.table(spark, folder, "pages").select(
        F.lit("pages").alias("origin"),
        F.col("page_id").alias("id"),
        F.col("html").alias("text"),
    )
    return documents.unionByName(pages).withColumn(
        "text", tx.redact_structured(F.col("text"))
    )


@query
def redact_names(spark: SparkSession, folder: str) -> DataFrame:
    """Structured and name redaction of every turn."""
    return transcript.redact_turns(inputs.turns(spark, folder)).select(
        "call_id", "pos", "text"
    )


@query
def extract_entities(spark: SparkSession, folder: str) -> DataFrame:
    return transcript.extract_entities(inputs.turns(spark, folder)).select(
        "call_id", "name", "token"
    )


@query
def pii_census(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents").select(
        F.lit("documents").alias("origin"), F.col("source").alias("part"), "text"
    )
    turns = inputs.turns(spark, folder).select(
        F.lit("turns").alias("origin"), F.col("speaker").alias("part"), "text"
    )
    return screens.pii_census(documents.unionByName(turns), ["origin", "part"])


# --- Replay -----------------------------------------------------------------------


@query
def action_costs(spark: SparkSession, folder: str) -> DataFrame:
    return act.price_actions(inputs.actions(spark, folder)).select(
        "event_id", "action_type", act.error_text().alias("error"), "cost"
    )


@query
def validate_flags(spark: SparkSession, folder: str) -> DataFrame:
    return act.validate_flags(inputs.actions(spark, folder)).select(
        "event_id", "violation_type", "severity", "error"
    )


@query
def replay_steps(spark: SparkSession, folder: str) -> DataFrame:
    return _rewarded(spark, folder).select(
        "episode_id",
        "step",
        "event_id",
        "recorded_action",
        "cost",
        "error",
        "remaining",
        "done",
        "reward",
        "cumulative_reward",
        "feedback",
    )


@query
def replay_checklist(spark: SparkSession, folder: str) -> DataFrame:
    return rp.checklist(_steps(spark, folder))


@query
def episode_state(spark: SparkSession, folder: str) -> DataFrame:
    def shown(flag: Column) -> Column:
        turn = F.coalesce(flag["turn_index"].cast("string"), F.lit("-"))
        return F.concat_ws(":", flag["type"], turn, flag["severity"])

    return rp.episode_state(_rewarded(spark, folder)).select(
        "episode_id",
        _difficulty().alias("difficulty"),
        "step_count",
        "total_budget",
        "budget_remaining",
        "done",
        "cumulative_reward",
        F.array_join("actions", ",").alias("actions_taken"),
        F.array_join(F.transform("flags", shown), ",").alias("flagged_violations"),
    )


@query
def budget_exhausted(spark: SparkSession, folder: str) -> DataFrame:
    return rp.budget_exhausted(_steps(spark, folder))


@query
def forced_submission(spark: SparkSession, folder: str) -> DataFrame:
    """Logs of which every third lacks its reports and is ended by a forced one."""
    unreported = (F.col("episode_id") % 3 == 0) & (F.col("action_type") == "submit_report")
    log = inputs.actions(spark, folder).where(~unreported)
    return rp.budget_exhausted(rp.replay(log, order=inputs.ORDER))


# --- Grading ----------------------------------------------------------------------


@query
def grade_match(spark: SparkSession, folder: str) -> DataFrame:
    flags = rp.flags_of(_audit(spark, folder))
    return grading.grade_match(_truth(spark, folder), flags).select(
        "episode_id", "type", "n_gt", "n_flag", "tp", "fp", "fn"
    )


def _grade_columns(*columns: str) -> Query:
    return lambda spark, folder: _graded(spark, folder).select("episode_id", *columns)


REGISTRY["grade_weights"] = _grade_columns("tp_weight", "gt_weight")
REGISTRY["grade_f1"] = _grade_columns("f1", "violation_score")
REGISTRY["grade_calibration"] = _grade_columns("severity_matches", "calibration_bonus")
REGISTRY["grade_fp_penalty"] = _grade_columns("absent_flags", "penalty_cents")
REGISTRY["grade_autofail"] = _grade_columns("missed_high", "raw_total", "total")
REGISTRY["grade_episodes"] = _grade_columns(
    "verdict_score",
    "violation_score",
    "efficiency_score",
    "calibration_bonus",
    "fp_penalty",
    "missed_high",
    "total",
    "final_score",
)


@query
def grade_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return grading.grade_breakdown(_graded(spark, folder)).select(
        "episode_id", "final_score", "breakdown.*", "details.*"
    )


@query
def score_completions(spark: SparkSession, folder: str) -> DataFrame:
    """Tool calls parsed from completion texts, replayed and graded."""
    texts = inputs.completions(spark, folder)
    # Labels belong to the task a completion answers.
    label = F.col("episode_id") % 12
    episodes = texts.select(F.col("completion_id").alias("episode_id"), "n_turns")
    parsed = act.parse_completions(texts.select("completion_id", "text", "n_turns"))
    log = parsed.withColumnsRenamed({"completion_id": "episode_id", "nth": "seq"})
    # The calls of a completion come from one row, so no episode can be large.
    steps = rp.replay(log, calls=episodes, short_episodes=True)
    gt = inputs.truth(episodes.select("episode_id"), label)
    counts = grading.audit_counts(rp.audit_rows(steps), gt)
    graded = grading.score(counts.withColumn("gt_compliance", label % 4 == 0))
    return graded.select(
        F.col("episode_id").alias("completion_id"), "steps", "tp", "fp", "final_score"
    )


@query
def parse_completions(spark: SparkSession, folder: str) -> DataFrame:
    texts = inputs.completions(spark, folder).select("completion_id", "text")
    return act.parse_completions(texts)


@query
def coerce_tool_args(spark: SparkSession, folder: str) -> DataFrame:
    return act.coerce_tool_args(inputs.tool_call_json(spark, folder))


# --- Reports ----------------------------------------------------------------------


@query
def report_findings(spark: SparkSession, folder: str) -> DataFrame:
    return _findings(spark, folder)


@query
def report_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    advice = report.report_recommendations(*_graded_and_findings(spark, folder))
    return advice.withColumn("recommendations", F.array_join("recommendations", "|"))


@query
def report_routing(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_routing(_graded(spark, folder)).drop("verdict_rationale")


@query
def report_rationale(spark: SparkSession, folder: str) -> DataFrame:
    return report.report_routing(_graded(spark, folder)).select(
        "episode_id", "verdict_rationale"
    )


@query
def draft_reports(spark: SparkSession, folder: str) -> DataFrame:
    def shown(f: Column) -> Column:
        return F.concat_ws("/", f["finding"], f["severity"], f["status"], f["detail"])

    reports = report.draft_reports(*_graded_and_findings(spark, folder))
    return reports.withColumns(
        {
            "findings": F.array_join(F.transform("findings", shown), "|"),
            "recommendations": F.array_join("recommendations", "|"),
        }
    )


@query
def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    return report.review_queue(report.report_routing(_graded(spark, folder)))


@query
def type_confusion(spark: SparkSession, folder: str) -> DataFrame:
    findings = _findings(spark, folder).withColumn("difficulty", _difficulty())
    return report.type_confusion(findings, ["difficulty"])


@query
def document_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of documents against findings by PII kind and length."""
    docs = inputs.table(spark, folder, "documents")
    labels = inputs.table(spark, folder, "labels")
    both = labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("episode_id"),
        "lang",
        "source",
        (F.col("toxic") == 1).alias("toxic"),
        (F.col("quality") == 0).alias("low_quality"),
        (tx.redact_structured(F.col("text")) != F.col("text")).alias("saw_toxic"),
        (F.col("n_chars") < 500).alias("saw_low_quality"),
    )

    def rows(toxic: str, low: str) -> DataFrame:
        hits = F.expr(
            f"""filter(array(
                IF({toxic}, struct('toxic' AS type, 'high' AS severity), NULL),
                IF({low}, struct('low_quality' AS type, 'medium' AS severity), NULL)
            ), hit -> hit IS NOT NULL)"""
        )
        listed = both.select("episode_id", F.posexplode(hits).alias("pos", "hit"))
        return listed.select(
            "episode_id", "pos", "hit.*", F.lit(None).cast("string").alias("description")
        )

    gt, flags = rows("toxic", "low_quality"), rows("saw_toxic", "saw_low_quality")
    place = both.select("episode_id", "lang", "source")
    findings = report.report_findings(gt, flags).join(place, "episode_id")
    return report.type_confusion(findings, ["lang", "source"])


# --- Dashboards -------------------------------------------------------------------


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.as_runs(_graded(spark, folder))


@query
def tier_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.tier_dashboard(_runs(spark, folder))


@query
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.run_summary(_runs(spark, folder))


@query
def success_rate(spark: SparkSession, folder: str) -> DataFrame:
    graded = _graded(spark, folder).withColumn("difficulty", _difficulty())
    return dashboard.success_rate(graded)


@query
def episode_success(spark: SparkSession, folder: str) -> DataFrame:
    graded = _graded(spark, folder).withColumn("difficulty", _difficulty())
    return dashboard.episode_success(graded)


@query
def model_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Expected models come from their own list; the last one has no result."""
    name = F.concat(F.lit("model_"), F.col("id").cast("string")).alias("model")
    models = spark.range(inputs.MODELS + 1).select(name)
    summaries = dashboard.run_summary(_runs(spark, folder))
    return dashboard.model_run_summary(models, inputs.RUNS + 1, summaries)


# --- Logs -------------------------------------------------------------------------


@query
def emit_run_log(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.emit_run_log(_rewarded(spark, folder), inputs.ENV, inputs.MODEL)


@query
def parse_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Emitted lines as one log of many files, read and parsed back where they stand."""
    path = new_folder(spark, "log")
    lines = emit_run_log(spark, folder)
    ordered = lines.orderBy("episode_id", "line_no").select("line")
    ordered.write.text(path)
    parsed = runlog.parse_log_files(spark, path, one_log=True)
    return parsed.drop("source", "episode", "chunk", "pos")


@query
def parse_cut_log(spark: SparkSession, folder: str) -> DataFrame:
    """Emitted lines, some starts lost and some lines cut, parsed back.

    Sixteen episodes in a row share one log.
    """
    lines = written(emit_run_log(spark, folder), "log")
    lost = (F.col("episode_id") % 10 == 0) & (F.col("line_no") == 0)
    cut = (F.col("episode_id") % 3 == 0) & F.col("line").startswith("[STEP]")
    log = lines.where(~lost).select(
        F.floor(F.col("episode_id") / 16).cast("string").alias("source"),
        F.col("episode_id").alias("chunk"),
        F.col("line_no").alias("pos"),
        F.when(cut, F.substring("line", 1, 110)).otherwise(F.col("line")).alias("line"),
    )
    return runlog.parse_run_log(log).drop("pos")


# --- Streaming --------------------------------------------------------------------


@query
def stream_redact(spark: SparkSession, folder: str) -> DataFrame:
    schema = inputs.table(spark, folder, "documents").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/documents*.parquet")
    redacted = redact_stream.redact_stream(stream.select("doc_id", "text"), "text")
    return spark.read.parquet(sinks.drain_to_parquet(redacted, "redacted"))


@query
def stream_budget_meter(spark: SparkSession, folder: str) -> DataFrame:
    schema = inputs.table(spark, folder, "events").schema
    # A micro-batch takes whole files of about this many bytes.
    stream = (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", 8 << 30)
        .parquet(f"{folder}/events*.parquet")
    )
    metered = meter.meter_stream(inputs.as_actions(stream), *inputs.ORDER)
    output, _ = sinks.drain_with_late(metered, "meter")
    counted = sinks.metered(spark, output, late=False)
    return counted.unionByName(sinks.metered(spark, output, late=True))
