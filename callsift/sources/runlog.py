"""Run logs: text lines written from replayed steps, and parsed back."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.numeric import two_decimals
from callsift.operators.scan import ordered_groups
from callsift.sources.shared_dir import written
from callsift.sources.splits import before, read_pieces, scanned, summaries, with_states


#: Steps whose rewards are joined at once.
STEPS_TOGETHER = 4_096


def action_text() -> Column:
    """``name(param=value,…)`` with the parameters a step was given."""
    shown = {
        f: F.col(f).cast("string") for f in fv.ACTION_FIELDS if f != "compliance_pass"
    }
    verdict = F.col("compliance_pass")
    # A given verdict prints as True/False, a forced one in lower case.
    shown["compliance_pass"] = F.when(
        F.col("forced"), F.lower(verdict.cast("string"))
    ).otherwise(F.initcap(verdict.cast("string")))
    params = F.concat_ws(
        ",",
        *[F.concat(F.lit(f"{f}="), shown[f]) for f in fv.ACTION_FIELDS],
    )
    return F.concat(F.col("action_type"), F.lit("("), params, F.lit(")"))


def emit_run_log(steps: DataFrame, env: str, model: str) -> DataFrame:
    """(episode_id, line_no, line) from rewarded steps: start, steps, end.

    Step lines are written row by row; only the rewards, a few characters a step,
    are gathered for the end line, which names all of them, in two levels. ``steps`` are
    read twice, so a written table serves best.
    """
    written = steps.select(
        "episode_id",
        "step",
        "done",
        "error",
        "final_score",
        two_decimals("reward").alias("paid"),
        action_text().alias("action"),
        F.lower(F.col("done").cast("string")).alias("done_text"),
    )
    step_line = F.format_string(
        fv.LOG_STEP,
        F.col("step"),
        F.col("action"),
        F.col("paid"),
        F.col("done_text"),
        F.coalesce("error", F.lit("null")),
    )
    start = F.format_string(
        fv.LOG_START, F.col("episode_id").cast("string"), F.lit(env), F.lit(model)
    )

    def entry(number: Column, line: Column) -> Column:
        return F.struct(number.cast("long").alias("line_no"), line.alias("line"))

    opening = F.when(F.col("step") == 1, F.array(entry(F.lit(0), start)))
    lines = F.concat(
        F.coalesce(opening, F.array()), F.array(entry(F.col("step"), step_line))
    )
    # Rewards are joined to text in pieces, then the pieces: no buffer holds all steps.
    pieces = written.groupBy(
        "episode_id", F.floor(F.col("step") / STEPS_TOGETHER).alias("piece")
    ).agg(
        _joined("step", "paid").alias("paid"),
        F.max("step").alias("last_step"),
        F.max("final_score").alias("final_score"),
    )
    ends = pieces.groupBy("episode_id").agg(
        _joined("piece", "paid").alias("rewards"),
        F.max("last_step").alias("last_step"),
        F.max("final_score").alias("final_score"),
    )
    success = F.lower((F.col("final_score") >= fv.SUCCESS_SCORE).cast("string"))
    end = F.format_string(fv.LOG_END, success, "last_step", "rewards")
    return written.select("episode_id", F.inline(lines)).unionByName(
        # After all step lines.
        ends.select("episode_id", F.lit(2**62).alias("line_no"), end.alias("line"))
    )


def _joined(order: str, text: str) -> Column:
    """Texts of a group in order, with commas between them."""
    entries = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(entries, lambda e: e[text]), ",")


def read_log_lines(spark: SparkSession, path: str, one_log: bool = False) -> DataFrame:
    """Lines of log files with their episode and its task: source, chunk, pos, line, …

    Every file is a log; with ``one_log`` all files are one, in the order of their
    paths, and ``source`` is empty. ``chunk`` is the byte offset of the file split a line
    comes from and ``pos`` its order there.

    A split is reduced to its number of end lines and the tasks named before the first and
    after the last of them. Composed in file order, these few rows tell the episode and
    task at each split's edges; then lines are numbered where they stand. A task holds
    the lines of one episode of its split at most.
    """
    lines = read_pieces(spark, path)
    schema = "ends bigint, head string, tail string"
    splits = summaries(lines, _split_summary, schema, "log-splits")
    log = F.lit("").alias("log") if one_log else F.col("source").alias("log")
    begun = splits.select("*", log).select("*", before(F.col("ends"), ["log"]).alias("first"))
    named = begun.select("log", "first", "source", "chunk", F.col("head").alias("task")).unionByName(
        begun.where("ends > 0").select(
            "log", (F.col("first") + F.col("ends")).alias("first"), "source", "chunk", F.col("tail").alias("task")
        )
    )
    tasks = (
        named.where("task IS NOT NULL")
        .groupBy("log", F.col("first").alias("episode"))
        .agg(F.max_by("task", F.struct("source", "chunk")).alias("task"))
    )
    at_first = tasks.select("log", F.col("episode").alias("first"), F.col("task").alias("first_task"))
    at_last = tasks.select("log", F.col("episode").alias("last"), F.col("task").alias("last_task"))
    states = (
        begun.withColumn("last", F.col("first") + F.col("ends"))
        .join(at_first, ["log", "first"], "left")
        .join(at_last, ["log", "last"], "left")
        .select("source", "chunk", "first", "last", "first_task", "last_task")
    )
    known = with_states(lines, written(states, "log-states"))
    schema = "source string, chunk bigint, pos bigint, line string, episode bigint, task string"
    numbered = scanned(known, _numbered_lines, schema)
    return numbered.withColumn("source", F.lit("")) if one_log else numbered


_TASK = " task=([^ \\t\\n\\x0b\\f\\r]+) env="


def _starts_and_ends(lines: pa.Array) -> tuple[np.ndarray, list[str | None], np.ndarray]:
    """Places of start lines, the tasks they name, and places of end lines."""
    starts, ends = (
        np.flatnonzero(pc.starts_with(lines, x).to_numpy(zero_copy_only=False)) for x in ("[START] ", "[END] ")
    )
    found = (re.search(_TASK, x) for x in lines.take(pa.array(starts)).to_pylist())
    return starts, [x and x[1] for x in found], ends


def _split_summary(state: dict, parts: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
    ends, head, tail = 0, None, None
    for lines in parts:
        starts, tasks, stops = _starts_and_ends(lines)
        for at, task in zip(starts.tolist(), tasks, strict=True):
            if task is None:
                continue
            if not ends and (not len(stops) or at < stops[0]):
                head = task
        if len(stops):
            tail = None
        last = stops[-1] if len(stops) else -1
        after = [t for at, t in zip(starts.tolist(), tasks, strict=True) if t is not None and at > last]
        ends += len(stops)
        if ends and after:
            tail = after[-1]
    names = ["source", "chunk", "ends", "head", "tail"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    values = [state["source"], state["chunk"], ends, head, tail]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)


def _numbered_lines(state: dict, parts: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
    """Lines with their place in the split, episode and task; whole episodes at a time."""
    episode, pos = state["first"], 0
    held: list[pa.Array] = []

    def numbered(lines: pa.Array) -> pa.RecordBatch:
        nonlocal episode, pos
        starts, tasks, ends = _starts_and_ends(lines)
        n = len(lines)
        closed = np.zeros(n + 1, np.int64)
        closed[ends + 1] = 1
        number = np.cumsum(closed)[:n]
        task = [None] * (len(ends) + 1)
        for at, name in zip(starts.tolist(), tasks, strict=True):
            if name is not None:
                task[number[at]] = name
        for k in range(len(task)):
            if episode + k == state["first"]:
                task[k] = state["first_task"]
            elif episode + k == state["last"]:
                task[k] = state["last_task"]
        values = [
            pa.array([state["source"]] * n, pa.string()),
            pa.array(np.full(n, state["chunk"], np.int64)),
            pa.array(np.arange(pos, pos + n)),
            lines,
            pa.array(episode + number),
            pa.array(task, pa.string()).take(pa.array(number)),
        ]
        episode, pos = episode + len(ends), pos + n
        return pa.RecordBatch.from_arrays(values, ["source", "chunk", "pos", "line", "episode", "task"])

    for lines in parts:
        held.append(lines)
        edge = np.flatnonzero(pc.starts_with(lines, "[END] ").to_numpy(zero_copy_only=False))
        whole = int(edge[-1]) + 1 if len(edge) else 0
        # The tasks of a split's first and last episode are known: nothing is to wait for.
        if episode + len(edge) in (state["first"], state["last"]):
            whole = len(lines)
        if whole:
            held[-1] = lines.slice(0, whole)
            yield numbered(pa.concat_arrays(held))
            held = [lines.slice(whole)] if whole < len(lines) else []
    if held:
        yield numbered(pa.concat_arrays(held))


def parse_log_files(spark: SparkSession, path: str, one_log: bool = False) -> DataFrame:
    """Typed columns per line of log files, with its episode number and task.

    Rules are those of ``parse_run_log``; no line is shuffled or sorted.
    """
    lines = read_log_lines(spark, path, one_log)
    return _typed(lines.withColumn("kind", _kind()), "task")


def parse_run_log(lines: DataFrame, target_rows: int | None = None) -> DataFrame:
    """Typed columns per row of a table of lines, with its episode number and task.

    The order of a source's lines is that of (chunk, pos). The episode is the number of
    end lines before a line of the same source; the task is the one its start line
    names, the last of several, null if that line is missing. Of lines cut at the
    terminal width only fields that are surely whole count: those with the next
    field's name after them, and a line's last field.
    """
    is_end = (F.col("kind") == "END").cast("int")
    numbered = (
        ordered_groups(
            lines.withColumn("kind", _kind()),
            ["source"],
            [F.col("chunk"), F.col("pos")],
            [F.col("chunk"), F.col("pos")],
            target_rows,
        )
        .running(ends=is_end)
        .rows()
        .withColumn("episode", F.col("ends") - is_end)
    )
    starts = (
        numbered.where(F.col("kind") == "START")
        .groupBy("source", "episode")
        .agg(F.max_by(_field("task", "env"), F.struct("chunk", "pos")).alias("task"))
    )
    return _typed(numbered).join(starts, ["source", "episode"], "left")


def _kind() -> Column:
    return F.regexp_extract("line", r"^\[(START|STEP|END)\] ", 1)


def _typed(numbered: DataFrame, *more: str) -> DataFrame:
    """Fields of each line as typed columns."""
    error = _rest("error")
    # "null" cut short is still no error.
    real_error = F.when(~F.lit("null").startswith(error), error)
    return numbered.select(
        "source",
        "episode",
        "chunk",
        "pos",
        "kind",
        _field("step", "action").try_cast("int").alias("step"),
        _extract(r" action=(.*?) reward=").alias("action"),
        _field("reward", "done").try_cast("double").alias("reward"),
        _field("done", "error").try_cast("boolean").alias("done"),
        real_error.alias("error"),
        _field("success", "steps").try_cast("boolean").alias("success"),
        _field("steps", "score|rewards").try_cast("int").alias("steps"),
        _field("score", "rewards").try_cast("double").alias("score"),
        _rest("rewards").alias("rewards"),
        F.when(F.col("kind") == "", F.col("line")).alias("_corrupt"),
        *more,
    )


def _extract(pattern: str) -> Column:
    found = F.regexp_extract("line", pattern, 1)
    return F.when(found != "", found)


def _field(name: str, following: str) -> Column:
    """A field's value, if the name of a field that follows it is there too."""
    return _extract(rf" {name}=(\S+) (?:{following})=")


def _rest(name: str) -> Column:
    return _extract(rf" {name}=(.*)$")
