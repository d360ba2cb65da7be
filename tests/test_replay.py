import random
import time

import pytest
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.operators import replay as rp
from callsift.operators.scan import ordered_groups
from callsift.plans import inputs
from callsift.sources import runlog
from callsift.streaming import meter, sinks

ACTION = (
    "episode_id long, seq long, action_type string, turn_index int, start_turn int, "
    "end_turn int, violation_type string, violation_severity string, "
    "compliance_pass boolean, policy_hypothesis string, n_turns int"
)


def _random_log(rng, episodes, longest):
    names = [*fv.ACTION_COST, "noop"]
    rows = []
    for e in range(episodes):
        n = rng.randint(1, 30)
        for seq in range(rng.randint(0, longest)):
            name = rng.choice(names)
            if name == "submit_report" and rng.random() < 0.8:
                name = "read_transcript_chunk"
            start = rng.choice([None, -1, *range(n + 1)])
            rows.append(
                (
                    e,
                    seq * 3,
                    name,
                    rng.choice([None, -1, *range(n + 2)]),
                    start,
                    None if rng.random() < 0.1 else (start or 0) + rng.randint(-1, 7),
                    rng.choice([None, "", "odd", *fv.VIOLATION_TYPES]),
                    rng.choice([None, "odd", *fv.SEVERITIES]),
                    rng.choice([None, True, False]),
                    None,
                    n,
                )
            )
    return rows


def _play(rows):
    """One episode, action by action: (step, action, remaining, done, verdict)."""
    n = rows[0][10]
    left, out = 50 + 3 * n, []
    rows = [*rows, (*rows[0][:2], "submit_report", *[None] * 5, False, None, n)]
    for _, _, name, turn, start, end, kind, sev, ok, _, _ in rows:
        if name == "read_transcript_chunk":
            bad = start is None or end is None or start < 0 or end >= n or start > end
            bad = bad or end - start >= 5
            cost = 0 if bad else 3 * (end - start + 1)
        else:
            cost = {**fv.ACTION_COST}.get(name, 5)
        step = len(out) + 1
        if name != "submit_report" and cost > left:
            out.append((step, fv.AUTO_SUBMIT_NAME, left, True, False))
            return out
        left -= cost
        done = name == "submit_report"
        verdict = (ok is None or ok) if done else None
        out.append((step, name, left, done, verdict))
        if done:
            return out
    return out


@pytest.mark.parametrize("target_rows", [None, 20])
def test_replay_matches_a_sequential_loop(spark, target_rows):
    rows = _random_log(random.Random(5), 60, 60)
    rng = random.Random(6)
    shuffled = rng.sample(rows, len(rows))
    actions = spark.createDataFrame(shuffled, ACTION)
    steps = rp.replay(actions, target_rows=target_rows).collect()
    got = {}
    for s in sorted(steps, key=lambda s: (s.episode_id, s.step)):
        got.setdefault(s.episode_id, []).append(
            (s.step, s.recorded_action, s.remaining, s.done, s.verdict)
        )
    expected = {}
    for row in rows:
        expected.setdefault(row[0], []).append(row)
    assert got == {e: _play(r) for e, r in expected.items()}


def test_calls_without_actions_get_a_forced_report(spark):
    actions = spark.createDataFrame([], ACTION).drop("n_turns")
    calls = spark.createDataFrame([(4, 10)], "episode_id long, n_turns int")
    row = rp.budget_exhausted(rp.replay(actions, calls)).first()
    assert (row.steps, row.spent, row.forced, row.exhausted) == (1, 0, True, False)
    assert rp.replay(actions, calls, force_submit=False).count() == 0


def test_one_group_with_most_rows_is_cut_and_summed_exactly(spark):
    # 1 of 3 rows in one group, and most of its rows at a few order keys.
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 7).otherwise(F.col("id") * 1000).alias("k"),
        "id",
        (F.col("id") % 11).alias("v"),
    )
    order = [F.col("k"), F.col("id")]
    plain = ordered_groups(df, ["g"], order, order).running(n=F.lit(1), s=F.col("v"))
    cut = ordered_groups(df, ["g"], order, order, target_rows=100)
    assert cut.chunks > 10
    chunk_sizes = cut.df.where("g = 0").groupBy("_chunk").count()
    assert chunk_sizes.agg(F.max("count")).first()[0] <= 100
    summed = cut.running(n=F.lit(1), s=F.col("v"))
    assert sorted(summed.rows().collect()) == sorted(plain.rows().collect())


def test_a_burst_at_one_instant_is_cut_by_the_next_key(spark):
    # All rows at one time, one of them without any.
    df = spark.range(1000).select(
        F.lit(1).alias("g"), F.when(F.col("id") < 999, F.lit(5)).alias("k"), "id"
    )
    order = [F.col("k").asc_nulls_last(), F.col("id")]
    cut = ordered_groups(df, ["g"], order, [F.col("k"), F.col("id")], target_rows=50)
    rows = cut.running(n=F.lit(1)).running(twice=F.col("n")).rows().collect()
    assert all(r.n == r.id + 1 and r.twice == r.n * (r.n + 1) // 2 for r in rows)
    assert len(rows) == 1000
    # Without the next key, and among equal rows, any order will do.
    for tied in (df, df.select("g", "k", F.lit(7).alias("id"))):
        cut = ordered_groups(tied, ["g"], [F.col("k").asc_nulls_last()], [F.col("k")], target_rows=50)
        assert cut.df.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 50
        rows = cut.running(n=F.lit(1)).rows().collect()
        assert sorted(r.n for r in rows) == list(range(1, 1001))
        assert [r.n for r in rows if r.k is None] == [1000]


@pytest.mark.parametrize("group", [1, None])
def test_a_burst_among_spread_rows_is_cut(spark, group):
    # A group just above the target; the order tells all rows apart by the last key.
    df = spark.range(3200).select(
        F.lit(group).cast("int").alias("g"),
        F.when(F.col("id") < 2200, F.lit(1_600_000))
        .otherwise(F.col("id") * F.col("id") * 1_000_003 % 31_536_000_000)
        .alias("k"),
        (F.col("id") * 7 % 3200).alias("id"),
    )
    order = [F.col("k"), F.col("id")]
    plain = ordered_groups(df, ["g"], order, order).running(n=F.lit(1), s=F.col("id"))
    cut = ordered_groups(df, ["g"], order, order, target_rows=2000)
    assert cut.df.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 2000
    summed = cut.running(n=F.lit(1), s=F.col("id"))
    assert sorted(summed.rows().collect(), key=str) == sorted(plain.rows().collect(), key=str)


def test_bursts_inside_bursts_are_cut_by_every_key(spark):
    keys = [f"k{i}" for i in range(8)]  # the first seven are alike in most rows
    df = spark.range(1200).select(
        F.lit(1).alias("g"),
        *[F.when(F.col("id") % 100 == i, F.col("id") - 600).otherwise(F.lit(3)).alias(k) for i, k in enumerate(keys[:-1])],
        F.col("id").alias(keys[-1]),
    )
    order = [F.col(k) for k in keys]
    cut = ordered_groups(df, ["g"], order, order, target_rows=200)
    assert cut.df.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 200
    rows = sorted(cut.running(n=F.lit(1)).rows().collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(1, 1201))
    assert [tuple(r[k] for k in keys) for r in rows] == sorted(tuple(r[k] for k in keys) for r in rows)


def test_a_cut_replay_reads_the_events_once(spark, small):
    steps = rp.replay(inputs.actions(spark, small), order=inputs.ORDER, target_rows=20)
    plan = steps._jdf.queryExecution().executedPlan().toString()
    # What is cut was kept, so the plan starts from there.
    assert "FileScan" not in plan
    assert plan.count("Window [") <= 2


def test_state_is_one_row_however_long_the_episode(spark):
    log = [(1, i, "read_transcript_chunk", None, -1, 2) for i in range(12_000)]
    log.append((1, 12_000, "get_call_metadata", None, None, None))
    rows = [(e, s, a, t, lo, hi, None, None, None, None, 40) for e, s, a, t, lo, hi in log]
    steps = rp.replay(spark.createDataFrame(rows, ACTION))
    grades = rp.endings_of(rp.audit_rows(steps)).withColumns(
        {"total": F.lit(0.5), "final_score": F.lit(0.5)}
    )
    rewarded = rp.rewarded_steps(steps, grades)
    state = rp.episode_state(rewarded).collect()
    assert [(r.step_count, r.done, len(r.actions)) for r in state] == [(12_002, True, 12_002)]
    assert state[0].cumulative_reward == pytest.approx(-0.02 * 12_000 + 0.05 + 0.5)
    lines = runlog.emit_run_log(rewarded, "e", "m").orderBy("line_no").collect()
    assert len(lines) == 12_004
    assert lines[-1].line.startswith("[END] success=true steps=12002 rewards=-0.02,")
    assert lines[-1].line.endswith(",0.05,0.50") and lines[-1].line.count(",") == 12_001


def test_low_budget_warnings_and_texts(spark):
    log = [
        (1, 0, "analyze_turn", 0), (1, 1, "analyze_turn", 0), (1, 2, "analyze_turn", 9),
        (1, 3, "analyze_turn", None), (1, 4, "get_call_metadata", None),
        (1, 5, "get_transcript_length", None), (1, 6, "flag_violation", None),
        (1, 7, "flag_violation", None), (1, 8, "get_transcript_length", None),
        (1, 9, "get_transcript_length", None),
    ]
    rows = [(e, s, a, t, None, None, None, None, None, None, 1) for e, s, a, t in log]
    steps = rp.replay(spark.createDataFrame(rows, ACTION))
    grades = rp.endings_of(rp.audit_rows(steps)).withColumns(
        {"total": F.lit(0.5), "final_score": F.lit(0.5)}
    )
    got = rp.rewarded_steps(steps, grades).orderBy("step").collect()
    assert [g.remaining for g in got] == [43, 33, 23, 13, 8, 7, 5, 3, 2, 1, 1]
    assert got[2].error == "turn_index 9 out of range [0, 0]."
    assert got[2].feedback == "Error: turn_index 9 out of range [0, 0]."
    assert got[7].feedback == "Error: Provide violation_type parameter." + fv.WARNING_FLAG_ONLY
    assert got[9].feedback.endswith(fv.WARNING_SUBMIT_NOW)
    assert got[10].done and got[10].feedback == fv.FEEDBACK_SUBMIT
    paid = 0.02 + 0.02 - 0.02 - 0.02 + 0.05 + 0.02 - 0.02 - 0.02 + 0.02 + 0.02
    assert got[10].cumulative_reward == pytest.approx(paid + 0.5)


def _events_in_files(spark, small, source, cuts):
    events = inputs.table(spark, small, "events")
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        part = events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi))
        part.coalesce(1).write.mode("append").parquet(source)
    return events.schema


def _file_stream(spark, schema, source):
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", "true").parquet(source)


def test_stream_meter_equals_batch_over_many_batches(spark, small, tmp_path):
    source = str(tmp_path / "events")
    schema = _events_in_files(spark, small, source, [0, 300, 350, 1000])
    stream = _file_stream(spark, schema, source)
    metered = meter.meter_stream(inputs.as_actions(stream), *inputs.ORDER)
    output, _ = sinks.drain_with_late(metered, "meter")
    batch = rp.replay(inputs.actions(spark, small), order=inputs.ORDER, force_submit=False)
    columns = ["episode_id", "step", "remaining", "exhausted", "done"]
    got = sinks.metered(spark, output, late=False).select(columns)
    assert sorted(got.collect()) == sorted(batch.select(columns).collect())
    # The session's own choice of a state store is left as it was.
    assert "RocksDB" not in (spark.conf.get(sinks._STORE, None) or "")


def test_stream_meter_merges_pieces_of_one_hot_episode(spark, tmp_path):
    """Most rows are one episode's; pieces and chunks are far smaller than it."""
    rng = random.Random(6)
    rows = [
        (0 if k % 10 else k, k // 3, k % 3, "get_transcript_length", *[None] * 7, 5_000)
        for k in range(3_000)
    ]
    rows += [(0, 10_000 + k, 0, "read_transcript_chunk", None, None, None, *[None] * 4, 5_000) for k in range(500)]
    rng.shuffle(rows)
    schema = ACTION.replace("seq long", "seq long, tie long")
    source = str(tmp_path / "hot")
    spark.createDataFrame(rows[:2_000], schema).coalesce(1).write.parquet(f"{source}/0")
    stream = _file_stream(spark, schema, source)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "64")
    chunk, meter.CHUNK_ROWS = meter.CHUNK_ROWS, 16
    try:
        output, _ = sinks.drain_with_late(meter.meter_stream(stream, "seq", "tie"), "hot")
    finally:
        spark.conf.set(limit, before)
        meter.CHUNK_ROWS = chunk
    actions = spark.createDataFrame(rows[:2_000], schema)
    batch = rp.replay(actions, order=("seq", "tie"), force_submit=False)
    columns = ["episode_id", "step", "remaining", "exhausted", "done"]
    got = sinks.metered(spark, output, late=False).select(columns).collect()
    assert sorted(got) == sorted(batch.select(columns).collect())
    assert sinks.metered(spark, output, late=True).count() == 0


class _Map:
    """What the meter needs of a map state."""

    def __init__(self):
        self.values = {}

    def updateValue(self, key, value):  # noqa: N802
        self.values[key] = value

    def getValue(self, key):  # noqa: N802
        return self.values[key]

    def removeKey(self, key):  # noqa: N802
        del self.values[key]


def test_runs_are_merged_in_order(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(meter, "CHUNK_ROWS", 7)
    rng = random.Random(9)
    for pieces in ([], [5], [30, 1, 44], [7, 7, 14, 200]):
        processor = meter.BudgetMeter(1, None)
        processor._runs = _Map()
        frames = [
            pd.DataFrame(
                {
                    "major": [rng.randrange(20) for _ in range(n)],
                    "minor": [rng.randrange(4) for _ in range(n)],
                    "cost": [1] * n,
                    "total_budget": [99] * n,
                    "action_type": ["x"] * n,
                }
            )
            for n in pieces
        ]
        keys = sorted((a, b) for f in frames for a, b in zip(f["major"], f["minor"], strict=True))
        out = list(processor._in_order(iter(frames)))
        assert [(a, b) for f in out for a, b in zip(f["major"], f["minor"], strict=True)] == keys
        assert not processor._runs.values
        assert all(len(f) <= 7 * len(pieces) or len(pieces) == 1 for f in out)


def _one_action(seq, name, episode=1):
    return (episode, seq, 0, name, *[None] * 7, 10)


def test_stream_meter_sets_late_rows_apart(spark, tmp_path):
    source = str(tmp_path / "late")
    schema = ACTION.replace("seq long", "seq long, tie long")
    batches = [
        [_one_action(5, "get_call_metadata")],
        [_one_action(4, "analyze_turn"), _one_action(6, "noop")],
    ]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{source}/{i}")
    metered = meter.meter_stream(_file_stream(spark, schema, source), "seq", "tie")
    output, _ = sinks.drain_with_late(metered, "late")
    late = sinks.metered(spark, output, late=True).collect()
    assert [(r.major, r.step, r.remaining) for r in late] == [(4, None, None)]
    got = sinks.metered(spark, output, late=False).orderBy("major").collect()
    assert [(r.major, r.step, r.remaining, r.late) for r in got] == [
        (5, 1, 75, False), (6, 2, 70, False),
    ]


def test_stream_meter_forgets_ended_and_closes_idle_episodes(spark, tmp_path):
    source = str(tmp_path / "idle")
    schema = ACTION.replace("seq long", "seq long, tie long")

    def feed(k, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(f"{source}/{k}")

    def run(output=None):
        stream = _file_stream(spark, schema, source)
        metered = meter.meter_stream(stream, "seq", "tie", ended_seconds=1, idle_seconds=1)
        return sinks.drain_with_late(metered, "idle", output)

    ended = [_one_action(1, "submit_report", e) for e in range(20, 40)]
    feed(0, _one_action(1, "get_call_metadata", 7), *ended)
    output, query = run()
    held = query.recentProgress[0]["stateOperators"][0]["numRowsTotal"]
    time.sleep(2.5)
    feed(1, _one_action(9, "noop", 8))
    _, query = run(output)
    time.sleep(2.5)
    feed(2, _one_action(9, "noop", 9))
    _, query = run(output)
    left = query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert left < held
    rows = sinks.metered(spark, output, late=False).where("episode_id = 7").orderBy("step").collect()
    assert [(r.major, r.action_type, r.step, r.remaining, r.done) for r in rows] == [
        (1, "get_call_metadata", 1, 75, False), (None, "submit_report", 2, 75, True),
    ]
