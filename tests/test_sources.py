import contextlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from callsift.operators import grading
from callsift.operators import replay as rp
from callsift.plans import inputs
from callsift.sources import corpus, json_array, results, runlog, shared_dir


def test_written_tables_go_to_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir.new_folder(spark, "x").startswith(folder + "/x-")
    kept = shared_dir.written(spark.range(3), "numbers")
    assert folder in kept.inputFiles()[0] and kept.count() == 3


def _call(name, turns, **more):
    return {
        "id": name,
        "difficulty": "easy",
        "metadata": {"department": "Cards", "call_reason": "r",
                     "call_duration_seconds": 9.5, "call_summary": "s"},
        "turns": [
            {"turn_index": i + 1, "speaker": "agent", "text": t,
             "timestamp_start": 1.0 * i, "timestamp_end": i + 0.5}
            for i, t in enumerate(turns)
        ],
        "ground_truth": {
            "violations": [{"type": "failed_escalation", "severity": "high"}],
            "overall_compliance_pass": False,
            "customer_sentiment_shifts": [{"turn_index": 1, "to": "angry"}],
        },
        **more,
    }


def test_last_duplicate_call_wins(spark, tmp_path):
    calls = [_call("a", ["old"]), _call("b", ["x", "y"]), _call("a", ["new", "newer"])]
    array = tmp_path / "array.json"
    array.write_text(json.dumps(calls, indent=1))
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(json.dumps(c) for c in calls))
    for path, multiline in [(array, True), (lines, False)]:
        read = corpus.read_calls(spark, str(path), multiline=multiline)
        turns = corpus.turns_of(read).orderBy("call_id", "pos").collect()
        assert [(t.call_id, t.pos, t.turn_index, t.text) for t in turns] == [
            ("a", 0, 1, "new"), ("a", 1, 2, "newer"), ("b", 0, 1, "x"), ("b", 1, 2, "y"),
        ]
        truth = corpus.truth_of(read).where("episode_id = 'a'").collect()
        assert [(t.pos, t.type, t.severity, t.description) for t in truth] == [
            (0, "failed_escalation", "high", None)
        ]
        flat = {r.call_id: r for r in corpus.calls_of(read).collect()}
        assert flat["a"].n_turns == 2 and flat["a"].gt_compliance is False
        assert flat["b"].sentiment_shifts == [{"turn_index": "1", "to": "angry"}]


def test_long_calls_are_stored_in_parts(spark, tmp_path, small):
    turns = inputs.turns(spark, small)
    calls = inputs.calls(turns)
    gt = inputs.truth(calls.select(F.col("call_id").alias("episode_id")))
    path = str(tmp_path / "calls")
    corpus.write_calls(corpus.nest_calls(turns, calls, gt, part_turns=4), path)
    read = corpus.read_calls(spark, path, multiline=False)
    assert read.where("part > 0").count() > 0
    columns = ["call_id", "pos", "turn_index", "speaker", "text", "ts_start", "ts_end"]
    assert sorted(
        corpus.turns_of(read).withColumn("call_id", F.col("call_id").cast("long"))
        .select(columns).collect()
    ) == sorted(turns.select(columns).collect())
    assert corpus.truth_of(read).count() == gt.count()
    sizes = {int(r.call_id): r.n_turns for r in corpus.calls_of(read).collect()}
    assert sizes == {r.call_id: r.n_turns for r in calls.collect()}


def test_run_files_take_name_and_number_from_the_path(spark, tmp_path):
    for name, number in [("My-Model-1B", 1), ("My-Model-1B", 2), ("Other_X", 1)]:
        document = {
            "model": "vendor/m", "benchmark": "b", "timestamp": "2026-01-02T03:04:05Z",
            "results": [
                {"task_id": f"call_{i}", "difficulty": "easy", "score": 0.5,
                 "time_seconds": 1.5, "details": {"true_positives": 1}}
                for i in range(number + 1)
            ],
            "summary": {"overall_avg": 0.5},
        }
        (tmp_path / f"{name}_run{number}.json").write_text(json.dumps(document, indent=2))
    files = results.read_run_files(spark, str(tmp_path))
    found = results.results_of(files).groupBy("display", "run").count().collect()
    assert {(r.display, r.run): r["count"] for r in found} == {
        ("My-Model-1B", 1): 2, ("My-Model-1B", 2): 3, ("Other_X", 1): 2,
    }


def test_large_runs_are_stored_in_several_documents(spark, tmp_path):
    rows = spark.range(95).select(
        F.lit("m x").alias("model"),
        F.lit(1).alias("run"),
        F.concat(F.lit("call_"), "id").alias("task_id"),
        F.lit("hard").alias("difficulty"),
        (F.col("id") / 1000).alias("score"),
        F.lit(0.5).alias("time_seconds"),
        F.lit(None).cast("struct<auto_fail_applied:boolean>").alias("breakdown"),
        F.lit(None).cast("struct<true_positives:bigint>").alias("details"),
    )
    path = str(tmp_path / "runs")
    stamp = F.lit("2026-01-02 03:04:05").cast("timestamp")
    results.write_run_files(results.nest_runs(rows, "b", stamp, part_results=10), path)
    files = results.read_run_files(spark, path, multiline=False)
    assert files.count() > 5
    first = files.first()
    assert (first.display, first.run, first.timestamp) == ("m x", 1, "2026-01-02T03:04:05Z")
    assert first.summary.overall_avg == sum(range(95)) / 1000 / 95
    assert first.summary.easy_avg == 0.0
    assert results.results_of(files).select("task_id").distinct().count() == 95


def _log(spark, small):
    steps = rp.replay(inputs.actions(spark, small), order=inputs.ORDER)
    ids = inputs.episode_ids(spark, small)
    counts = grading.audit_counts(rp.audit_rows(steps), inputs.truth(ids))
    grades = grading.score(counts.withColumn("gt_compliance", inputs.truth_compliance()))
    rewarded = rp.rewarded_steps(steps, grades)
    return rewarded, runlog.emit_run_log(rewarded, "env", "m")


def test_log_survives_text_files(spark, small, tmp_path):
    rewarded, lines = _log(spark, small)
    path = str(tmp_path / "log")
    (
        lines.repartition(3, "episode_id")
        .sortWithinPartitions("episode_id", "line_no")
        .select("line")
        .write.text(path)
    )
    parsed = runlog.parse_log_files(spark, path)
    assert parsed.where("_corrupt IS NOT NULL").count() == 0
    got = parsed.where("kind = 'STEP'").select(
        F.col("task").cast("long").alias("episode_id"), "step", "done", "error"
    )
    expected = rewarded.select("episode_id", F.col("step").cast("int"), "done", "error")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got.collect(), key=key) == sorted(expected.collect(), key=key)
    ends = parsed.where("kind = 'END'").collect()
    assert len(ends) == rewarded.select("episode_id").distinct().count()
    assert all(len(e.rewards.split(",")) == e.steps for e in ends)


CONSOLE = """noise before
[STEP] step=1 action=get_call_metadata() reward=0.05 done=false error=null
[STEP] step=2 action=submit_report(compliance_pass=False) reward=-0.10 done=true error=nul
[END] success=true steps=2 score=0.512 rewards=0.05,-0.10
[START] task=case_77 env=e model=a/b
[STEP] step=1 action=read_transcript_chunk(start_turn=3,end_turn=9) reward=-0.02 done=false error=Turn 9 doesn't exist.
[STEP] step=2 action=flag_violation(violation_type=x) reward=0.00 done=false e
[END] success=false steps=2 rewards=-0.02,0.00"""


def test_console_log_with_lost_start_and_cut_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text(CONSOLE)
    parsed = runlog.parse_log_files(spark, str(tmp_path))
    rows = parsed.orderBy("pos").collect()
    assert [(r.kind, r.episode, r.task) for r in rows] == [
        ("", 0, None), ("STEP", 0, None), ("STEP", 0, None), ("END", 0, None),
        ("START", 1, "case_77"), ("STEP", 1, "case_77"), ("STEP", 1, "case_77"),
        ("END", 1, "case_77"),
    ]
    assert rows[0]._corrupt == "noise before"
    assert (rows[2].done, rows[2].error, rows[2].reward) == (True, None, -0.1)
    assert (rows[3].score, rows[7].score, rows[7].success) == (0.512, None, False)
    assert rows[5].error == "Turn 9 doesn't exist."
    assert (rows[6].action, rows[6].done, rows[6].error) == (
        "flag_violation(violation_type=x)", None, None,
    )


@contextlib.contextmanager
def _settings(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _split(size, batch):
    return {
        "spark__sql__files__maxPartitionBytes": size,
        "spark__sql__files__openCostInBytes": 1,
        "spark__sql__execution__arrow__maxRecordsPerBatch": batch,
    }


def test_log_lines_in_any_splits(spark, tmp_path):
    """Starts lost, doubled and late; logs without ends; a file of one long episode."""
    rng = random.Random(4)
    kinds = ["[START] task=t{} env=e model=m", "[STEP] step={} action=a() reward=0.00 done=false error=null", "[END] success=true steps={} rewards=0.00", "noise {}"]
    logs = {}
    for name, weights, n in (("a", (3, 9, 3, 1), 400), ("b", (1, 30, 0, 1), 300), ("c", (1, 60, 1, 1), 500), ("d", (0, 1, 0, 0), 1)):
        lines = [rng.choices(kinds, weights)[0].format(k) for k in range(n)]
        (tmp_path / f"{name}.log").write_text("\n".join(lines) + "\n")
        logs[name] = lines

    def numbered(lines):
        episodes, tasks, at = [], {}, 0
        for line in lines:
            episodes.append(at)
            if line.startswith("[START] "):
                tasks[at] = line.split("task=")[1].split(" ")[0]
            at += line.startswith("[END] ")
        return [(x, e, tasks.get(e)) for x, e in zip(lines, episodes, strict=True)]

    apart = {name: numbered(lines) for name, lines in logs.items()}
    together = numbered([x for name in sorted(logs) for x in logs[name]])
    for size, batch in ((700, 5), (700, 10_000), (5_000, 50), ("128m", 10_000)):
        with _settings(spark, **_split(size, batch)):
            rows = runlog.read_log_lines(spark, str(tmp_path)).orderBy("source", "chunk", "pos").collect()
            for name, expected in apart.items():
                got = [(r.line, r.episode, r.task) for r in rows if r.source.endswith(f"/{name}.log")]
                assert got == expected
            if size == 700:
                assert len({(r.source, r.chunk) for r in rows}) > 20
            one = runlog.read_log_lines(spark, str(tmp_path), one_log=True).collect()
            assert sorted((r.line, r.episode, str(r.task)) for r in one) == sorted((x, e, str(t)) for x, e, t in together)


def test_parsed_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.log").write_text(CONSOLE)
    plan = runlog.parse_log_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"Exchange (hash|range|single)|SortMergeJoin|Window", plan)


def test_beyond_few_splits_rows_come_back_in_order(spark, tmp_path, monkeypatch):
    from callsift.sources import splits

    monkeypatch.setattr(splits, "BROADCAST_ROWS", 0)
    (tmp_path / "a.log").write_text(CONSOLE * 40)
    with _settings(spark, **_split(900, 7)):
        many = runlog.read_log_lines(spark, str(tmp_path)).collect()
    monkeypatch.undo()
    assert sorted(map(str, many)) != []
    with _settings(spark, **_split(900, 7)):
        few = runlog.read_log_lines(spark, str(tmp_path)).collect()
    assert sorted(map(str, many)) == sorted(map(str, few))


def _json_value(rng, depth):
    kind = rng.randint(0, 6)
    if kind == 0:
        return {_json_text(rng, 3): _json_value(rng, depth - 1) if depth else 1 for _ in range(rng.randint(0, 3))}
    if kind == 1:
        return [_json_value(rng, depth - 1) if depth else 2 for _ in range(rng.randint(0, 3))]
    return _json_text(rng, rng.randint(0, 12))


def _json_text(rng, n):
    return "".join(rng.choice('ab"\\{}[]é\n ,:🙂') for _ in range(n))


def test_json_arrays_in_any_splits(spark, tmp_path):
    """Braces and quotes in strings, escapes, records over many splits, odd elements."""
    rng = random.Random(3)
    expected = []
    for f, n in enumerate((0, 1, 250)):
        records = [{"id": k, "x": _json_value(rng, 3), "s": "}" * rng.randint(0, 3) + '\\"{'} for k in range(n)]
        if f == 2:
            records[7]["big"] = [{"k": "}" * 9} for _ in range(300)]
        expected += records
        odd = [3, "x{", None, [1, [2]]] if f == 2 else []
        text = json.dumps([*odd, *records, *odd], ensure_ascii=bool(f % 2), indent=2 if f == 1 else None)
        (tmp_path / f"{f}.json").write_text(text)
    for size, batch in ((1_500, 7), (1_500, 10_000), ("128m", 10_000)):
        with _settings(spark, **_split(size, batch)):
            rows = json_array.read_array(spark, str(tmp_path)).orderBy("source", "chunk", "nth").collect()
        assert [json.loads(r.text) for r in rows] == expected
        if size == 1_500:
            assert len({r.chunk for r in rows}) > 5


def test_calls_of_an_array_keep_the_last_version(spark, tmp_path):
    turn = {"speaker": "agent", "text": 'a "}" b'}
    calls = [{"id": f"c{k % 40}", "turns": [turn] * (k + 1), "difficulty": None} for k in range(60)] + [{"turns": []}]
    (tmp_path / "calls.json").write_text(json.dumps(calls))
    with _settings(spark, **_split(2_000, 16)):
        read = corpus.read_calls(spark, str(tmp_path))
        plan = read._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: len(r["turns"]) for r in read.collect()}
    assert got == {f"c{k}": (k + 41 if k < 20 else k + 1) for k in range(40)}
    # Transcripts meet no aggregation; only the pieces of cut records are gathered.
    assert "max_by" not in plan


def test_a_shorter_later_call_replaces_all_parts_of_an_earlier_one(spark, tmp_path):
    import json

    turn = {"speaker": "agent", "text": "x"}
    old = [{"id": "a", "part": p or None, "parts": 2, "turns": [turn] * 3} for p in (0, 1)]
    lines = [*old, {"id": "b", "turns": [turn]}, {"id": "a", "turns": [turn]}]
    path = tmp_path / "calls.json"
    path.write_text("\n".join(map(json.dumps, lines)))
    read = corpus.read_calls(spark, str(path), multiline=False)
    assert sorted((r["id"], r["part"], len(r["turns"])) for r in read.collect()) == [("a", 0, 1), ("b", 0, 1)]


def test_no_folder_is_made_up(spark, monkeypatch):
    from callsift.sources import shared_dir

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir.checkpoint_root(Session())
