import random

from pyspark.sql import functions as F

from callsift.operators import screens, transcript
from callsift.plans import inputs

TURN = (
    "call_id long, pos long, turn_index int, speaker string, text string, "
    "ts_start double, ts_end double"
)


def _calls(spark, rng, sizes):
    rows = []
    for call, size in enumerate(sizes):
        clock = 0.0
        for pos in range(size):
            clock += rng.choice([0.0, 0.05, 0.25, 1.15, 7.333])
            rows.append((call, pos, pos + 5, rng.choice(["agent", "customer"]),
                         f"t{call}.{pos}", clock, clock + 1.1))
            clock += 1.1
    return rows, spark.createDataFrame(rng.sample(rows, len(rows)), TURN)


def test_context_is_the_same_for_any_part_size(spark):
    rows, turns = _calls(spark, random.Random(1), [1, 2, 3, 4, 5, 6, 7, 13, 29])
    by_place = {(r[0], r[1]): r for r in rows}
    sizes = {r[0]: 0 for r in rows}
    for r in rows:
        sizes[r[0]] += 1
    for part in (3, 4, 5, 4096):
        got = transcript.turn_context(turns, part_turns=part).collect()
        assert len(got) == len(rows)
        for g in got:
            before = by_place.get((g.call_id, g.pos - 1))
            after = by_place.get((g.call_id, g.pos + 1))
            assert g.before_text == (before and before[4])
            assert g.before_ts_end == (before and before[6])
            assert g.after_text == (after and after[4])
            assert g.after_turn_index == (after and after[2])
            gap = round(g.ts_start - before[6], 1) if before else 0.0
            assert g.silence_gap_before_seconds == gap
            place = "mid-call"
            if g.pos <= 2:
                place = "opening"
            elif g.pos >= sizes[g.call_id] - 3:
                place = "closing"
            assert g.speaker_turn_position == place


def test_chunk_requests(spark):
    _, turns = _calls(spark, random.Random(2), [6])
    requests = spark.createDataFrame(
        [(1, 0, 1, 3), (2, 0, None, 3), (3, 0, -1, 2), (4, 0, 2, 6), (5, 0, 4, 3),
         (6, 0, 0, 5), (7, 0, 5, 5), (8, 0, 0, 4)],
        "request_id long, call_id long, start_turn int, end_turn int",
    )
    checked = transcript.validate_reads(requests, transcript.call_lengths(turns))
    errors = {r.request_id: r.error for r in checked.collect()}
    assert errors == {
        1: None,
        2: "Provide start_turn and end_turn parameters.",
        3: "start_turn -1 must be non-negative. Valid indices: [0, 5].",
        4: "Turn 6 doesn't exist. Last valid turn is 5.",
        5: "start_turn (4) cannot exceed end_turn (3).",
        6: "Chunk too large (6 turns). Maximum 5 turns per read.",
        7: None,
        8: None,
    }
    got = transcript.read_chunks(requests, turns).collect()
    by_request = {}
    for g in got:
        by_request.setdefault(g.request_id, set()).add(g.pos)
        assert g.total_turns == 6 and g.turn_index == g.pos + 5
    assert by_request == {1: {1, 2, 3}, 7: {5}, 8: {0, 1, 2, 3, 4}}


def _screened(spark, said, department="Billing"):
    rows = [(1, i, i, who, text, 0.0, 0.0) for i, (who, text) in enumerate(said)]
    calls = spark.createDataFrame([(1, department)], "call_id long, department string")
    return screens.screen_rubric(spark.createDataFrame(rows, TURN), calls).first()


def test_collections_calls_must_tell_of_the_debt(spark):
    debt = "This is an ATTEMPT to collect a debt; the call may be recorded"
    recorded = "This call may be recorded"
    for department, turns, missing in (
        ("Collections", [("customer", debt), ("agent", recorded), ("agent", debt)], (False, True)),
        ("Collections", [("customer", "hi"), ("agent", debt)], (False, False)),
        ("Collections", [("customer", debt)], (None, None)),
        ("Billing", [("agent", recorded)], (False, None)),
    ):
        got = _screened(spark, turns, department)
        assert (got.disclosure_missing, got.debt_disclosure_missing) == missing


def test_holds_that_were_asked_for(spark):
    rows = [
        (1, 0, 0, "customer", "Let me grab my account number", 0.0, 1.0),
        (1, 1, 1, "customer", "here it is", 50.0, 51.0),
        (1, 2, 2, "agent", "may I place you on a brief hold?", 52.0, 53.0),
        (1, 3, 3, "agent", "Sorry about that", 90.0, 91.0),
        (1, 4, 4, "agent", "let me grab my account number", 92.0, 93.0),
        (1, 5, 5, "agent", "Sorry about that", 101.0, 102.0),
        (1, 6, 6, "customer", "sorry about that", 110.0, 111.0),
    ]
    got = screens.screen_hold_gaps(spark.createDataFrame(rows, TURN)).orderBy("pos")
    assert [(r.pos, r.agent_apologised, r.severity) for r in got.collect()] == [
        (5, True, "low"), (6, False, "low"),
    ]


def test_rubric_screens_and_their_exceptions(spark):
    hit = _screened(
        spark,
        [
            ("customer", "This call may be recorded, I know"),
            ("agent", "Welcome to quality service"),
            ("customer", "I WANT to speak to a supervisor"),
            ("agent", "A supervisor would tell you the same thing"),
            ("agent", "I guarantee it"),
            ("agent", "Please give me your Social Security number"),
            ("agent", "I'll give you 50% off"),
            ("agent", "this call may be recorded"),
        ],
    )
    assert hit.disclosure_missing
    assert (hit.supervisor_request_pos, hit.deflection_pos, hit.commitment_pos) == (2, 3, 4)
    assert (hit.full_ssn_pos, hit.discount_pos) == (5, 6)
    clear = _screened(
        spark,
        [
            ("agent", "Hello, this call is being recorded"),
            ("customer", "I guarantee I'll give you 50% off"),
            ("agent", "Usually I promise a reply"),
            ("agent", "give me your social security number, last four only"),
            ("agent", "I can check if any promotions are available, 10 or so"),
            ("agent", "I want to speak to a supervisor"),
        ],
    )
    assert not clear.disclosure_missing
    assert [
        clear.supervisor_request_pos, clear.deflection_pos, clear.commitment_pos,
        clear.full_ssn_pos, clear.discount_pos,
    ] == [None] * 5


def test_hold_gaps(spark):
    rows = [
        (1, 0, 0, "agent", "one sec", 0.0, 1.0),
        (1, 1, 1, "agent", "back", 21.0, 22.0),
        (1, 2, 2, "customer", "Hello? are you still there", 30.0, 31.0),
        (1, 3, 3, "agent", "yes", 34.0, 35.0),
        (1, 4, 4, "customer", "fine", 41.0, 42.0),
        (1, 5, 5, "agent", "so", 90.0, 91.0),
    ]
    got = screens.screen_hold_gaps(spark.createDataFrame(rows, TURN)).orderBy("pos")
    assert [(r.pos, r.gap_seconds, r.severity) for r in got.collect()] == [
        (1, 20.0, "medium"), (2, 8.0, "medium"), (4, 6.0, "low"), (5, 48.0, "medium"),
    ]


def test_unknown_policy(spark):
    asked = spark.createDataFrame(
        [(1, "failed_escalation"), (2, "nope"), (3, ""), (4, None)],
        "request_id long, policy_hypothesis string",
    )
    got = {r.request_id: r for r in transcript.rubric_lookup(asked).collect()}
    assert got[1].definition and got[1].compliance_rubric_error is None
    assert got[2].compliance_rubric_error.startswith(
        "Unknown policy: 'nope'. Valid policies: ['regulatory_disclosure_failure', "
    )
    assert got[3].compliance_rubric_error is None and got[3].policy is None
    assert got[4].compliance_rubric_error is None


def test_a_call_with_a_third_of_all_turns_is_cut_without_a_trace(
    spark, small, monkeypatch
):
    whole_table = inputs.table

    def skewed(session, folder, name):
        df = whole_table(session, folder, name)
        if name != "conversations":
            return df
        moved = F.col("conv_id") % 3 == 0
        return df.select(
            F.when(moved, F.lit(0)).otherwise(F.col("conv_id")).alias("conv_id"),
            F.when(moved, F.pmod(F.xxhash64("text"), F.lit(2**31 - 1)))
            .otherwise(F.col("turn"))
            .alias("turn"),
            "role",
            "text",
        )

    monkeypatch.setattr(inputs, "table", skewed)
    plain, cut = inputs.turns(spark, small), inputs.turns(spark, small, target_rows=5)
    assert sorted(plain.collect()) == sorted(cut.collect())
    key = repr
    assert sorted(transcript.turn_context(plain).collect(), key=key) == sorted(
        transcript.turn_context(cut, part_turns=4).collect(), key=key
    )
