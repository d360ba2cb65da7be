import re

from callsift.operators import actions as act

FIELDS = [
    "action_type", "turn_index", "start_turn", "end_turn", "violation_type",
    "violation_severity", "compliance_pass", "policy_hypothesis",
]


def _parse(spark, text):
    df = spark.createDataFrame([(1, text)], "completion_id long, text string")
    rows = act.parse_completions(df).orderBy("nth").collect()
    return [{f: r[f] for f in FIELDS if r[f] is not None} for r in rows]


def test_calls_are_found_in_order(spark):
    got = _parse(
        spark,
        "Plan: get_call_metadata() then\nread_transcript_chunk( start_turn = 0 ,end_turn=4)"
        " so flag_violation(violation_type='pii_exposure_risk', violation_severity=\"high\","
        "turn_index=3); submit_report(compliance_pass=False) f(x",
    )
    assert got == [
        {"action_type": "get_call_metadata"},
        {"action_type": "read_transcript_chunk", "start_turn": 0, "end_turn": 4},
        {
            "action_type": "flag_violation",
            "violation_type": "pii_exposure_risk",
            "violation_severity": "high",
            "turn_index": 3,
        },
        {"action_type": "submit_report", "compliance_pass": False},
    ]


# One call each: the parsed fields, or None if the whole call is dropped.
VALUES = [
    ("a(turn_index=-2)", {"turn_index": -2}),
    ("a(turn_index='7')", {"turn_index": 7}),
    ("a(turn_index=3.0)", {"turn_index": 3}),
    ("a(turn_index=True)", {"turn_index": 1}),
    ("a(turn_index=3.5)", None),
    ("a(turn_index=two)", None),
    ("a(turn_index=)", None),
    ("a(turn_index=None)", None),
    ("a(compliance_pass=YES)", {"compliance_pass": True}),
    ("a(compliance_pass=0)", {"compliance_pass": False}),
    ("a(compliance_pass=2)", None),
    ("a(violation_type=x=y)", {"violation_type": "x=y"}),
    ("a(violation_type=)", {"violation_type": ""}),
    ("a(violation_type=12)", None),
    ("a(violation_type=true)", None),
    ("a(violation_type=-12)", {"violation_type": "-12"}),
    ("a(type='x')", None),
    ("a(action_type=b)", None),
    ("a(=5)", None),
    ("a(just words, more)", {}),
    ("a(turn_index=x,turn_index=4)", {"turn_index": 4}),
    ("a(turn_index=4,turn_index=x)", None),
    ("a(my_turn_index=4)", None),
    ("a(policy_hypothesis=' b c ')", {"policy_hypothesis": " b c "}),
    ("a( turn_index=1\n,\nend_turn=2)", {"turn_index": 1, "end_turn": 2}),
]


def test_parameter_values(spark):
    df = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(VALUES)], "completion_id long, text string"
    )
    rows = {r.completion_id: r for r in act.parse_completions(df).collect()}
    for i, (text, expected) in enumerate(VALUES):
        row = rows.get(i)
        got = row and {f: row[f] for f in FIELDS[1:] if row[f] is not None}
        assert got == expected, text


def test_call_pattern_finds_what_the_plain_pattern_finds(spark):
    texts = ["f(g(x) h() éa(1) a b(2", "((x)) a_b9(c) (d)", "aa(bb(cc))dd(ee)"]
    for text in texts:
        df = spark.createDataFrame([(1, text)], "completion_id long, text string")
        got = [r.action_type for r in act.parse_completions(df).orderBy("nth").collect()]
        assert got == [name for name, _ in re.findall(r"(\w+)\(([^)]*)\)", text)]


ARGUMENTS = [
    ('{"turn_index": 3}', {"turn_index": 3}),
    ('{"turn_index": "3", "start_turn": "", "end_turn": "None"}', {"turn_index": 3}),
    ('{"turn_index": 3.9}', {"turn_index": 3}),
    ('{"turn_index": true}', {"turn_index": 1}),
    ('{"turn_index": "soon"}', {}),
    ('{"compliance_pass": "Yes"}', {"compliance_pass": True}),
    ('{"compliance_pass": 1}', {"compliance_pass": True}),
    ('{"compliance_pass": "None"}', {"compliance_pass": False}),
    ('{"compliance_pass": "null"}', {}),
    ('{"compliance_pass": null}', {}),
    ('{"violation_type": "x", "other": 1}', {"violation_type": "x"}),
    ('{"violation_type": 7, "turn_index": 1e1}', {"violation_type": "7", "turn_index": 10}),
    ('{"compliance_pass": 1.0}', {"compliance_pass": False}),
    ('{"turn_index": 99999999999, "start_turn": [1], "end_turn": {"a": 2}}', {}),
    ("[1, 2]", {}),
    ('{"turn_index": 3', {}),
    ("", {}),
    (None, {}),
]


def test_json_arguments(spark):
    df = spark.createDataFrame(
        [(i, "f", args) for i, (args, _) in enumerate(ARGUMENTS)],
        "id long, fn_name string, args string",
    )
    for row in act.coerce_tool_args(df).collect():
        args, expected = ARGUMENTS[row.id]
        assert {f: row[f] for f in FIELDS[1:] if row[f] is not None} == expected, args


def test_only_bare_numbers_are_numbers(spark):
    given = ['"3.7"', '"3d"', '"1e3"', '"true"', '" 12 "', '"-4"', "3.7", "true", "5", "null", '""']
    rows = [(k, "flag_violation", f'{{"turn_index": {x}}}') for k, x in enumerate(given)]
    df = spark.createDataFrame(rows, "k int, fn_name string, args string")
    found = {r["k"]: r["turn_index"] for r in act.coerce_tool_args(df).collect()}
    assert [found[k] for k in range(len(given))] == [None, None, None, None, 12, -4, 3, 1, 5, None, None]
