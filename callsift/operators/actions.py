"""Audit actions: validation, prices, and the two text forms they arrive in.

``actions``: episode_id, seq, action_type, turn_index, start_turn, end_turn,
violation_type, violation_severity, compliance_pass, policy_hypothesis, plus the
``n_turns`` of the call under audit.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift import fixed_values as fv
from callsift.functions.text import sql_text

_INT_FIELDS = ["turn_index", "start_turn", "end_turn"]
_TEXT_FIELDS = ["violation_type", "violation_severity", "policy_hypothesis"]


# --- Validation -----------------------------------------------------------------

_READ, _ANALYZE, _FLAG = "read_transcript_chunk", "analyze_turn", "flag_violation"
_LAST = "n_turns - 1"
_SIZE = "end_turn - start_turn + 1"
_TYPES = ", ".join(sql_text(t) for t in fv.VIOLATION_TYPES)
_TYPE_SET = sql_text("{" + ", ".join(f"'{t}'" for t in fv.VIOLATION_TYPES) + "}")

# Per action in the order of testing; the first rule that holds names the error:
# (code, action, condition, message, its arguments, shorter message as feedback,
# its arguments).
RULES = [
    (1, _READ, "start_turn IS NULL OR end_turn IS NULL", fv.MSG_READ_MISSING, [], "", []),
    (
        2,
        _READ,
        "start_turn < 0",
        fv.MSG_READ_NEGATIVE,
        ["start_turn", _LAST],
        fv.MSG_READ_NEGATIVE_SHORT,
        ["start_turn"],
    ),
    (3, _READ, f"end_turn > {_LAST}", fv.MSG_READ_PAST_END, ["end_turn", _LAST], "", []),
    (
        4,
        _READ,
        "start_turn > end_turn",
        fv.MSG_READ_REVERSED,
        ["start_turn", "end_turn"],
        "",
        [],
    ),
    (
        5,
        _READ,
        f"{_SIZE} > {fv.MAX_CHUNK_TURNS}",
        fv.MSG_READ_TOO_LARGE,
        [_SIZE],
        fv.MSG_READ_TOO_LARGE_SHORT,
        [_SIZE],
    ),
    (6, _ANALYZE, "turn_index IS NULL", fv.MSG_TURN_MISSING, [], "", []),
    (
        7,
        _ANALYZE,
        f"turn_index < 0 OR turn_index > {_LAST}",
        fv.MSG_TURN_RANGE,
        ["turn_index", _LAST],
        "",
        [],
    ),
    (8, _FLAG, "coalesce(violation_type, '') = ''", fv.MSG_FLAG_MISSING, [], "", []),
    (
        9,
        _FLAG,
        f"violation_type NOT IN ({_TYPES})",
        fv.MSG_FLAG_TYPE,
        ["violation_type", _TYPE_SET],
        "",
        [],
    ),
    (
        10,
        _FLAG,
        "violation_severity NOT IN ('high', 'medium', 'low')",
        fv.MSG_FLAG_SEVERITY,
        [],
        "",
        [],
    ),
]


def _code_case(action: str) -> str:
    tests = [f"WHEN {rule[2]} THEN {rule[0]}" for rule in RULES if rule[1] == action]
    return "CASE " + " ".join(tests) + " END"


def rule_code(action: str) -> Column:
    """Code of the first rule a row of this action breaks, null if none."""
    return F.expr(_code_case(action))


def with_error_code(actions: DataFrame) -> DataFrame:
    """Add ``error_code``; rows stay narrow until a message is asked for."""
    per_action = [f"WHEN '{a}' THEN {_code_case(a)}" for a in (_READ, _ANALYZE, _FLAG)]
    return actions.withColumn(
        "error_code", F.expr(f"CASE action_type {' '.join(per_action)} END")
    )


def error_text(action: str | None = None, short: bool = False) -> Column:
    """Message of ``error_code``, in the shorter form where feedback uses one.

    With ``action`` only its own rules are considered, for rows that hold no
    other parameters.
    """
    cases = []
    for code, rule_action, _, message, args, brief, brief_args in RULES:
        if action not in (None, rule_action):
            continue
        if short and brief:
            message, args = brief, brief_args
        text = sql_text(message)
        if args:
            text = f"format_string({', '.join([text, *args])})"
        cases.append(f"WHEN {code} THEN {text}")
    return F.expr(f"CASE error_code {' '.join(cases)} END")


def validate_flags(actions: DataFrame) -> DataFrame:
    """Flag actions with ``error``; a missing severity is recorded as low."""
    flags = actions.where(F.col("action_type") == _FLAG)
    return with_error_code(flags).withColumns(
        {
            "error": error_text(_FLAG),
            "severity": F.coalesce("violation_severity", F.lit("low")),
        }
    )


# --- Prices -------------------------------------------------------------------


def _by_action(values: dict[str, int], default: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {value}" for name, value in values.items())
    return f"CASE action_type {cases} ELSE {default} END"


def price_actions(actions: DataFrame) -> DataFrame:
    """Add ``error_code`` and ``cost``: an invalid read is free, all else charged."""
    per_turn = fv.ACTION_COST[_READ]
    flat = {name: cost for name, cost in fv.ACTION_COST.items() if name != _READ}
    cost = f"""CASE WHEN action_type = '{_READ}'
        THEN IF(error_code IS NULL, {per_turn} * ({_SIZE}), 0)
        ELSE {_by_action(flat, fv.UNKNOWN_ACTION_COST)} END"""
    return with_error_code(actions).withColumn("cost", F.expr(f"CAST({cost} AS BIGINT)"))


def reward_cents() -> Column:
    """Reward of an executed action in hundredths, before any grade."""
    plain = _by_action(fv.REWARD_CENTS, fv.UNKNOWN_REWARD_CENTS)
    invalid = fv.INVALID_REWARD_CENTS
    return F.expr(
        f"CAST(IF(error_code IS NOT NULL, {invalid}, {plain}) AS BIGINT)"
    )


# --- Tool arguments as JSON ---------------------------------------------------


def _whole_number(kind: Column, raw: Column) -> Column:
    """A whole number from a bare number, a bare switch or a string of digits."""
    digits = F.when(raw.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(raw).try_cast("int"))
    return (
        F.when(kind == "STRING", digits)
        .when(kind == "BOOLEAN", (raw == "true").cast("int"))
        .when(kind.rlike(_NUMBER), raw.try_cast("double").try_cast("int"))
    )


def _switch(kind: Column, raw: Column) -> Column:
    fraction = kind.rlike("^(DECIMAL|DOUBLE)")
    known = F.lower(raw).isin("true", "1", "yes")
    return F.when(~raw.isin("", "null"), known & ~fraction)


_NUMBER = "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL|FLOAT|DOUBLE)"


def coerce_tool_args(calls: DataFrame) -> DataFrame:
    """(…, fn_name, args) to typed action columns; unusable values become null.

    The text is parsed once, to a variant, whose values keep their types: only bare
    values are numbers and switches, quoted ones stay strings. Malformed text, and an
    object that gives a name twice, has no arguments.
    """
    kept = [c for c in calls.columns if c not in ("fn_name", "args")]
    parsed = calls.select(
        F.struct(*kept).alias("kept"), "fn_name", F.try_parse_json("args").alias("given")
    )

    def raw(field: str) -> Column:
        return F.try_variant_get("given", f"$.{field}", "string")

    def kind(field: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("given", f"$.{field}", "variant"))

    typed = {f: _whole_number(kind(f), raw(f)) for f in _INT_FIELDS}
    typed |= {f: raw(f) for f in _TEXT_FIELDS}
    typed["compliance_pass"] = _switch(kind("compliance_pass"), raw("compliance_pass"))
    return parsed.select(
        "kept.*",
        F.col("fn_name").alias("action_type"),
        *[typed[f].alias(f) for f in fv.ACTION_FIELDS],
    )


# --- Tool calls inside completion text -----------------------------------------


def parse_completions(completions: DataFrame) -> DataFrame:
    """(completion_id, text, …) to one row per valid tool call, in text order.

    A call is dropped as a whole if it names an unknown parameter or gives a
    parameter a value its type cannot take.
    """
    kept = [c for c in completions.columns if c != "text"]
    found = F.regexp_extract_all(F.col("text"), F.lit(_CALL), 0)
    calls = completions.select(*kept, F.posexplode(found).alias("nth", "call"))
    name = F.substring_index("call", "(", 1)
    named = calls.select(
        *kept,
        "nth",
        name.alias("action_type"),
        F.expr(
            "substring(call, length(substring_index(call, '(', 1)) + 2, "
            "length(call) - length(substring_index(call, '(', 1)) - 2)"
        ).alias("params"),
    )
    raw = named.where(~F.col("params").rlike(_BAD_PARAM)).select(
        *kept, "nth", "action_type", *[_param(f).alias(f) for f in fv.ACTION_FIELDS]
    )
    typed = {f: _typed_int(F.col(f)) for f in _INT_FIELDS}
    typed["compliance_pass"] = F.lower("compliance_pass").rlike(_YES)
    return raw.select(
        *kept,
        "nth",
        "action_type",
        *[typed.get(f, F.col(f)).alias(f) for f in fv.ACTION_FIELDS],
    )


# The tool-call pattern, told not to retry inside a word it has already read.
_CALL = "(?U)\\b" + fv.TOOL_CALL.replace(r"(\w+)", r"(\w++)")
_YES = "^(true|t|yes|y|on|0*1)$"


def _bad_param() -> str:
    """One pattern for a parameter list that must be dropped.

    It finds a piece with an unknown name, or the last piece of a known name
    whose value does not fit. Being a single test on the raw text, the filter
    can run before any parameter is taken apart.
    """
    quotes = "[\"']*"
    known = "|".join(fv.ACTION_FIELDS)
    ints, texts = "|".join(_INT_FIELDS), "|".join(_TEXT_FIELDS)
    switch = "(?i:true|false)"
    number = rf"(?:[+-]?[0-9]+(?:\.0+)?|{switch})"
    verdict = "(?i:true|t|yes|y|on|0*1|false|f|no|n|off|0+)"
    end = r"\s*(?:,|$)"
    fitting = (
        rf"(?:{ints})\s*=\s*{quotes}{number}{quotes}{end}"
        rf"|compliance_pass\s*=\s*{quotes}{verdict}{quotes}{end}"
        # Bare digits and true/false are numbers and switches, not text.
        rf"|(?:{texts})\s*=(?!\s*{quotes}(?:[0-9]+|{switch}){quotes}{end})"
    )
    last_known = rf"({known})\s*=(?!.*,\s*\1\s*=)"
    unknown = rf"(?!(?:{known})\s*=)[^,=]*="
    return rf"(?sU)(?:^|,)\s*+(?!{fitting})(?:{last_known}|{unknown})"


_BAD_PARAM = _bad_param()


def _param(field: str) -> Column:
    """Text given for one parameter; a repeated one takes its last value."""
    pattern = rf"(?sU)^(?:.*,)?\s*{field}\s*=([^,]*)"
    value = F.regexp_extract("params", pattern, 1)
    blanks, quotes = F.lit(" \t\n\r\f\v"), F.lit("\"'")
    given = F.contains(F.col("params"), F.lit(field)) & F.col("params").rlike(pattern)
    return F.when(given, F.btrim(F.btrim(value, blanks), quotes))


def _typed_int(raw: Column) -> Column:
    switch = F.when(F.lower(raw) == "true", 1).when(F.lower(raw) == "false", 0)
    return F.coalesce(switch, F.substring_index(raw, ".", 1).try_cast("int"))
