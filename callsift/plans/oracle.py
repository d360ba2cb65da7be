"""The registered queries once more as plain SQL over the given tables.

Written from the rules, not from the DataFrame plans: sequential numbering and
windows here, joins and sums there. Each query is a chain of named subqueries;
``_sql`` puts those it needs in front of its final SELECT.
"""

from __future__ import annotations

from callsift import fixed_values as fv
from callsift.plans import inputs


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _list(values: list[str | None]) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _pick(values: list[str | None], index: str) -> str:
    return f"({_list(values)})[CAST(({index}) + 1 AS INT)]"


def _case(column: str, values: dict[str, int], default: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {v}" for k, v in values.items())
    return f"CASE {column} {whens} ELSE {default} END"


def _round(x: str, digits: int) -> str:
    """Half-even rounding of the stored value of a non-negative double."""
    s = f"{float(10**digits)}::DOUBLE"
    lifted = f"(({x}) * 134217729.0::DOUBLE)"
    head = f"({lifted} - ({lifted} - ({x})))"
    tail = f"(({x}) - {head})"
    whole = f"floor(({x}) * {s})"
    over = f"((({head} * {s} - {whole}) - 0.5::DOUBLE) + {tail} * {s})"
    return (
        f"(({whole} + CASE WHEN {over} > 0 OR ({over} = 0 AND {whole} % 2 = 1) "
        f"THEN 1::DOUBLE ELSE 0::DOUBLE END) / {s})"
    )


def _money(x: str) -> str:
    """Two decimals as text, sign kept."""
    cents = f"CAST(round({_round(f'abs({x})', 2)} * 100) AS BIGINT)"
    return (
        f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || CAST({cents} // 100 AS VARCHAR) "
        f"|| '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0'))"
    )


def _redact(text: str) -> str:
    stages = [
        (fv.SSN_FULL, fv.TOKEN_SSN, "g"),
        (f"({fv.SSN_LAST4_PREFIX}){fv.SSN_LAST4_DIGITS}", "\\1" + fv.TOKEN_SSN, "gi"),
        (fv.PHONE, fv.TOKEN_PHONE, "g"),
        (fv.ACCOUNT, fv.TOKEN_ACCOUNT, "g"),
        (fv.EMAIL, fv.TOKEN_EMAIL, "g"),
    ]
    for pattern, token, flags in stages:
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(token)}, {_q(flags)})"
    return text


_VALID_SET = "{" + ", ".join(f"'{t}'" for t in fv.VIOLATION_TYPES) + "}"
_VALID_LIST = "[" + ", ".join(f"'{t}'" for t in fv.VIOLATION_TYPES) + "]"
_SKIP = "(" + ", ".join(_q(n) for n in fv.NOT_A_NAME) + ")"
_TYPES = "(" + ", ".join(_q(t) for t in fv.VIOLATION_TYPES) + ")"

# Name -> (subquery, names it reads from), in an order where parents come first.
_CTE: dict[str, tuple[str, list[str]]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    _CTE[name] = (sql, list(needs))


def _sql(final: str, *needs: str) -> str:
    wanted: set[str] = set()

    def add(name: str) -> None:
        for parent in _CTE[name][1]:
            add(parent)
        wanted.add(name)

    for name in needs:
        add(name)
    parts = [f"{n} AS ({sql})" for n, (sql, _) in _CTE.items() if n in wanted]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final


def _truth_of(ids: str) -> str:
    return f"""
    SELECT e AS episode_id, CAST(i AS INT) AS pos,
           {_pick(fv.VIOLATION_TYPES, "(e + i * 3) % 6")} AS type,
           {_pick(fv.SEVERITIES, "(e + i) % 3")} AS severity,
           CASE WHEN (e + i) % 5 > 0 THEN 'Seen in episode ' || e END AS description,
           CAST(e * 3 + i AS INT) AS turn_index
    FROM (SELECT DISTINCT {ids}) ids(e), range(0, 3) r(i) WHERE i < e % 4"""


# --- Calls ------------------------------------------------------------------------

_cte(
    "said",
    f"""SELECT conv_id // 3 AS call_id, conv_id, CAST(turn AS INT) AS turn_index,
    CASE role WHEN 'assistant' THEN 'agent' WHEN 'user' THEN 'customer'
         ELSE 'system' END AS speaker,
    CASE WHEN plant = '' THEN text ELSE plant || ' ' || text END AS text,
    10 + length(text) % 400 AS dur
    FROM (SELECT *, {_pick(inputs.PLANTS, "(conv_id * 5 + turn) % " + str(len(inputs.PLANTS)))} AS plant
          FROM conversations)""",
)
_cte(
    "placed",
    """SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY conv_id, turn_index)
    - 1 AS pos FROM said""",
    "said",
)
_cte(
    "gapped",
    """SELECT *, CASE WHEN pos = 0 THEN 0
    ELSE ((call_id * 7 + pos * 13) % 40) * 10 + pos % 10 END AS gap FROM placed""",
    "placed",
)
_cte(
    "turns",
    """SELECT call_id, pos, turn_index, speaker, text,
    CAST(e - dur AS DOUBLE) / 10.0::DOUBLE AS ts_start,
    CAST(e AS DOUBLE) / 10.0::DOUBLE AS ts_end
    FROM (SELECT *, CAST(sum(gap + dur) OVER (PARTITION BY call_id ORDER BY pos) AS BIGINT)
          AS e FROM gapped)""",
    "gapped",
)
_cte(
    "calls",
    f"""SELECT call_id, CAST(count(*) AS INT) AS n_turns,
    max(ts_end) AS call_duration_seconds,
    {_pick(inputs.DIFFICULTIES, "call_id % 3")} AS difficulty,
    {_pick(inputs.DEPARTMENTS, "call_id % 4")} AS department,
    {_pick(inputs.REASONS, "call_id % 3")} AS call_reason
    FROM turns GROUP BY call_id""",
    "turns",
)
_cte(
    "intros",
    f"""SELECT call_id, pos, speaker, 0 AS rank,
    unnest(regexp_extract_all(text, {_q(fv.INTRO_SELF)}, 1)) AS name,
    generate_subscripts(regexp_extract_all(text, {_q(fv.INTRO_SELF)}, 1), 1) AS nth
    FROM turns WHERE pos < 8
    UNION ALL
    SELECT call_id, pos, speaker, 1,
    unnest(regexp_extract_all(text, {_q(fv.INTRO_THIS_IS)}, 1)),
    generate_subscripts(regexp_extract_all(text, {_q(fv.INTRO_THIS_IS)}, 1), 1)
    FROM turns WHERE pos < 8""",
    "turns",
)
_cte(
    "name_events",
    f"""SELECT call_id, name, 0 AS kind, speaker,
    ((pos * 2 + rank) * 100000 + nth) * 2 AS told FROM intros WHERE name NOT IN {_SKIP}
    UNION ALL
    SELECT call_id, regexp_extract(name, '^(\\S+)', 1), 1, speaker,
    ((pos * 2 + rank) * 100000 + nth) * 2 + 1 FROM intros
    WHERE name NOT IN {_SKIP} AND regexp_extract(name, '^(\\S+)', 1) NOT IN {_SKIP}""",
    "intros",
)
_cte(
    "entities",
    f"""SELECT call_id, name, CASE WHEN coalesce(
        arg_max(speaker, told) FILTER (WHERE kind = 0), arg_min(speaker, told)) = 'agent'
        THEN '{fv.TOKEN_AGENT}' ELSE '{fv.TOKEN_CUSTOMER}' END AS token,
    min(told) AS inserted FROM name_events GROUP BY call_id, name""",
    "name_events",
)
_cte(
    "ranked_names",
    """SELECT *, row_number() OVER (PARTITION BY call_id
    ORDER BY length(name) DESC, inserted) AS i FROM entities""",
    "entities",
)
_cte(
    "folded",
    f"""SELECT call_id, pos, CAST(0 AS BIGINT) AS i, {_redact("text")} AS text FROM turns
    UNION ALL
    SELECT f.call_id, f.pos, n.i, regexp_replace(f.text, n.name, n.token, 'gi')
    FROM folded f JOIN ranked_names n ON n.call_id = f.call_id AND n.i = f.i + 1""",
    "turns",
    "ranked_names",
)
_cte(
    "clean_turns",
    """SELECT t.* REPLACE (f.text AS text) FROM turns t JOIN
    (SELECT call_id, pos, arg_max(text, i) AS text FROM folded GROUP BY call_id, pos) f
    USING (call_id, pos)""",
    "folded",
)


def _context(source: str) -> str:
    gap = _round("ts_start - before_ts_end", 1)
    return f"""SELECT *, CASE WHEN pos = 0 THEN 0.0::DOUBLE ELSE {gap} END
        AS silence_gap_before_seconds,
    CASE WHEN pos <= 2 THEN 'opening' WHEN pos >= n - 3 THEN 'closing'
         ELSE 'mid-call' END AS speaker_turn_position
    FROM (SELECT *, count(*) OVER (PARTITION BY call_id) AS n,
        lag(turn_index) OVER w AS before_turn_index, lag(speaker) OVER w AS before_speaker,
        lag(text) OVER w AS before_text, lag(ts_end) OVER w AS before_ts_end,
        lead(turn_index) OVER w AS after_turn_index, lead(speaker) OVER w AS after_speaker,
        lead(text) OVER w AS after_text, lead(ts_start) OVER w AS after_ts_start
        FROM {source} WINDOW w AS (PARTITION BY call_id ORDER BY pos))"""


_cte("context", _context("turns"), "turns")
_cte("clean_context", _context("clean_turns"), "clean_turns")
_cte(
    "reads",
    """SELECT call_id * 4294967296 + pos AS request_id, call_id,
    CASE WHEN (call_id + pos) % 11 <> 0 THEN CAST(pos - call_id % 3 AS INT) END
        AS start_turn,
    CAST(pos + (call_id * 3 + pos * 7) % 8 - 2 AS INT) AS end_turn, n_turns
    FROM turns JOIN calls USING (call_id)""",
    "calls",
)


def _read_error(start: str, end: str, n: str) -> str:
    return f"""CASE WHEN {start} IS NULL OR {end} IS NULL THEN {_q(fv.MSG_READ_MISSING)}
    WHEN {start} < 0 THEN printf({_q(fv.MSG_READ_NEGATIVE)}, {start}, {n} - 1)
    WHEN {end} >= {n} THEN printf({_q(fv.MSG_READ_PAST_END)}, {end}, {n} - 1)
    WHEN {start} > {end} THEN printf({_q(fv.MSG_READ_REVERSED)}, {start}, {end})
    WHEN {end} - {start} + 1 > 5
        THEN printf({_q(fv.MSG_READ_TOO_LARGE)}, {end} - {start} + 1) END"""


_cte(
    "checked_reads",
    f"SELECT *, {_read_error('start_turn', 'end_turn', 'n_turns')} AS error FROM reads",
    "reads",
)
_cte(
    "asks",
    f"""SELECT call_id * 4294967296 + pos AS request_id, call_id,
    CASE (call_id + pos) % 13 WHEN 0 THEN NULL WHEN 1 THEN -1
         WHEN 2 THEN CAST(pos + 100 AS INT) ELSE CAST(pos AS INT) END AS asked_index,
    {_pick([*inputs.FLAG_TYPES, None, ""], "(call_id + pos) % 9")} AS policy_hypothesis
    FROM turns""",
    "turns",
)
_RUBRIC = ", ".join(
    "("
    + ", ".join(
        [
            _q(p),
            _q(fv.VIOLATION_CATEGORY[p]),
            _q(d),
            _q(g),
            _q("|".join(ind)),
            _q("|".join(ex)),
        ]
    )
    + ")"
    for p, d, ind, g, ex in fv.RUBRIC
)
_cte(
    "rubric",
    f"""SELECT * FROM (VALUES {_RUBRIC}) r(policy, category, definition, severity_guide,
    indicators, common_false_positives)""",
)
_POLICY_ERROR = f"""CASE WHEN policy_hypothesis <> '' AND policy IS NULL
    THEN printf({_q(fv.MSG_POLICY_UNKNOWN)}, policy_hypothesis, {_q(_VALID_LIST)}) END
    AS compliance_rubric_error"""

# --- Actions ----------------------------------------------------------------------


def _actions() -> str:
    flag_type = _pick(inputs.FLAG_TYPES, "k % 7")
    return f"""SELECT user_id AS episode_id, ts, event_id, n AS n_turns,
    CASE event_type WHEN 'view' THEN 'read_transcript_chunk'
         WHEN 'click' THEN 'analyze_turn' WHEN 'error' THEN 'flag_violation'
         WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'get_call_metadata'
                                 ELSE 'get_sentiment_timeline' END
         ELSE CASE k % 10 WHEN 0 THEN 'submit_report' WHEN 1 THEN 'noop'
                          ELSE 'get_transcript_length' END END AS action_type,
    CASE WHEN event_type = 'click' THEN k
         WHEN event_type = 'error' AND event_id % 3 > 0 THEN k % n END AS turn_index,
    CASE WHEN event_type = 'view' THEN CASE event_id % 13 WHEN 0 THEN NULL WHEN 1 THEN -1
         ELSE k % n END END AS start_turn,
    CASE WHEN event_type = 'view' THEN CAST(k % n + event_id % 7 - 1 AS INT) END
        AS end_turn,
    CASE WHEN event_type = 'error' THEN {flag_type} END AS violation_type,
    CASE WHEN event_type = 'error' THEN {_pick([*fv.SEVERITIES, None], "event_id % 4")}
         END AS violation_severity,
    CASE WHEN event_type = 'purchase' AND k % 10 = 0 AND event_id % 3 > 0
         THEN k % 20 = 0 END AS compliance_pass,
    CASE WHEN event_type = 'click' AND k % 2 = 0 THEN {flag_type} END
        AS policy_hypothesis
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
          CAST(20 + user_id % 30 AS INT) AS n FROM events)"""


def _replay_chain(prefix: str, source: str, order: str) -> None:
    """Subqueries that replay ``source``: priced, summed, ended, stepped."""
    _cte(
        f"{prefix}logged",
        f"""SELECT *, false AS forced FROM {source}
        UNION ALL BY NAME
        SELECT DISTINCT episode_id, n_turns, 'submit_report' AS action_type,
        false AS compliance_pass, true AS forced FROM {source}""",
        source,
    )
    _cte(
        f"{prefix}errors",
        f"""SELECT *, CASE action_type
        WHEN 'read_transcript_chunk'
            THEN {_read_error("start_turn", "end_turn", "n_turns")}
        WHEN 'analyze_turn' THEN CASE WHEN turn_index IS NULL
            THEN {_q(fv.MSG_TURN_MISSING)}
            WHEN turn_index < 0 OR turn_index >= n_turns
            THEN printf({_q(fv.MSG_TURN_RANGE)}, turn_index, n_turns - 1) END
        WHEN 'flag_violation' THEN CASE
            WHEN coalesce(violation_type, '') = '' THEN {_q(fv.MSG_FLAG_MISSING)}
            WHEN violation_type NOT IN {_TYPES}
            THEN printf({_q(fv.MSG_FLAG_TYPE)}, violation_type, {_q(_VALID_SET)})
            WHEN violation_severity NOT IN ('high', 'medium', 'low')
            THEN {_q(fv.MSG_FLAG_SEVERITY)} END
        END AS error FROM {prefix}logged""",
        f"{prefix}logged",
    )
    fixed = {k: v for k, v in fv.ACTION_COST.items() if k != "read_transcript_chunk"}
    _cte(
        f"{prefix}priced",
        f"""SELECT *, 50 + 3 * n_turns AS total_budget,
        CASE WHEN action_type = 'read_transcript_chunk' THEN CASE WHEN error IS NULL
             THEN 3 * (end_turn - start_turn + 1) ELSE 0 END
             ELSE {_case("action_type", fixed, "5")} END AS cost
        FROM {prefix}errors""",
        f"{prefix}errors",
    )
    _cte(
        f"{prefix}spent",
        f"""SELECT *, row_number() OVER w AS nth, sum(cost) OVER w AS cum
        FROM {prefix}priced WINDOW w AS (PARTITION BY episode_id
        ORDER BY forced, {order} ROWS UNBOUNDED PRECEDING)""",
        f"{prefix}priced",
    )
    _cte(
        f"{prefix}last",
        f"""SELECT episode_id, min(nth) AS last FROM {prefix}spent
        WHERE action_type = 'submit_report' OR cum > total_budget GROUP BY episode_id""",
        f"{prefix}spent",
    )
    _cte(
        f"{prefix}kept",
        f"""SELECT s.*, nth = last AS done,
        nth = last AND action_type <> 'submit_report' AS exhausted
        FROM {prefix}spent s JOIN {prefix}last USING (episode_id) WHERE nth <= last""",
        f"{prefix}last",
    )
    _cte(
        f"{prefix}steps",
        f"""SELECT *, nth AS step,
        CASE WHEN exhausted THEN '{fv.AUTO_SUBMIT_NAME}' ELSE action_type END
            AS recorded_action,
        CAST(total_budget - cum + CASE WHEN exhausted THEN cost ELSE 0 END AS BIGINT)
            AS remaining,
        CASE WHEN done THEN NOT exhausted AND coalesce(compliance_pass, true) END
            AS verdict,
        NOT exhausted AND action_type = 'flag_violation' AND error IS NULL AS is_flag,
        CASE WHEN done THEN 0 WHEN error IS NOT NULL THEN -2
             ELSE {_case("action_type", fv.REWARD_CENTS, "-5")} END AS cents
        FROM {prefix}kept""",
        f"{prefix}kept",
    )
    _cte(
        f"{prefix}flags",
        f"""SELECT episode_id, row_number() OVER (PARTITION BY episode_id ORDER BY step) - 1
        AS pos, violation_type AS type, turn_index,
        coalesce(violation_severity, 'low') AS severity FROM {prefix}steps WHERE is_flag""",
        f"{prefix}steps",
    )


_cte("acts", _actions())
_cte(
    "open_acts",
    """SELECT * FROM acts
    WHERE NOT (action_type = 'submit_report' AND episode_id % 3 = 0)""",
    "acts",
)
_replay_chain("", "acts", "ts, event_id")
_replay_chain("open_", "open_acts", "ts, event_id")

# --- Grades -----------------------------------------------------------------------

_cte("gt", _truth_of("user_id FROM events"))


def _grade_chain(prefix: str, compliance: str, gt: str) -> None:
    weight = _case("severity", fv.SEVERITY_WEIGHT, "1")
    penalty = _case("severity", fv.FALSE_POSITIVE_CENTS, "5")
    _cte(
        f"{prefix}gt_types",
        f"""SELECT episode_id, type, count(*) AS n_gt, sum({weight}) AS gt_weight,
        count(*) FILTER (WHERE severity = 'high') AS n_high,
        count(*) FILTER (WHERE severity = 'medium') AS n_medium,
        count(*) FILTER (WHERE severity = 'low') AS n_low,
        arg_max(severity, pos) AS gt_severity FROM {gt} GROUP BY episode_id, type""",
        gt,
    )
    _cte(
        f"{prefix}flag_types",
        f"""SELECT episode_id, type, count(*) AS n_flag, sum({penalty}) AS claim_cents,
        arg_max(severity, pos) AS flag_severity FROM {prefix}flags
        GROUP BY episode_id, type""",
        f"{prefix}flags",
    )
    _cte(
        f"{prefix}pairs",
        f"""SELECT episode_id, type, coalesce(n_gt, 0) AS n_gt,
        coalesce(n_flag, 0) AS n_flag, coalesce(gt_weight, 0) AS gt_weight,
        coalesce(n_high, 0) AS n_high, coalesce(n_medium, 0) AS n_medium,
        coalesce(n_low, 0) AS n_low, claim_cents, gt_severity, flag_severity,
        least(coalesce(n_gt, 0), coalesce(n_flag, 0)) AS tp
        FROM {prefix}gt_types FULL JOIN {prefix}flag_types USING (episode_id, type)""",
        f"{prefix}gt_types",
        f"{prefix}flag_types",
    )
    _cte(
        f"{prefix}sums",
        f"""SELECT episode_id, sum(n_gt) AS n_gt, sum(n_flag) AS n_flag,
        sum(n_high) AS n_high, sum(n_medium) AS n_medium, sum(n_low) AS n_low,
        sum(tp) AS tp, sum(n_flag - tp) AS fp, sum(n_gt - tp) AS fn,
        sum(gt_weight) AS gt_weight,
        sum(tp * {_case("gt_severity", fv.SEVERITY_WEIGHT, "1")}) AS tp_weight,
        sum(CASE WHEN gt_severity = flag_severity THEN tp ELSE 0 END) AS severity_matches,
        sum(CASE WHEN n_gt = 0 THEN n_flag ELSE 0 END) AS absent_flags,
        sum(CASE WHEN n_gt = 0 THEN claim_cents ELSE 0 END) AS penalty_cents,
        sum(CASE WHEN n_flag = 0 THEN n_gt ELSE 0 END) AS missed_rows,
        bool_or(n_high > 0) AND NOT bool_or(n_high > 0 AND n_flag > 0) AS missed_high
        FROM {prefix}pairs GROUP BY episode_id""",
        f"{prefix}pairs",
    )
    counts = ", ".join(
        f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}"
        for c in [
            "n_gt", "n_flag", "n_high", "n_medium", "n_low", "tp", "fp", "fn",
            "gt_weight", "tp_weight", "severity_matches", "absent_flags",
            "penalty_cents", "missed_rows",
        ]
    )
    _cte(
        f"{prefix}ends",
        f"""SELECT episode_id, verdict, remaining AS budget_remaining,
        CAST(total_budget AS BIGINT) AS total_budget, step AS steps, exhausted, forced,
        {compliance} AS gt_compliance, {counts},
        coalesce(missed_high, false) AS missed_high
        FROM {prefix}steps LEFT JOIN {prefix}sums USING (episode_id) WHERE done""",
        f"{prefix}steps",
        f"{prefix}sums",
    )
    p = "CAST(tp_weight AS DOUBLE) / CAST(tp_weight + fp AS DOUBLE)"
    r = "CAST(tp_weight AS DOUBLE) / CAST(gt_weight AS DOUBLE)"
    _cte(
        f"{prefix}parts",
        f"""SELECT *, CASE WHEN n_flag = 0
            THEN CASE WHEN gt_weight = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
            WHEN gt_weight = 0 OR tp_weight = 0 THEN 0.0::DOUBLE
            ELSE 2.0::DOUBLE * ({p}) * ({r}) / (({p}) + ({r})) END AS f1,
        CASE WHEN verdict = gt_compliance THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
            AS verdict_score,
        0.2::DOUBLE * CASE WHEN total_budget > 0 THEN CAST(budget_remaining AS DOUBLE)
            / CAST(total_budget AS DOUBLE) ELSE 0.0::DOUBLE END AS efficiency_score,
        0.02::DOUBLE * CAST(severity_matches AS DOUBLE) AS calibration_bonus,
        CAST(penalty_cents AS DOUBLE) / 100.0::DOUBLE AS fp_penalty
        FROM {prefix}ends""",
        f"{prefix}ends",
    )
    _cte(
        f"{prefix}raw",
        f"""SELECT *, 0.6::DOUBLE * f1 AS violation_score,
        verdict_score + 0.6::DOUBLE * f1 + efficiency_score + calibration_bonus
            - fp_penalty AS raw_total FROM {prefix}parts""",
        f"{prefix}parts",
    )
    _cte(
        f"{prefix}clamped",
        f"""SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN missed_high
        THEN least(raw_total, 0.3::DOUBLE) ELSE raw_total END)) AS c FROM {prefix}raw""",
        f"{prefix}raw",
    )
    _cte(
        f"{prefix}scored",
        f"""SELECT *, CASE WHEN c = 1 THEN 0.999::DOUBLE WHEN c = 0 THEN 0.001::DOUBLE
        ELSE c END AS total FROM {prefix}clamped""",
        f"{prefix}clamped",
    )
    _cte(
        f"{prefix}graded",
        f"SELECT *, {_round('total', 3)} AS final_score FROM {prefix}scored",
        f"{prefix}scored",
    )


_grade_chain("", "episode_id % 4 = 0", "gt")

# --- Rewards, reports, runs -------------------------------------------------------

_SHORT = f"""CASE WHEN start_turn IS NULL OR end_turn IS NULL THEN {_q(fv.MSG_READ_MISSING)}
    WHEN start_turn < 0 THEN printf({_q(fv.MSG_READ_NEGATIVE_SHORT)}, start_turn)
    WHEN end_turn >= n_turns THEN printf({_q(fv.MSG_READ_PAST_END)}, end_turn, n_turns - 1)
    WHEN start_turn > end_turn THEN printf({_q(fv.MSG_READ_REVERSED)}, start_turn, end_turn)
    ELSE printf({_q(fv.MSG_READ_TOO_LARGE_SHORT)}, end_turn - start_turn + 1) END"""
_FEEDBACK = f"""CASE WHEN exhausted
    THEN printf({_q(fv.FEEDBACK_EXHAUSTED)}, remaining, cost)
    WHEN error IS NOT NULL THEN 'Error: ' || CASE
        WHEN action_type = 'read_transcript_chunk' THEN {_SHORT} ELSE error END
    ELSE CASE action_type
        WHEN 'get_call_metadata' THEN {_q(fv.FEEDBACK_METADATA)}
        WHEN 'get_sentiment_timeline' THEN {_q(fv.FEEDBACK_SENTIMENT)}
        WHEN 'get_transcript_length' THEN {_q(fv.FEEDBACK_LENGTH)}
        WHEN 'read_transcript_chunk'
            THEN printf({_q(fv.FEEDBACK_READ)}, start_turn, end_turn)
        WHEN 'analyze_turn' THEN printf({_q(fv.FEEDBACK_ANALYZE)}, turn_index)
        WHEN 'flag_violation' THEN {_q(fv.FEEDBACK_FLAG)}
        WHEN 'submit_report' THEN {_q(fv.FEEDBACK_SUBMIT)}
        ELSE 'Unknown action_type: ' || action_type END END
    || CASE WHEN done OR remaining >= 5
             OR (action_type = 'read_transcript_chunk' AND error IS NOT NULL) THEN ''
        WHEN remaining >= 2 THEN {_q(fv.WARNING_FLAG_ONLY)}
        ELSE {_q(fv.WARNING_SUBMIT_NOW)} END"""
_cte(
    "rewarded",
    f"""SELECT s.*, {_FEEDBACK} AS feedback, final_score, CASE WHEN done
        THEN CASE WHEN s.exhausted THEN total - 0.1::DOUBLE ELSE total END
        ELSE CAST(cents AS DOUBLE) / 100.0::DOUBLE END AS reward,
    sum(cents) OVER (PARTITION BY episode_id ORDER BY step) AS paid
    FROM steps s JOIN (SELECT episode_id, total, final_score FROM graded)
    USING (episode_id)""",
    "graded",
)
_friendly = (
    "array_to_string(list_transform(string_split(type, '_'), "
    "lambda w: upper(w[1:1]) || w[2:]), ' ')"
)
_cte(
    "findings",
    f"""SELECT episode_id, 0 AS section, CAST(pos AS BIGINT) AS pos, {_friendly} AS finding,
    upper(severity) AS severity, hit AS detected,
    coalesce(description, {_q(fv.TEXT_NO_DESCRIPTION)}) AS detail,
    CASE WHEN hit THEN 'DETECTED' ELSE 'MISSED' END AS status
    FROM (SELECT *, (episode_id, type) IN (SELECT (episode_id, type) FROM flags) AS hit
          FROM gt)
    UNION ALL
    SELECT episode_id, 1, pos, {_friendly}, upper(severity), false,
    {_q(fv.TEXT_FALSE_POSITIVE)}, 'FALSE POSITIVE' FROM flags f
    WHERE NOT EXISTS (SELECT 1 FROM gt g WHERE g.episode_id = f.episode_id
                      AND g.type = f.type)""",
    "gt",
    "flags",
)
_cte(
    "advice",
    f"""SELECT episode_id, 0 AS section, pos,
    printf({_q(fv.REC_MISSED)}, finding) AS text FROM findings WHERE status = 'MISSED'
    UNION ALL SELECT episode_id, 1, 0, CASE WHEN gt_compliance THEN {_q(fv.REC_TOO_STRICT)}
        ELSE {_q(fv.REC_TOO_LAX)} END FROM graded WHERE verdict <> gt_compliance
    UNION ALL SELECT DISTINCT episode_id, 2, 0, {_q(fv.REC_PRECISION)} FROM findings
        WHERE status = 'FALSE POSITIVE'""",
    "findings",
    "graded",
)
_cte(
    "recommended",
    f"""SELECT episode_id, coalesce(r, {_q(fv.REC_NONE)})
    AS recommendations FROM graded LEFT JOIN (SELECT episode_id,
    string_agg(text, '|' ORDER BY section, pos) AS r FROM advice GROUP BY episode_id)
    USING (episode_id)""",
    "advice",
)
_cte(
    "routing",
    f"""SELECT episode_id, CASE WHEN gt_compliance THEN 'PASS' ELSE 'FAIL' END AS verdict,
    g.verdict = gt_compliance AS agent_verdict_correct,
    CASE WHEN gt_compliance THEN {_q(fv.TEXT_CLEAN)} ELSE printf({_q(fv.TEXT_RATIONALE)},
        n_gt, array_to_string(list_filter([
            CASE WHEN n_high > 0 THEN n_high || ' high-severity' END,
            CASE WHEN n_medium > 0 THEN n_medium || ' medium-severity' END,
            CASE WHEN n_low > 0 THEN n_low || ' low-severity' END],
            lambda x: x IS NOT NULL), ', ')) END AS verdict_rationale,
    CASE WHEN gt_compliance THEN {_q(fv.ROUTE_ARCHIVE)} WHEN n_high > 0
        THEN {_q(fv.ROUTE_ESCALATE)} ELSE {_q(fv.ROUTE_REVIEW)} END AS recommended_action,
    CAST(round_even(CAST(budget_remaining AS DOUBLE) / CAST(total_budget AS DOUBLE)
        * 100.0::DOUBLE, 0) AS BIGINT) AS triage_efficiency_pct,
    CASE WHEN gt_compliance THEN 0 ELSE 5 + 3 * n_gt END
        AS estimated_human_review_minutes FROM graded g""",
    "graded",
)
_cte(
    "runs",
    f"""SELECT 'model_' || episode_id % 3 AS model, CAST(episode_id // 3 % 3 + 1 AS INT)
    AS run, 'call_' || episode_id AS task_id,
    {_pick(inputs.DIFFICULTIES, "episode_id // 5 % 3")} AS difficulty,
    final_score AS score,
    CAST(58 + (episode_id * 37) % 682 AS DOUBLE) / 10.0::DOUBLE AS time_seconds, g.*
    FROM graded g""",
    "graded",
)


def _avg(condition: str) -> str:
    total = f"sum(CAST(round(score * 1000) AS BIGINT)) FILTER (WHERE {condition})"
    n = f"count(*) FILTER (WHERE {condition})"
    return (
        f"coalesce(CAST({total} AS DOUBLE) / 1000.0::DOUBLE "
        f"/ nullif(CAST({n} AS DOUBLE), 0), 0)"
    )


_TIME = "CAST(sum(CAST(round(time_seconds * 10) AS BIGINT)) AS DOUBLE) / 10.0::DOUBLE"
_cte(
    "summaries",
    f"""SELECT model, run, {_avg("difficulty = 'easy'")} AS easy_avg,
    {_avg("difficulty = 'medium'")} AS medium_avg,
    {_avg("difficulty = 'hard'")} AS hard_avg, {_avg("true")} AS overall_avg,
    {_TIME} AS total_time, count(*) AS tasks FROM runs GROUP BY model, run""",
    "runs",
)

_ACTION_TEXT = """action_type || '(' || array_to_string(list_filter([
    'turn_index=' || turn_index, 'start_turn=' || start_turn, 'end_turn=' || end_turn,
    'violation_type=' || violation_type, 'violation_severity=' || violation_severity,
    'compliance_pass=' || CASE WHEN forced THEN lower(CAST(compliance_pass AS VARCHAR))
        WHEN compliance_pass THEN 'True' ELSE CASE WHEN NOT compliance_pass THEN 'False' END
        END,
    'policy_hypothesis=' || policy_hypothesis], lambda x: x IS NOT NULL), ',') || ')'"""
_cte(
    "log",
    f"""SELECT episode_id, CAST(0 AS BIGINT) AS line_no,
    printf({_q(fv.LOG_START)}, CAST(episode_id AS VARCHAR), '{inputs.ENV}',
        '{inputs.MODEL}') AS line FROM graded
    UNION ALL
    SELECT episode_id, step, printf({_q(fv.LOG_STEP)}, step, {_ACTION_TEXT},
        {_money("reward")}, CAST(done AS VARCHAR), coalesce(error, 'null')) FROM rewarded
    UNION ALL
    SELECT episode_id, CAST(4611686018427387904 AS BIGINT), printf({_q(fv.LOG_END)},
        CAST(max(final_score) >= 0.5 AS VARCHAR), max(step),
        string_agg({_money("reward")}, ',' ORDER BY step))
    FROM rewarded GROUP BY episode_id""",
    "rewarded",
)
_cte(
    "log_fields",
    f"""SELECT episode_id, line_no, line AS raw, step, {_ACTION_TEXT} AS action,
    {_money("reward")} AS reward_text, done, error FROM log
    LEFT JOIN rewarded USING (episode_id) WHERE line_no = rewarded.step""",
    "log",
)

# --- Completions ------------------------------------------------------------------

_cte(
    "texts",
    f"""SELECT event_id, event_id % 12 AS task, n_turns,
    coalesce(CAST(start_turn AS VARCHAR), '2') AS s,
    coalesce(CAST(end_turn AS VARCHAR), '2') AS e,
    coalesce(violation_type, {_pick(fv.VIOLATION_TYPES, "event_id % 6")}) AS vt,
    {_pick(fv.SEVERITIES, "event_id % 3")} AS vs FROM acts""",
    "acts",
)
# The calls each text was built from, in text order, without the invalid ones.
_NO_ARGS = """CAST(NULL AS INT) AS turn_index, CAST(NULL AS INT) AS start_turn,
    CAST(NULL AS INT) AS end_turn, CAST(NULL AS VARCHAR) AS violation_type,
    CAST(NULL AS VARCHAR) AS violation_severity, CAST(NULL AS BOOLEAN) AS compliance_pass,
    CAST(NULL AS VARCHAR) AS policy_hypothesis"""
_cte(
    "parsed",
    f"""SELECT event_id AS completion_id, 0 AS nth, 'get_call_metadata' AS action_type,
        {_NO_ARGS} FROM texts
    UNION ALL BY NAME
    SELECT event_id AS completion_id, 1 AS nth, 'read_transcript_chunk' AS action_type,
        CAST(s AS INT) AS start_turn, CAST(e AS INT) AS end_turn FROM texts
    UNION ALL BY NAME
    SELECT event_id AS completion_id, 2 AS nth, 'flag_violation' AS action_type,
        vt AS violation_type, vs AS violation_severity FROM texts
    UNION ALL BY NAME
    SELECT event_id AS completion_id,
        3 + CAST(event_id % 5 = 0 AS INT) AS nth, 'analyze_turn' AS action_type,
        1 AS turn_index, 'failed_escalation' AS policy_hypothesis FROM texts
        WHERE event_id % 7 <> 0
    UNION ALL BY NAME
    SELECT event_id AS completion_id, 4 + CAST(event_id % 5 = 0 AS INT) AS nth,
        'submit_report' AS action_type, event_id % 3 = 0 AS compliance_pass FROM texts
        WHERE event_id % 3 < 2
    UNION ALL BY NAME
    SELECT event_id AS completion_id, 5 + CAST(event_id % 5 = 0 AS INT) AS nth,
        'get_call_metadata' AS action_type FROM texts WHERE event_id % 3 = 1""",
    "texts",
)
_cte(
    "c_acts",
    """SELECT p.* RENAME (completion_id AS episode_id, nth AS seq), n_turns
    FROM parsed p JOIN texts ON event_id = completion_id""",
    "parsed",
)
_replay_chain("c_", "c_acts", "seq")
_cte(
    "c_gt",
    f"""SELECT event_id AS episode_id, g.* EXCLUDE (episode_id)
    FROM texts JOIN ({_truth_of("event_id % 12 FROM events")}) g ON g.episode_id = task""",
    "texts",
)
_grade_chain("c_", "episode_id % 12 % 4 = 0", "c_gt")


# --- Final queries ----------------------------------------------------------------

_BREAKDOWN = ", ".join(
    f"{_round(c, 3)} AS {alias}"
    for c, alias in [
        ("verdict_score", "compliance_correct"),
        ("violation_score", "violation_f1_weighted"),
        ("efficiency_score", "efficiency_bonus"),
        ("calibration_bonus", "severity_calibration_bonus"),
        ("fp_penalty", "false_positive_penalty"),
    ]
)
_EXHAUSTED = """SELECT episode_id, step AS steps, CAST(total_budget AS BIGINT) AS total_budget,
    CAST(total_budget - remaining AS BIGINT) AS spent, remaining AS budget_remaining,
    exhausted, forced"""


def _grades(*columns: str) -> str:
    return _sql(f"SELECT episode_id, {', '.join(columns)} FROM graded", "graded")


def _census(origin: str, part: str, source: str) -> str:
    counts = []
    text = "text"
    stages = [
        ("ssn", fv.SSN_FULL, fv.TOKEN_SSN, ""),
        (
            "ssn_last4",
            f"({fv.SSN_LAST4_PREFIX}){fv.SSN_LAST4_DIGITS}",
            "\\1" + fv.TOKEN_SSN,
            "i",
        ),
        ("phone", fv.PHONE, fv.TOKEN_PHONE, ""),
        ("account", fv.ACCOUNT, fv.TOKEN_ACCOUNT, ""),
        ("email", fv.EMAIL, fv.TOKEN_EMAIL, ""),
    ]
    for kind, pattern, token, flag in stages:
        shown = f"(?i){pattern}" if flag else pattern
        counts.append(
            f"CAST(sum(len(regexp_extract_all({text}, {_q(shown)}))) AS BIGINT) AS {kind}"
        )
        text = f"regexp_replace({text}, {_q(pattern)}, {_q(token)}, {_q('g' + flag)})"
    return (
        f"SELECT '{origin}' AS origin, {part} AS part, {', '.join(counts)} "
        f"FROM {source} GROUP BY {part}"
    )


def _confusion(keys: str, source: str) -> str:
    return f"""SELECT {keys}, finding,
    count(*) FILTER (WHERE status <> 'FALSE POSITIVE') AS support,
    count(*) FILTER (WHERE status = 'DETECTED') AS detected,
    count(*) FILTER (WHERE status = 'FALSE POSITIVE') AS false_positives
    FROM {source} GROUP BY {keys}, finding"""


def _first_pos(condition: str, alias: str) -> str:
    return f"min(pos) FILTER (WHERE {condition}) AS {alias}"


def _has(pattern: str) -> str:
    return f"regexp_matches(lower(text), {_q(pattern)})"


_REPLY = """lower(CASE WHEN speaker = 'customer' THEN text
    WHEN after_speaker = 'customer' THEN after_text ELSE '' END)"""
_CONFUSED = f"regexp_matches({_REPLY}, {_q(fv.SCREEN_CONFUSED)})"
_GAP = "silence_gap_before_seconds"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["turns_base"] = _sql("SELECT * FROM turns", "turns")
    sql["gt_base"] = _sql("SELECT * FROM gt", "gt")
    sql["src_calls"] = _sql(
        "SELECT * REPLACE (CAST(call_id AS VARCHAR) AS call_id, CAST(pos AS INT) AS pos) "
        "FROM turns",
        "turns",
    )
    sql["src_truth"] = (
        "WITH placed AS (SELECT conv_id // 3 AS call_id FROM conversations) "
        "SELECT * REPLACE (CAST(episode_id AS VARCHAR) AS episode_id) FROM "
        f"({_truth_of('call_id FROM placed')})"
    )
    sql["src_call_metadata"] = _sql(
        """SELECT CAST(call_id AS VARCHAR) AS call_id, difficulty, department, call_reason,
        call_duration_seconds, 'Call about a ' || call_reason AS call_summary,
        call_id % 4 = 0 AS gt_compliance, n_turns,
        CAST(CASE WHEN call_id % 5 < 2 THEN call_id % 3 + 1 ELSE 0 END AS INT) AS n_shifts
        FROM calls""",
        "calls",
    )
    sql["src_run_results"] = _sql(
        f"""SELECT model AS display, run, task_id, difficulty, score, time_seconds,
        {_round("violation_score", 3)} AS violation_f1_weighted,
        missed_high AS auto_fail_applied, tp AS true_positives, budget_remaining
        FROM runs""",
        "runs",
    )
    sql["sink_run_results"] = _sql(
        f"SELECT '{inputs.ENV}' AS benchmark, * FROM summaries", "summaries"
    )
    sql["dim_rubric"] = _sql(
        """SELECT rubric.*, count(event_id) AS flags FROM rubric LEFT JOIN
        (SELECT * FROM errors WHERE action_type = 'flag_violation' AND error IS NULL)
        ON violation_type = policy GROUP BY ALL""",
        "rubric",
        "errors",
    )
    base = _case("action_type", fv.ACTION_COST, "5")
    sql["dim_costs"] = _sql(
        f"""SELECT action_type, CAST({base} AS INT) AS base_cost, count(*) AS actions
        FROM acts GROUP BY action_type""",
        "acts",
    )
    severities = ", ".join(
        f"({_q(s)}, {fv.SEVERITY_WEIGHT[s]}, {fv.FALSE_POSITIVE_CENTS[s]})"
        for s in fv.SEVERITIES
    )
    sql["dim_severity"] = _sql(
        f"""SELECT severity, weight, penalty_cents, count(event_id) AS flags
        FROM (VALUES {severities}) d(severity, weight, penalty_cents) LEFT JOIN errors
        ON action_type = 'flag_violation' AND error IS NULL
        AND coalesce(violation_severity, 'low') = severity GROUP BY ALL""",
        "errors",
    )
    tasks = ", ".join(f"({_q(t)}, {_q(d)})" for t, d in fv.TASKS)
    sql["dim_tasks"] = f"""SELECT task_id, difficulty, count(event_id) AS completions
        FROM (VALUES {tasks}) d(task_id, difficulty) LEFT JOIN events
        ON printf('call_%03d', event_id % 12 + 1) = task_id GROUP BY ALL"""
    sql["call_metadata"] = _sql(
        """SELECT call_id, difficulty, department, call_reason, call_duration_seconds,
        'Call about a ' || call_reason AS call_summary, n_turns AS total_turns FROM calls""",
        "calls",
    )
    sql["list_tasks"] = _sql(
        "SELECT call_id AS task_id, difficulty FROM calls", "calls"
    )
    sql["sentiment_timeline"] = _sql(
        f"""SELECT call_id, CAST(i - 1 AS INT) AS shift_pos,
        CAST(i * 2 AS VARCHAR) AS turn_index,
        CASE WHEN i IS NOT NULL THEN {_pick(inputs.MOODS, "(call_id + i) % 3")} END
            AS to_mood
        FROM calls LEFT JOIN range(1, 4) r(i) ON call_id % 5 < 2 AND i <= call_id % 3 + 1""",
        "calls",
    )
    sql["transcript_length"] = _sql(
        """SELECT call_id, n_turns AS total_turns,
        printf('0 to %d (inclusive)', n_turns - 1) AS valid_turn_indices,
        CAST(5 AS INT) AS max_chunk_size FROM calls""",
        "calls",
    )
    sql["episode_budget"] = _sql(
        "SELECT call_id, n_turns, CAST(50 + 3 * n_turns AS INT) AS total_budget FROM calls",
        "calls",
    )
    sql["episode_start"] = _sql(
        f"""SELECT call_id, printf({_q(fv.MSG_LOADED)}, CAST(call_id AS VARCHAR), n_turns,
        department, 50 + 3 * n_turns) AS result, {_q(fv.FEEDBACK_RESET)} AS feedback,
        CAST(50 + 3 * n_turns AS BIGINT) AS total_budget FROM calls""",
        "calls",
    )
    sql["validate_reads"] = _sql(
        "SELECT *, error IS NULL AS is_valid FROM checked_reads", "checked_reads"
    )
    sql["read_chunks"] = _sql(
        """SELECT t.call_id, t.pos, request_id, start_turn, end_turn,
        n_turns AS total_turns, turn_index, speaker, text, ts_start, ts_end
        FROM checked_reads r JOIN clean_turns t
        ON t.call_id = r.call_id AND t.pos BETWEEN start_turn AND end_turn
        WHERE error IS NULL""",
        "checked_reads",
        "clean_turns",
    )
    sql["turn_context"] = _sql("SELECT * EXCLUDE (text, n) FROM context", "context")
    sql["silence_gaps"] = _sql(f"SELECT call_id, pos, {_GAP} FROM context", "context")
    sql["turn_position"] = _sql(
        "SELECT call_id, pos, speaker_turn_position FROM context", "context"
    )
    sql["analyze_turns"] = _sql(
        f"""SELECT request_id, a.call_id, asked_index, CASE WHEN asked_index IS NULL
            THEN {_q(fv.MSG_TURN_MISSING)} WHEN asked_index < 0 OR asked_index >= n_turns
            THEN printf({_q(fv.MSG_TURN_RANGE)}, asked_index, n_turns - 1) END AS error,
        speaker, text, before_text, after_text, {_GAP}, speaker_turn_position, policy,
        {_POLICY_ERROR} FROM asks a JOIN calls USING (call_id)
        LEFT JOIN clean_context c ON c.call_id = a.call_id AND c.pos = asked_index
        LEFT JOIN rubric ON policy = policy_hypothesis""",
        "asks",
        "calls",
        "clean_context",
        "rubric",
    )
    sql["rubric_lookup"] = _sql(
        f"""SELECT request_id, policy_hypothesis, definition, severity_guide, indicators,
        {_POLICY_ERROR} FROM asks LEFT JOIN rubric ON policy = policy_hypothesis""",
        "asks",
        "rubric",
    )
    sql["screen_hold_gaps"] = _sql(
        f"""SELECT call_id, pos, {_GAP} AS gap_seconds, {_CONFUSED} AS customer_confused,
        speaker = 'agent' AND {_has(fv.SCREEN_APOLOGY)} AS agent_apologised,
        CASE WHEN {_CONFUSED} OR {_GAP} >= 30 THEN 'medium' ELSE 'low' END AS severity
        FROM context WHERE {_GAP} >= 5 AND NOT coalesce(CASE before_speaker
            WHEN 'customer' THEN regexp_matches(lower(before_text), {_q(fv.SCREEN_CUSTOMER_PAUSE)})
            WHEN 'agent' THEN regexp_matches(lower(before_text), {_q(fv.SCREEN_HOLD_ASKED)}) END, false)""",
        "context",
    )
    agent = "speaker = 'agent'"
    sql["screen_rubric"] = _sql(
        f"""SELECT call_id, NOT arg_min({_has(fv.SCREEN_DISCLOSURE)}, pos)
            FILTER (WHERE {agent}) AS disclosure_missing,
        CASE WHEN {_pick(inputs.DEPARTMENTS, "call_id % 4")} = {_q(fv.COLLECTIONS)}
            THEN NOT arg_min({_has(fv.SCREEN_DEBT_DISCLOSURE)}, pos)
            FILTER (WHERE {agent}) END AS debt_disclosure_missing,
        {_first_pos(f"speaker = 'customer' AND {_has(fv.SCREEN_SUPERVISOR_REQUEST)}",
                    "supervisor_request_pos")},
        {_first_pos(f"{agent} AND {_has(fv.SCREEN_DEFLECTION)}", "deflection_pos")},
        {_first_pos(f"{agent} AND {_has(fv.SCREEN_COMMITMENT)} "
                    f"AND NOT {_has(fv.SCREEN_HEDGE)}", "commitment_pos")},
        {_first_pos(f"{agent} AND {_has(fv.SCREEN_FULL_SSN)} "
                    f"AND NOT {_has(fv.SCREEN_LAST_FOUR)}", "full_ssn_pos")},
        {_first_pos(f"{agent} AND {_has(fv.SCREEN_DISCOUNT)} "
                    f"AND NOT {_has(fv.SCREEN_DISCOUNT_OK)}", "discount_pos")}
        FROM turns GROUP BY call_id""",
        "turns",
    )
    sql["redact_structured"] = f"""SELECT 'documents' AS origin, doc_id AS id,
        {_redact("text")} AS text FROM documents
        UNION ALL SELECT 'pages', page_id, {_redact("html")} FROM pages"""
    sql["redact_names"] = _sql(
        "SELECT call_id, pos, text FROM clean_turns", "clean_turns"
    )
    sql["extract_entities"] = _sql(
        "SELECT call_id, name, token FROM entities", "entities"
    )
    sql["pii_census"] = _sql(
        _census("documents", "source", "documents")
        + " UNION ALL "
        + _census("turns", "speaker", "turns"),
        "turns",
    )
    sql["action_costs"] = _sql(
        """SELECT event_id, action_type, error, CAST(cost AS BIGINT) AS cost FROM priced
        WHERE NOT forced""",
        "priced",
    )
    sql["validate_flags"] = _sql(
        """SELECT event_id, violation_type, coalesce(violation_severity, 'low') AS severity,
        error FROM errors WHERE action_type = 'flag_violation'""",
        "errors",
    )
    sql["replay_steps"] = _sql(
        """SELECT episode_id, step, event_id, recorded_action, CAST(cost AS BIGINT) AS cost,
        error, remaining, done, reward, CAST(paid AS DOUBLE) / 100.0::DOUBLE
        + CASE WHEN done THEN reward ELSE 0.0::DOUBLE END AS cumulative_reward, feedback
        FROM rewarded""",
        "rewarded",
    )
    running = "OVER (PARTITION BY episode_id ORDER BY step)"

    def so_far(condition: str) -> str:
        return f"count(*) FILTER (WHERE {condition}) {running}"

    sql["replay_checklist"] = _sql(
        f"""SELECT episode_id, step,
        {so_far("recorded_action = 'get_call_metadata'")} > 0 AS metadata_reviewed,
        {so_far("recorded_action = 'get_sentiment_timeline'")} > 0 AS sentiment_checked,
        {so_far("recorded_action = 'read_transcript_chunk'")} AS transcript_chunks_read,
        {so_far("recorded_action = 'analyze_turn'")} AS turns_analyzed,
        {so_far("is_flag")} AS violations_flagged, done AS report_submitted,
        CAST(round_even(CAST(100 * remaining AS DOUBLE) / CAST(total_budget AS DOUBLE), 0)
            AS BIGINT) AS budget_remaining_pct,
        remaining AS budget_remaining_units, CAST(total_budget AS BIGINT) AS total_budget
        FROM steps""",
        "steps",
    )
    level = _pick(inputs.DIFFICULTIES, "episode_id // 5 % 3")
    sql["episode_state"] = _sql(
        f"""SELECT episode_id, {level} AS difficulty, max(step) AS step_count,
        CAST(max(total_budget) AS BIGINT) AS total_budget,
        min(remaining) AS budget_remaining, bool_or(done) AS done,
        CAST(max(paid) FILTER (WHERE done) AS DOUBLE) / 100.0::DOUBLE
            + max(reward) FILTER (WHERE done) AS cumulative_reward,
        string_agg(recorded_action, ',' ORDER BY step) AS actions_taken,
        coalesce(string_agg(violation_type || ':'
            || coalesce(CAST(turn_index AS VARCHAR), '-') || ':'
            || coalesce(violation_severity, 'low'), ',' ORDER BY step)
            FILTER (WHERE is_flag), '') AS flagged_violations
        FROM rewarded GROUP BY episode_id""",
        "rewarded",
    )
    sql["budget_exhausted"] = _sql(f"{_EXHAUSTED} FROM steps WHERE done", "steps")
    sql["forced_submission"] = _sql(
        f"{_EXHAUSTED} FROM open_steps WHERE done", "open_steps"
    )
    sql["grade_match"] = _sql(
        """SELECT episode_id, type, n_gt, n_flag, tp, n_flag - tp AS fp, n_gt - tp AS fn
        FROM pairs""",
        "pairs",
    )
    sql["grade_weights"] = _grades("tp_weight", "gt_weight")
    sql["grade_f1"] = _grades("f1", "violation_score")
    sql["grade_calibration"] = _grades("severity_matches", "calibration_bonus")
    sql["grade_fp_penalty"] = _grades("absent_flags", "penalty_cents")
    sql["grade_autofail"] = _grades("missed_high", "raw_total", "total")
    sql["grade_episodes"] = _grades(
        "verdict_score", "violation_score", "efficiency_score", "calibration_bonus",
        "fp_penalty", "missed_high", "total", "final_score",
    )
    sql["grade_breakdown"] = _grades(
        "final_score", _BREAKDOWN, "missed_high AS auto_fail_applied",
        "tp AS true_positives", "fp AS false_positives", "fn AS false_negatives",
        "severity_matches", "n_gt AS ground_truth_count", "n_flag AS agent_flagged_count",
        "budget_remaining", "total_budget", "missed_high AS missed_high_severity",
    )
    sql["score_completions"] = _sql(
        """SELECT episode_id AS completion_id, steps, tp, fp, final_score
        FROM c_graded""",
        "c_graded",
    )
    sql["parse_completions"] = _sql("SELECT * FROM parsed", "parsed")
    sql["coerce_tool_args"] = _sql(
        """SELECT event_id, action_type,
        CASE WHEN event_id % 17 > 0 THEN turn_index END AS turn_index,
        CASE WHEN event_id % 17 > 0 AND event_id % 5 > 0 THEN start_turn END AS start_turn,
        CASE WHEN event_id % 17 > 0 AND event_id % 7 > 0 THEN end_turn END AS end_turn,
        CASE WHEN event_id % 17 > 0 THEN coalesce(violation_type, '') END
            AS violation_type, CAST(NULL AS VARCHAR) AS violation_severity,
        CASE WHEN event_id % 17 > 0 THEN event_id % 4 < 3 END AS compliance_pass,
        CAST(NULL AS VARCHAR) AS policy_hypothesis FROM acts""",
        "acts",
    )
    sql["report_findings"] = _sql("SELECT * FROM findings", "findings")
    sql["report_recommendations"] = _sql("SELECT * FROM recommended", "recommended")
    sql["report_routing"] = _sql(
        "SELECT * EXCLUDE (verdict_rationale) FROM routing", "routing"
    )
    sql["report_rationale"] = _sql(
        "SELECT episode_id, verdict_rationale FROM routing", "routing"
    )
    sql["draft_reports"] = _sql(
        """SELECT routing.*, coalesce(f, '') AS findings, recommendations
        FROM routing JOIN recommended USING (episode_id) LEFT JOIN (SELECT episode_id,
        string_agg(finding || '/' || severity || '/' || status || '/' || detail, '|'
            ORDER BY section, pos) AS f FROM findings GROUP BY episode_id)
        USING (episode_id)""",
        "routing",
        "recommended",
        "findings",
    )
    sql["review_queue"] = _sql(
        """SELECT recommended_action, count(*) AS calls,
        CAST(sum(estimated_human_review_minutes) AS BIGINT) AS review_minutes
        FROM routing GROUP BY recommended_action""",
        "routing",
    )
    sql["type_confusion"] = _sql(
        _confusion("difficulty", f"(SELECT *, {level} AS difficulty FROM findings)"),
        "findings",
    )
    both = f"""SELECT lang, source, toxic = 1 AS t, quality = 0 AS q,
        {_redact("text")} <> text AS st, n_chars < 500 AS sq
        FROM labels JOIN documents USING (doc_id)"""
    statuses = (
        "CASE WHEN {t} AND {s} THEN 'DETECTED' WHEN {t} THEN 'MISSED' "
        "ELSE 'FALSE POSITIVE' END"
    )
    sql["document_confusion"] = _confusion(
        "lang, source",
        f"""(SELECT lang, source, 'Toxic' AS finding,
            {statuses.format(t="t", s="st")} AS status FROM ({both}) WHERE t OR st
        UNION ALL SELECT lang, source, 'Low Quality',
            {statuses.format(t="q", s="sq")} FROM ({both}) WHERE q OR sq)""",
    )
    sql["tier_dashboard"] = _sql(
        f"""SELECT model, coalesce(difficulty, 'overall') AS difficulty, count(*) AS tasks,
        {_avg("true")} AS avg_score, min(score) AS min_score, max(score) AS max_score,
        {_TIME} AS total_time FROM runs
        GROUP BY GROUPING SETS ((model, difficulty), (model))""",
        "runs",
    )
    sql["run_summary"] = _sql("SELECT * EXCLUDE (tasks) FROM summaries", "summaries")
    sql["success_rate"] = _sql(
        """SELECT difficulty, count(*) AS episodes,
        count(*) FILTER (WHERE final_score >= 0.5) AS successes,
        CAST(sum(steps) AS BIGINT) AS steps FROM runs GROUP BY difficulty""",
        "runs",
    )
    sql["episode_success"] = _sql(
        """SELECT episode_id, difficulty, final_score, final_score >= 0.5 AS success,
        steps FROM runs""",
        "runs",
    )
    sql["model_run_summary"] = _sql(
        """SELECT m.model, CAST(r AS INT) AS run, s.* EXCLUDE (model, run, tasks),
        s.run IS NOT NULL AS success,
        CASE WHEN s.run IS NULL THEN 'output file not generated' END AS error
        FROM (SELECT 'model_' || i AS model FROM range(0, 4) t(i)) m
        JOIN range(1, 5) g(r) ON true
        LEFT JOIN summaries s ON s.model = m.model AND s.run = r""",
        "summaries",
    )
    sql["emit_run_log"] = _sql("SELECT * FROM log", "log")
    sql["parse_run_log"] = _parse_oracle(cut=False)
    sql["parse_cut_log"] = _parse_oracle(cut=True)
    sql["stream_redact"] = f"SELECT doc_id, {_redact('text')} AS text FROM documents"
    sql["stream_budget_meter"] = _sql(
        """SELECT episode_id, epoch_us(ts) AS major, event_id AS minor, action_type, step,
        remaining, exhausted, done, false AS late FROM steps WHERE NOT forced""",
        "steps",
    )
    return sql


def _parse_oracle(cut: bool) -> str:
    """What the parser should find: fields that the cut leaves whole, nothing else."""
    limit = "CASE WHEN episode_id % 3 = 0 THEN 110 ELSE 1000000 END" if cut else "1000000"
    lost = "WHERE episode_id % 10 > 0" if cut else ""
    task = "CASE WHEN episode_id % 10 > 0 THEN CAST(episode_id AS VARCHAR) END"
    if not cut:
        task = "CAST(episode_id AS VARCHAR)"
    shown = "source, episode, episode_id AS chunk, " if cut else ""
    heads = f"""SELECT episode_id, step, done, error, reward, {_ACTION_TEXT} AS action_text,
        {limit} AS width,
        length(printf('[STEP] step=%d action=%s reward=', step, {_ACTION_TEXT})) AS to_reward,
        length({_money("reward")} || ' done=') AS to_done,
        length(CAST(done AS VARCHAR) || ' error=') AS to_error FROM rewarded"""
    ranked = f"""SELECT DISTINCT episode_id, CAST(episode_id // 16 AS VARCHAR) AS source,
        dense_rank() OVER (PARTITION BY episode_id // 16 ORDER BY episode_id) - 1
        AS episode, {task} AS task FROM graded"""
    nothing = """CAST(NULL AS INT) AS step, CAST(NULL AS VARCHAR) AS action,
        CAST(NULL AS DOUBLE) AS reward, CAST(NULL AS BOOLEAN) AS done,
        CAST(NULL AS VARCHAR) AS error, CAST(NULL AS BOOLEAN) AS success,
        CAST(NULL AS INT) AS steps, CAST(NULL AS DOUBLE) AS score,
        CAST(NULL AS VARCHAR) AS rewards, CAST(NULL AS VARCHAR) AS _corrupt"""
    return _sql(
        f"""SELECT {shown}kind, step, action, reward, done,
            error, success, steps, score, rewards, _corrupt, task FROM (
        SELECT episode_id, 'START' AS kind, {nothing} FROM graded {lost}
        UNION ALL BY NAME
        SELECT episode_id, 'STEP' AS kind, CAST(step AS INT) AS step,
            CASE WHEN to_reward <= width THEN action_text END AS action,
            CASE WHEN to_reward + to_done <= width
                 THEN CAST({_money("reward")} AS DOUBLE) END AS reward,
            CASE WHEN to_reward + to_done + to_error <= width THEN done END AS done,
            CASE WHEN to_reward + to_done + to_error < width
                 THEN left(error, width - to_reward - to_done - to_error) END AS error
        FROM ({heads})
        UNION ALL BY NAME
        SELECT episode_id, 'END' AS kind, max(final_score) >= 0.5 AS success,
            CAST(max(step) AS INT) AS steps,
            string_agg({_money("reward")}, ',' ORDER BY step) AS rewards
        FROM rewarded GROUP BY episode_id) JOIN ({ranked}) USING (episode_id)""",
        "rewarded",
    )
