"""Fixed values.

Everything in this file is a value that results depend on (names, prices,
weights, patterns, message formats). It is data, not logic: other modules read
it and hold no constants of their own.
"""

# --- Fixed values: violation types, in rubric order -------------------------
VIOLATION_TYPES = [
    "regulatory_disclosure_failure",
    "failed_escalation",
    "unauthorized_commitment",
    "incorrect_hold_procedure",
    "pii_exposure_risk",
    "churn_save_policy_breach",
]

# --- Fixed values: risk category of each violation type ----------------------
VIOLATION_CATEGORY = {
    "regulatory_disclosure_failure": "Legal",
    "failed_escalation": "Legal",
    "unauthorized_commitment": "Revenue",
    "incorrect_hold_procedure": "Operational",
    "pii_exposure_risk": "Legal",
    "churn_save_policy_breach": "Revenue",
}

# --- Fixed values: severities, F1 weights, penalties in hundredths ----------
SEVERITIES = ["high", "medium", "low"]
SEVERITY_WEIGHT = {"high": 3, "medium": 2, "low": 1}
DEFAULT_SEVERITY_WEIGHT = 1
FALSE_POSITIVE_CENTS = {"high": 10, "medium": 5, "low": 3}
DEFAULT_FALSE_POSITIVE_CENTS = 5

# --- Fixed values: score composition ----------------------------------------
VERDICT_POINTS = 0.2
VIOLATION_POINTS = 0.6
EFFICIENCY_POINTS = 0.2
CALIBRATION_POINTS = 0.02
AUTO_FAIL_CAP = 0.30
PERFECT_SCORE_SHOWN_AS = 0.999
ZERO_SCORE_SHOWN_AS = 0.001
SUCCESS_SCORE = 0.5

# --- Fixed values: action prices and rewards (hundredths) -------------------
ACTION_COST = {
    "get_call_metadata": 5,
    "get_sentiment_timeline": 5,
    "get_transcript_length": 1,
    "read_transcript_chunk": 3,
    "analyze_turn": 10,
    "flag_violation": 2,
    "submit_report": 0,
}
UNKNOWN_ACTION_COST = 5
LOW_BUDGET_BELOW = 5
BUDGET_BASE = 50
BUDGET_PER_TURN = 3
MAX_CHUNK_TURNS = 5
REWARD_CENTS = {
    "get_call_metadata": 5,
    "get_sentiment_timeline": 5,
    "get_transcript_length": 2,
    "read_transcript_chunk": 2,
    "analyze_turn": 2,
    "flag_violation": 0,
    "submit_report": 0,
}
INVALID_REWARD_CENTS = -2
UNKNOWN_REWARD_CENTS = -5
EXHAUSTED_PENALTY = 0.10
AUTO_SUBMIT_NAME = "auto_submit_budget_exhausted"
ACTION_FIELDS = [
    "turn_index",
    "start_turn",
    "end_turn",
    "violation_type",
    "violation_severity",
    "compliance_pass",
    "policy_hypothesis",
]

# --- Fixed values: messages (printf formats) --------------------------------
MSG_READ_MISSING = "Provide start_turn and end_turn parameters."
MSG_READ_NEGATIVE = "start_turn %d must be non-negative. Valid indices: [0, %d]."
MSG_READ_NEGATIVE_SHORT = "start_turn %d must be non-negative."
MSG_READ_PAST_END = "Turn %d doesn't exist. Last valid turn is %d."
MSG_READ_REVERSED = "start_turn (%d) cannot exceed end_turn (%d)."
MSG_READ_TOO_LARGE = "Chunk too large (%d turns). Maximum 5 turns per read."
MSG_READ_TOO_LARGE_SHORT = "Chunk too large (%d turns). Maximum 5."
MSG_TURN_MISSING = "Provide turn_index parameter."
MSG_TURN_RANGE = "turn_index %d out of range [0, %d]."
MSG_FLAG_MISSING = "Provide violation_type parameter."
MSG_FLAG_TYPE = "Invalid violation_type '%s'. Valid: %s"
MSG_FLAG_SEVERITY = "Invalid violation_severity. Must be high, medium, or low."
MSG_POLICY_UNKNOWN = "Unknown policy: '%s'. Valid policies: %s"
MSG_LENGTH_RANGE = "0 to %d (inclusive)"

MSG_LOADED = "Loaded call %s | %d turns | Department: %s | Compute budget: %d units"
FEEDBACK_RESET = "Environment reset. Use get_call_metadata to begin your audit."
FEEDBACK_METADATA = "Metadata returned. Review before reading transcript."
FEEDBACK_SENTIMENT = (
    "Sentiment timeline returned. Use hotspots to target your investigation."
)
FEEDBACK_LENGTH = "Transcript length returned. Use this to plan your read ranges."
FEEDBACK_READ = "Transcript chunk returned (turns %d-%d)."
FEEDBACK_ANALYZE = "Contextual analysis of turn %d complete."
FEEDBACK_FLAG = "Violation flagged. Score determined at submission."
FEEDBACK_SUBMIT = "Report submitted. Episode complete."
FEEDBACK_UNKNOWN = "Unknown action_type: %s"
FEEDBACK_ERROR = "Error: %s"
FEEDBACK_EXHAUSTED = (
    "Budget exhausted (%d remaining, action costs %d). Auto-submitting with penalty."
)
WARNING_FLAG_ONLY = (
    " ⚠ Budget critically low. Only flagging and submission remain affordable."
)
WARNING_SUBMIT_NOW = " ⚠ Budget exhausted. Submit your report now."

# --- Fixed values: report texts ---------------------------------------------
TEXT_CLEAN = "No compliance violations detected in this call."
TEXT_RATIONALE = "%d violation(s) identified: %s."
TEXT_NO_DESCRIPTION = "No description available."
TEXT_FALSE_POSITIVE = (
    "Agent flagged this violation but it does not exist in ground truth."
)
REC_MISSED = "Review detection methodology for '%s' violations."
REC_TOO_STRICT = (
    "Calibrate compliance verdict — this call was actually compliant."
)
REC_TOO_LAX = (
    "Tighten compliance threshold — violations were present but verdict was 'pass'."
)
REC_PRECISION = (
    "Reduce false positive rate — review flagging criteria for precision."
)
REC_NONE = "Audit performance meets quality standards. No corrective action needed."
ROUTE_ESCALATE = (
    "ESCALATE — High-severity regulatory violation(s) require immediate QA "
    "supervisor review and sign-off."
)
ROUTE_REVIEW = (
    "REVIEW — Medium/low-severity findings require QA supervisor review."
)
ROUTE_ARCHIVE = (
    "ARCHIVE — No violations detected. Safe to archive without further review."
)
REVIEW_BASE_MINUTES = 5
REVIEW_MINUTES_PER_VIOLATION = 3

# --- Fixed values: redaction patterns and tokens, in order of application ----
SSN_FULL = r"\b\d{3}[-\s]\d{2}[-\s]\d{4}\b"
SSN_LAST4_PREFIX = (
    r"(?:SSN|social(?:\s+security)?(?:\s+number)?"
    r"|last\s+four(?:\s+digits)?(?:\s+of\s+(?:my|your|the)\s+)?"
    r"(?:SSN|social(?:\s+security)?(?:\s+number)?)?)"
    r"[\s:]*(?:is\s+|are\s+)?"
)
SSN_LAST4_DIGITS = r"\d{4}\b"
PHONE = r"(?:\(\d{3}\)\s*|\b\d{3}[-.])\d{3}[-.]?\d{4}\b"
ACCOUNT = r"\b\d{4}(?:[-\s]\d{4}){1,3}\b"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
TOKEN_SSN = "[SSN_REDACTED]"
TOKEN_PHONE = "[PHONE_REDACTED]"
TOKEN_ACCOUNT = "[ACCOUNT_NUMBER]"
TOKEN_EMAIL = "[EMAIL_REDACTED]"
TOKEN_AGENT = "[AGENT_NAME]"
TOKEN_CUSTOMER = "[CUSTOMER_NAME]"

# --- Fixed values: name introductions ---------------------------------------
NAME = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)"
INTRO_SELF = r"(?:[Mm]y name is|I'm|I am)\s+" + NAME
INTRO_THIS_IS = r"(?:^|[.!?]\s+|,\s+)[Tt]his is\s+" + NAME
NOT_A_NAME = ["Acme", "Financial", "Services", "Thank", "Hello", "Sure"]
INTRO_TURNS = 8

# --- Fixed values: tool calls in completions and log lines ------------------
TOOL_CALL = r"(\w+)\(([^)]*)\)"
LOG_START = "[START] task=%s env=%s model=%s"
LOG_STEP = "[STEP] step=%d action=%s reward=%s done=%s error=%s"
LOG_END = "[END] success=%s steps=%d rewards=%s"

# --- Fixed values: tasks as graded (id, difficulty) -------------------------
TASKS = [
    ("call_001", "easy"),
    ("call_002", "hard"),
    ("call_003", "easy"),
    ("call_004", "hard"),
    ("call_005", "medium"),
    ("call_006", "medium"),
    ("call_007", "medium"),
    ("call_008", "medium"),
    ("call_009", "hard"),
    ("call_010", "hard"),
    ("call_011", "medium"),
    ("call_012", "hard"),
]

# --- Fixed values: screening phrases, lower case ----------------------------
SCREEN_DISCLOSURE = (
    r"call may be recorded|call is being recorded|recorded for quality"
)
COLLECTIONS = "Collections"
SCREEN_DEBT_DISCLOSURE = r"this is an attempt to collect a debt"
SCREEN_SUPERVISOR_REQUEST = (
    r"i want to speak to a supervisor|let me talk to your manager|get me someone else"
)
SCREEN_DEFLECTION = (
    r"a supervisor would tell you the same thing"
    r"|i can have someone call you back|let me handle this for you"
)
SCREEN_COMMITMENT = (
    r"i guarantee|i promise|definitely will happen|i can guarantee that rate"
    r"|make sure that fee doesn't show up|don't worry about it, i'll take care of that"
    r"|i'll just push this through|let me just override that|skip the normal process"
)
SCREEN_HEDGE = r"typically|usually|you might expect|submit the request for review"
SCREEN_CONFUSED = r"hello\?|are you still there"
SCREEN_HOLD_ASKED = r"may i place you on a brief hold"
SCREEN_CUSTOMER_PAUSE = r"let me grab my account number"
SCREEN_APOLOGY = r"sorry about that"
SCREEN_FULL_SSN = r"give me your social security number|your full social security number"
SCREEN_LAST_FOUR = r"last four"
SCREEN_DISCOUNT = (
    r"give you [0-9]+% off|bump you to our premium tier|interest-free"
    r"|credit \$[0-9]+ to your account"
)
SCREEN_DISCOUNT_OK = r"check if any promotions are available"
HOLD_GAP_SECONDS = 30.0
NATURAL_PAUSE_SECONDS = 5.0

# --- Fixed values: compliance rubric ----------------------------------------
# (policy, definition, indicators, severity guide, common false positives)
RUBRIC = [
    (
        "regulatory_disclosure_failure",
        "Every call MUST begin with a clear statement that the call may be recorded for "
        "quality assurance and/or training purposes. In debt collection calls, "
        "Mini-Miranda rights disclosure is also required. The disclaimer must occur "
        "within the agent's first speaking turn. Absence constitutes a regulatory "
        "violation with immediate legal liability.",
        [
            "Check the agent's first turn for phrases like 'this call may be recorded', "
            "'call is being recorded', 'recorded for quality'",
            "The disclaimer must be explicit — generic greetings without recording "
            "mention do NOT satisfy the requirement",
            "A disclaimer buried mid-call (not in the opening) is still considered missing",
            "For Collections department: also check for Mini-Miranda disclosure ('this is "
            "an attempt to collect a debt')",
        ],
        "Always HIGH. Recording disclaimer is a legal/regulatory requirement.",
        [
            "Agent saying 'quality service' without mentioning recording",
            "IVR/automated system providing the disclaimer before agent connects (not "
            "visible in agent transcript)",
        ],
    ),
    (
        "failed_escalation",
        "When a customer's sentiment reaches 'angry' (not just frustrated), the agent MUST "
        "offer to transfer the call to a supervisor or manager. An explicit customer "
        "request to speak with a supervisor must be honored immediately — deflection, "
        "delay tactics, or offering callbacks instead of live transfer all constitute "
        "failed escalation. This is a CFPB complaint trigger and regulatory investigation "
        "risk.",
        [
            "Customer uses escalation language: 'I want to speak to a supervisor', 'let me "
            "talk to your manager', 'get me someone else'",
            "Customer sentiment has clearly shifted to angry: raised voice indicators, "
            "profanity, threats to leave, repeated demands",
            "Agent deflects: 'a supervisor would tell you the same thing', 'I can have "
            "someone call you back', 'let me handle this for you'",
            "Implicit escalation need: customer threatens to close account, file "
            "complaint, or contact regulatory body",
        ],
        "Always HIGH. Failed escalation creates legal and reputational risk.",
        [
            "Customer is frustrated but not angry — check for clear anger indicators",
            "Agent successfully de-escalates WITH supervisor offer that customer declines",
            "Customer asks a general question about supervisor availability without "
            "requesting transfer",
        ],
    ),
    (
        "unauthorized_commitment",
        "Agents CANNOT promise specific financial outcomes — refunds, interest rates, "
        "fee waivers, processing timelines, or policy exceptions — without documented "
        "supervisor authorization or a system-generated approval code. This creates "
        "binding verbal contracts the company may be unable to fulfill, opening the door "
        "for regulatory fines or lawsuits. Both explicit guarantees and implicit "
        "commitments that remove financial uncertainty constitute violations.",
        [
            "Explicit promises: 'I guarantee', 'I promise', 'definitely will happen', 'I "
            "can guarantee that rate'",
            "Implicit commitments: 'I'll make sure that fee doesn't show up', 'don't worry "
            "about it, I'll take care of that', 'I'll just push this through'",
            "Rate/amount specifics: quoting exact percentages or dollar amounts as certain "
            "outcomes without hedging language",
            "Process bypass: 'Let me just override that', 'I'll skip the normal process'",
        ],
        "HIGH if financial amount > $500 or involves rate/interest commitments. MEDIUM for "
        "smaller amounts or operational commitments.",
        [
            "Agent saying 'I'll submit the request for review' (submitting ≠ "
            "guaranteeing)",
            "Agent quoting published rates from an official fee schedule",
            "Agent using hedged language: 'typically', 'usually', 'you might expect'",
            "Agent confirming what has ALREADY been approved by system/supervisor",
        ],
    ),
    (
        "incorrect_hold_procedure",
        "Before placing a customer on hold, the agent MUST: (1) explain why the hold is "
        "needed, (2) ask for the customer's permission, and (3) provide an estimated wait "
        "time. Going silent without notification, or extended unexplained pauses, "
        "constitute hold procedure violations. Violates TCPA regulations and drives "
        "customer abandonment.",
        [
            "Large timestamp gap between consecutive turns suggesting unannounced hold",
            "Customer saying 'hello?', 'are you still there?', indicating unexpected "
            "silence",
            "Agent resuming with 'sorry about that' after a gap without prior hold "
            "announcement",
            "Agent saying 'hold on' or 'one sec' without asking permission",
        ],
        "MEDIUM if customer noticed and expressed confusion. LOW if gap was brief (<30 "
        "seconds) with no customer complaint.",
        [
            "Agent properly asked 'may I place you on a brief hold?' and customer agreed",
            "Brief natural pause (<5 seconds) between turns — normal conversation",
            "Customer initiated the pause ('let me grab my account number')",
        ],
    ),
    (
        "pii_exposure_risk",
        "Agents must follow minimum-necessary PII collection principles. They must NOT "
        "request more personally identifiable information than required for the "
        "transaction. Asking for a full Social Security Number when only the last four "
        "digits are needed, reading back a full account number aloud, or requesting "
        "sensitive data already on file constitutes a PII exposure risk. This violates "
        "GDPR, CCPA, and internal data minimization policies.",
        [
            "Agent asks for full SSN: 'Can you give me your Social Security Number?' when "
            "policy requires only last four digits",
            "Agent reads back full account number aloud instead of confirming last four",
            "Agent requests information already verified by IVR or system lookup",
            "Agent asks for sensitive data (DOB, SSN, mother's maiden name) without "
            "explaining why it is needed for this specific transaction",
        ],
        "HIGH if full SSN or other high-sensitivity PII was requested unnecessarily. "
        "MEDIUM if agent read back full account number or requested redundant "
        "verification.",
        [
            "Agent asking for last four of SSN (this is standard and correct)",
            "Agent asking for account number when no prior verification was done",
            "Agent confirming partial information: 'account ending in 4567?'",
            "Legitimate re-verification after a transfer or system timeout",
        ],
    ),
    (
        "churn_save_policy_breach",
        "Agents must NOT offer unauthorized discounts, credits, rate reductions, or "
        "retention incentives that are not pre-approved by the CRM retention system or a "
        "supervisor. Inventing retention offers on the spot — even if the customer is "
        "threatening to leave — constitutes a P&L leak. Retention offers must be "
        "system-driven based on Customer Lifetime Value (CLV) calculations, not "
        "agent-driven improvisation ('Hero Agent Anti-Pattern').",
        [
            "Agent invents a discount: 'I'll give you 50% off for the next six months'",
            "Agent offers service upgrades without authorization: 'Let me bump you to our "
            "premium tier at no extra cost'",
            "Agent creates payment plans outside standard policy: 'I can spread that over "
            "12 months interest-free' without system approval",
            "Agent offers credits to prevent churn: 'How about I credit $100 to your "
            "account to make up for the inconvenience?'",
            "Key difference from unauthorized_commitment: churn_save is about giving away "
            "the company's money to retain a customer. unauthorized_commitment is about "
            "promising a financial outcome the company may not be able to deliver.",
        ],
        "HIGH if the unauthorized retention offer exceeds $200 or involves multi-month "
        "commitments. MEDIUM for smaller one-time credits or minor service adjustments.",
        [
            "Agent offering a retention deal that IS in the CRM-approved offers list",
            "Agent saying 'I can check if any promotions are available for your account'",
            "Agent executing a supervisor-approved exception with documented approval",
            "Standard courtesy credits within the agent's documented authority level",
        ],
    ),
]
