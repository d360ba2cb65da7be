import pytest
from pyspark.sql import functions as F

from callsift.functions import text as tx
from callsift.operators import transcript

SSN, PHONE = "[SSN_REDACTED]", "[PHONE_REDACTED]"
ACCOUNT, EMAIL = "[ACCOUNT_NUMBER]", "[EMAIL_REDACTED]"

STRUCTURED = [
    # account numbers
    ("Please debit 2468-1357-8642 today.", f"Please debit {ACCOUNT} today."),
    ("Card 4111-1111-2222-3333, thanks", f"Card {ACCOUNT}, thanks"),
    ("Acct 8765-4321 is mine.", f"Acct {ACCOUNT} is mine."),
    ("Yes: 1111-2222-3333.", f"Yes: {ACCOUNT}."),
    ("Read out 1212 3434 5656.", f"Read out {ACCOUNT}."),
    ("Opened in 1998.", "Opened in 1998."),
    ("from 2019-2023", f"from {ACCOUNT}"),
    # social security numbers
    ("It is 987-65-4321.", f"It is {SSN}."),
    ("SSN 987 65 4321 noted", f"SSN {SSN} noted"),
    ("the last four of my SSN is 9876.", f"the last four of my SSN is {SSN}."),
    (
        "LAST FOUR DIGITS of your social security number are 5678",
        f"LAST FOUR DIGITS of your social security number are {SSN}",
    ),
    ("social: 1234", f"social: {SSN}"),
    ("SSN 1234-5678", f"SSN {SSN}-5678"),
    ("SSN ending 4532", "SSN ending 4532"),
    # phones
    ("Ring (415) 555-0101 now", f"Ring {PHONE} now"),
    ("Ring 415-555-0101 now", f"Ring {PHONE} now"),
    ("Ring 415.555.0101 now", f"Ring {PHONE} now"),
    ("Ring 415-5550101 now", f"Ring {PHONE} now"),
    ("Ring 4155550101 now", "Ring 4155550101 now"),
    # e-mail
    ("Mail joe.b+x@mail.example.org.", f"Mail {EMAIL}."),
    ("to anna_b7@example.com please", f"to {EMAIL} please"),
    # amounts stay
    ("A fee of $12.50.", "A fee of $12.50."),
    ("Owed: $98,765.43.", "Owed: $98,765.43."),
    ("Only 4.25% a year", "Only 4.25% a year"),
    # edges
    ("", ""),
    (None, None),
    ("Nothing to hide here.", "Nothing to hide here."),
    (f"{ACCOUNT} and {SSN} stay", f"{ACCOUNT} and {SSN} stay"),
    # word boundaries, digits and blanks are Unicode
    ("é415-555-0101", "é415-555-0101"),
    ("٤١٥-٥٥٥-٠١٠١", PHONE),
    ("987 65 4321", SSN),
]

NAMED = [
    ("Hello, this is Rosa Diaz.", {"Rosa Diaz": "[C]"}, "Hello, this is [C]."),
    ("Thanks Rosa!", {"Rosa Diaz": "[C]", "Rosa": "[C]"}, "Thanks [C]!"),
    ("hi ROSA DIAZ", {"Rosa": "[F]", "rosa diaz": "[C]"}, "hi [C]"),
    ("Ian told Rosa", {"Rosa": "[C]", "Ian": "[A]"}, "[A] told [C]"),
    ("Rosa Diaz", {}, "Rosa Diaz"),
    ("Rosa Diaz", None, "Rosa Diaz"),
    # no word boundary, and tokens are searched again
    ("the annual fee", {"Ann": "[A]"}, "the [A]ual fee"),
    ("Tomas", {"Tomas": "[CUSTOMER_NAME]", "Tom": "[X]"}, "[CUS[X]ER_NAME]"),
    ("a.b axb", {"a.b": "$1\\"}, "$1\\ axb"),
    ("Ian, 8765-4321", {"Ian": "[A]"}, f"[A], {ACCOUNT}"),
]


def test_structured_redaction(spark):
    df = spark.createDataFrame(STRUCTURED, "text string, expected string")
    rows = df.withColumn("got", tx.redact_structured(F.col("text"))).collect()
    assert [(r.text, r.got) for r in rows] == STRUCTURED


@pytest.mark.parametrize("text, names, expected", NAMED)
def test_name_redaction(spark, text, names, expected):
    df = spark.createDataFrame([(text, names)], "text string, names map<string,string>")
    ordered = tx.names_longest_first(F.col("names"))
    assert df.select(tx.redact_pii(F.col("text"), ordered)).first()[0] == expected


def _turns(spark, rows):
    return spark.createDataFrame(
        [(1, pos, pos, who, said, 0.0, 0.0) for pos, who, said in rows],
        "call_id long, pos long, turn_index int, speaker string, text string, "
        "ts_start double, ts_end double",
    )


def _entities(spark, rows):
    found = transcript.extract_entities(_turns(spark, rows)).collect()
    return {r.name: r.token for r in found}


AGENT, CUSTOMER = "[AGENT_NAME]", "[CUSTOMER_NAME]"


def test_names_come_from_introductions(spark):
    found = _entities(
        spark,
        [
            (0, "agent", "My name is Lee Wong. How are you?"),
            (1, "customer", "Hi, this is Kim! I am sure this is Bad."),
            (2, "system", "I'm Hal"),
            (3, "agent", "This is Acme. I'm Financial. I am Acme Financial"),
            (8, "customer", "My name is Late"),
        ],
    )
    assert found == {
        "Lee Wong": AGENT,
        "Lee": AGENT,
        "Kim": CUSTOMER,
        "Hal": CUSTOMER,
        "Acme Financial": AGENT,
    }


def test_full_introduction_overrides_first_word(spark):
    found = _entities(
        spark,
        [
            (0, "agent", "I'm Jo Park"),
            (1, "customer", "I'm Jo Lund"),
            (2, "customer", "I'm Jo"),
            (3, "agent", "I'm Jo Lund"),
        ],
    )
    assert found == {"Jo Park": AGENT, "Jo": CUSTOMER, "Jo Lund": AGENT}


def test_entities_match_a_sequential_dictionary(spark):
    import random
    import re

    rng = random.Random(3)
    people = ["Al", "Al Gray", "Bo", "Bo Gray", "Acme", "Acme Hill", "Sure"]
    intro = ["I'm {}", "My name is {}.", "Well, this is {}", "I am {}", "so {}"]
    for _ in range(12):
        rows = [
            (
                i,
                rng.choice(["agent", "customer"]),
                ". ".join(rng.choice(intro).format(rng.choice(people)) for _ in range(3)),
            )
            for i in range(9)
        ]
        expected = {}
        skip = {"Acme", "Financial", "Services", "Thank", "Hello", "Sure"}
        name = r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)"
        for _, who, said in rows[:8]:
            hits = re.findall(r"(?:[Mm]y name is|I'm|I am)\s+" + name, said)
            hits += re.findall(r"(?:^|[.!?]\s+|,\s+)[Tt]his is\s+" + name, said)
            for hit in hits:
                if hit in skip:
                    continue
                expected[hit] = AGENT if who == "agent" else CUSTOMER
                word = hit.split()[0]
                if word not in skip:
                    expected.setdefault(word, expected[hit])
        assert _entities(spark, rows) == expected


def test_calls_are_redacted_by_their_own_names(spark):
    turns = _turns(spark, [(0, "customer", "I'm Eve."), (1, "agent", "Thanks eve, 8765-4321")])
    other = turns.withColumn("call_id", F.lit(2).cast("long")).where("pos = 1")
    done = transcript.redact_turns(turns.unionByName(other)).orderBy("call_id", "pos")
    assert [r.text for r in done.collect()] == [
        f"I'm {CUSTOMER}.",
        f"Thanks {CUSTOMER}, {ACCOUNT}",
        f"Thanks eve, {ACCOUNT}",
    ]
