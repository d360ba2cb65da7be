"""Redaction as column expressions.

Patterns run with ``(?U)``: word boundaries, digits and white space follow
Unicode, so an accented letter in front of a number counts as part of a word.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from callsift import fixed_values as fv

_UNICODE = "(?U)"
_UNICODE_ANY_CASE = "(?iU)"

# Kind, pattern, replacement, in the order the replacements must be applied.
STAGES = [
    ("ssn", _UNICODE + fv.SSN_FULL, fv.TOKEN_SSN),
    (
        "ssn_last4",
        f"{_UNICODE_ANY_CASE}({fv.SSN_LAST4_PREFIX}){fv.SSN_LAST4_DIGITS}",
        "$1" + fv.TOKEN_SSN,
    ),
    ("phone", _UNICODE + fv.PHONE, fv.TOKEN_PHONE),
    ("account", _UNICODE + fv.ACCOUNT, fv.TOKEN_ACCOUNT),
    ("email", _UNICODE + fv.EMAIL, fv.TOKEN_EMAIL),
]

# Every structured kind holds a digit or an at sign; other texts skip the chain.
_MAY_HOLD = r"(?U)[\d@]"


def sql_text(value: str) -> str:
    """A string as a Spark SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def redact_structured(text: Column) -> Column:
    """SSNs, last-four SSNs, phones, accounts and e-mails replaced by tokens."""
    redacted = text
    for _, pattern, token in STAGES:
        redacted = F.regexp_replace(redacted, pattern, token)
    return F.when(text.rlike(_MAY_HOLD), redacted).otherwise(text)


def redactable(text: Column) -> Column:
    """The text if it can hold structured data at all, else null."""
    return F.when(text.rlike(_MAY_HOLD), text)


def redact_names(text: Column, names: Column) -> Column:
    """Replace names in the order given: ``array<struct<name, token>>``.

    Names match anywhere, in any case, also inside words and inside tokens put
    in before; that is the defined result, so each name is one pass.
    """

    def quoted(name: Column) -> Column:
        safe = F.replace(name, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        return F.concat(F.lit("(?iu)\\Q"), safe, F.lit("\\E"))

    def literal(token: Column) -> Column:
        no_slash = F.replace(token, F.lit("\\"), F.lit("\\\\"))
        return F.replace(no_slash, F.lit("$"), F.lit("\\$"))

    replaced = F.aggregate(
        names,
        text,
        lambda done, entry: F.regexp_replace(
            done, quoted(entry["name"]), literal(entry["token"])
        ),
    )
    return F.when(names.isNull() | (F.size(names) == 0), text).otherwise(replaced)


def names_longest_first(name_map: Column) -> Column:
    """A name-to-token map as the ordered list :func:`redact_names` takes."""
    entries = F.map_entries(name_map)
    keyed = F.transform(
        entries,
        lambda e, i: F.struct(
            (-F.length(e["key"])).alias("by_length"),
            i.alias("by_entry"),
            e["key"].alias("name"),
            e["value"].alias("token"),
        ),
    )
    return F.array_sort(keyed)


def redact_pii(text: Column, names: Column | None = None) -> Column:
    redacted = redact_structured(text)
    if names is None:
        return redacted
    return redact_names(redacted, names)
