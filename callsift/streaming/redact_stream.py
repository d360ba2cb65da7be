"""Stateless redaction of a text stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.functions.text import redact_structured


def redact_stream(stream: DataFrame, text_col: str) -> DataFrame:
    return stream.withColumn(text_col, redact_structured(F.col(text_col)))
