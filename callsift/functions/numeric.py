"""Rounding that follows the exact binary value of a double.

Spark's ``round`` and ``bround`` work on the shortest decimal text of a double,
so 2.675 (stored as 2.67499...) becomes 2.68. Audit scores are defined by
rounding the stored value, half to even, and these expressions do that with
plain arithmetic that stays inside code generation. Arguments are SQL text,
mostly column names.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled_half_even(x: str, scale: int) -> str:
    """``abs(x) * scale`` as the nearest whole number, decided without error.

    The product is split in two exact parts (a 26-bit head and the rest), so the
    distance to the midpoint keeps its true sign even next to a tie.
    """
    size = f"abs({x})"
    lifted = f"({size} * 134217729D)"
    head = f"({lifted} - ({lifted} - {size}))"
    whole = f"CAST(floor({size} * {scale}D) AS DOUBLE)"
    over_half = f"(({head} * {scale}D - {whole} - 0.5D) + ({size} - {head}) * {scale}D)"
    bump = f"{over_half} > 0 OR ({over_half} = 0 AND {whole} % 2D = 1D)"
    return f"({whole} + IF({bump}, 1D, 0D))"


def round_half_even(x: str, digits: int) -> Column:
    scale = 10**digits
    rounded = f"{_scaled_half_even(x, scale)} / {scale}D"
    return F.expr(f"IF({x} < 0, -({rounded}), {rounded})")


def two_decimals(x: str) -> Column:
    """Text with two decimals; a negative value keeps its sign even as -0.00."""
    cents = f"CAST({_scaled_half_even(x, 100)} AS BIGINT)"
    return F.expr(
        f"concat(IF({x} < 0, '-', ''), CAST({cents} div 100 AS STRING), '.', "
        f"lpad(CAST({cents} % 100 AS STRING), 2, '0'))"
    )


def percent(part: str, total: str) -> Column:
    """``100 * part / total`` to the nearest whole number, 0 without a total."""
    share = f"CAST(100 * {part} AS DOUBLE) / CAST({total} AS DOUBLE)"
    return F.expr(f"IF({total} > 0, CAST(rint({share}) AS BIGINT), 0L)")
