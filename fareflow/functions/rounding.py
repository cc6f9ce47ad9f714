"""Rounding and fixed-width text, as reports print them."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Half-even after scaling by a power of ten: how array libraries round."""
    scale = F.lit(10.0**digits)
    return F.rint(value * scale) / scale


def fixed_text(value: Column, digits: int) -> Column:
    """`digits` decimals, rounded from the exact binary value (1.005 prints 1.00)."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value, F.lit(pattern))


def round_exact(value: Column, digits: int) -> Column:
    """Nearest `digits`-decimal number to the exact binary value."""
    finite = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    return F.coalesce(F.when(finite, fixed_text(value, digits)).cast("double"), value)


def right_align(text: Column, width: int) -> Column:
    """Pads on the left and, unlike lpad, never cuts a longer text."""
    return F.format_string(f"%{width}s", text)
