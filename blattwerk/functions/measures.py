"""Column functions over numbers: geometry, budgets and verdicts of recognised pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of a derailed recognition.
LOOP, LEAST_EXPECTED = 8, 300
CORRIDOR, COARSE = (0.80, 2.2), (0.45, 2.6)
CHARS_PER_TOKEN, GENEROUS, TOKEN_MIN, TOKEN_MAX = 2.2, 1.8, 1024, 8192
CHARS_PER_INK = 18.8 / 1000


def per_mille(x: Column, of: Column) -> Column:
    """Position on a page as a whole number from 0 to 1000, cut towards zero."""
    return (x / of * 1000).cast("int")


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.least(a1, b1) - F.greatest(a0, b0)


def inside(x: Column, y: Column, box: dict[str, Column]) -> Column:
    return x.between(box["x0"], box["x1"]) & y.between(box["y0"], box["y1"])


def expected_chars(ink: Column, own_chars: Column, own_ink: Column) -> Column:
    """Characters that the ink of a page lets expect; calibrated by pages with enough text."""
    factor = F.when((own_chars >= 400) & (own_ink > 0), own_chars / own_ink).otherwise(F.lit(CHARS_PER_INK))
    return ink * factor


def token_budget(expected: Column) -> Column:
    budget = F.least(F.greatest(expected / CHARS_PER_TOKEN * GENEROUS, F.lit(float(TOKEN_MIN))), F.lit(float(TOKEN_MAX)))
    return F.when(expected.isNull() | (expected < LEAST_EXPECTED), F.lit(TOKEN_MAX)).otherwise(budget.cast("int"))


def derailment(loop: Column, chars: Column, expected: Column, calibrated: bool = False) -> Column:
    low, high = CORRIDOR if calibrated else COARSE
    ratio = chars / expected
    sized = expected.isNotNull() & (expected >= LEAST_EXPECTED)
    return F.when(loop >= LOOP, "loop").when(sized & (ratio > high), "too long").when(sized & (ratio < low), "cut short")


def penalty(loop: Column, chars: Column, expected: Column) -> Column:
    """Smaller is more credible."""
    base = F.when(loop >= LOOP, 10.0).otherwise(0.0)
    sized = expected.isNotNull() & (expected >= LEAST_EXPECTED)
    return F.when(sized, base + F.abs(F.ln(F.greatest(chars, F.lit(1)) / expected))).otherwise(base - F.least(chars, F.lit(20000)) / 20000.0)


def ink_at(ink: Column, dpi: Column) -> Column:
    return ink * F.pow(150.0 / F.greatest(dpi, F.lit(1)), F.lit(2))


def tile_mode(two_columns: Column, chars: Column, tile_from: int = 3000) -> Column:
    return F.when(two_columns, "vertical").when(chars >= tile_from, "horizontal").otherwise("whole")


def scanned_page(image_ratio: Column, chars: Column) -> Column:
    return (image_ratio >= 0.5) | (chars < 100)
