"""Rounding on the shortest decimal form, against exact decimals."""

from __future__ import annotations

from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from quotewell.functions.scalars import round_shortest


@pytest.mark.parametrize("half", ["even", "up"])
def test_rounding_of_the_shortest_decimal(spark, half):
    values = [0.125, 0.375, 2.675, -2.675, -0.125, 0.5, 1.5, -1.5, 1e-9, 123456789.125, 1e14 + 0.5,
              1e20, -0.0, 5e-324, 1.005, float("inf"), float("nan"), None]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    found = frame.select("x", round_shortest(F.col("x"), 2, half).alias("y")).collect()
    mode = ROUND_HALF_EVEN if half == "even" else ROUND_HALF_UP
    for x, y in found:
        if x is None or x != x or abs(x) == float("inf"):
            assert (y is None) == (x is None) and str(y) == str(x)
        else:
            exact = Decimal(repr(x)).quantize(Decimal("0.01"), mode) if abs(x) < 1e15 else x
            assert y == float(exact), (x, y)
    with pytest.raises(ValueError, match="half is"):
        round_shortest(F.col("x"), 2, "down")
