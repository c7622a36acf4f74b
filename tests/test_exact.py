"""Exact HALF_UP ratios against Python decimals, across both evaluation paths."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from tickerlake.functions.exact import pct_half_up, ratio_half_up


def _values(rng, n):
    out = []
    for _ in range(n):
        bound = rng.choice([10 ** 2, 10 ** 6, 10 ** 12, 10 ** 15])   # small to near 18 digits
        out.append((Decimal(rng.randint(-bound, bound)) / 100,
                    Decimal(rng.randint(-bound, bound)) / 100))
    # Exact half-way quotients (0.125 %, -0.125 %), an exact one, a zero denominator.
    out += [(Decimal("0.01"), Decimal("8.00")), (Decimal("-0.01"), Decimal("8.00")),
            (Decimal("0.01"), Decimal("0.08")), (Decimal("1.00"), Decimal("0.00"))]
    return out


def _expected(num, den, scale, factor):
    if den == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 80
        return (num * factor / den).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def test_ratios_match_python_decimal(spark):
    rows = _values(random.Random(7), 3000)
    df = spark.createDataFrame(rows, "num decimal(18,2), den decimal(18,2)")
    got = df.select(
        "num", "den",
        pct_half_up("num", "den").alias("pct"),                                   # integer path + fallback
        ratio_half_up(F.col("num"), F.col("den"), 2, factor=100).alias("pct_decimal"),  # decimal only
        ratio_half_up(F.col("num"), F.col("den"), 4, operand_scale=2).alias("ratio4"),
    ).collect()
    for r in got:
        want = _expected(r.num, r.den, 2, 100)
        assert r.pct == want, (r.num, r.den, r.pct, want)
        assert r.pct_decimal == want, (r.num, r.den, r.pct_decimal, want)
        assert r.ratio4 == _expected(r.num, r.den, 4, 1), (r.num, r.den, r.ratio4)
    halfway = {(r.num, r.den): r.pct for r in got}
    assert halfway[(Decimal("0.01"), Decimal("8.00"))] == Decimal("0.13")
    assert halfway[(Decimal("-0.01"), Decimal("8.00"))] == Decimal("-0.13")
