"""Label rules of the marts, as Column expressions (searched CASE chains)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerlake import schema as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def return_category(pct) -> Column:
    """Label of a rounded daily return in percent; NULL falls to Large Loss."""
    p = _col(pct)
    return (F.when(p > 3, S.RETURN_LARGE_GAIN)
            .when(p > 1, S.RETURN_MODERATE_GAIN)
            .when(p >= -1, S.RETURN_FLAT)
            .when(p >= -3, S.RETURN_MODERATE_LOSS)
            .otherwise(S.RETURN_LARGE_LOSS))


def crossover_signal(fast, slow, prev_fast, prev_slow) -> Column:
    """Golden Cross when fast rises above slow, Death Cross when it falls below.

    The previous bar's comparison includes equality; NULL previous averages
    (first bar) give NULL.
    """
    f, s, pf, ps = map(_col, (fast, slow, prev_fast, prev_slow))
    return (F.when((f > s) & (pf <= ps), S.GOLDEN_CROSS)
            .when((f < s) & (pf >= ps), S.DEATH_CROSS))


def volume_category(pct) -> Column:
    p = _col(pct)
    return (F.when(p > 200, S.VOLUME_VERY_HIGH)
            .when(p > 150, S.VOLUME_HIGH)
            .when(p > 80, S.VOLUME_NORMAL)
            .when(p > 50, S.VOLUME_LOW)
            .otherwise(S.VOLUME_VERY_LOW))


def trend_strength(price_pct, volume_pct) -> Column:
    """Price-volume divergence label; a NULL price change is Neutral."""
    p, v = _col(price_pct), _col(volume_pct)
    return (F.when((p > 2) & (v > 150), S.TREND_STRONG_UP)
            .when((p < -2) & (v > 150), S.TREND_STRONG_DOWN)
            .when((p > 2) & (v < 80), S.TREND_WEAK_UP)
            .when((p < -2) & (v < 80), S.TREND_WEAK_DOWN)
            .otherwise(S.TREND_NEUTRAL))
