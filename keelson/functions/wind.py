"""True wind, Beaufort class and fuel totals.

Inputs are FLOAT columns; the arithmetic runs in DOUBLE (FLOAT operands widen)
and results are narrowed to FLOAT at the end, like the SQL the calc table was
defined with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beaufort class boundaries in knots. A speed below the n-th bound
# (1-based) is class n-1; a speed at a bound belongs to the higher class; at or
# above the last bound the class is 12.
BEAUFORT_BOUNDS = (1.0, 4.0, 7.0, 11.0, 17.0, 22.0, 28.0, 34.0, 41.0, 48.0, 56.0, 64.0)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def true_wind_vector(rel_speed: Column | str, rel_angle_deg: Column | str, sog: Column | str) -> tuple[Column, Column]:
    """Components of the true wind from relative wind (speed, bow angle) and speed over ground."""
    w, theta = _c(rel_speed), F.radians(_c(rel_angle_deg))
    v_x = -w * F.sin(theta)
    v_y = -w * F.cos(theta) + _c(sog)
    return v_x, v_y


def true_wind_speed_raw(v_x: Column, v_y: Column) -> Column:
    return F.sqrt(F.pow(v_x, 2) + F.pow(v_y, 2))


def true_wind_angle_raw(v_x: Column, v_y: Column) -> Column:
    """Direction the air moves to, relative to the bow, in [0, 360)."""
    return (F.degrees(F.atan2(v_x, v_y)) + F.lit(360)) % F.lit(360)


def true_wind_speed(rel_speed, rel_angle_deg, sog) -> Column:
    return true_wind_speed_raw(*true_wind_vector(rel_speed, rel_angle_deg, sog)).cast("float")


def true_wind_angle(rel_speed, rel_angle_deg, sog) -> Column:
    return true_wind_angle_raw(*true_wind_vector(rel_speed, rel_angle_deg, sog)).cast("float")


def beaufort(speed: Column | str, cap: int = 12, null_guard: bool = True) -> Column:
    """Beaufort class of a speed in knots; NaN compares above every bound.

    ``cap`` < 12 gives the shorter scale whose top class collects everything at or
    above bound ``cap``; with ``null_guard=False`` a NULL speed falls through to the
    top class, as the older calc script did. The pipeline uses the defaults.
    """
    if not 1 <= cap <= len(BEAUFORT_BOUNDS):
        raise ValueError(f"cap must be within 1..{len(BEAUFORT_BOUNDS)}")
    s = _c(speed)
    expr = None
    if null_guard:
        expr = F.when(s.isNull(), F.lit(None).cast("int"))
    for klass, bound in enumerate(BEAUFORT_BOUNDS[:cap]):
        expr = F.when(s < F.lit(bound), F.lit(klass)) if expr is None else expr.when(s < F.lit(bound), F.lit(klass))
    return expr.otherwise(F.lit(cap))


def fuel_total(*terms: Column | str) -> Column:
    """Sum of flow terms in DOUBLE, narrowed to FLOAT; NULL when any term is NULL."""
    if not terms:
        raise ValueError("fuel_total needs at least one term")
    total = None
    for t in terms:
        d = _c(t).cast("double")
        total = d if total is None else total + d
    return total.cast("float")
