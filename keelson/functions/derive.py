"""Hull-specific derived columns as a declarative rule table.

Each rule names the output column, its catalog type and the expression that
computes it from catalog columns. Adding a hull means adding an entry; the
same entries drive the table schema (``declared_columns``) and the values
(``add_derived``), so both always agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.conform import spark_type


@dataclass(frozen=True)
class Derived:
    name: str
    data_type: str
    inputs: tuple[str, ...]
    expr: Callable[[], Column]
    declared: bool = True  # False: re-cast of an existing catalog column, not a new table column


def sum_rule(name: str, *inputs: str) -> Derived:
    """Plain sum: NULL when any term is NULL."""
    def build() -> Column:
        total = F.col(inputs[0])
        for n in inputs[1:]:
            total = total + F.col(n)
        return total
    return Derived(name, "FLOAT", inputs, build)


def load_percent_rule(name: str, power: str, rated_kw: float) -> Derived:
    # FLOAT arithmetic: 100 and the rating are FLOAT literals, the quotient is narrowed to FLOAT.
    def build() -> Column:
        return (F.lit(100.0).cast("float") * F.col(power)) / F.lit(rated_kw).cast("float")
    return Derived(name, "FLOAT", (power,), build)


def recast_bool_rule(name: str) -> Derived:
    return Derived(name, "BOOLEAN", (name,), lambda: F.col(name).cast("boolean"), declared=False)


# Rated power (kW) of generator engines 1-4 of hull H2508.
H2508_RATED_KW = {"ge1": 2750.0, "ge2": 3670.0, "ge3": 3670.0, "ge4": 2750.0}

# H2508 on/off flags that are re-cast to BOOLEAN.
H2508_FLAGS = (
    "me1_fg_use", "me2_fg_use", "me1_fo_vlsfo_use", "me2_fo_vlsfo_use", "me1_fo_lsmgo_use",
    "me2_fo_lsmgo_use", "ge1_fg_use", "ge2_fg_use", "ge3_fg_use", "ge4_fg_use",
)

_MAIN_ENGINE_SUMS = [
    sum_rule("me_fo_flow", "me1_fo_flow", "me2_fo_flow"),
    sum_rule("me_fg_flow", "me1_fg_flow", "me2_fg_flow"),
]

HULL_RULES: dict[str, list[Derived]] = {
    "H2508": [
        *(recast_bool_rule(f) for f in H2508_FLAGS),
        sum_rule("ge_fg_flow", "ge1_fg_flow", "ge2_fg_flow", "ge3_fg_flow", "ge4_fg_flow"),
        *(load_percent_rule(f"{ge}_load", f"{ge}_power", kw) for ge, kw in H2508_RATED_KW.items()),
        *_MAIN_ENGINE_SUMS,
        sum_rule("auxb_fo_flow", "auxb_fo_lsmgo_flow", "auxb_fo_vlsfo_flow"),
    ],
    "H2521": [sum_rule("ge2_power", "ge2_1_power", "ge2_2_power"), *_MAIN_ENGINE_SUMS],
    "H2532": [sum_rule("ge2_power", "ge2_1_power", "ge2_2_power"), *_MAIN_ENGINE_SUMS],
}


def rules_for(hull: str) -> list[Derived]:
    """Rules of a hull; an unknown hull has none."""
    return HULL_RULES.get(hull.strip().upper(), [])


def declared_columns(hull: str) -> list[tuple[str, str]]:
    """(name, catalog type) of the columns a hull adds to its raw table."""
    return [(r.name, r.data_type) for r in rules_for(hull) if r.declared]


def add_derived(df: DataFrame, hull: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """Add (or re-cast) the hull's derived columns in one projection."""
    rules = [r for r in rules_for(hull) if only is None or r.name in only]
    if only is not None:
        unknown = sorted(set(only) - {r.name for r in rules})
        if unknown:
            raise ValueError(f"hull {hull} has no rules for {unknown}")
    if not rules:
        return df
    missing = sorted({n for r in rules for n in r.inputs} - set(df.columns))
    if missing:
        raise ValueError(f"derived columns of {hull} need missing columns {missing}")
    return df.withColumns({r.name: r.expr().cast(spark_type(r.data_type)) for r in rules})
