import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.functions.derive import H2508_RATED_KW, add_derived, declared_columns, rules_for


def test_load_is_float32_arithmetic(spark):
    rng = np.random.default_rng(1)
    vals = rng.uniform(0, 4000, 2000).astype(np.float32)
    df = spark.createDataFrame([(float(v),) for v in vals], "ge1_power float")
    out = add_derived(df, "H2508", only=("ge1_load",)).select("ge1_power", "ge1_load").collect()
    for r in out:
        exp = np.float32(np.float32(100.0) * np.float32(r.ge1_power)) / np.float32(H2508_RATED_KW["ge1"])
        assert np.float32(r.ge1_load) == np.float32(exp)


def test_sums_are_null_when_a_term_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, None), (1.0, 2.0, 3.0, 4.0)],
                               "me1_fo_flow float, me2_fo_flow float, me1_fg_flow float, me2_fg_flow float")
    df = df.withColumns({"ge2_1_power": F.lit(1.0).cast("float"), "ge2_2_power": F.lit(None).cast("float")})
    out = add_derived(df, "H2521").collect()
    assert out[0].me_fo_flow == 3.0 and out[0].me_fg_flow is None and out[0].ge2_power is None
    assert out[1].me_fg_flow == 7.0


def test_rule_table_shapes():
    assert [n for n, _ in declared_columns("H2508")] == [
        "ge_fg_flow", "ge1_load", "ge2_load", "ge3_load", "ge4_load", "me_fo_flow", "me_fg_flow", "auxb_fo_flow"]
    assert [n for n, _ in declared_columns("h2521 ")] == ["ge2_power", "me_fo_flow", "me_fg_flow"]
    assert rules_for("H0000") == []


def test_missing_inputs_fail_early(spark):
    with pytest.raises(ValueError, match="missing columns"):
        add_derived(spark.createDataFrame([(1.0,)], "me1_fo_flow float"), "H2521")


def test_unknown_rule_names_are_refused(spark):
    with pytest.raises(ValueError, match="no rules"):
        add_derived(spark.createDataFrame([(1.0,)], "ge1_power float"), "H2508", only=("ge9_load",))
