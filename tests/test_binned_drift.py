import random

import pytest
from pyspark.sql import functions as F

from demandloom.operators import quantiles

SCHEMA = "v double, w double"


def ks(a, b):
    """Largest gap of two empirical distributions, at every value."""
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def sample(seed, n, shift, kind):
    pick = random.Random(seed)
    draw = {"normal": lambda: pick.gauss(shift, 1.0), "steps": lambda: float(pick.randint(0, 5) + (pick.random() < shift)),
            "hot": lambda: 7.0 if pick.random() < 0.4 else pick.uniform(0, 10 + shift)}[kind]
    return [draw() for _ in range(n)]


def frame(spark, values):
    rows = [(v, float(i % 7)) for i, v in enumerate(values)]
    return spark.createDataFrame([*rows, (None, None), (float("nan"), float("inf"))], SCHEMA)


@pytest.mark.parametrize("kind, shift", [("normal", 0.0), ("normal", 0.3), ("steps", 0.4), ("hot", 2.0)])
@pytest.mark.parametrize("bins", [4, 64])
def test_bounds_hold_and_the_recount_agrees_with_the_statistic(spark, kind, shift, bins):
    old, new = sample(1, 900, 0.0, kind), sample(2, 700, shift, kind)
    reference, current = frame(spark, old), frame(spark, new)
    stored = quantiles.reference_bins(reference, ["v", "w"], bins)
    assert stored.groupBy("column").agg(F.sum("rows")).collect()[0][1] == 900
    want = ks(old, new)
    row = {r["column"]: r for r in quantiles.binned_drift(stored, current).collect()}["v"]
    assert row["ks_low"] - 1e-12 <= want <= row["ks_high"] + 1e-12
    assert row["drifted"] in (None, int(want > 0.1))
    for limit in (0.02, want - 1e-6, want + 1e-6, 0.5):
        rows = quantiles.binned_drift(stored, current, limit, reference).collect()
        assert {r["column"]: r["drifted"] for r in rows}["v"] == int(want > limit)
    whole = {r["column"]: r["ks"] for r in quantiles.two_sample_ks(reference, current, ["v", "w"]).collect()}
    assert whole["v"] == pytest.approx(want)


def test_values_of_one_bin_each_leave_no_doubt(spark):
    old, new = sample(3, 500, 0.0, "steps"), sample(4, 500, 0.2, "steps")
    stored = quantiles.reference_bins(frame(spark, old), ["v"], 64)
    row = quantiles.binned_drift(stored, frame(spark, new)).first()
    assert row["ks_low"] == row["ks_high"] == pytest.approx(ks(old, new))


def test_stored_bins_add_up_and_columns_without_values_stay_open(spark):
    reference = frame(spark, sample(5, 300, 0.0, "normal"))
    stored = quantiles.reference_bins(reference, ["v"], 16)
    assert stored.where("edge is null").count() == 1
    empty = spark.createDataFrame([(None, 1.0)], SCHEMA)
    (row,) = quantiles.binned_drift(stored, empty, 0.1, reference).collect()
    assert row["drifted"] is None and row["ks_low"] is None
    (none,) = quantiles.reference_bins(empty, ["v"], 16).collect()
    assert (none["bin"], none["rows"]) == (0, 0)
