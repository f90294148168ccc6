import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.operators import learn, staffing
from demandloom.streaming import demand

SCHEMA = (
    T.StructType()
    .add("timestamp", T.TimestampNTZType())
    .add("channel", T.StringType())
    .add("handle_time", T.DoubleType())
    .add("contact_id", T.LongType())
)
START = dt.datetime(2024, 1, 1)


def write_events(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def drain(df, name):
    run = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination(120)
    return df.sparkSession.table(name)


@pytest.fixture
def events(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(START + dt.timedelta(minutes=10 * i), "voice", 300.0, i) for i in range(60)]
    write_events(spark, path, rows)
    return path


def test_interval_demand_equals_batch_for_closed_hours(spark, events):
    stream = demand.read_stream(spark, events, SCHEMA)
    got = drain(demand.interval_demand(stream), "cube")
    batch = staffing.demand_cube(spark.read.parquet(events))
    closed = batch.where(F.col("timestamp") < F.lit(START + dt.timedelta(hours=7)).cast("timestamp_ntz"))
    columns = [F.col("timestamp").cast("string"), "channel", "volume", "average_handle_time"]
    assert got.count() == closed.count() == 7
    assert got.select(*columns).exceptAll(closed.select(*columns)).count() == 0


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "late")
    write_events(spark, path, [(START + dt.timedelta(hours=h), "voice", 60.0, h) for h in range(12)])
    write_events(spark, path, [(START + dt.timedelta(hours=12), "voice", 60.0, 98)])
    write_events(spark, path, [(START, "voice", 60.0, 99), (START + dt.timedelta(hours=20), "voice", 60.0, 100)])
    stream = demand.read_stream(spark, path, SCHEMA, files_per_trigger=1)
    got = drain(demand.interval_demand(stream), "late")
    assert got.where(F.col("timestamp") == F.lit(START)).first()["volume"] == 1


def test_live_staffing(spark, events):
    got = drain(demand.live_staffing(demand.read_stream(spark, events, SCHEMA)), "staffed").first()
    assert got["volume"] == 6 and got["workload"] == pytest.approx(0.5) and got["required_agents"] > 0


def test_repeats_are_suppressed(spark, events):
    write_events(spark, events, [(START + dt.timedelta(minutes=10 * i), "voice", 300.0, i) for i in range(50, 60)])
    got = drain(demand.without_repeats(demand.read_stream(spark, events, SCHEMA), ["contact_id"]), "unique")
    assert got.count() == 60


def test_batches_are_scored_once(spark, events, tmp_path):
    stream = demand.read_stream(spark, events, SCHEMA)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):
        writer = demand.score_batches(stream, lambda d: d.withColumn("prediction", F.col("handle_time") * 2), out, checkpoint)
        writer.start().awaitTermination(120)
    rows = spark.read.parquet(out)
    assert rows.count() == 60 and rows.first()["prediction"] == 600.0


FEATURES = ["x", "noise"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x, noise = rng.uniform(0, 10, 600), rng.uniform(0, 1, 600)
    data = [(float(a), float(b), float(a * a), i >= 500) for i, (a, b) in enumerate(zip(x, noise))]
    return spark.createDataFrame(data, "x double, noise double, sales double, is_validation boolean")


def test_boosted_trees_learn_and_rank(spark, rows):
    model = learn.boosted_trees(rows, FEATURES, params={"maxIter": 15, "maxDepth": 4, "stepSize": 0.3})
    error = learn.predict(model, rows).agg(F.avg(F.abs(F.col("prediction") - F.col("sales")))).first()[0]
    assert error < 3
    table = {r["feature"]: r["importance"] for r in learn.importances(model, FEATURES, rows, "m").collect()}
    assert table["x"] > 0.9


def test_search_picks_the_lowest_loss(rows):
    candidates = [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 10, "maxDepth": 4, "stepSize": 0.3}]
    best, results = learn.search(rows, FEATURES, candidates=candidates, parallelism=2)
    assert best == candidates[1] and results[0][1] < results[1][1]


def test_draws_are_seeded_and_in_range():
    draws = learn.draw_parameters(20)
    assert draws == learn.draw_parameters(20)
    assert all(0.01 <= d["stepSize"] <= 0.3 and 3 <= d["maxDepth"] <= 10 for d in draws)


def test_feature_selection(rows):
    kept = {r["feature"] for r in learn.select_features(rows, FEATURES, trees=10, threshold=0.2).collect()}
    assert kept == {"x"}
