from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from sward.sources import views
from sward.streaming import assessments

START = datetime(2024, 1, 1)


def write_events(spark, folder, number, events):
    data = [(token, START + timedelta(hours=hours), 1, "view", value, "{}") for token, hours, value in events]
    schema = assessments.EVENTS.replace("timestamp_ntz", "timestamp")
    df = spark.createDataFrame(data, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.coalesce(1).write.parquet(f"{folder}/events-{number}.parquet")


def log(spark, folder):
    return views.monitor(assessments.event_stream(spark, folder, "events*.parquet/*.parquet"))


def test_a_token_is_committed_once_across_batches(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_events(spark, folder, 1, [(1, 0, 5.0), (2, 1, 6.0), (1, 2, 5.0)])
    stream = assessments.commit_once(log(spark, folder), "2 days")
    assessments.append_to(stream, out, f"{out}-checkpoint").awaitTermination()
    write_events(spark, folder, 2, [(1, 20, 5.0), (3, 21, 7.0)])
    assessments.append_to(assessments.commit_once(log(spark, folder), "2 days"), out, f"{out}-checkpoint").awaitTermination()
    assert [r["token"] for r in rows(spark.read.parquet(out), "token")] == [1, 2, 3]


def test_a_token_returns_after_the_watermark(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for number, events in enumerate([[(1, 0, 5.0)], [(9, 500, 1.0)], [(1, 501, 5.0)]]):
        write_events(spark, folder, number, events)
        assessments.append_to(assessments.commit_once(log(spark, folder), "1 hour"), out, f"{out}-checkpoint").awaitTermination()
    assert sorted(r["token"] for r in rows(spark.read.parquet(out))) == [1, 1, 9]


def test_running_totals_survive_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    expected = []
    for number in range(3):
        events = [(number * 10 + i, number + i, float(i)) for i in range(4)]
        expected += [value for _, _, value in events]
        write_events(spark, folder, number, events)
        totals = assessments.running_totals(log(spark, folder))
        assessments.upsert_to(totals, out, f"{out}-checkpoint", ["State"]).awaitTermination()
        state = rows(assessments.current_state(spark, out, ["State"], totals.schema))
        assert state == [{"State": "view", "assessments": len(expected), "mean_value": sum(expected) / len(expected)}]


def test_trend_equals_its_batch_twin(spark, tmp_path):
    folder = str(tmp_path)
    write_events(spark, folder, 1, [(i, 7 * i, float(i % 5)) for i in range(100)])
    streamed = rows(assessments.drain_updates(assessments.windowed_trend(log(spark, folder)), "trend", ["window_start"]), "window_start")
    batch = views.monitor(spark.read.parquet(f"{folder}/events-1.parquet"))
    assert streamed == rows(assessments.windowed_trend(batch), "window_start")


def test_upsert_tables_are_snapshotted_and_older_batches_go(spark, tmp_path):
    """Five batches with a snapshot every two: few folders stay, and the newest version of every group is found."""
    import os

    from pyspark.sql import functions as F

    from sward.streaming import assessments

    source, target = tmp_path / "in", str(tmp_path / "out")
    for i in range(5):
        spark.createDataFrame([(f"g{i % 3}", float(i), i), ("all", float(i), i)], "State string, v double, n int").coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("State string, v double, n int").option("maxFilesPerTrigger", 1).parquet(str(source))
    totals = stream.groupBy("State").agg(F.count("*").alias("c"), F.sum("v").alias("s"))
    assessments.upsert_to(totals, target, str(tmp_path / "cp"), ["State"], snapshot_every=2).awaitTermination()
    assert sorted(n for n in os.listdir(target) if n.startswith("batch=")) == ["batch=4"]
    state = {r["State"]: (r["c"], r["s"]) for r in assessments.current_state(spark, target, ["State"], totals.schema).collect()}
    assert state["all"] == (5, 10.0) and sum(c for c, _ in state.values()) == 10


def test_duplicate_tokens_are_forgotten_after_the_watermark(spark, tmp_path):
    """The second copy of a token within the delay is dropped; one that comes after its state expired is new."""
    from pyspark.sql import functions as F

    from sward.streaming import assessments

    source = tmp_path / "in"
    for token, day in ((1, 1), (1, 1), (2, 10), (3, 20), (1, 21)):
        row = spark.createDataFrame([(token, day)], "token long, day int")
        stamped = row.select("token", F.make_timestamp(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("ts"))
        stamped.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema("token long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(source))
    kept = assessments.drain_appends(assessments.commit_once(stream, "2 days"), "expiry")
    assert sorted(r["token"] for r in kept.collect()) == [1, 1, 2, 3]


def test_stored_tables_follow_their_inputs(spark, tmp_path):
    from sward.session import forget_stored, stored_once

    folder = str(tmp_path / "tables")
    spark.range(3).write.parquet(f"{folder}/t.parquet")

    def stored():
        return stored_once(spark, f"{folder}/copy", lambda: spark.read.parquet(f"{folder}/t.parquet"))

    assert stored().count() == 3
    spark.range(2).write.mode("append").parquet(f"{folder}/t.parquet")
    assert stored().count() == 5
    forget_stored(spark)
    assert stored().count() == 5
