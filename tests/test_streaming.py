import datetime as dt

from pyspark.sql import functions as F

from tallyloom.sources.tables import read_current, write_replace
from tallyloom.streaming.micro_batch import daily_counts_stream, upsert_stream

from conftest import rows

SCHEMA = "id long, name string, amount long, landed timestamp"


def test_upsert_stream_matches_batch(spark, tmp_path):
    target = str(tmp_path / "dim")
    write_replace(spark.createDataFrame([(1, "a", 10, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
                                        "id long, name string, amount long, loaded_at timestamp, "
                                        "updated_at timestamp"), target)
    land = tmp_path / "landing"
    spark.createDataFrame([(1, "a2", 11, dt.datetime(2024, 2, 1)), (2, "b", 20, dt.datetime(2024, 2, 1))],
                          SCHEMA).write.parquet(str(land / "batch1"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(land / "*"))
    q = upsert_stream(stream, target, ["id"], "landed", checkpoint_location=str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = rows(read_current(spark, target), "id", "name", "amount", "updated_at")
    assert got == [(1, "a2", 11, dt.datetime(2024, 2, 1)), (2, "b", 20, dt.datetime(2024, 2, 1))]


def test_daily_counts_stream(spark, tmp_path):
    src = tmp_path / "events"
    spark.createDataFrame([("click", dt.datetime(2024, 1, 2, 3, 0)), ("click", dt.datetime(2024, 1, 2, 6, 0)),
                           ("view", dt.datetime(2024, 1, 2, 12, 0))], "event_type string, ts timestamp_ntz") \
        .write.parquet(str(src / "p1"))
    stream = spark.readStream.schema("event_type string, ts timestamp_ntz").parquet(str(src / "*"))
    out = tmp_path / "out"
    q = (daily_counts_stream(stream, "ts", ["event_type"], "America/Bogota")
         .writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "ck2"))
         .foreachBatch(lambda b, i: b.write.mode("append").parquet(str(out)))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = rows(spark.read.parquet(str(out)).groupBy("event_type", "day").agg(F.max("n_events").alias("n")))
    # 03:00 UTC is the previous local day in UTC-5
    assert got == [("click", dt.date(2024, 1, 1), 1), ("click", dt.date(2024, 1, 2), 1),
                   ("view", dt.date(2024, 1, 2), 1)]


def test_upsert_stream_rerun_is_exactly_once(spark, tmp_path):
    from tallyloom.sources.tables import current_version

    target = str(tmp_path / "dim2")
    write_replace(spark.createDataFrame([(1, "a", 10, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
                                        "id long, name string, amount long, loaded_at timestamp, "
                                        "updated_at timestamp"), target)
    land = tmp_path / "landing2"
    spark.createDataFrame([(2, "b", 20, dt.datetime(2024, 2, 1))], SCHEMA).write.parquet(str(land / "b1"))
    ck = str(tmp_path / "ck3")
    for _ in range(2):  # the second run finds no new files in the checkpoint's log
        upsert_stream(spark.readStream.schema(SCHEMA).parquet(str(land / "*")), target, ["id"], "landed",
                      checkpoint_location=ck).awaitTermination(120)
    first = current_version(spark, target)
    upsert_stream(spark.readStream.schema(SCHEMA).parquet(str(land / "*")), target, ["id"], "landed",
                  checkpoint_location=ck).awaitTermination(120)
    assert current_version(spark, target) == first
    assert read_current(spark, target).count() == 2


def test_upsert_partitions_stream(spark, tmp_path):
    from tallyloom.streaming.micro_batch import upsert_partitions_stream

    schema = "id long, region string, name string, landed timestamp"
    land, target = tmp_path / "landing", str(tmp_path / "dim")
    stream = spark.readStream.schema(schema).parquet(str(land / "*"))
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    for batch in ([(1, "a", "x", t1), (2, "b", "y", t1)], [(2, "b", "y2", t2), (3, "b", "z", t2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(land / f"b{batch[0][0]}"))
        q = upsert_partitions_stream(stream, target, ["id"], ["region"], "landed", checkpoint_location=str(tmp_path / "ck"))
        q.awaitTermination(120)
        assert q.exception() is None
    assert rows(spark.read.parquet(target), "id", "region", "name", "loaded_at", "updated_at") == [
        (1, "a", "x", t1, t1), (2, "b", "y2", t1, t2), (3, "b", "z", t2, t2)]
