import datetime as dt

from pyspark.sql import functions as F

from tessera.streaming.windows import bursts, deduplicated, events_in_utc, sessions, windowed


def stream(spark, sf, tmp_path, make, mode="append"):
    t = spark.read.parquet(f"{sf}/events.parquet")
    for i in range(2):  # twice the same rows, in two files
        events_in_utc(t).write.parquet(f"file://{tmp_path}/in/{i}")
    schema = events_in_utc(t).schema
    source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")
    q = make(source).writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/cp").outputMode(mode).trigger(availableNow=True).start(f"file://{tmp_path}/out")
    q.awaitTermination()
    return spark.read.parquet(f"file://{tmp_path}/out")


def test_stream_equals_batch_on_closed_windows(spark, sf, tmp_path):
    got = stream(spark, sf, tmp_path, lambda s: windowed(s, "1 day", late="1 hour"))
    batch = windowed(events_in_utc(spark.read.parquet(f"{sf}/events.parquet")), "1 day")
    # The input holds each row twice.
    everything = {(r.window_start, r.event_type): (2 * r.n, round(2 * r.total, 2)) for r in batch.collect()}
    closed = {(r.window_start, r.event_type): (r.n, round(r.total, 2)) for r in got.collect()}
    last = max(w for w, _ in everything)
    # Every window but the last day's five is closed and complete.
    assert closed == {k: v for k, v in everything.items() if k[0] != last}
    assert len(everything) == 150 and len(closed) == 145


def test_late_rows_of_a_later_batch_are_dropped(spark, tmp_path):
    at = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    batches = [[("a", 1.0, at(0, 10)), ("a", 2.0, at(5))], [("a", 100.0, at(0, 50)), ("a", 4.0, at(4, 30)), ("a", 8.0, at(9))], [("a", 16.0, at(15))]]
    schema = "event_type string, value double, ts timestamp"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in/*")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
        q = windowed(source, "1 hour", late="1 hour").writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start(f"file://{tmp_path}/out")
        q.awaitTermination()
    got = {r.window_start.hour: (r.n, r.total) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()}
    # 0:50 comes after the watermark has passed 4:00 and is dropped; 4:30 is in time.
    assert got == {0: (1, 1.0), 4: (1, 4.0), 5: (1, 2.0), 9: (1, 8.0)}


def test_bursts_keep_state_across_batches(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    batches = [[(1, at(0)), (1, at(4)), (2, at(1)), (3, None)], [(1, at(6)), (2, at(30)), (1, at(7))], [(2, at(31)), (2, at(32)), (1, at(50)), (None, at(33))]]
    schema = "user_id long, ts timestamp"
    source = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in/*")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{i}")
        q = bursts(source, 3, "10 minutes").writeStream.format("parquet").option("checkpointLocation", f"file://{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start(f"file://{tmp_path}/out")
        q.awaitTermination()
    got = sorted((r.user_id, r.first.minute, r.last.minute, r.n) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    # User 1: 0, 4, 6 (third within ten minutes), then 7 starts anew; user 2: 30, 31, 32.
    assert got == [(1, 0, 6, 3), (2, 30, 32, 3)]


def test_duplicates_are_dropped(spark, sf, tmp_path):
    assert stream(spark, sf, tmp_path, lambda s: deduplicated(s, "60 days")).count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_session_ends_at_the_gap(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    e = spark.createDataFrame([(1, at(0)), (1, at(4)), (1, at(20)), (None, at(1))], "user_id long, ts timestamp")
    got = sorted((r.user_id or 0, r.n) for r in sessions(e, "10 minutes").collect())
    assert got == [(0, 1), (1, 1), (1, 2)]


def test_resumed_index_adds_only_new_files(spark, tmp_path):
    from tessera.streaming.windows import resume_index

    def add(name, rows):
        spark.createDataFrame(rows, "chunk_id string, text string").coalesce(1).write.mode("append").json(f"file://{tmp_path}/chunks")

    def run():
        q = resume_index(spark, f"file://{tmp_path}/chunks", "chunk_id string, text string", lambda c: c.withColumn("size", F.length("text")), f"file://{tmp_path}/vectors", f"file://{tmp_path}/cp")
        q.awaitTermination()
        return sorted(r.chunk_id for r in spark.read.parquet(f"file://{tmp_path}/vectors").collect())

    add("a", [("1", "x"), ("2", None)])
    assert run() == ["1", "2"] and run() == ["1", "2"]
    add("b", [("3", "y")])
    assert run() == ["1", "2", "3"]
