from pyspark.sql import functions as F

from rollbook.operators import history
from rollbook.operators.inventory import InventoryStore
from rollbook.streaming import runs


def test_runs_as_batches(spark, tmp_path):
    schema = "authority string, property_name string, url string, seq long"
    folder = str(tmp_path / "in")
    spark.createDataFrame([("A", "P", "https://x.example/p", 1)], schema).coalesce(1).write.json(folder)
    store = InventoryStore(spark, str(tmp_path / "store"))
    targets = spark.createDataFrame([("A", "eden", "", "")], "authority string, scraping_measures string, validated_zero string, validated_zero_review_due string")
    for name in ("P", "Q"):
        q = runs.stream_runs(spark.readStream.schema(schema).json(folder), store, targets, str(tmp_path / "cp"), "2025-01-01T00:00:00")
        q.awaitTermination()
        spark.createDataFrame([("A", "Q", "https://x.example/q", 2)], schema).coalesce(1).write.mode("append").json(folder)
    got = {r.property_name: (r.first_run_id, r.last_run_id) for r in store.read().collect()}
    assert got["P"][0] == "B00000000000000" and got["Q"][0] == "B00000000000001"


def test_batches_have_times_and_failed_sources(spark, tmp_path):
    schema = "authority string, property_name string, url string"
    folder = str(tmp_path / "in")
    store = InventoryStore(spark, str(tmp_path / "store"))
    targets = spark.createDataFrame([("A", "eden", "", "")], "authority string, scraping_measures string, validated_zero string, validated_zero_review_due string")
    seen = []

    def outcomes(number):
        seen.append(number)
        return spark.createDataFrame([("B", True)], "authority string, had_error boolean")

    rows = [("A", "P", "https://x.example/p"), ("A", "P", "https://x.example/p"), ("B", "Q", "https://x.example/q")]
    spark.createDataFrame(rows, schema).coalesce(1).write.json(folder)
    runs.stream_runs(spark.readStream.schema(schema).json(folder), store, targets, str(tmp_path / "cp"), lambda n: f"2025-01-0{n + 1}T00:00:00", outcomes=outcomes).awaitTermination()
    got = sorted((r.property_name, r.first_seen) for r in store.read().collect())
    assert got == [("P", "2025-01-01T00:00:00"), ("Q", "2025-01-01T00:00:00")] and seen == [0]
    assert store.previous_full_run() is None, "a run with failed sources is no baseline"


def test_chains_from_stream(spark, tmp_path):
    schema = "entity long, value string, seen timestamp_ntz, first_seen timestamp_ntz, received timestamp_ntz, tie string"
    folder = str(tmp_path / "in")

    def put(rows):
        df = spark.createDataFrame(rows, "entity long, value string, t string")
        t = F.col("t").cast("timestamp_ntz")
        df.select("entity", "value", t.alias("seen"), t.alias("first_seen"), t.alias("received"), F.lit("x").alias("tie")).coalesce(1).write.mode("append").parquet(folder)

    store = history.ChainStore(spark, str(tmp_path / "store"))
    (tmp_path / "store").mkdir()
    for rows in ([(1, "open", "2025-01-01"), (2, "open", "2025-01-01")], [(1, "closed", "2025-02-01"), (1, "waitlist", "2025-01-15")]):
        put(rows)
        runs.stream_chains(spark.readStream.schema(schema).parquet(folder), str(tmp_path / "raw"), store, str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.entity, r.value) for r in store.current().collect())
    assert got == [(1, "closed"), (1, "open"), (1, "waitlist"), (2, "open")]


def test_windows_and_quiet_sources(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "2024-01-01T00:00:00"), ("b", "2024-01-01T05:00:00"), ("a", "2024-01-20T00:00:00")], "event_type string, t string")
    rows.select("event_type", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.parquet(folder)
    batch = runs.windowed_counts(spark.read.parquet(folder), "ts")
    assert sorted(r.n for r in batch.collect()) == [1, 1, 1]
    stream = spark.readStream.schema("event_type string, ts timestamp").parquet(folder)
    q = runs.stale_sources(stream, "event_type", "ts").writeStream.format("memory").queryName("quiet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    got = {(r.key, r.stale) for r in spark.table("quiet").collect()}
    assert ("a", False) in got and ("b", False) in got
