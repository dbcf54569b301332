from gearwatch.functions.messages import encode_messages
from gearwatch.plans.store import Store
from gearwatch.sources.fixtures import messages, telemetry
from gearwatch.streaming.ingest import ingest_stream, machine_feed, read_message_files, score_stream
from pyspark.sql import functions as F


def test_stream_is_ingested_once(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    files = str(tmp_path / "in")
    rows = messages(spark, folder)
    total = rows.count()
    rows.filter("arrival_seq < 500").coalesce(1).write.parquet(files)
    def drain(feed):
        ingest_stream(store, read_message_files(spark, files), feed, str(tmp_path / feed)).awaitTermination()
    drain("a")
    half = store.raw().count()
    rows.filter("arrival_seq >= 500").coalesce(1).write.mode("append").parquet(files)
    drain("a")
    drain("a")
    counts = store.ingests().agg(F.sum("consumed"), F.sum("inserted"), F.sum("skipped")).first()
    assert counts[0] + counts[2] == total and counts[0] == counts[1] == store.raw().count() > half
    drain("b")
    assert store.raw().count() == counts[1]
    assert store.quarantine().filter("ingest_id LIKE 'a-%'").count() == counts[2]
    ids = store.raw().agg(F.count_distinct("raw_id")).first()[0]
    assert ids == counts[1]


def test_messages_of_one_file_are_parsed_by_all_cores(spark, folder, tmp_path):
    store, files = Store(spark, str(tmp_path / "store")).create(), str(tmp_path / "in")
    messages(spark, folder).coalesce(1).write.parquet(files)
    ingest_stream(store, read_message_files(spark, files), "a", str(tmp_path / "a")).awaitTermination()
    parsed = spark.read.parquet(f"{store.root}/staging/classified/ingest_id=a-0").groupBy(F.input_file_name()).count().collect()
    assert len(parsed) == spark.sparkContext.defaultParallelism and max(r["count"] for r in parsed) <= 2 * min(r["count"] for r in parsed)
    ids = store.raw().agg(F.min("raw_id"), F.max("raw_id"), F.count("raw_id")).first()
    assert ids[0] == 1 and ids[1] == ids[2] and store.raw().orderBy("raw_id").select("time_in_cycles").take(2)[0][0] == 4


def test_scoring_follows_the_ingests(spark, folder, tmp_path):
    store = Store(spark, str(tmp_path / "store")).create()
    rows = telemetry(spark, folder).withColumn("arrival_seq", F.col("raw_id") - 1).drop("raw_id")
    total = rows.count()
    for part, (low, high) in enumerate([(0, total // 2), (total // 2, total)]):
        store.ingest(rows.filter(F.col("arrival_seq").between(low, high - 1)), f"p-{part}")
        score_stream(store, str(tmp_path / "offsets")).awaitTermination()
    assert store.checkpoint()["last_processed_raw_id"] == total == store.processed().count()
    assert store.runs().filter("run_type = 'stream' AND status = 'SUCCESS' AND raw_rows_used > 0").count() == 2


def test_machine_feed_has_its_own_default_source(spark, folder):
    wire = machine_feed(messages(spark, folder))
    sources = {r.key.split(":")[0] for r in wire.collect()}
    assert "MQTT" in sources and "B" in sources and "UNKNOWN" not in sources
    assert wire.columns == encode_messages(telemetry(spark, folder)).columns
