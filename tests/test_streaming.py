"""File streams through bronze and silver: restarts, repeats across batches, bad messages, late rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadlake.operators import medallion
from leadlake.schemas import BRONZE_LEAD
from leadlake.streaming import jobs

ENVELOPE = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def message(i, email, source="apollo", minute=0, **more):
    value = json.dumps({"lead_id": f"l{i}", "source": source, "first_name": "Ann", "last_name": "Lee", "email": email, **more})
    return (f"l{i}", value, "leads", 0, i, datetime(2026, 6, 1, minute // 60, minute % 60))


def land(spark, folder, *rows):
    frame = spark.createDataFrame(list(rows), ENVELOPE).coalesce(1)
    frame.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic", "partition", "offset", "timestamp").write.mode("append").parquet(folder)


def envelope_stream(spark, folder):
    return spark.readStream.schema("key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp").parquet(folder)


def bronze_pass(spark, base):
    jobs.start_bronze(envelope_stream(spark, f"{base}/in"), f"{base}/bronze", f"{base}/cp_b", every=None).awaitTermination()


def silver_pass(spark, base, dedup, **options):
    bronze = jobs.read_bronze_stream(spark, f"{base}/bronze", BRONZE_LEAD + ", kafka_timestamp timestamp")
    jobs.start_silver(bronze, f"{base}/silver", f"{base}/cp_s", every=None, dedup=dedup, **options).awaitTermination()
    return spark.read.parquet(f"{base}/silver")


def test_bronze_restart_and_bad_messages(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/in", message(1, "a@x.com", employee_count=12, extra="kept in raw"), ("l2", "{broken", "leads", 0, 2, None),
         ("l3", "[1]", "leads", 0, 3, None), message(4, "b@x.com", "hubspot"))
    bronze_pass(spark, base)
    bronze_pass(spark, base)  # nothing new: the checkpoint remembers
    land(spark, f"{base}/in", message(5, "c@x.com"))
    bronze_pass(spark, base)
    bronze = spark.read.parquet(f"{base}/bronze")
    rows = {r.kafka_key: r for r in bronze.collect()}
    assert bronze.count() == len(rows) == 4 + 1
    assert [rows[k].is_corrupt for k in ("l1", "l2", "l3", "l4", "l5")] == [False, True, True, False, False]
    assert rows["l1"].employee_count == 12 and "kept in raw" in rows["l1"].raw_value and rows["l2"].raw_value == "{broken"
    assert (tmp_path / "bronze" / "source=hubspot").is_dir()


@pytest.mark.parametrize("dedup", ["exact", "watermark", "table", "index"])
def test_repeats_across_batches(spark, tmp_path, dedup):
    base = str(tmp_path)
    land(spark, f"{base}/in", message(1, "a@x.com", minute=1), message(2, " A@X.com ", minute=2), message(3, "a@x.com", "hubspot", 3),
         message(6, None, minute=3), message(7, None, minute=3))
    bronze_pass(spark, base)
    assert silver_pass(spark, base, dedup).count() == 3
    land(spark, f"{base}/in", message(4, "a@x.com", minute=4), message(5, "b@x.com", minute=5), message(8, None, minute=5))
    bronze_pass(spark, base)
    silver = silver_pass(spark, base, dedup)
    assert {(r.email, r.source) for r in silver.collect()} == {
        ("a@x.com", "apollo"), ("a@x.com", "hubspot"), ("b@x.com", "apollo"), (None, "apollo")}
    assert silver.count() == 4
    assert "layer" in silver.columns and "processed_at" in silver.columns


def test_row_past_the_watermark_is_dropped(spark, tmp_path):
    base = str(tmp_path)
    for number, minute in ((1, 600), (2, 601), (3, 5)):
        land(spark, f"{base}/in", message(number, f"p{number}@x.com", minute=minute))
        bronze_pass(spark, base)
        silver = silver_pass(spark, base, "watermark", delay="10 minutes")
    assert {r.lead_id for r in silver.collect()} == {"l1", "l2"}


def test_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = spark.createDataFrame([("l1", "a@x.com", "apollo"), ("l2", None, "apollo")], "lead_id string, email string, source string")
    for _ in range(2):
        jobs.append_new_keys(batch, path, ["email", "source"])
    assert spark.read.parquet(path).count() == 2


def test_two_streams_run_together(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/in", message(1, "a@x.com"))
    queries = [jobs.start_bronze(envelope_stream(spark, f"{base}/in"), f"{base}/out{i}", f"{base}/cp{i}", every=None) for i in (1, 2)]
    jobs.run_streams(spark)
    for q in queries:
        q.awaitTermination()
    assert [spark.read.parquet(f"{base}/out{i}").count() for i in (1, 2)] == [1, 1]


def test_batch_and_stream_parse_alike(spark, tmp_path):
    base = str(tmp_path)
    land(spark, f"{base}/in", message(1, "a@x.com"), message(2, "b@x.com", "hubspot"))
    bronze_pass(spark, base)
    batch = medallion.parse_envelope(spark.read.parquet(f"{base}/in"))
    columns = [c for c in batch.columns if c != "bronze_loaded_at"]
    assert batch.select(columns).exceptAll(spark.read.parquet(f"{base}/bronze").select(columns)).isEmpty()


def test_bronze_writes_folders_side_by_side(spark, tmp_path):
    """No sort of a task's rows by folder; with more folders than are written side by side nothing is lost."""
    base, sources = str(tmp_path), jobs.OPEN_FOLDERS + 8
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    land(spark, f"{base}/in", *(message(i, f"p{i}@x.com", f"s{i % sources}") for i in range(3 * sources)), ("bad", "{", "leads", 0, -1, None))
    bronze_pass(spark, base)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    bronze = spark.read.parquet(f"{base}/bronze")
    assert sorted((r.kafka_key, r.source) for r in bronze.filter("not is_corrupt").collect()) == sorted(
        (f"l{i}", f"s{i % sources}") for i in range(3 * sources))
    assert bronze.filter("is_corrupt").count() == 1
