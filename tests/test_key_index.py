"""Deduplication against an index of keys: same rows as by hand, replays, merges, and what is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.operators import key_index

COLUMNS = ["email", "source"]
SCHEMA = "lead_id string, email string, source string"


def batch(spark, *keys):
    return spark.createDataFrame([(f"l{i:04d}", *key) for i, key in enumerate(keys)], SCHEMA)


def append(spark, base, name, *keys):
    key_index.append_new(batch(spark, *keys), COLUMNS, [F.col("lead_id")], f"{base}/t", f"{base}/k", name)
    return sorted(((r.email, r.source) for r in spark.read.parquet(f"{base}/t").collect()), key=str)


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(key_index, "BUCKET_KEYS", 50)


def test_filter_holds_its_hashes():
    rng = np.random.default_rng(1)
    inside, outside = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(-2**63, 2**63 - 1, 20000)
    for stride in (1, 64):
        held = inside // stride * stride
        bits = key_index.bloom(held)
        assert key_index.may_contain(bits, held).all()
        assert key_index.may_contain(bits, outside // stride * stride).mean() < 0.03
    assert not key_index.may_contain(key_index.bloom(inside[:0]), inside).any()


def test_batches_against_a_set(spark, tmp_path, small_buckets, monkeypatch):
    monkeypatch.setattr(key_index, "FAN", 3)
    rng = np.random.default_rng(2)
    seen = set()
    for number in range(7):
        keys = [(f"u{k}@x.com", ("a", "b")[k % 2]) for k in rng.integers(0, 400, 120)] + [(None, "a"), ("", None), (None, None), ("u1@x.com", "a")]
        seen |= set(keys)
        assert append(spark, tmp_path, f"b{number}", *keys) == sorted(seen, key=str)
    levels = [r.level for r in key_index.runs(spark, f"{tmp_path}/k")]
    assert max(levels) == 1 and all(levels.count(level) <= 3 for level in levels)
    append(spark, tmp_path, "empty")
    assert append(spark, tmp_path, "again", *seen) == sorted(seen, key=str)


def test_replay_gives_the_same_rows(spark, tmp_path):
    append(spark, tmp_path, "b0", ("a", "x"), ("a", "x"), (None, "x"))
    for _ in range(2):  # the batch was whole, but its end was not recorded
        rows = append(spark, tmp_path, "b1", ("a", "x"), ("b", "x"))
        assert rows == sorted([("a", "x"), ("b", "x"), (None, "x")], key=str)
    # Rows were written, but the run has no mark.
    key_index._filesystem(spark, f"{tmp_path}/k/b1/done")[0].delete(key_index._filesystem(spark, f"{tmp_path}/k/b1/done")[1], True)
    assert append(spark, tmp_path, "b1", ("a", "x"), ("b", "x")) == rows
    assert append(spark, tmp_path, "b2", ("b", "x")) == rows


def test_reading_follows_the_batch(spark, tmp_path, small_buckets):
    """The same batch reads as many buckets of a table of 16,000 keys as of one of 2,000."""
    asked = spark.range(1_000_000, 1_000_010).unionAll(spark.range(5)).select(F.col("id").cast("string").alias("id"))
    sizes = []
    for rows in (2_000, 16_000):
        folder = f"{tmp_path}/k{rows}"
        key_index.rebuild(spark.range(rows).select(F.col("id").cast("string").alias("id")), ["id"], folder, "all")
        (run,) = key_index.runs(spark, folder)
        assert run.buckets == rows // 50
        read = key_index.buckets_to_read(asked, ["id"], folder)
        sizes.append(len(read["all"]))
        assert {r.id for r in key_index.known_keys(asked, ["id"], folder).collect()} == {str(i) for i in range(5)}
    assert max(sizes) <= 7


def test_rebuild_replaces_all_runs(spark, tmp_path):
    append(spark, tmp_path, "b0", ("a", "x"))
    append(spark, tmp_path, "b1", ("b", "x"))
    key_index.rebuild(spark.read.parquet(f"{tmp_path}/t"), COLUMNS, f"{tmp_path}/k", "all")
    assert [r.name for r in key_index.runs(spark, f"{tmp_path}/k")] == ["all"]
    assert append(spark, tmp_path, "b2", ("b", "x"), ("c", "x")) == [("a", "x"), ("b", "x"), ("c", "x")]
