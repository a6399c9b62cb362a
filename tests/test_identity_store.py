"""Identities that grow batch by batch against one resolution of everything."""

import random
from collections import Counter, defaultdict

import pytest

from leadlake.operators import identity, identity_store
from tests.test_identity import frame, lead, random_rows


def partition(rows):
    """The sets of ids behind (id, component) rows with more than one member."""
    groups = defaultdict(set)
    for r in rows:
        groups[r.component].add(r.id)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("seed, batches", [(11, 2), (12, 4)])
def test_batches_equal_one_run(spark, tmp_path, seed, batches):
    rows = random_rows(seed, 160)
    random.Random(seed).shuffle(rows)
    folder, retired = str(tmp_path / "store"), set()
    for k in range(batches):
        before = {r.component for r in identity_store.labels(spark, folder).collect()}
        merges = identity_store.add_batch(frame(spark, rows[k::batches]), folder).collect()
        assert all(m.retired in before and m.kept in before for m in merges)
        after = {r.component for r in identity_store.labels(spark, folder).collect()}
        assert before - after == {m.retired for m in merges}  # a label stays or is reported
        retired |= {m.retired for m in merges}
    leads = frame(spark, rows)
    got = identity_store.labels(spark, folder)
    assert not retired & {r.component for r in got.collect()}
    assert partition(got.collect()) == partition(identity.cluster_labels(leads).collect())
    sizes = lambda labels: Counter(map(tuple, identity.golden_records(leads, labels).collect()))
    assert sizes(got) == sizes(None)


def test_merge_is_reported_and_repeats_change_nothing(spark, tmp_path):
    folder = str(tmp_path / "store")
    first = frame(spark, [lead(0, "Ann Lee", "a@x.com", "Acme"), lead(1, "Bob Ray", "b@y.com", "Bolt")])
    assert identity_store.add_batch(first, folder).count() == 0
    bridge = frame(spark, [lead(2, "Ann Lee", "b@y.com", "Acme")])
    (merge,) = identity_store.add_batch(bridge, folder).collect()
    assert merge.kept < merge.retired
    once = set(identity_store.labels(spark, folder).collect())
    assert len({r.component for r in once}) == 1
    assert identity_store.add_batch(bridge.unionByName(first), folder).count() == 0
    assert set(identity_store.labels(spark, folder).collect()) == once


def test_unfinished_batch_is_not_read(spark, tmp_path):
    folder = tmp_path / "store"
    identity_store.add_batch(frame(spark, [lead(0, "Ann Lee", "a@x.com")]), str(folder))
    (batch,) = folder.glob("batch-*")
    (batch / "done" / "_SUCCESS").unlink()
    assert identity_store.labels(spark, str(folder)).count() == 0
    identity_store.add_batch(frame(spark, []), str(folder))
    assert identity_store.labels(spark, str(folder)).count() == 0


def test_stored_names_are_not_compared_again(spark, tmp_path, monkeypatch):
    """Each pair of names with a new end once per rule; pairs of stored names were compared when they came."""
    folder, seen, plain = str(tmp_path / "store"), [], identity.similar_pairs

    def recorded(short, long, threshold, total):
        found = plain(short, long, threshold, total)
        seen.extend((threshold, r.own_a, *sorted((r.text_a, r.text_b))) for r in found.collect())
        return found

    monkeypatch.setattr(identity, "similar_pairs", recorded)
    names = ["Alexandra Bellingham", "Alexandra Bellinghan", "Alexandra Bellinghams"]
    rows = [lead(i, name, f"p{i}@x.com", company) for i, (name, company) in enumerate(zip(names, ("Acme", "Acme", "Acme")))]
    identity_store.add_batch(frame(spark, rows[:2]), folder)
    assert Counter(s[0] for s in seen) == {85: 1, 90: 1}
    seen.clear()
    identity_store.add_batch(frame(spark, rows[2:]), folder)
    assert Counter(s[0] for s in seen) == {85: 2, 90: 2}
    assert all("alexandra bellinghams" in s[2:] for s in seen)
    assert len({r.component for r in identity_store.labels(spark, folder).collect()}) == 1
