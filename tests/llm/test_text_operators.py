"""Text operators against brute force, and their defined results for awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
import zlib

from leadlake.llm import boosting, mixing, pii, quality, sentencepiece_codec, sharding, simhash, suffix_dedup, toxicity
from tests.llm.conftest import edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


# ------------------------------------------------------------------------------------------ suffix dedup

def brute_repeats(texts, window=400):
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        edges = np.diff(np.r_[0, gone.astype(int), 0])
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def passages():
    rnd = random.Random(5)
    noise = lambda n: "".join(rnd.choice("abcdefg ") for _ in range(n))
    shared = [noise(n) for n in (399, 400, 401, 500, 900)]
    texts = [None, "", "x" * 399, "x" * 400, "x" * 1000, "ab" * 700, noise(2000), "é" * 300 + shared[1]]
    for _ in range(40):
        texts.append("".join(rnd.choice([noise(rnd.randrange(5, 700)), rnd.choice(shared), rnd.choice(shared)[rnd.randrange(90):]])
                             for _ in range(rnd.randrange(1, 6))))
    return texts + [texts[10], texts[10], texts[12] + "é"]


@pytest.mark.parametrize("bucket", [2048, 2])
def test_suffix_dedup_brute_force(spark, bucket):
    texts = passages()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, h string")
    got = suffix_dedup.remove_repeats(docs, bucket).collect()
    want = brute_repeats([(t or "").encode() for t in texts])
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == dict(enumerate(want))


def test_suffix_pieces_do_not_change_results(monkeypatch):
    text = passages()[6].encode() * 2
    whole = suffix_dedup.text_stretches(text)
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    suffix_dedup._powers.cache_clear()
    parts = suffix_dedup.text_stretches(text)
    suffix_dedup._powers.cache_clear()
    total = lambda rows: sum(r[2] * (1 + len(r[1] or ())) for r in rows)
    assert total(whole) == total(parts) == len(text) - 399


def test_difference_cover():
    pairs = {(a - b) % suffix_dedup.COVER for a in suffix_dedup.RESIDUES for b in suffix_dedup.RESIDUES}
    assert pairs == set(range(suffix_dedup.COVER))


def test_suffix_dedup_edges(edge, empty):
    got = suffix_dedup.report(edge)
    assert suffix_dedup.report(empty).count() == 0
    rows = by_id(got.collect())
    assert len(rows) == len(edge_rows())
    assert (rows[0].n_bytes, rows[0].kept_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert {r.doc_id: r.n_removed for r in rows}[6] == 20_000


# ---------------------------------------------------------------------------------------------- simhash

def brute_fingerprint(text):
    words = re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, linked):
    parent = list(range(len(items)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_simhash_brute_force(spark, edge, empty):
    rnd = random.Random(2)
    texts = [r[1] for r in edge_rows() if r[0] is not None and len(r[1] or "") < 5000]
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randrange(1, 4) for _ in range(rnd.randrange(3, 300))) for _ in range(25)]
    for text in base:
        words = text.split()
        texts.append(text)
        for _ in range(4):
            words[rnd.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    parts = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in range(len(texts))] == parts
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(edge_rows())
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_representatives(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 5, 6, 7, 9, 10]


def test_simhash_keeps_one_row_per_component_of_repeated_ids(spark):
    """An id with unrelated texts represents only the components that it names."""
    rnd = random.Random(4)
    a, b = (" ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400)) for _ in range(2))
    rows = [(3, a + " x"), (5, a), (5, b), (5, b), (7, b), (9, None), (9, ""), (9, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in simhash.keep_representatives(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, a + " x"), (5, b), (9, None)], key=str)


@pytest.mark.parametrize("distance,total", [(4, 1000), (4, 10**8), (3, 10**6), (6, 10**5)])
def test_pigeonhole_loses_no_pair(distance, total):
    """Thresholds sum to distance - parts + 1, so some bucket mask hides all differing bits of any near pair."""
    rnd = np.random.default_rng(1)
    sample = rnd.integers(0, 1 << 63, 500, dtype=np.uint64)
    groups, limits = simhash.allocate(sample, total, distance)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert sum(limits) == distance - len(groups) + 1
    masks = simhash.bucket_masks(groups, limits)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rnd.choice(64, distance, replace=False))
        assert any(not flips & m for m in masks)


def test_hot_buckets_are_split(spark, monkeypatch):
    """Blocks of a bucket are compared with each other and themselves exactly once."""
    from leadlake.llm import blocks
    import pyarrow as pa
    rows = spark.createDataFrame([(0, 7, i) for i in range(50)] + [(1, 9, 1)], "tag int, key long, id long")

    def pairs(table, i, j):
        ids = table.column("id").to_numpy()
        return pa.table({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})

    got = blocks.map_pairs(blocks.block_groups(rows, "id", 8), pairs, "a long, b long").collect()
    assert sorted((r.a, r.b) for r in got) == [(a, b) for a in range(50) for b in range(a + 1, 50)]


# ---------------------------------------------------------------------------------------------- quality

def brute_statistics(text):
    text = text or ""
    words = re.findall(WORD, text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {k + d for k in range(len(words) - 2) if grams[tuple(words[k:k + 3])] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_quality_brute_force(edge, empty, labels):
    rows = quality.assess(edge, labels).collect()
    got = Counter(tuple(r)[:6] for r in rows)
    assert got == Counter((r[0], *brute_statistics(r[1])) for r in edge_rows())
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # too few labels for trees
    assert quality.assess(empty, labels).count() == 0
    assert quality.assess(edge, labels.limit(0)).count() == len(edge_rows())
    assert quality.keep_good(edge, labels).columns == edge.columns


def test_quality_statistics_on_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = {r.doc_id: r for r in quality.assess(docs, labels).collect()}
    for d in docs.collect():
        assert tuple(rows[d.doc_id])[1:6] == brute_statistics(d.text)
    known = [(rows[r.doc_id], r.quality) for r in labels.collect()]
    assert np.mean([r.kept == bool(q) for r, q in known if not r.base_failed]) > 0.97


def test_boosting_is_monotone_and_flat_form_agrees(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(1500, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] + rnd.normal(size=1500) * 0.5) > 0).astype(float)
    forest = boosting.fit(x, y, {0: 1, 1: -1}, trees=20, depth=3)
    line = np.linspace(-3, 3, 200)
    for other in (-1.0, 0.0, 1.0):
        margin = forest.margin(np.stack([line, np.full(200, other), np.full(200, 0.3)], axis=1))
        assert (np.diff(margin) >= -1e-12).all()
        margin = forest.margin(np.stack([np.full(200, other), line, np.full(200, 0.3)], axis=1))
        assert (np.diff(margin) <= 1e-12).all()
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], "a double, b double, c double")
    got = [r[0] for r in frame.select(forest.column([frame.a, frame.b, frame.c])).collect()]
    assert np.allclose(sorted(got), sorted(forest.margin(x[:200])))


# --------------------------------------------------------------------------------------------- toxicity

def test_toxicity_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    pairs = []
    for r in labels.collect():
        score = rows[r.doc_id]
        assert score.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= score.score <= 1 and score.predicted == int(score.score >= 0.3)
        if score.held_out:
            pairs.append((score.score, r.toxic))
    scores, truth = np.array(pairs).T
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    positives = truth.sum()
    area = (rank[truth == 1].sum() - positives * (positives - 1) / 2) / (positives * (len(truth) - positives))
    assert area > 0.88


def test_toxicity_learns_from_whole_texts(spark):
    """A toxic word counts wherever it stands in a long labelled text."""
    rnd = random.Random(8)
    words = lambda n: ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    rows = []
    for i in range(160):
        plain = words(3000 if i < 60 else 60)  # 21,000 bytes or short
        if i < 60:
            while True:
                mixed = list(plain)
                mixed[rnd.randrange(2000, 3000)] = "zorblaxer"
                text = " ".join(mixed)
                if any(b"zorblaxer" in w for w in toxicity.windows(text.encode())[1::2]):
                    break
        rows.append((i, text if i < 60 else " ".join(plain)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i < 60)) for i in range(160)], "doc_id long, quality int, toxic int")
    assert b" zorblaxer" in toxicity.train(docs, labels).toxic


def test_toxicity_edges(edge, empty, labels):
    rows = toxicity.classify(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.classify(empty, labels).count() == 0
    assert toxicity.classify(edge, labels.limit(0)).select("score").distinct().count() == 1
    assert b"".join(toxicity.windows(b"One two " * 100)) == b" " + b"one two " * 100


# --------------------------------------------------------------------------------------------- sharding

def test_best_fit_decreasing_matches_plain_search():
    rnd = random.Random(3)
    for _ in range(30):
        sizes = [rnd.randrange(1, 60) for _ in range(rnd.randrange(1, 80))]
        bins = []
        for s in sorted(sizes, reverse=True):
            fitting = [k for k, left in enumerate(bins) if left >= s]
            if fitting:
                k = min(fitting, key=lambda k: (bins[k], k))
                bins[k] -= s
            else:
                bins.append(100 - s)
        placed = list(sharding.best_fit_decreasing(list(Counter(sizes).items()), 100))
        used = Counter()
        for size, shard, number in placed:
            used[shard] += size * number
        assert sorted(100 - u for u in used.values()) == sorted(bins)


def test_sharding(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.pack_into(docs, 16).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    weight, slots, homes = Counter(), {}, {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        weight[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        assert homes.setdefault(texts[r.doc_id], r.shard) == r.shard
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(weight.values()) < 1.01 * min(weight.values())
    rows = sharding.pack_into(edge, 4).collect()
    assert len(rows) == len(edge_rows()) and len({r.shard for r in rows if r.size == 1}) == 1
    assert sharding.pack_into(empty, 4).count() == 0
    shards = {r.doc_id: r.shard for r in sharding.pack(edge, 30_000).collect()}
    assert [d for d, s in shards.items() if s == 1] == [5]  # larger than a shard: alone


# ---------------------------------------------------------------------------------------- sentencepiece

@pytest.fixture(scope="session")
def unigram_file(tmp_path_factory):
    """The same pieces as a unigram model; scores of -1e9 are raised, because single precision would blur all others."""
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    with open(sentencepiece_codec.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_viterbi_matches_library(spark, unigram_file):
    codec = sentencepiece_codec.Encoder(sentencepiece_codec.load(unigram_file))
    library = sentencepiece.SentencePieceProcessor(model_file=unigram_file)
    sentences = ["", " ", "  a  b ", "日本語😀 x", "x" * 300, "the lere hest"]
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        sentences += [s for line in r.text.split("\n")[:10] for s in line.split(". ")[:4]]
    for sentence in sentences:
        ids = codec.encode(sentence)
        assert ids == library.encode(sentence)
        assert library.decode(ids) == sentence == codec.decode(ids)


def test_streaming_equals_whole_search(monkeypatch):
    codec = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdehinorst \n▁é") for _ in range(rnd.randrange(1, 900))) for _ in range(40)]
    streamed = [list(codec.search(" " + t)) for t in texts]
    assert streamed == [codec.encode(t) for t in texts]
    monkeypatch.setattr(sentencepiece_codec, "LOOK", 10**9)  # commit only at the end
    assert streamed == [list(codec.search(" " + t)) for t in texts]
    assert [codec.decode(i) for i in streamed] == texts


def test_long_words_go_through_the_window(monkeypatch):
    codec = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    rnd = random.Random(5)
    texts = ["a" * 5000, "".join(rnd.choice("abcdefXYZ0123456789+/") for _ in range(5000)), "short words " * 30]
    want = [codec.encode(t) for t in texts]
    whole, lengths = codec._word, []
    codec = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    monkeypatch.setattr(codec, "_word", lambda word: lengths.append(len(word)) or whole(word))
    assert [codec.encode(t) for t in texts] == want == [list(codec.search(" " + t)) for t in texts]
    assert lengths and max(lengths) <= sentencepiece_codec.LONGEST_WORD


def test_search_commits_before_the_end():
    codec = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    read = []

    class Watched(str):
        def __getitem__(self, at):
            read.append(at if isinstance(at, int) else at.stop)
            return super().__getitem__(at)

    next(codec.search(Watched(" the house" * 500)))
    assert max(read) < 1000


def test_sentencepiece_documents(spark, edge, empty):
    rows = sentencepiece_codec.encode_documents(edge)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows.collect())
    texts = sentencepiece_codec.decode_documents(rows).collect()
    assert Counter((r.doc_id, r.text) for r in texts) == Counter((r[0], r[1] or "") for r in edge_rows())
    assert sentencepiece_codec.encode_documents(empty).count() == 0


# ----------------------------------------------------------------------------------------------- mixing

def test_mixing_targets_and_rows(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, targets, taken, cut = Counter(), {}, Counter(), Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        cut[r.source] += r.taken not in (0, r.size, 2 * r.size)
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    goal, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    while True:  # share by weight until no target is above its limit
        left = 1.5 * sum(sizes.values()) - sum(goal[s] for s in sizes if s not in open_)
        shares = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = {s for s in open_ if shares[s] > 2 * sizes[s]}
        goal.update(shares)
        if not full:
            break
        goal.update({s: 2.0 * sizes[s] for s in full})
        open_ -= full
    for s in sizes:
        assert math.isclose(targets[s], goal[s], rel_tol=1e-9)
        assert targets[s] - 1 <= taken[s] <= targets[s] and cut[s] <= 1
    assert Counter(map(str, rows)) == Counter(map(str, mixing.mix(docs.repartition(3)).collect()))
    got = mixing.mix(edge).collect()
    assert len(got) == len(edge_rows()) and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns
    assert mixed.count() == sum(len(r.finishes) for r in got) > 0


# -------------------------------------------------------------------------------------------------- pii

RULES = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def brute_pii(text):
    found = []
    for place, (kind, pattern) in enumerate(RULES):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255
                    or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            found.append((m.start(), place, m.end(), kind))
    return sorted(found)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


def test_pii_rules(spark, edge, empty):
    hard = ["a@b.c_x@y.z", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 0.0.0.0", "ä +1 (736) 555-2678 x", "é a.b@c.d.e", "@" * 50,
            "9" * 30_000, "x" * 30_000 + "@y", "+1" + "2" * 20, "+12 3.4-", "a@b", "..@..", "+4 (1) 2-3 4 5 6 7 8 9",
            "\U0001f600 a@b.co 1.1.1.1", "4111-1111-1111-1111 4111 1111 1111 1112", "1.2.3.4@5.6.7.8", "+1+2345678901 +"]
    rnd = random.Random(6)
    hard += ["".join(rnd.choice("0123456789.+-@ ()ab_é") for _ in range(rnd.randrange(5, 120))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    for i, text in enumerate(hard):
        want = brute_pii(text)
        assert got[i].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), text
        assert tuple(got[i])[1:5] == tuple(sum(s[3] == k for s in want) for k, _ in RULES)
        assert set(listed(want).split(",")) - {""} <= set(got[i].spans.split(","))
    rows = by_id(pii.report(edge).collect())
    assert len(rows) == len(edge_rows()) and rows[0].spans == ""
    assert pii.report(empty).count() == 0
    clean = {r.doc_id: r.text for r in pii.redact(edge).collect()}
    assert pii.redact(edge).columns == edge.columns
    assert clean[1] is None and clean[10] == "mail me at [EMAIL] or [PHONE], [IP] and [CARD]."


def test_pii_trees_add_formats_the_rules_miss(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    forest, limits = pii.fit_model(docs)
    assert forest is not None and np.isfinite(limits["phone"])
    extra = spark.createDataFrame([(-1, "Bitte call (736) 555-2678 heute"), (-2, "version 2.0 of 3 things")],
                                  "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.report(docs.unionByName(extra)).filter("doc_id < 0").collect()}
    assert spans[-1].startswith("phone:") and spans[-2] == ""


def test_pii_thresholds_come_from_the_whole_table(spark, monkeypatch):
    """Kinds that are rare in the sample get a threshold from the other documents."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 1500)
    forest, limits = pii.fit_model(docs)
    assert forest is not None and all(np.isfinite(limits[k]) for k in ("email", "ip", "phone"))


def test_pii_many_spans_in_one_text(spark):
    """Tens of thousands of spans in a text: offsets, sweep and redaction work block by block."""
    hits = [f"user{i}@example{i % 97}.com" if i % 3 else f"10.{i % 256}.0.1" for i in range(20_000)]
    text, spans, at = " é ".join(hits), [], 0
    for hit in hits:
        spans.append(f"{'email' if '@' in hit else 'ip'}:{at}:{at + len(hit)}")
        at += len(hit) + 3
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.report(docs).first()
    assert row.spans == ",".join(spans) and row.n_email + row.n_ip == len(hits)
    assert pii.redact(docs).first().text == " é ".join("[EMAIL]" if "@" in h else "[IP]" for h in hits)


@pytest.mark.parametrize("doc_id", [7, None])
def test_suffix_dedup_many_rows_with_one_id(spark, doc_id):
    """Rows that repeat as a whole are listed once, so the work stays in proportion to the rows."""
    rnd = random.Random(3)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(6000))
    other = text[:500] + "".join(rnd.choice("abcdefgh ") for _ in range(700))
    docs = spark.createDataFrame([(doc_id, text)] * 1500 + [(9, other)], "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(docs).collect())
    assert got == {(doc_id, 6000, 6000, 1): 1500, (9, 1200, 500, 1): 1}
