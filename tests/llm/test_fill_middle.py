"""Fill-in-the-middle against plain slicing, and the exact way back."""

import hashlib
import random

import numpy as np
import pytest

from leadlake.llm import fill_middle
from tests.llm.conftest import edge_rows


def expected(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    lines = text.split("\n")
    units = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rnd = random.Random(3)
    out = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "<P>", "x<S>\ny", "<M", "S>\n<P\n>", "é\n\U0001f600\r\nü", "<\nP>\n<S\n>"]
    out += ["".join(rnd.choice("ab<>PSMé\n\n") for _ in range(rnd.randrange(1, 60))) for _ in range(200)]
    return out + ["line é\n" * 50_000]


@pytest.mark.parametrize("rate, spm_rate", [(100, 50), (40, 0), (100, 100)])
def test_brute_force(spark, rate, spm_rate):
    rows = [(i if i % 17 else None, t, i, "clash") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, output string")
    done = fill_middle.restore(fill_middle.transform(docs, rate=rate, spm_rate=spm_rate)).collect()
    assert sorted(r.kept.n for r in done) == list(range(len(rows)))
    for r in done:
        doc_id, text, _, _ = rows[r.kept.n]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output.decode()) == expected(doc_id, text, 7, rate, spm_rate)
        assert r.restored.decode() == (text or "") and r.kept.output == "clash"


def test_rotation_in_steps(monkeypatch):
    monkeypatch.setattr(fill_middle, "STEP", 3)
    for n in range(25):
        for cut in range(n + 1):
            data = np.arange(n, dtype=np.uint8)
            fill_middle.rotate(data, 0, cut, n)
            assert data.tolist() == [*range(cut, n), *range(cut)]


def test_edges(edge, empty):
    assert fill_middle.report(empty).count() == 0
    got = fill_middle.report(edge).collect()
    want = [(r[0], *expected(r[0], r[1])[:4], hashlib.sha256(expected(r[0], r[1])[4].encode()).hexdigest(),
             hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in edge_rows()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
