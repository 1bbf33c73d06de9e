import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from noisefield.llm import periods, queries as Q
from tests.conftest import SF


def _plain(w, least_length=24, least_periods=3):
    """All runs by trying every period at every place."""
    found, n = {}, len(w)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - a >= max(least_length, least_periods * q):
                found.setdefault((a, i + q - a), q)
    return sorted((a, length, q) for (a, length), q in found.items())


def _texts(rng):
    for _ in range(300):
        w = []
        while len(w) < rng.randrange(1, 160):
            kind = rng.random()
            if kind < 0.3:
                w += [rng.randrange(3) for _ in range(rng.randrange(30))]
            elif kind < 0.8:
                root = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
                w += (root * 20)[: rng.randrange(90)]
            else:
                w += [100 + len(w) + k for k in range(rng.randrange(6))]
        yield w


def test_runs_against_every_period_at_every_place():
    rng = random.Random(11)
    for w in _texts(rng):
        assert [tuple(r) for r in periods.runs(np.array(w, np.int64)).tolist()] == _plain(w)
        assert [tuple(r) for r in periods.runs(np.array(w, np.int64), 4, 2).tolist()] == _plain(w, 4, 2)
    fib = "a"
    before = "b"
    while len(fib) < 400:
        fib, before = fib + before, fib
    w = [ord(c) for c in fib]
    assert [tuple(r) for r in periods.runs(np.array(w), 2, 2).tolist()] == _plain(w, 2, 2)


def test_tree_extensions_and_minima():
    rng = random.Random(2)
    for n in (1, 2, 17, 200):
        w = [rng.randrange(1, 3) for _ in range(n)]
        tree = periods.SuffixTree(w)
        i, j = np.array([(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]).T
        want = [next((d for d in range(n) if i + d >= n or j + d >= n or w[i + d] != w[j + d]), 0) for i, j in zip(i.tolist(), j.tolist(), strict=True)]
        assert tree.extension(i, j).tolist() == want
        assert tree.ranks().tolist() == [1 + sorted(range(n), key=lambda k: w[k:]).index(k) for k in range(n)]
    values = np.array([rng.randrange(1000) for _ in range(1500)], np.int32)
    a, z = np.sort(np.array([(rng.randrange(1500), rng.randrange(1500)) for _ in range(4000)]), axis=1).T
    assert periods.RangeMinimum(values).between(a, z).tolist() == [int(values[x : y + 1].min()) for x, y in zip(a, z, strict=True)]


def test_stretches_hold_every_run():
    rng = random.Random(4)
    held = list(_texts(rng))
    words, doc = np.concatenate([np.array(w, np.int64) for w in held]), np.repeat(np.arange(len(held)), [len(w) for w in held])
    first = np.searchsorted(doc, np.arange(len(held)))
    found = {(int(doc[a]), int(s + a - first[doc[a]]), int(n), int(q)) for a, z in periods.stretches(words, doc) for s, n, q in periods.runs(words[a:z])}
    assert found == {(d, *r) for d, w in enumerate(held) for r in _plain(w)}


def _report(doc_id, text, plant=True):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if plant and h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = _plain(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_every_period(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    short = {d for d, t in docs.items() if len(t or "") < 6000}
    rows = {r.doc_id: tuple(r) for r in Q.op12_periodic_runs(spark, SF).collect()}
    assert rows.keys() == docs.keys()
    assert {d: rows[d] for d in short} == {d: _report(d, docs[d]) for d in short}
    assert sum(r[1] > 0 for r in rows.values()) >= len(docs) // 20


def test_odd_rows_long_texts_and_none(odd, none, spark, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: str(r)
    rows = sorted((tuple(r) for r in Q.op12_periodic_runs(spark, str(tmp_path)).collect()), key=key)
    assert rows == sorted((_report(r.doc_id, r.text) for r in odd.collect()), key=key)
    out = {r.doc_id: r for r in periods.periodic_runs(odd).collect()}
    assert [tuple(r) for r in out[5].runs] == [(0, 30_000, 1)] and out[5].collapsed == "word end" and out[5].n_words == 30_001
    assert out[2].runs == [] and out[2].collapsed == "" and out[2].n_words == 0
    assert periods.periodic_runs(none).count() == 0
    whole = [f"w{k}" for k in range(40_000)]
    long = spark.createDataFrame([(1, " ".join(whole * 4)), (2, " ".join(whole[:1000] + whole[:1000]))], "doc_id long, text string")
    got = {r.doc_id: r for r in periods.periodic_runs(long).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 160_000, 40_000)] and got[1].collapsed == " ".join(whole) and got[2].runs == []


@pytest.mark.parametrize("text", ["a b " * 12, "a b " * 11 + "a", " ".join("abcdefgh" * 3), " ".join("abcdefghi" * 2)])
def test_shortest_runs(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(r) for r in periods.periodic_runs(df).first().runs] == _plain(text.split())
