import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from noisefield.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _plain(rows, least=10, most=10):
    """The audit over dense columns, term by term, in Python's whole numbers."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in docs:
        terms = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: [c[t] for t in terms] for (x, s), c in counts.items() if x == lang}
        share = lambda col: [1 + 10**9 * (n + 2) // (sum(col) + 2 * len(terms)) for n in col]
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: share(col) for s, col in groups.items()}
        q = share([sum(col) for col in zip(*groups.values(), strict=True)])
        for s in groups:
            found = {"pair": [(sum(map(f, p[s], p[o])), o) for o in groups if o != s], "term": [(f(p[s][k], q[k]), t) for k, t in enumerate(terms) if groups[s][k] and p[s][k] > q[k]]}
            for part, held in found.items():
                held.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(held, 1) if part == "pair" or r <= most]
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 20)
    monkeypatch.setattr(divergence, "TILE", 3)


def test_blocks_and_tiles_equal_dense_columns(spark, small):
    rng = random.Random(5)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(150)] + ["É", "日本", "x9y", "MiXed", "a_b"]
    share = [1 / (k + 1) for k in range(len(words))]
    rows = [(rng.choice(["en", "fr", None]), rng.choice([None, *(f"s{k}" for k in range(8))]), " ".join(rng.choices(words, share, k=rng.randrange(40)))) for _ in range(400)]
    rows += [("de", "only", "ein wort")] * 12 + [("it", f"z{k}", None if k else "") for k in range(3)] + [("en", "silent", "9 8 7")]
    df = spark.createDataFrame([(*r, k, 1) for k, r in enumerate(rows)], "lang string, source string, text string, n long, block int")
    assert _got(divergence.audit(df)) == _plain(rows)
    assert {r[2] for r in _plain(rows) if r[0] == "it"} == {"pair"} and {r[2] for r in _plain(rows) if r[0] == "de"} == set()


def test_odd_rows_and_none(odd, none):
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert _got(divergence.audit(odd, least_docs=2)) == _plain(rows, 2)
    assert divergence.audit(none).count() == 0


def test_shares_are_exact_for_large_counts():
    base = 9 * 10**15
    n = np.array([0, 1, 10**10, 123_456_789_012_345, base - 2])
    assert divergence.shares(n, base).tolist() == [1 + 10**9 * (int(x) + 2) // base for x in n]


def test_runs_of_a_column():
    start, value = divergence.run_lengths(np.array([1, 2, 3, 7]), np.array([4, 4, 5, 1]), 9)
    assert (start.tolist(), value.tolist()) == ([0, 1, 3, 4, 7, 8], [0, 4, 5, 0, 1, 0])
    assert divergence.run_lengths(np.zeros(0, int), np.zeros(0, int), 0)[0].tolist() == []
