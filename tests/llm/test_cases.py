"""Odd rows, empty tables and brute force on small fixtures."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from noisefield.llm import chat, fingerprints, lengths, mixing, near, packing, quality, shards, suffix, toxicity

TOKENS = public_tokenizers.path("word_bpe_49k.json")


def test_mixing(odd, none):
    out = mixing.mix(odd, 0.5, {("domain1",): 2.0}, 3, levels={"domain": mixing.source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")})
    rows = out.collect()
    total = sum(r.n_tokens for r in rows)
    assert len(rows) == 10 and sum(r.tokens_taken for r in rows) == int(total * 0.5)
    assert all(0 <= r.last_tokens <= r.n_tokens for r in rows)
    assert mixing.mix(none, 0.5, levels={"lang": F.col("lang")}).count() == 0
    kept = mixing.keep_mixed(odd, 1.0, levels={"lang": F.col("lang")})
    assert kept.columns == odd.columns and kept.count() == 10


@pytest.mark.parametrize(("caps", "weights", "budget", "want"), [([10, 10, 10], [1, 1, 1], 9, [3, 3, 3]), ([1, 10, 10], [1, 1, 1], 9, [1, 4, 4]), ([2, 3, 4], [1, 1, 1], 100, [2, 3, 4]), ([50, 50], [3, 1], 8, [6, 2]), ([10, 10, 10], [1, 1, 1], 10, [4, 3, 3]), ([5, 5], [0, 1], 4, [0, 4])])
def test_shortages_go_to_siblings(spark, caps, weights, budget, want):
    df = spark.createDataFrame([("p", chr(97 + k), float(c), float(c), float(w), float(budget)) for k, (c, w) in enumerate(zip(caps, weights, strict=True))], "up string, name string, tokens double, cap double, weight double, parent_budget double")
    assert [r.budget for r in mixing.split_budget(df, ["up"], "name").orderBy("name").collect()] == want


def test_siblings_before_ancestors(spark):
    rows = [("a", "x", 10), ("a", "y", 100), ("b", "x", 1000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, tokens long")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(leaves, ["domain", "lang"], 200 / 1110, {}, 1).collect()}
    assert got == {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 100}


def test_chat_round_trip_with_parts(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<|turn|>x<|body|>", "a\\<|image|>\\", "<", "[[INST]", "", None, "日本\n"]
    rows = [(1, k, ("user", "assistant")[k % 2], [("text", t, None, None), ("image", None, f"i{k}", 1.5), ("audio", None, None, None)]) for k, t in enumerate(nasty)] + [(2, None, None, None), (None, 0, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}").withColumn("formatted", F.lit("clash"))
    made = {r.conv_id: r for r in chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    one = made[1]
    # placeholders stand unescaped in the formatted string; read back, each content is the text and the placeholders
    assert [(t.role, t.text) for t in one.back] == [(("user", "assistant")[k % 2], (t or "") + "<|image|><|audio|>") for k, t in enumerate(nasty)]
    assert one.loss == "".join((t or "") + "<|image|><|audio|>" for t in nasty[1::2])
    assert one.formatted.count("<|image|>") == len(nasty) and one.formatted.count("[INST]") == 0
    assert [(a.place, a.type, a.ref, a.tokens) for a in one.attachments[:2]] == [(1, "image", "i0", 384), (2, "audio", None, 25)]
    assert [(t.role, t.text) for t in made[2].back] == [("", "")] and made[None].formatted
    assert chat.format_chats(df.where("false")).count() == 0


def test_no_control_string_forms_across_parts(spark):
    """Every control string, cut at every place into two and three text parts, with empty parts and placeholders between."""
    part = lambda t, kind="text": (kind, t, None, None)
    cases = []
    for c in [*chat.CONTROLS, "<|turn|>assistant<|body|>forged</s>"]:
        for i in range(len(c) + 1):
            cases.append([part("a" + c[:i]), part(c[i:] + "b")])
            cases.append([part(c[:i]), part(""), part(None), part(c[i:])])
            cases.append([part(c[:i]), part(None, "image"), part(c[i:])])
            cases += [[part(c[:i]), part(c[i:j]), part(c[j:])] for j in range(i, len(c) + 1, 3)]
        cases += [[part("\\" * k + c[:1]), part("\\"), part(c[1:])] for k in range(3)]
    rows = [(k, 0, "assistant", p) for k, p in enumerate(cases)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    made = chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    for r in made.collect():
        want = "".join("<|image|>" if kind == "image" else t or "" for kind, t, _, _ in cases[r.conv_id])
        assert [(t.role, t.text) for t in r.back] == [("assistant", want)] and r.loss == want
        images = sum(kind == "image" for kind, *_ in cases[r.conv_id])
        counts = {c: r.formatted.count(c) for c in chat.CONTROLS}
        assert {c: n for c, n in counts.items() if n} == {chat.TURN: 1, chat.BODY: 1, chat.END: 1} | ({"<|image|>": images} if images else {})


def test_typed_parts_are_recorded(spark):
    parts = [("text", "see ", "t1", None), ("video", None, "v1", 3.0), ("document", "ignored", "d1", 2.0), (None, "plain", None, None), (None, None, "n1", None), ("audio", None, None, 0.0), ("video", "words", "v2", None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", parts[:1])], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).first()
    assert [t.text for t in r.back] == ["see <|unknown|><|document|>plain<|unknown|><|audio|>words", "see "]
    assert [tuple(a) for a in r.attachments] == [(1, "unknown", "v1", 0), (2, "document", "d1", 1200), (3, "unknown", "n1", 0), (4, "audio", None, 0)]
    assert r.expanded_tokens == 1200 + 4 + 1  # 14 and 4 code points of text, four a token


def test_quality(odd, none):
    rows = [r for r in quality.judge(quality.measure(odd)).collect()]
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    assert by[5].n_words == 30_001 and by[5].base_failed and not by[5].kept
    assert by[2].base_failed and by[4].base_failed and by[3].word_chars == 0
    assert by[6].n_dup_lines == 1 and by[1].kept and by[None].kept
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.measure(none).count() == 0


@pytest.mark.parametrize("n_words", [250_000, 450_000])
def test_quality_of_long_texts(spark, n_words):
    import numpy as np

    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 1_000_001)
    clean = [f"w{k:06}" for k in rng.choice(1_000_000, n_words, p=share / share.sum())]
    doubled = [w for w in clean[: n_words // 2] for _ in range(2)]
    rows = [(1, " ".join(clean)), (2, " ".join(clean[:15_000])), (3, " ".join(doubled)), (4, " ".join(doubled[:15_000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    by = {r.doc_id: r for r in quality.judge(quality.measure(df)).collect()}
    assert by[1].rep_1 > 0.7 * by[1].word_chars and by[2].rep_1 == by[2].win_1
    assert {k: r.kept for k, r in by.items()} == {1: True, 2: True, 3: False, 4: False}
    assert {r.doc_id for r in quality.keep_good(df).collect()} == {1, 2}


def test_fingerprints_of_odd_rows(odd, none):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == 10 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id == 1}
    assert len(same) == 1 and len({r.fingerprint for r in rows if r.doc_id in (2, 3)}) == 1
    assert fingerprints.fingerprints(none).count() == 0
    alone = fingerprints.fingerprints(odd.where("doc_id = 6")).first()
    assert alone.near_next == 1.0


def test_peeling_recovers_the_difference_or_says_so(spark):
    sets = {"p": (64, range(1, 40), range(20, 60)), "q": (64, [5, 5, 5], [5]), "full": (4, range(100), [])}
    entries = [(i, side, m, k) for i, (m, *both) in sets.items() for side, held in zip((1, -1), both, strict=True) for k in held]
    df = spark.createDataFrame(entries, "id string, side int, cells int, digest long")
    one = fingerprints.sketch(df, ["id", "side"])
    difference = fingerprints._settle(one.withColumn("n", F.col("n") * F.col("side")), ["id"])
    left = fingerprints.peel(difference, ["id"])
    key = {(d, c): k for d, c, k in df.select("digest").distinct().selectExpr("digest", "explode(sequence(1L, 3L)) c").selectExpr("digest", "c", "xxhash64(digest, c) & 1099511627775").collect()}
    found = {(r.id, r.c): r.n for r in left.where(f"t = {fingerprints.TABLES}").collect()}
    assert {c: n for (i, c), n in found.items() if i == "p"} == {key[k, 1]: 1 for k in range(1, 20)} | {key[k, 1]: -1 for k in range(40, 60)}
    assert {c: n for (i, c), n in found.items() if i == "q"} == {key[5, 2]: 1, key[5, 3]: 1}
    assert {r.id: r.failed for r in fingerprints.differences(left, ["id"]).collect()} == {"p": False, "q": False, "full": True}
    counted = fingerprints.differences(fingerprints.peel(difference, ["id"], listed=False), ["id"])
    assert {r.id: r.differing for r in counted.where("not failed").collect()} == {"p": 39, "q": 2}


def test_failed_pairs_are_tried_again(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "LEAST_CELLS", 2)
    monkeypatch.setattr(fingerprints, "CELLS_EACH", 0.1)
    text = lambda k: "\n".join(f"line {k} {i}" for i in range(20))
    df = spark.createDataFrame([(k, text(k // 2)) for k in range(8)], "doc_id long, text string")
    got = {r.doc_id: (r.near_next, r.n_differing_next) for r in fingerprints.fingerprints(df).collect()}
    assert {k: got[k] for k in (7, 5, 3, 1)} == dict.fromkeys((7, 5, 3, 1), (1.0, 0))
    assert {k: got[k] for k in (6, 4, 2, 0)} == dict.fromkeys((6, 4, 2, 0), (0.0, 40))


@pytest.mark.parametrize("hopeless", [False, True])
def test_paragraphs_that_share_a_key(spark, monkeypatch, hopeless):
    """Two paragraphs of one text with one key never peel at any size: other keys part them, or at last they are counted."""
    import re
    from collections import Counter

    monkeypatch.setattr(fingerprints, "_KEY", (1 << 16) - 1)
    keys = spark.range(3000).select(F.concat(F.lit("line "), "id").alias("p")).withColumn("k", F.xxhash64(F.xxhash64("p"), F.lit(1).cast("long")).bitwiseAND(F.lit(0xFFFF)))
    twins = keys.groupBy("k").agg(F.sort_array(F.collect_list("p")).alias("p")).where("size(p) = 2").orderBy("k").limit(6).collect()
    docs = {k: "\n".join([*r.p, *(f"plain {k * 40 + i}" for i in range(25))]) for k, r in enumerate(twins)}
    rounds = []

    def differ(*a, real=fingerprints._differ):
        rounds.append(1)
        return real(*a).withColumns({"failed_e": F.lit(True), "failed_x": F.lit(True)}) if hopeless else real(*a)

    monkeypatch.setattr(fingerprints, "_differ", differ)
    got = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert len(rounds) == 1 + fingerprints.RETRIES if hopeless else 2 <= len(rounds) <= 1 + fingerprints.RETRIES
    cut = lambda t: Counter(re.split(r"\n|(?<=[a-f][.!?]) ", t))
    for k, t in docs.items():
        following = docs[(k - 1) % 6]
        half = len(t) // 2
        for c, other in (("edited", t[: len(t) - half] + following[:half]), ("next", following)):
            a, b = cut(t), cut(other)
            assert got[k][f"n_differing_{c}"] == (a - b).total() + (b - a).total()


def test_exact_counts(spark):
    df = spark.createDataFrame([(1, [1, 1, 2], [1, 3], [1, 1, 2]), (2, [5], [5], [6, 6])], "k int, a array<long>, e array<long>, x array<long>")
    assert {r.k: (r.differing_e, r.differing_x, r.failed_e) for r in fingerprints.exact(df, ["k"]).collect()} == {1: (3, 0, False), 2: (0, 3, False)}


@pytest.mark.parametrize("docs_each", [500, 7])
def test_neighbours_with_far_and_missing_ids(spark, monkeypatch, docs_each):
    monkeypatch.setattr(fingerprints, "BLOCK_DOCS", docs_each)
    rows = [(k * 3, f"text {k}") for k in range(100)] + [(10**15, "far"), (-(10**12), "low")] + [(None, f"none {k}") for k in range(110)] + [(None, "same")] * 3 + [(6, "again")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, guest long")
    got = fingerprints.with_next(df).where("guest = 0").collect()
    assert sorted(map(str, ((r.id, r.text) for r in got))) == sorted(map(str, rows))
    held = [sum(r.block == b for r in got) for b in {r.block for r in got}]
    assert docs_each == 500 or (max(held) <= 2 * docs_each and len(held) > 20)
    # one ring that falls by id, null ids last
    ids = [r.id for r in sorted(got, key=lambda r: (r.block, r.row))]
    assert ids == sorted((i for i, _ in rows if i is not None), reverse=True) + [None] * 113
    ring = sorted(got, key=lambda r: (r.block, r.row))
    assert [(r.next_id, r.next_text) for r in ring] == [(r.id, r.text) for r in [*ring[1:], ring[0]]]


def test_two_fingerprints_alone_give_the_likeness(spark):
    import random

    rng = random.Random(5)
    line = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon".split()) for _ in range(9))
    texts = ["\n".join(line() for _ in range(rng.choice((1, 2, 5, 20, 90)))) for _ in range(60)]
    texts += [t + "\n" + line() for t in texts[:20]] + ["", "a\na\na", "a\na"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = fingerprints.fingerprints(df).cache()
    prints = {r.doc_id: r.fingerprint for r in out.collect()}
    pairs = [(r.doc_id, "e", r.fingerprint, r.edited_fingerprint) for r in out.collect()] + [(d, "x", p, prints[d - 1] if d else prints[max(prints)]) for d, p in prints.items()]
    got = fingerprints.compare(spark.createDataFrame(pairs, "doc_id long, pair string, left string, right string"), ["doc_id", "pair"])
    found = {(r.doc_id, r.pair): (r.differing, r.failed) for r in got.collect()}
    want = {(r.doc_id, p): n for r in out.collect() for p, n in (("e", r.n_differing_edited), ("x", r.n_differing_next))}
    assert len(found) == len(want) == 2 * len(texts)
    peeled = {k: n for k, (n, failed) in found.items() if not failed}
    assert len(peeled) >= 0.97 * len(want) and all(want[k] == n for k, n in peeled.items())


def test_toxicity_of_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1, 1), (5, None, None), (99, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, toxicity.categories_of(labels))
    assert toxicity.score(odd, model).count() == 10 and toxicity.score(none, model).count() == 0
    empty = toxicity.train(odd, toxicity.categories_of(labels.where("false")))
    assert all(r.p_toxic < 1e-6 for r in toxicity.score(odd, empty).collect())


def test_unseen_words_have_no_weight(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    bad = [f"vile{k}" for k in range(40)]
    plain = [f"word{k}" for k in range(300)]
    texts = [" ".join([*rng.choice(plain, 30), *(rng.choice(bad, 20) if k % 2 else [])]) for k in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(600)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, toxicity.categories_of(labels))
    new = " ".join(f"unseen{k}" for k in range(600_000))
    rows = [(1, ""), (2, new), (3, " ".join(bad)), (4, f"{new} {' '.join(bad)}"), (5, " ".join(plain[:30])), (6, f"{' '.join(plain[:30])} {new}")]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[2].p_toxic == got[1].p_toxic and got[4].p_toxic == got[3].p_toxic > 0.5 > got[6].p_toxic == got[5].p_toxic
    assert got[2].n_distinct_words == 600_000


def test_packing_of_odd_rows(odd, none):
    rows = packing.best_two_fit(odd, TOKENS).collect()
    assert sum(r.piece == 0 for r in rows) == 10
    assert {r.length for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert sum(r.length for r in rows if r.doc_id == 5) == 30_002
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 4096 for v in seqs.values())
    assert packing.best_two_fit(none, TOKENS).count() == 0


def test_two_smaller_pieces_replace_one(spark):
    import numpy as np

    sizes = np.array([60, 30, 29, 11])  # greedy: 60 + 30, gap 10; better: 60 + 29 + 11
    seq, offset = packing.pack(sizes, 100)
    assert seq[0] == seq[2] == seq[3] != seq[1] and sorted(offset[[0, 2, 3]]) == [0, 60, 71]
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 101, 5000)
    seq, offset = packing.pack(sizes, 100)
    for s in range(seq.max() + 1):
        k = np.flatnonzero(seq == s)
        k = k[np.argsort(offset[k])]
        assert (offset[k] == np.cumsum(sizes[k]) - sizes[k]).all() and sizes[k].sum() <= 100
    assert seq.max() + 1 <= 1.01 * sizes.sum() / 100 + 1


@pytest.mark.parametrize("hot", [2000, 1])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    import random

    monkeypatch.setattr(suffix, "HOT_DOCS", hot)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 1500)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdé ") for _ in range(90))
    texts = []
    for k in range(40):
        body = "".join(rng.choice("abcdefgh ü") for _ in range(rng.randrange(0, 150)))
        texts.append(body + (passage[rng.randrange(40) :] if k % 2 else "") + ("x" * 120 if k % 5 == 0 else "") + body[:20])
    texts += [texts[3], texts[3], "", None, "z" * 60, "é" * 30]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash"))
    got = sorted(((r.id if r.id is not None else 1 << 62), r.n_bytes, r.n_removed, r.n_spans) for r in suffix.Repeats(df).report().collect())
    least = {}
    raw = [((k if k is not None else 1 << 62), (t or "").encode()) for k, t in rows]
    for k, b in raw:
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(k, least.get(b[i : i + 50], k))
    want = []
    for k, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < k:
                gone[i : i + 50] = b"\1" * 50
        want.append((k, len(b), sum(gone), len([1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1])])))
    assert got == sorted(want)


def test_cut_repeats_keeps_columns_and_characters(odd, none, spark):
    out = suffix.cut_repeats(odd)
    assert out.columns == odd.columns and out.count() == 10
    by = {(r.doc_id, r.row): r for r in out.collect()}
    assert by[2, 2].text is None and by[3, 3].text == "" and all(r.n_chars == (len(r.text) if r.text is not None else None) for r in by.values())
    assert suffix.cut_repeats(none).count() == 0
    shared = "ö" * 20 + "0123456789" * 4
    two = spark.createDataFrame([(1, shared), (2, "ä" + shared[1:] + "ü")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in suffix.cut_repeats(two).collect()} == {1: shared, 2: "äü"}


def test_suffix_order_is_sorted():
    import numpy as np

    rng = np.random.default_rng(1)
    for n, k in ((300, 2), (2000, 3), (5000, 20), (1, 1), (700, 1), (0, 1)):
        t = rng.integers(0, k, n).astype(np.uint8)
        if n == 5000:
            t[1000:1200], t[4000:4300] = t[3000:3200].copy(), 7
        order, words = suffix.suffix_order(t)
        keys = [t[i : i + 50].tobytes().ljust(50, b"\0") for i in order]
        assert sorted(order) == list(range(n)) and keys == sorted(keys)
        common = [next((k for k in range(50) if a[k] != b[k]), 50) for a, b in zip(keys[:-1], keys[1:], strict=True)]
        assert suffix.common_prefixes(order, words).tolist() == ([0, *common] if n else [])


def test_equal_hashes_of_different_bytes(spark, monkeypatch):
    import numpy as np

    from noisefield.llm import _text

    monkeypatch.setattr(suffix.X, "span_hashes", lambda raw, start, end: _text.mix((end - start).astype(np.uint64)))
    ids = np.array([3, 1, 2, 2])
    texts = [b"a" * 60, b"b" * 60, b"a" * 60, b"c" * 10 + b"a" * 50]
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    spans = suffix._match_part(ids, np.zeros(4, np.int64), np.arange(4), np.zeros(4, np.int64), size, data)
    assert sorted(map(tuple, spans.T.tolist())) == [(0, 0, 0, 60)]


def test_shards_of_odd_rows(odd, none, tmp_path, spark):
    rows = shards.shard_documents(odd, 3).collect()
    assert sorted(r.shard for r in rows).count(0) in (3, 4) and len({(r.shard, r.slot) for r in rows}) == 10
    assert {r.size for r in rows if r.doc_id == 2} == {1}
    assert shards.shard_documents(none, 3).count() == 0
    clash = odd.withColumnsRenamed({"key": "shard", "row": "slot", "node": "record"})
    files = shards.write_shards(clash, str(tmp_path / "out"), 3)
    assert files.count() == 10 and files.select("record.*").columns == clash.columns


def test_shards_depend_on_the_seed_alone(spark):
    rows = [(k, f"text {k}" if k % 7 else None) for k in range(1000)] + [(None, "same")] * 400
    places = []
    for partitions, adaptive, sizes in (("4", "true", {}), ("16", "false", {}), ("3", "true", {})):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(int(partitions))
        got = shards.shard_documents(df, 7, bucket_rows=60, **sizes).collect()
        places.append(sorted((r.shard, r.slot, r.doc_id or -1, r.text_crc32) for r in got))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert places[0] == places[1] == places[2]
    assert [len({s for k, s, *_ in places[0] if k == i}) for i in range(7)] == [200] * 7
    other = shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 7, seed=8, bucket_rows=60).collect()
    same = {(r.shard, r.slot, r.doc_id) for r in other} & {p[:3] for p in places[0]}
    assert len(same) < 20
    neighbours = [d for *_, d, _ in places[0]]
    assert sum(abs(a - b) == 1 for a, b in zip(neighbours[:-1], neighbours[1:], strict=True) if min(a, b) >= 0) < 20


def test_very_many_copies_are_dealt_by_number(spark, monkeypatch):
    monkeypatch.setattr(shards, "_RUN", 64)
    df = spark.createDataFrame([(1, "same")] * 500 + [(k, "other") for k in range(500)], "doc_id long, text string")
    placed = shards.two_pass(df, 4, bucket_rows=50)
    rows = placed.collect()
    assert len({(r.shard, r.slot) for r in rows}) == 1000 and sum(r.record.text == "same" for r in rows) == 500
    assert all(80 < sum(r.record.text == "same" for r in rows if r.shard == s) < 170 for s in range(4))


def test_fisher_yates_draws_every_permutation(spark):
    got = spark.range(6000).select(shards.fisher_yates(F.lit(3), F.lit(7), F.col("id")).alias("p")).groupBy("p").count().collect()
    assert len(got) == 6 and all(850 < r["count"] < 1150 and sorted(r.p) == [0, 1, 2] for r in got)


def test_records_that_differ_in_a_map_alone(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 1).alias("doc_id"), F.lit("same").alias("text"), F.create_map(F.lit("k"), F.when(F.col("id") > 0, F.col("id"))).alias("m"), F.array(F.create_map(F.lit(1), F.lit("v"))).alias("n"))
    files = shards.write_shards(df, str(tmp_path / "out"), 4, bucket_rows=50)
    assert files.select(F.col("record.m")["k"].alias("v")).distinct().count() == 1000 and files.count() == 1000
    twice = df.unionByName(df.where("m['k'] = 5").crossJoin(spark.range(200)).drop("id"))
    placed = shards.two_pass(twice, 4, bucket_rows=50).select(F.col("record.m")["k"].alias("v"), "shard", "slot").collect()
    assert len(placed) == 1200 == len({(r.shard, r.slot) for r in placed}) and sum(r.v == 5 for r in placed) == 201
    assert fingerprints.fingerprints(df.limit(5)).count() == 5


def test_a_large_bucket_is_a_permutation(spark):
    p = spark.range(1).select(shards.fisher_yates(F.lit(5000), F.lit(7), F.col("id")).alias("p")).first().p
    draws = [r.h % (r.i + 1) for r in spark.range(5000).select(F.col("id").cast("int").alias("i"), F.xxhash64(F.lit(7), F.lit(0).cast("long"), F.col("id").cast("int")).alias("h")).orderBy("i").collect()]
    want = []
    for i, j in enumerate(draws):
        want.append(i)
        want[i], want[j] = want[j], i
    assert p == want


def test_both_passes_against_plain_python(spark):
    """Buckets by hash, the order of hashes, draws step by step and runs of equal length, written out."""
    n, seed, n_shards, rows_each = 300, 7, 7, 40
    df = spark.createDataFrame([(k // 2, f"text {k // 3}" if k % 5 else None) for k in range(n)], "doc_id long, text string")
    buckets = -(-n // rows_each)
    keyed = df.select("*", F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"), F.xxhash64(F.lit(2), "doc_id", "text").alias("k2"))
    rows = [(r.b, r.k1, r.k2, (r.doc_id, r.text)) for r in keyed.withColumn("b", F.pmod(F.xxhash64(F.lit(seed), "k1", "k2", F.lit(0).cast("long")), F.lit(buckets))).collect()]
    draws = {(r.b, r.i): r.h for r in spark.range(buckets).withColumnRenamed("id", "b").crossJoin(spark.range(n).select(F.col("id").cast("int").alias("i"))).select("b", "i", F.xxhash64(F.lit(seed), "b", "i").alias("h")).collect()}
    sequence = []
    for b in range(buckets):
        held = sorted((r for r in rows if r[0] == b), key=lambda r: r[1:3])
        places = []
        for i in range(len(held)):
            j = draws[b, i] % (i + 1)
            places.append(i)
            places[i], places[j] = places[j], i
        out = [None] * len(held)
        for r, place in zip(held, places, strict=True):
            out[place] = r[3]
        sequence += out
    want, at = [], 0
    for s in range(n_shards):
        size = n * (s + 1) // n_shards - n * s // n_shards
        want += [(s, k, *x) for k, x in enumerate(sequence[at : at + size])]
        at += size
    got = shards.two_pass(df, n_shards, seed, bucket_rows=rows_each).select("shard", "slot", "record.*").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def _brute(rows, n, percent):
    import re

    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[find(i)] = min(best.get(find(i), d), d)
    return sorted((d, len(sets[i]), best[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("blocks", [(1024, 256), (4, 2)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, blocks):
    import random

    from noisefield.llm import _store

    for name, value in zip(("BLOCK_NODES", "PACK_NODES"), blocks, strict=True):
        monkeypatch.setattr(near, name, value)
    monkeypatch.setattr(near, "DENSE_PAIRS", 5)
    monkeypatch.setattr(near, "PAIRS_AT_A_TIME", 3)
    if blocks[0] == 4:
        monkeypatch.setattr(_store, "LEAST_HOT", 2)
        monkeypatch.setattr(_store, "BROADCAST_FACTS", 0)
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = f"W{rng.randrange(500)}"
            rows.append((len(rows), (" " if g % 2 else "\n").join(w)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, " \t")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    out = near.near_duplicates(df, 4, 80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == _brute(rows, 4, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """A text and a group of near copies that hold a third of all rows each, in many blocks."""
    import random

    monkeypatch.setattr(near, "BLOCK_NODES", 16)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(150):
        w = list(base)
        w[rng.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, "one text that very many rows share word for word") for k in range(600)]
    rows += [(2000 + k, " ".join(f"y{k}_{j}" for j in range(30))) for k in range(100)]
    out = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {d: 0 if d < 150 else 1000 if d < 2000 else d for d, _ in rows}


def test_a_chain_costs_what_its_buckets_cost(spark, monkeypatch):
    """Each text shares most words with the next: one group, but few texts share a bucket."""
    monkeypatch.setattr(near, "PACK_NODES", 8)
    monkeypatch.setattr(near, "BLOCK_NODES", 32)
    placed, places = [], near._places

    def spy(shared):
        out = places(shared)
        sizes = out.groupBy("task", "i", "j").agg(F.count_if("left").alias("a"), F.count_if("right").alias("b"))
        placed.append(sizes.agg(F.sum(F.col("a") * F.col("b"))).first()[0])
        return out

    monkeypatch.setattr(near, "_places", spy)
    n, step, each = 800, 8, 120
    words = [f"w{k}" for k in range(n * step + each)]
    rows = [(n - k, " ".join(words[k * step : k * step + each])) for k in range(n)]
    rows += [(5000 + k, " ".join(words[:each] + [f"u{k}"])) for k in range(40)]  # and a tight group at its end
    out = {r.doc_id: r.component_id for r in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    assert out == dict.fromkeys(out, 1) and len(out) == len(rows)
    assert placed[0] < len(rows) ** 2 / 4  # the whole cluster would be more than half of the square


def test_near_duplicates_of_odd_rows(odd, none):
    out = near.near_duplicates(odd).collect()
    assert len(out) == 10
    assert {r.component_id for r in out if r.doc_id == 7} == {7} and {r.component_id for r in out if r.doc_id is None} == {None}
    assert sum(r.kept for r in out) == 9 and all(r.kept for r in out if r.doc_id != 1)
    kept = near.keep_first(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [None, 1, 2, 3, 4, 5, 6, 7, 7]))
    assert near.near_duplicates(none).count() == 0 and near.keep_first(none).count() == 0


def test_rows_without_or_with_repeated_ids_are_kept_by_row(spark):
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(20))
    rows = [(None, text(k)) for k in range(40)]  # different texts without ids
    rows += [(None, text(100)), (9, text(100)), (5, text(101)), (5, text(102)), (5, text(103)), (3, text(103)), (3, text(103)), (None, text(104)), (None, text(104)), (8, None), (8, ""), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(None, text(k)) for k in range(40)] + [(9, text(100)), (5, text(101)), (5, text(102)), (3, text(103)), (None, text(104)), (8, None), (8, ""), (None, "")]
    sort = lambda x: sorted(map(str, x))
    assert sort(tuple(r) for r in near.keep_first(df).collect()) == sort(want)
    marked = near.near_duplicates(df).where("kept")
    assert sort(r.doc_id for r in marked.collect()) == sort(d for d, _ in want)


def test_unsettled_links_are_an_error(spark):
    from noisefield.llm import _links

    path = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with pytest.raises(RuntimeError, match="2 rounds"):
        _links.components(path, 2)
    assert {r.comp for r in _links.components(path).collect()} == {0}


def test_estimates_are_corrected_for_chance():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    for share in (0.0, 0.5, 0.8, 1.0):
        b = np.concatenate([a[: int(4000 * 2 * share / (1 + share))], rng.integers(0, 1 << 64, 4000 - int(4000 * 2 * share / (1 + share)), dtype=np.uint64)])
        m = np.stack([near.minima(a), near.minima(b)])
        bits = near.pack_low_bits(m)
        assert near.estimates(bits[:1], bits[1:])[0, 0] == pytest.approx(share, abs=0.2)


def test_lengths_of_odd_rows(odd, none):
    report = lengths.suffix_report(lengths.histogram(lengths.encoded_lengths(odd, TOKENS)))
    rows = {r.context_limit: r for r in report.collect()}
    assert rows[0].n_docs == 3 and rows[0].docs_at_least == 10 and rows[30_001].truncated_tokens == rows[0].total_tokens
    assert {r.share: r.context_limit for r in lengths.quantiles(report, [0.3, 1.0]).collect()} == {0.3: 0, 1.0: 30_001}
    total = rows[0].total_tokens
    assert [(r.context_limit, r.docs_at_least, r.truncated_tokens, r.share_fitting) for r in lengths.at_limits(report, [10_000, 50_000]).collect()] == [(10_000, 1, total - 20_001, 0.9), (50_000, 0, total, 1.0)]
    empty = lengths.suffix_report(lengths.histogram(lengths.encoded_lengths(none, TOKENS)))
    assert empty.count() == lengths.at_limits(empty, [5]).count() == lengths.quantiles(empty, [0.5]).count() == 0


def test_word_ids_equal_whole_texts():
    import pyarrow as pa

    from noisefield.llm import _tokens

    texts = ["a<|endoftext|>b, c's.,", "", None, "É.İ,x  ΣΑΣ, ﬁ. é, ́. l'eau.,. 12.5, A.,b.,", "<|startoftext|>.,", "x y.  \x1cz,  it's, It'S. 0 10 a0.", "日本語。 ok no　yes"]
    tok = _tokens.tokenizer(TOKENS)
    got = []
    for _, ids, at in _tokens.encode(pa.array(texts), TOKENS):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    other = public_tokenizers.path("byte_bpe_50k.json")
    [(_, ids, at)] = list(_tokens.encode(pa.array(["two words", None]), other))
    assert ids.tolist() == _tokens.tokenizer(other).encode("two words").ids and at.tolist() == [0, len(ids), len(ids)]


def test_a_repeated_id_brings_one_row_to_the_fit(spark, monkeypatch):
    """Thousands of rows of one labelled id: the fit gets one of them, that with the least hash of its text."""
    bad, good = "vile words here", "plain words there"
    rows = [(k, f"{bad if k % 2 else good} {k % 5}") for k in range(60)] + [(7, f"{good} again {k % 3}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(60)], "doc_id long, low_quality int, toxic int")
    seen = []
    real = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *c: (seen.append(self) if c == ("all",) else None) or real(self, *c))
    once = toxicity.train(docs, labels)
    assert [x.count() for x in seen] == [60]
    least = docs.where("doc_id = 7").select("text", F.xxhash64("text").alias("h")).orderBy("h").first().text
    alone = toxicity.train(docs.where("doc_id <> 7").unionByName(spark.createDataFrame([(7, least)], docs.schema)), labels)
    assert all((a == b).all() for a, b in zip(once, alone, strict=True))


def _slow_pack(lengths, most):
    """Sequences by looking through all pieces and all pairs of pieces: largest that fits, then the pair that fills the gap best."""
    left, out = sorted(lengths), []
    while left:
        held, gap = [], most
        while fit := [x for x in left if x <= gap]:
            left.remove(fit[-1])
            held.append(fit[-1])
            gap -= fit[-1]
        if gap and left:
            room = gap + held[-1]
            best = max((left[i] + left[j] for i in range(len(left)) for j in range(i + 1, len(left)) if left[i] + left[j] <= room), default=0)
            if best > held[-1]:
                i, j = next((i, j) for i in range(len(left)) for j in range(i + 1, len(left)) if left[i] + left[j] == best)
                pair = [left[i], left[j]]
                left = sorted([*left[:i], *left[i + 1 : j], *left[j + 1 :], held.pop()])
                held += pair
        out.append(sum(held))
    return out


def test_packing_against_a_search_of_all_pairs():
    import numpy as np

    rng = np.random.default_rng(12)
    for most in (20, 100, 257):
        for n in (1, 2, 40, 90):
            lengths = np.minimum(rng.geometric(4 / most, n), most)
            seq, offset = packing.pack(lengths, most)
            full = np.bincount(seq, lengths).astype(int).tolist()
            assert full == _slow_pack(lengths.tolist(), most)
            for k in range(seq.max() + 1):
                mine = np.flatnonzero(seq == k)
                order = mine[np.argsort(offset[mine])]
                assert offset[order].tolist() == [0, *np.cumsum(lengths[order])[:-1].tolist()]
