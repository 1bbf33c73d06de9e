import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from noisefield.llm import _pieces, queries as Q, tokenfile
from noisefield.sources.store import filesystem
from tests.conftest import SF

PATH = public_tokenizers.path(Q.FILE_TOKENIZER)


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_query_against_whole_texts(spark, tok):
    rows = {r.doc_id: r for r in Q.op13_token_files(spark, SF).collect()}
    at = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, Q.FILE_END], "<u4")
        got = rows.pop(r.doc_id)
        assert (got.start, got.n_tokens, got.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not rows


def test_pieces_give_the_ids_of_whole_texts(tok):
    rng = random.Random(1)
    parts = ["a", "é", " ", " ", "\n", "　", "1", "'s", "<|endoftext|>", "!", "\t", " ", "日", "\x1c", "\x85", "😀", "b ", "\x7f", " ", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(5000)] + [None, "", " ", "x" * 5000]
    got = [ids[a:z].tolist() for _, ids, at in _pieces.encode(pa.array(texts), PATH) for a, z in zip(at[:-1], at[1:], strict=True)]
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_odd_rows_hot_ids_and_none(odd, none, spark, tok, tmp_path):
    rows = tokenfile.token_files(odd, PATH, 2).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [1, 1, 2, 3, 4, 5, 6, 7, 7, None]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(10)]
    texts = [r.text for r in odd.orderBy(F.asc_nulls_last("doc_id"), "key").collect()]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert tokenfile.token_files(none, PATH, 2).count() == 0
    hot = spark.range(400).select(F.lit(9).cast("long").alias("doc_id"), F.lit("the same words in every row").alias("text"))
    files = tokenfile.write_documents(hot, str(tmp_path / "hot"), PATH, 2, file_bytes=1000)
    assert files.count() > 3 and tokenfile.read_documents(tokenfile.starts(files)).count() == 400


def test_only_wanted_frames_are_read(spark, tok, tmp_path):
    docs = spark.createDataFrame([(k, f"text number {k} " * (k + 1)) for k in range(60)], "doc_id long, text string")
    files = tokenfile.write_documents(docs, str(tmp_path / "files"), PATH, 2)
    whole = {r.doc_id: r for r in tokenfile.read_documents(tokenfile.starts(files)).collect()}
    assert sorted(whole) == list(range(60))
    # the files are plain zstandard files
    made = b"".join(zstandard.ZstdDecompressor().stream_reader(open(filesystem(r.path)[1], "rb"), read_across_frames=True).read() for r in files.orderBy("file").collect())
    assert made == b"".join(whole[k].ids for k in range(60))
    # damage one frame of each file: other documents are still read, the damaged ones are errors
    hurt = []
    for r in files.collect():
        with tokenfile.FrameReader(r.path) as f:
            k = len(f.n_tokens) // 2
            hurt.append(f.doc_ids[k].as_py())
            at = int(f.begin[k] + f.table["packed"][k]) - 2
        with open(filesystem(r.path)[1], "r+b") as g:
            g.seek(at)
            byte = g.read(1)
            g.seek(at)
            g.write(bytes([byte[0] ^ 0x55]))
    fit = sorted(set(range(60)) - set(hurt))
    some = {r.doc_id: r for r in tokenfile.read_documents(tokenfile.starts(files), [*fit, 1000]).collect()}
    assert {k: tuple(r) for k, r in some.items()} == {k: tuple(whole[k]) for k in fit}
    with pytest.raises(Exception, match="damaged|decompress"):
        tokenfile.read_documents(tokenfile.starts(files), hurt[:1]).collect()


def test_damaged_files_are_errors(tmp_path):
    path = str(tmp_path / "x.zst")
    with open(path, "wb") as f:
        w = tokenfile.FrameWriter(f)
        w.add(np.arange(5))
        w.close(pa.array([7], pa.int64()))
    with tokenfile.FrameReader(path) as r:
        assert np.frombuffer(r.ids(0), "<u4").tolist() == [0, 1, 2, 3, 4] and r.doc_ids.to_pylist() == [7]
    raw = open(path, "rb").read()
    for cut in (raw[:-3], raw[:5], raw[:-11] + bytes([raw[-11] ^ 1]) + raw[-10:], raw[: len(raw) // 2]):
        with open(path, "wb") as f:
            f.write(cut)
        with pytest.raises(ValueError, match="seek table|short|directory"):
            tokenfile.FrameReader(path)


def test_pieces_stay_right_when_few_are_kept(tok, monkeypatch):
    monkeypatch.setattr(_pieces, "PIECES_KEPT", 40)
    monkeypatch.setattr(_pieces, "PASS_BYTES", 300)
    monkeypatch.setattr(_pieces, "PART_BYTES", 100)
    monkeypatch.setattr(_pieces, "_known", {})
    rng = random.Random(3)
    words = [f"{rng.choice('abcdef')}{k}".replace("7", "é") for k in range(60)]
    texts = [" ".join(rng.choice(words[: 4 if k % 3 else 60]) + rng.choice(["", "", ",", ".", "!)"]) for _ in range(rng.randrange(60))) for k in range(200)]
    got = [ids[a:z].tolist() for _, ids, at in _pieces.encode(pa.array(texts), PATH, 2) for a, z in zip(at[:-1], at[1:], strict=True)]
    assert got == [[*tok.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert len(_pieces._known[PATH].pieces) < 100
