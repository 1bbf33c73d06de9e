"""Tokenizing Arrow batches with a public vocabulary file, each distinct word once.

`word_bpe` vocabularies drop white space and never join characters across it, so the ids of a text are the
ids of its words one after another. A worker keeps the words it has met and their ids in Arrow and numpy arrays of
bounded size, finds the distinct words of a batch with Arrow's dictionary encoding, and spreads their ids with numpy.
Vocabularies that see white space are given whole texts.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import _text as X

#: Words whose ids a Python worker keeps (some 40 bytes each); beyond that it starts afresh.
WORDS_KEPT = 700_000
#: Bytes of text whose distinct words are looked up at once.
PASS_BYTES = 6 << 20

_open: dict[str, object] = {}
_known: dict[str, _Words] = {}


class _Words:
    """Words and their ids, one run after another; the first word is empty."""

    def __init__(self) -> None:
        self.words = pa.array([""], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.size = np.zeros(1, np.int64)

    def places(self, words: pa.Array, path: str) -> np.ndarray:
        """Where distinct words stand; those not met before are encoded and added."""
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            fresh = words.filter(pc.is_null(at))
            ids = _encode_words(fresh.to_pylist(), path)
            self.words = pa.concat_arrays([self.words, fresh])
            self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), "<u4")])
            at = pc.index_in(words, value_set=self.words)
        return np.asarray(at, np.int64)


def tokenizer(path: str):
    if path not in _open:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _open[path] = Tokenizer.from_file(path)
        _known[path] = _Words()
    return _open[path]


def drops_space(path: str) -> bool:
    """Whether the file's tokenizer splits at white space and drops it."""
    import json

    state = json.loads(tokenizer(path).to_str())
    return state["model"].get("end_of_word_suffix") == "</w>" and "\\s+" in str(state.get("normalizer"))


#: A final run of . and , after a Latin letter is a token of its own whatever the letter.
_TAIL = "[A-Za-z\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{17F}][.,]+$"
#: Words with these keep their case here: special tokens, and letters whose lower case needs care.
_AS_IS = "[<\\x{130}-\\x{10FFFF}]"


def _spread(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `flat` (of the given sizes) in the order `which`, and where each starts."""
    begin = np.cumsum(size) - size
    each = size[which]
    starts = np.zeros(len(which) + 1, np.int64)
    np.cumsum(each, out=starts[1:])
    return flat[np.repeat(begin[which] - starts[:-1], each) + np.arange(starts[-1])], starts


def _encode_words(words: list[str], path: str) -> list[tuple[int, ...]]:
    """Ids of each word. Words go in lines of many with a lone digit between them, which is a token of its own."""
    tok = tokenizer(path)
    mark = tok.encode("0", add_special_tokens=False).ids
    plain = [w for w in words if "0" not in w] if len(mark) == 1 else []
    found: dict[str, tuple[int, ...]] = {}
    lines = [plain[k : k + 256] for k in range(0, len(plain), 256)]
    for line, e in zip(lines, tok.encode_batch_fast([" 0 ".join(x) for x in lines], add_special_tokens=False), strict=True):
        own: list[tuple[int, ...]] = []
        ids, a = e.ids, 0
        try:
            while True:
                z = ids.index(mark[0], a)
                own.append(tuple(ids[a:z]))
                a = z + 1
        except ValueError:
            own.append(tuple(ids[a:]))
        if len(own) == len(line):
            found.update(zip(line, own, strict=True))
    rest = [w for w in words if w not in found]
    for w, e in zip(rest, tok.encode_batch_fast(rest, add_special_tokens=False), strict=True):
        found[w] = tuple(e.ids)
    return [found[w] for w in words]


def _ids_of(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, one run after another, and the runs' sizes."""
    tokenizer(path)
    if len(_known[path].words) > WORDS_KEPT:
        _known[path] = _Words()
    known = _known[path]
    cut = pc.if_else(pc.match_substring_regex(words, _TAIL), pc.utf8_rtrim(words, characters=".,"), words)
    core = pc.if_else(pc.match_substring_regex(cut, _AS_IS), cut, pc.utf8_lower(cut)).dictionary_encode()
    which = np.zeros((len(words), 2), np.int64)
    which[:, 0] = known.places(core.dictionary, path)[np.asarray(core.indices)]
    tailed = np.flatnonzero(pc.not_equal(pc.binary_length(words), pc.binary_length(cut)).to_numpy(zero_copy_only=False))
    tails = pc.replace_substring_regex(words.take(pa.array(tailed)), "(?s)^.*[^.,]", "").dictionary_encode()
    which[tailed, 1] = known.places(tails.dictionary, path)[np.asarray(tails.indices)]
    flat, starts = _spread(known.ids, known.size, which.ravel())
    return flat, np.diff(starts[::2])


def encode(texts: pa.Array, path: str, end_id: int | None = None):
    """For each pass over the batch: its first document, the ids of all its documents, and where each document's ids start."""
    tok = tokenizer(path)
    by_word = drops_space(path)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at = X.as_bytes(texts)
    for i, j in X.passes(at, PASS_BYTES):
        part = texts.slice(i, j - i)
        if by_word:
            split = pc.ascii_split_whitespace(part)
            edge = np.asarray(split.offsets, np.int64)
            coded = split.values.slice(edge[0], edge[-1] - edge[0]).dictionary_encode()
            edge = edge - edge[0]
            which = np.asarray(coded.indices, np.int64)
            flat, size = _ids_of(coded.dictionary, path)
            ids, starts = _spread(flat, size, which)
            doc_at = starts[edge]
        else:
            got = [e.ids for e in tok.encode_batch(part.to_pylist(), add_special_tokens=False)]
            doc_at = np.cumsum([0, *map(len, got)])
            ids = np.fromiter((t for g in got for t in g), "<u4", int(doc_at[-1]))
        if end_id is not None:
            ids = np.insert(ids, doc_at[1:], end_id).astype("<u4")
            doc_at = doc_at + np.arange(len(doc_at))
        yield i, ids, doc_at
    X.give_back()
