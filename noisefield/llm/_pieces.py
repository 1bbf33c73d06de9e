"""Ids of whole texts by byte-level vocabularies, each distinct piece once.

A byte-level pre-tokenizer never joins a character that is no white space with the white space after it, nor a letter with the
punctuation after it, so a text may be cut there and its pieces encoded by themselves: the ids are those of the whole text. Cuts are made
only where the characters are surely of these kinds; fewer cuts give longer pieces and the same ids. A worker keeps the pieces it has met and their ids
in Arrow and numpy arrays of bounded size, and finds those of a pass with Arrow's dictionary encoding. Other vocabularies are given whole texts.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import _text as X, _tokens

#: Pieces and their bytes that a Python worker keeps; beyond that it keeps those most used.
PIECES_KEPT, BYTES_KEPT = 1_500_000, 32 << 20
#: Bytes of text whose pieces are looked up at once, and whose ids are put together at once.
PASS_BYTES, PART_BYTES = 12 << 20, 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Second last bytes of characters outside ASCII that may be white space (U+0085, U+00A0, U+1680, U+2000 and later, U+3000).
_MAYBE = np.zeros(256, bool)
_MAYBE[[0x80, 0x81, 0x9A, 0xC2]] = True
#: Punctuation before which a text is cut after a letter from A to Z.
_STOPS = ".,;:!?)"
_STOP, _LATIN = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(_STOPS.encode())] = True
_LATIN[65:91] = _LATIN[97:123] = True

_known: dict[str, _Known] = {}
_cut: dict[str, bool] = {}


class _Known:
    """Pieces and their ids, one run after another, and how often each was used; the first piece is empty."""

    def __init__(self) -> None:
        self.pieces = pa.array([""], pa.large_string())
        self.ids = np.zeros(0, "<u4")
        self.size = np.zeros(1, np.int64)
        self.uses = np.ones(1, np.int64)

    def places(self, pieces: pa.Array, uses: np.ndarray, tok) -> np.ndarray:
        at = pc.index_in(pieces, value_set=self.pieces)
        if at.null_count:
            if len(self.pieces) > PIECES_KEPT or self.pieces.nbytes > BYTES_KEPT:
                self._halve()
                at = pc.index_in(pieces, value_set=self.pieces)
            missing = np.asarray(pc.is_null(at))
            fresh = pieces.filter(pa.array(missing))
            ids = [e.ids for e in tok.encode_batch_fast(fresh.to_pylist(), add_special_tokens=False)]
            found = np.asarray(at.fill_null(0), np.int64)
            found[missing] = len(self.pieces) + np.arange(len(fresh))
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.size = np.concatenate([self.size, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), "<u4")])
            self.uses = np.append(self.uses, np.zeros(len(fresh), np.int64))
        else:
            found = np.asarray(at, np.int64)
        self.uses[found] += uses
        return found

    def _halve(self) -> None:
        """Leaves the half that was used most, with half its uses."""
        left = np.sort(np.append(0, 1 + np.argsort(-self.uses[1:], kind="stable")[: len(self.uses) // 2]))
        self.ids, _ = _tokens._spread(self.ids, self.size, left)
        self.pieces, self.size, self.uses = self.pieces.take(pa.array(left)), self.size[left], self.uses[left] // 2


def cuts_at_space(path: str) -> bool:
    """Whether the file's tokenizer is byte-level as described above, without a normalizer or special tokens that take in white space or stops."""
    if path not in _cut:
        state = json.loads(_tokens.tokenizer(path).to_str())
        pre = state.get("pre_tokenizer") or {}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not any(c.isspace() or c in _STOPS for c in t["content"]) for t in state["added_tokens"])
        _cut[path] = plain and not state.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return _cut[path]


def cuts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where pieces start: at each text that is not empty, at white space after a character that is surely none, and at a stop after a letter."""
    first = np.zeros(len(raw) + 1, bool)
    if len(raw) > 2:
        before = raw[1:-1]
        solid = (before > 0x20) & (before < 0x7F) | (before >= 0x80) & ~_MAYBE[raw[:-2]]
        first[2:-1] = _SPACE[raw[2:]] & solid | _STOP[raw[2:]] & _LATIN[before]
    first[at[:-1]] = True
    return np.flatnonzero(first[: len(raw)])


def encode(texts: pa.Array, path: str, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each pass over the batch: its first document, the ids of all its documents, and where each document's ids start."""
    tok = _tokens.tokenizer(path)
    if not cuts_at_space(path):
        yield from _tokens.encode(texts, path, end_id)
        return
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    raw, at = X.as_bytes(texts)
    known = _known.setdefault(path, _Known())
    for i, j in X.passes(at, PASS_BYTES):
        part, edge = raw[at[i] : at[j]], at[i : j + 1] - at[i]
        start = cuts(part, edge)
        coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(part)).astype(np.int64)), pa.py_buffer(part)).dictionary_encode()
        indices = np.asarray(coded.indices)
        places = known.places(coded.dictionary, np.bincount(indices, minlength=len(coded.dictionary)), tok)
        first = np.searchsorted(start, edge)
        for a, z in X.passes(edge, PART_BYTES):
            ids, starts = _tokens._spread(known.ids, known.size, places[indices[first[a] : first[z]]])
            doc_at = starts[first[a : z + 1] - first[a]]
            if end_id is not None:
                ids = np.insert(ids, doc_at[1:], end_id).astype("<u4")
                doc_at = doc_at + np.arange(len(doc_at))
            yield i + a, ids, doc_at
    X.give_back()
