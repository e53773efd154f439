"""Token ids of whole texts: exactly what the tokenizer gives, from one call per distinct piece of a text.

Both tokenizers cut a text at white space before they merge anything, so a text's ids are those of its
words and marks one after another. These repeat: each is encoded once, kept in a bounded cache of the Python worker, and
gathered by numpy. The cache knows pieces by two hashes, without their texts; a slice in which hashes of different
pieces meet is encoded whole.
Texts that the cut does not describe exactly (white space other than single spaces and line ends) are encoded whole, and
so are texts that may hold a token which the tokenizer finds before it cuts, such as ``<|endoftext|>``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerkit.llm.words import buffers, mix

#: Pieces kept by a worker, at some 40 bytes each; beyond it the cache starts anew between slices.
CACHE_PIECES = 2_000_000
#: Bytes of text worked on at once.
SLICE_BYTES = 8_000_000
#: A mark before a piece that has no space before it in its text.
BARE = "\x02"
#: Marks that end a word: no tokenizer here joins them to the letter before.
TAIL = r"([A-Za-zÀ-ÖØ-öø-ɏ])([,.!?;:|]+)(\s|$)"
#: Texts whose cut at single spaces and line ends might differ from the tokenizer's own.
IRREGULAR = (
    r"^[ \n]|[ \n]$|[ \n][ \n]|[\t\r\v\f\x02\x1c-\x1f]"
    r"|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


class Encoded(NamedTuple):
    """Ids of several texts one after another, and how many each has."""

    ids: np.ndarray
    counts: np.ndarray


def piece_hashes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text, of 64 and of 32 bits: sums over its bytes and their places."""
    data, offsets = buffers(pieces)
    size = np.diff(offsets)
    first, second = np.zeros(len(pieces), np.uint64), np.zeros(len(pieces), np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        inside = np.arange(len(data)) - np.repeat(offsets[:-1], size)
        spread = mix((data.astype(np.uint64) << np.uint64(32)) + inside.astype(np.uint64) + np.uint64(1))
        first[filled] = np.add.reduceat(spread, offsets[:-1][filled])
        second[filled] = np.add.reduceat(mix(spread), offsets[:-1][filled])
    return mix(first + size.astype(np.uint64)), (mix(second) >> np.uint64(32)).astype(np.uint32)


class WordEncoder:
    """``keeps_space``: the tokenizer's words hold the space before them (byte-level BPE); else spaces vanish."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.keeps_space = keeps_space
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # sorted; ``place`` leads to the other arrays
        self.place = np.empty(0, np.int32)
        self.checks = np.empty(0, np.uint32)
        self.flat = np.empty(0, self.dtype)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int32)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each piece is known, and where."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.place[at].astype(np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _literal(self, piece: str) -> str:
        if not self.keeps_space:
            return piece.removeprefix(BARE)
        return piece[1:] if piece.startswith(BARE) else f" {piece}"

    def _learn(self, pieces: list[str], hashes: np.ndarray, checks: np.ndarray) -> None:
        ids = self._whole([self._literal(p) for p in pieces])
        counts = np.fromiter(map(len, ids), np.int32, len(ids))
        new = np.fromiter(chain.from_iterable(ids), self.dtype, int(counts.sum()))
        places = np.arange(len(self.counts), len(self.counts) + len(pieces), dtype=np.int32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts, dtype=np.int64) - counts])
        self.flat = np.concatenate([self.flat, new])
        self.counts = np.concatenate([self.counts, counts])
        self.checks = np.concatenate([self.checks, checks])
        own = np.argsort(hashes)
        both = np.concatenate([self.hashes, hashes[own]])
        order = np.argsort(both, kind="stable")  # two sorted runs
        self.hashes, self.place = both[order], np.concatenate([self.place, places[own]])[order]

    def _by_pieces(self, texts: pa.Array) -> Encoded:
        cut = pc.replace_substring_regex(texts, TAIL, rf"\1 {BARE}\2\3")
        if self.keeps_space:
            cut = pc.replace_substring(cut, "\n", f" {BARE}\n {BARE}")
            lists = pc.split_pattern(pc.binary_join_element_wise(BARE, cut, ""), " ")
        else:
            lists = pc.ascii_split_whitespace(cut)
        distinct = lists.flatten().dictionary_encode()
        pieces = distinct.dictionary
        hashes, checks = piece_hashes(pieces)
        if len(self.counts) + len(pieces) > CACHE_PIECES:
            self._clear()
        known, place = self._find(hashes)
        new = ~known
        if new.any():
            if len(np.unique(hashes[new])) < new.sum():
                return self._all_whole(texts)
            self._learn(pieces.filter(pa.array(new)).to_pylist(), hashes[new], checks[new])
            _, place = self._find(hashes)
        if (self.checks[place] != checks).any():
            return self._all_whole(texts)
        use = place[distinct.indices.to_numpy(zero_copy_only=False)]
        counts = self.counts[use].astype(np.int64)
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[use] - (ends - counts), counts) + np.arange(total)
        offsets = np.asarray(lists.offsets)
        return Encoded(self.flat[at], np.diff(np.concatenate([[0], ends])[offsets - offsets[0]]))

    def _all_whole(self, texts: pa.Array) -> Encoded:
        ids = self._whole(texts.to_pylist())
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return Encoded(np.fromiter(chain.from_iterable(ids), self.dtype, int(counts.sum())), counts)

    def encode(self, texts: pa.Array) -> Encoded:
        """Ids of ``texts``; a null is an empty text."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, IRREGULAR if self.keeps_space else BARE)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token, ignore_case=True))
        found = self._by_pieces(pc.if_else(odd, "", texts))
        where = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(where):
            return found
        whole = [np.array(x, self.dtype) for x in self._whole([texts[int(i)].as_py() for i in where])]
        ids = np.split(found.ids, np.cumsum(found.counts)[:-1])
        for i, x in zip(where, whole, strict=True):
            ids[i] = x
        return Encoded(np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))


@lru_cache(maxsize=2)
def encoder(path: str, keeps_space: bool) -> WordEncoder:
    """The worker's own encoder: its cache outlives a task."""
    return WordEncoder(path, keeps_space)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """``batches`` cut so that ``column`` has about SLICE_BYTES of text in each, and one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        groups = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
