"""SentencePiece ids by vectorised merge rounds, and texts from ids; both equal the library's.

A model of byte-pair pieces merges, again and again, the neighbouring symbols whose joint piece has the best score, the
leftmost of equals. Two characters that stand side by side in no piece can never be merged over: a text is cut there
into words, and each distinct word of a slice is merged once. All words take part in a round: the best rank of each
word is a segmented minimum over one flat array, every leftmost pair of that rank is merged at once, and finished words
leave the array. Where a merge makes a pair that is due before the word's next one, the rest waits for the next round,
so that the order is the library's. Characters without a piece become byte pieces.

Cases: a null text is an empty text (its end id only); texts of any length are taken whole, in slices of bounded size
and one text at least; repeated rows are worked on each for itself; an empty table gives an empty one. Other columns
stay, but those named like a new column, in any case, are replaced.

The model: byte pieces, an identity normaliser that only puts a space before a text, no user-defined pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerkit.llm.columns import map_rows, settle
from ledgerkit.llm.words import buffers, mix, text_slices

SPACE = 0x2581
#: Ids decoded at once.
SLICE_IDS = 500_000
#: Rounds for all words together; what is longer then is finished from a queue, in the same order.
ROUNDS = 256
NONE = np.iinfo(np.int32).max


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i]`` to ``starts[i] + counts[i]`` one after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def every_second(at: np.ndarray) -> np.ndarray:
    """Of sorted positions those that a merge from the left takes: the first of each run, and every second after it."""
    index = np.arange(len(at))
    begin = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, index, 0))
    return at[(index - begin) % 2 == 0]


class PieceModel:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        spelled = [lib.id_to_piece(i) for i in range(size)]
        byte, control = np.zeros(size, bool), np.zeros(size, bool)
        for i in range(size):
            byte[i], control[i] = lib.is_byte(i), lib.is_control(i)
        plain = [i for i in range(size) if not (byte[i] or control[i] or lib.is_unknown(i))]
        if byte.sum() != 256 or any(lib.is_unused(i) for i in plain):
            raise ValueError(f"{path}: a model with all byte pieces and no unused ones is needed")
        if lib.normalize(" Ａ  b\t") != "▁▁Ａ▁▁b\t":
            raise ValueError(f"{path}: its normaliser does more than put a space before a text")
        self.end_id, self.control = lib.eos_id(), control
        self.byte_id = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self._symbols({spelled[i]: i for i in plain}, size)
        self._pairs({i: lib.get_score(i) for i in plain})
        self._surfaces(spelled, byte)

    def _symbols(self, ids: dict[str, int], size: int) -> None:
        """Characters of pieces, numbered; symbols: the pieces' ids, then characters that are no piece."""
        chars = sorted({c for piece in ids for c in piece})
        number = {c: k for k, c in enumerate(chars)}
        self.n_chars = len(chars)
        self.char_of = np.full(0x110000, self.n_chars, np.int32)
        self.char_of[[ord(c) for c in chars]] = np.arange(self.n_chars)
        self.symbols = dict(ids)
        for c in chars:
            self.symbols.setdefault(c, size + len(self.symbols) - len(ids))
        self.n_symbols = size + len(self.symbols) - len(ids) + 1
        self.symbol_of = np.array([self.symbols[c] for c in chars] + [self.n_symbols - 1], np.int64)
        beside = {(number[a], number[b]) for piece in ids for a, b in zip(piece, piece[1:], strict=False)}
        bits = np.zeros((self.n_chars + 1) ** 2, bool)
        bits[[a * (self.n_chars + 1) + b for a, b in beside]] = True
        self.beside = np.packbits(bits, bitorder="little")
        # the ids that stand for a symbol: itself, or a character's bytes
        self.extra = {s: self.byte_id[list(c.encode())] for c, s in self.symbols.items() if s >= size}
        self.size = size

    def _pairs(self, scores: dict[int, float]) -> None:
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        found = []
        for piece, i in self.symbols.items():
            if i in scores:
                for k in range(1, len(piece)):
                    left, right = self.symbols.get(piece[:k]), self.symbols.get(piece[k:])
                    if left is not None and right is not None:
                        found.append((left * self.n_symbols + right, rank[scores[i]], i))
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self.keys = np.append(table[:, 0], np.iinfo(np.int64).max)
        self.ranks = np.append(table[:, 1], NONE).astype(np.int32)
        self.targets = np.append(table[:, 2], 0)

    def _surfaces(self, spelled: list[str], byte: np.ndarray) -> None:
        texts = [s.replace("▁", " ").encode() for s in spelled]
        for b, i in enumerate(self.byte_id.tolist()):
            texts[i] = bytes([b])
        for i in np.flatnonzero(self.control).tolist():
            texts[i] = b""
        texts[self.library.unk_id()] = " ⁇ ".encode()
        self.surface_size = np.array([len(t) for t in texts], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.surface = np.frombuffer(b"".join(texts), np.uint8)
        self.opens = np.array([s.startswith("▁") for s in spelled]) & ~byte & ~self.control

    def pair(self, left: np.ndarray, right: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joint piece of two symbols; ``same``: whether they lie in one word."""
        key = left * self.n_symbols + right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & same, self.ranks[at], NONE), self.targets[at]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair remains; ``word`` numbers each symbol's word, ascending. Returns both, shorter."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, target = self._after(symbols, word)
        for _ in range(ROUNDS):
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, begin) if len(begin) else begin, np.diff(begin, append=len(word)))
            live = best < NONE
            if not live.all():
                done.append((symbols[~live], word[~live]))
                symbols, word, rank, target, best = symbols[live], word[live], rank[live], target[live], best[live]
            if not len(symbols):
                break
            at = every_second(np.flatnonzero(rank == best))
            at = at[self._in_turn(symbols, word, target, best, at)]
            symbols[at] = target[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, rank, target = symbols[keep], word[keep], rank[keep], target[keep]
            at = at - np.arange(len(at))
            at = np.concatenate([at, at[at > 0] - 1])
            rank[at], target[at] = self._pairs_at(symbols, word, at)
        else:
            done.append(self._finish(symbols, word))
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _pairs_at(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        right = np.minimum(at + 1, len(symbols) - 1)
        return self.pair(symbols[at], symbols[right], (word[at] == word[right]) & (right > at))

    def _after(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs_at(symbols, word, np.arange(len(symbols)))

    def _in_turn(
        self, symbols: np.ndarray, word: np.ndarray, target: np.ndarray, best: np.ndarray, at: np.ndarray
    ) -> np.ndarray:
        """Which merges come before any pair that an earlier one of the same word makes."""
        again = np.diff(word[at], prepend=-1) == 0
        if not again.any():
            return ~again
        after = symbols.copy()
        after[at] = target[at]
        chosen = np.zeros(len(symbols) + 2, bool)
        chosen[at] = True
        left = np.where(chosen[at - 2] & (at > 1), at - 2, at - 1)
        right = np.minimum(at + 2, len(symbols) - 1)
        new_left, _ = self.pair(after[left], after[at], (left >= 0) & (word[left] == word[at]))
        new_right, _ = self.pair(after[at], symbols[right], (right == at + 2) & (word[right] == word[at]))
        early = np.minimum(new_left, new_right) <= best[at]
        seen = np.cumsum(early) - early
        return seen == np.maximum.accumulate(np.where(again, 0, seen))

    def _finish(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that are still unfinished, each from a queue of its pairs."""
        bounds = np.flatnonzero(np.diff(word, prepend=-1, append=-1))
        parts = [self._queue(symbols[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        return np.concatenate(parts), np.repeat(word[bounds[:-1]], [len(p) for p in parts])

    def _queue(self, symbols: np.ndarray) -> np.ndarray:
        n, held = len(symbols), symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank, target = self._after(symbols, np.zeros(n, np.int64))
        known: dict[tuple[int, int], tuple[int, int]] = {}
        queue = [(int(rank[i]), i, held[i], held[i + 1], int(target[i])) for i in np.flatnonzero(rank < NONE).tolist()]
        heapq.heapify(queue)

        def offer(i: int) -> None:
            if i < 0 or after[i] >= n:
                return
            pair = held[i], held[after[i]]
            if pair not in known:
                r, t = self.pair(np.array([pair[0]]), np.array([pair[1]]), np.ones(1, bool))
                known[pair] = int(r[0]), int(t[0])
            r, t = known[pair]
            if r < NONE:
                heapq.heappush(queue, (r, i, *pair, t))

        while queue:
            _, i, left, right, t = heapq.heappop(queue)
            j = after[i]
            if held[i] != left or j >= n or held[j] != right:
                continue
            held[i], held[j], after[i] = t, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([s for s in held if s >= 0], np.int64)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all texts with the space before each, where words begin, and each text's first character."""
        data, offsets = buffers(texts)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        filled = np.diff(first) > 0
        points = np.insert(np.where(points == 0x20, np.uint32(SPACE), points), first[:-1][filled], np.uint32(SPACE))
        first = first + np.concatenate([[0], np.cumsum(filled)])
        chars = self.char_of[points].astype(np.int64)
        at = chars[:-1] * (self.n_chars + 1) + chars[1:]
        begins = np.ones(len(points), bool)
        begins[1:] = (self.beside[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 0
        begins[first[:-1][filled]] = True
        return points, np.flatnonzero(begins), first

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, without end ids, and how many each has."""
        points, begin, first = self._cut(texts)
        if not len(points):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        size = np.diff(begin, append=len(points))
        chars = self.char_of[points]
        inside = np.arange(len(points)) - np.repeat(begin, size)
        spread = mix(points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + inside.astype(np.uint64))
        _, where, which = np.unique(np.add.reduceat(spread, begin), return_index=True, return_inverse=True)
        twin = where[which]
        if (size[twin] != size).any() or (points[ranges(begin[twin], size)] != points).any():
            where = which = np.arange(len(begin))  # two words share a hash: merge every word for itself
        at = ranges(begin[where], size[where])
        symbols, word = self.merge(self.symbol_of[chars[at]], np.repeat(np.arange(len(where)), size[where]))
        ids, word = self._spell(symbols, word, points[begin[where]])
        count = np.bincount(word, minlength=len(where))
        start = np.cumsum(count) - count
        of_text = np.concatenate([[0], np.cumsum(count[which])])[np.searchsorted(begin, first)]
        return ids[ranges(start[which], count[which])], np.diff(of_text)

    def _spell(self, symbols: np.ndarray, word: np.ndarray, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece as byte ids; ``point``: first code point of each word."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols.astype(np.int32), word
        parts, last = [], 0
        for i in odd.tolist():
            raw = self.extra.get(int(symbols[i]))
            if raw is None:  # in no piece, so a word of its own
                raw = self.byte_id[list(chr(point[word[i]]).encode())]
            parts += [symbols[last:i], raw]
            last = i + 1
        parts.append(symbols[last:])
        times = np.ones(len(symbols), np.int64)
        times[odd] = [len(p) for p in parts[1::2]]
        return np.concatenate(parts).astype(np.int32), np.repeat(word, times)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Texts of the id lists ``ids[bounds[i]:bounds[i + 1]]``."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id that the model does not have")
        size = self.surface_size[ids].copy()
        at = self.surface_at[ids].copy()
        said = np.flatnonzero(~self.control[ids])  # the first piece that is no control loses its space
        k = np.searchsorted(said, bounds[:-1])
        k = said[k[k < len(said)]] if len(said) else k[:0]
        k = np.unique(k[self.opens[ids[k]]])
        inner = np.searchsorted(bounds, k, "right")
        k = k[inner <= len(bounds) - 1]
        size[k] -= 1
        at[k] += 1
        data = self.surface[ranges(at, size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[bounds]
        raw = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8: the library's marks for them
            lists = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
            return pa.array([self.library.decode(x) for x in lists], pa.string())


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """The worker's own model: it outlives a task."""
    return PieceModel(path)


def encode_pieces(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", end: bool = True) -> DataFrame:
    """``docs`` with the ids of its texts, each list closed by the end id if ``end``."""
    docs = settle(docs, [text], [ids])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in text_slices(batches, text):
            flat, count = m.encode(batch.column(text))
            if end:
                flat = np.insert(flat, np.cumsum(count), m.end_id)
                count = count + 1
            bounds = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
            yield batch.append_column(ids, pa.ListArray.from_arrays(bounds, flat.astype(np.int32)))

    return map_rows(docs, run, [T.StructField(ids, T.ArrayType(T.IntegerType(), False))])


def decode_pieces(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text of each id list; a null list gives a null text."""
    coded = settle(coded, [ids], [text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_IDS)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    part = batch.slice(a, b - a)
                    flat = part.column(ids).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                    bounds = np.concatenate([[0], np.cumsum(size[a:b])]).astype(np.int64)
                    found = pc.if_else(part.column(ids).is_valid(), m.decode(flat, bounds), None)
                    yield part.append_column(text, found)

    return map_rows(coded, run, [T.StructField(text, T.StringType())])
