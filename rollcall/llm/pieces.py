"""SentencePiece encoding and decoding by suffix-array matching (operator 7).

A batch's texts fall into stretches (a run of spaces and what follows it) that no
piece can cross. The batch's distinct new stretches are put behind one another and
indexed by a suffix array, sorted as deep as the longest piece. Every piece of the
vocabulary is searched in it by bisection, one character after the other, which
gives its range of occurrences. The occurrences are the edges: dealt by position
(a bucket sort), they say which piece spans any two places. Relaxing follows the model: in a BPE
model the score of a piece is its merge rank, so neighbouring symbols that an edge
spans are merged, the best score first and the leftmost among equals, until no
edge spans two symbols. Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import packed, slices, utf8

SPACE = "▁"
#: Stands for a U+2581 of the text itself, which must not turn into a space; no valid text holds it.
ESCAPED = "\udc81"
CACHE_BYTES = 64_000_000  # what a task may hold of stretches and their pieces, beyond one batch's
ENTRY_BYTES = 150  # of a remembered stretch, besides its characters and ids
BATCH_BYTES = 2_000_000
LONG = 128  # longer stretches are relaxed one by one, with a heap
NEVER = np.int32(2**31 - 1)


class Vocabulary:
    """What tasks need of a model: pieces as characters, merge order, byte pieces."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = list(range(model.get_piece_size()))
        self.names: list[str] = model.id_to_piece(ids)
        usual = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(SPACE in self.names[i].lstrip(SPACE) or "\n" in self.names[i] for i in usual):
            raise ValueError("a piece spans a space or a line end")
        self.bytes = np.full(256, -1, np.int32)
        for i in ids:
            if model.is_byte(i):
                self.bytes[int(self.names[i][3:5], 16)] = i
        self.unknown = model.unk_id()
        self.ids = np.array(usual, np.int32)
        scores = np.array([model.get_score(i) for i in usual])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.length = np.array([len(self.names[i]) for i in usual], np.int32)
        self.depth = int(self.length.max())
        self.chars = np.zeros((len(usual), self.depth), np.uint32)
        for row, i in enumerate(usual):
            self.chars[row, : self.length[row]] = [ord(c) for c in self.names[i]]
        control = {i for i in ids if model.is_control(i)}
        self.raw = [
            bytes([int(n[3:5], 16)]) if model.is_byte(i) else b"" if i in control else n.replace(SPACE, " ").encode()
            for i, n in enumerate(self.names)
        ]

    def fallback(self, char: str) -> list[int]:
        known = self.bytes[list((SPACE if char == ESCAPED else char).encode())]
        return [self.unknown] if (known < 0).any() else known.tolist()


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text in the order of their first ``depth`` characters (or more), by doubling."""
    padded = np.concatenate([codes, np.zeros(2, codes.dtype)]).astype(np.int64)
    key, step = (padded[:-2] << 42) | (padded[1:-1] << 21) | padded[2:], 3
    while step < depth:
        rank = np.unique(key, return_inverse=True)[1] + 1
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        key, step = rank * (len(codes) + 2) + after, step * 2
    return np.argsort(key).astype(np.int32)


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, char: np.ndarray, right: bool) -> np.ndarray:
    """Bisection for many characters at once, each within its own range of ``column``."""
    low, high = low.copy(), high.copy()
    open_ = low < high
    while open_.any():
        middle = (low + high) >> 1
        seen = column[np.minimum(middle, len(column) - 1)]
        beyond = open_ & ((seen <= char) if right else (seen < char))
        low = np.where(beyond, middle + 1, low)
        high = np.where(open_ & ~beyond, middle, high)
        open_ = low < high
    return low


def occurrences(codes: np.ndarray, order: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Start and piece (row of the vocabulary) of every occurrence."""
    low = np.zeros(len(vocabulary.ids), np.int64)
    high = np.full(len(vocabulary.ids), len(order))
    padded = np.concatenate([codes, np.zeros(vocabulary.depth, codes.dtype)])
    for depth in range(vocabulary.depth):
        alive = np.flatnonzero((vocabulary.length > depth) & (low < high))
        column, char = padded[order + depth], vocabulary.chars[alive, depth]
        first = _bound(column, low[alive], high[alive], char, right=False)
        high[alive] = _bound(column, first, high[alive], char, right=True)
        low[alive] = first
    counts = np.maximum(high - low, 0)
    piece = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    at = np.repeat((low - np.cumsum(counts) + counts).astype(np.int32), counts)
    at += np.arange(len(piece), dtype=np.int32)
    return order[at], piece


def _relax_long(begin: int, end: int, spans: np.ndarray, rank: np.ndarray, depth: int) -> list[int]:
    """Symbol starts of one stretch, by a heap of possible merges."""
    after, before = list(range(1, end - begin + 1)), list(range(-1, end - begin - 1))
    size, heap = end - begin, []

    def offer(at: int) -> None:
        other = after[at]
        if other < size and after[other] - at <= depth:
            order = int(rank[spans[begin + at, after[other] - at - 1]])
            if order != NEVER:
                heapq.heappush(heap, (order, at, after[other]))

    for at in range(size):
        offer(at)
    gone = [False] * size
    while heap:
        _, at, until = heapq.heappop(heap)
        if gone[at] or after[at] >= size or after[after[at]] != until:
            continue
        other = after[at]
        gone[other] = True
        after[at] = until
        if until < size:
            before[until] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    return [begin + at for at in range(size) if not gone[at]]


def _relax(cuts: np.ndarray, spans: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """Symbol starts of all stretches after merging, the best edge of every stretch at a time."""
    rank, depth = np.append(NEVER, vocabulary.rank), vocabulary.depth
    places = np.arange(cuts[-1])
    stretch = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    long = np.diff(cuts) > LONG
    done = [np.array(_relax_long(cuts[i], cuts[i + 1], spans, rank, depth), np.int64) for i in np.flatnonzero(long)]
    start, end = places[~long[stretch]], places[~long[stretch]] + 1
    owner = stretch[start]
    while len(start):
        until = np.append(end[1:], 0)
        span = until - start
        fits = (np.append(owner[1:], -1) == owner) & (span <= depth)
        order = rank[spans[start, np.where(fits, span, 1) - 1]].astype(np.int64)
        order[~fits] = NEVER
        key = (order << 32) | np.arange(len(start))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        best = np.minimum.reduceat(key, first)
        merge = best[(best >> 32) != NEVER] & 0xFFFFFFFF
        settled = np.repeat((best >> 32) == NEVER, np.diff(first, append=len(start)))
        done.append(start[settled])
        end[merge] = until[merge]
        stays = ~settled
        stays[merge + 1] = False
        start, end, owner = start[stays], end[stays], owner[stays]
    return np.sort(np.concatenate(done))


def encode_stretches(stretches: Sequence[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids (int32, as bytes) of each stretch."""
    text = "".join(stretches)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in stretches])])
    # Edges across two stretches may be found, but are never looked at.
    start, piece = occurrences(codes, suffix_array(codes, vocabulary.depth), vocabulary)
    spans = np.zeros((len(codes), vocabulary.depth), np.int32)  # piece + 1 from a place, by length
    spans[start, vocabulary.length[piece] - 1] = piece + 1
    symbols = _relax(cuts, spans, vocabulary)
    edges = np.searchsorted(symbols, cuts)
    ends = np.append(symbols[1:], len(codes))
    ids = np.append(np.int32(-1), vocabulary.ids)[spans[symbols, ends - symbols - 1]]
    raw = ids.tobytes()
    out = [raw[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    for one in np.unique(np.searchsorted(edges, np.flatnonzero(ids < 0), "right") - 1):
        expanded: list[int] = []
        for at, found in zip(symbols[edges[one] : edges[one + 1]].tolist(), ids[edges[one] : edges[one + 1]].tolist(), strict=True):
            expanded += [found] if found >= 0 else vocabulary.fallback(text[at])
        out[one] = np.array(expanded, np.int32).tobytes()
    return out


def _width(stretch: str) -> int:
    """Bytes a character takes in memory."""
    return 1 if stretch.isascii() else 4 if max(stretch) > "\uffff" else 2


class Encoder:
    """Encodes texts batch by batch and remembers stretches it has met."""

    _stretch = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self.held = vocabulary, {}, 0

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        parts = [
            self._stretch.findall(SPACE + t.replace(SPACE, ESCAPED).replace(" ", SPACE)) if t else [] for t in texts
        ]
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        new = list(set().union(*parts).difference(self.known))
        if new:
            ids = encode_stretches(new, self.vocabulary)
            self.known.update(zip(new, ids, strict=True))
            self.held += sum(ENTRY_BYTES + _width(s) * len(s) + len(b) for s, b in zip(new, ids, strict=True))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, part)), np.int32) for part in parts]


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of some ids: byte pieces joined, the leading space of the encoder taken off."""
    raw = b"".join([vocabulary.raw[i] for i in ids])
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encoder(vocabulary: Vocabulary):
    """Column function: text -> ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = Encoder(vocabulary)
        for batch in batches:
            _, offsets = utf8(batch)
            parts = []
            for lo, hi in slices(offsets, offsets, BATCH_BYTES):
                parts += run([t or "" for t in batch.slice(lo, hi - lo).to_pylist()])
            cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            mask = np.append(batch.is_null().to_numpy(zero_copy_only=False), False)
            yield pa.ListArray.from_arrays(pa.array(cuts, mask=mask), pa.array(flat, pa.int32()))

    return encode


def decoder(vocabulary: Vocabulary):
    """Column function: ids -> text."""

    @F.arrow_udf("string")
    def back(lists: pa.Array) -> pa.Array:
        values, cuts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lists.value_lengths().fill_null(0).to_numpy()])
        texts = [decode(values[a:b].tolist(), vocabulary) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return back


def encoded(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``_row, ids`` for every row, ``_row`` holding the input columns.

    A null text has null ids, an empty one no ids. Ids equal those of the model's own
    library, but for a U+2581 in the text: it becomes byte pieces, so that decoding
    gives back every text exactly. Repeated rows get equal ids; an empty table gives
    no rows.
    """
    rows = packed(docs)
    return rows.select("_row", encoder(vocabulary)(F.col("_row").getField(text_col).cast("string")).alias("ids"))
