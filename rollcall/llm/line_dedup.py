"""Line dedup by a deletion-neighbourhood join (operator 8).

A line goes if an earlier line (by document id, then position) equals it or is one
edit away (a character put in, taken out or exchanged), whether that one stayed or
not. Lines are compared without white space at their ends; near matches are
sought among lines of ``NEAR_CHARS`` characters and more, equal ones among all.

Two lines one edit apart share a deletion variant: one is the other less a
character, or both are equal once the character at the same place is taken out.
So a variant key never has to give out pairs: the *earliest* line per key decides,
which is a plain grouped minimum. To keep variants of long lines few, the edit is
located first, losing nothing:

1. an edit leaves the first or the last ``h`` bytes alone (``h`` a power of two, up
   to half of what the edit leaves): only lines that share such an end with another line go on;
2. cut at multiples of ``WINDOW`` from the start and from the end, the parts before
   and after the edit are equal: only windows whose surroundings occur twice go on;
3. these windows (under ``2 * WINDOW`` characters) get all deletion variants.

The earliest partner found is then verified by its edit distance.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import (
    BROADCAST_ROWS,
    SLICE_BYTES,
    checkpointed,
    col,
    constants,
    measured,
    mix,
    packed,
    slices,
    small_batches,
    spread,
    utf8,
)

NEAR_CHARS = 16
WINDOW = 32
EDITS = 1
LAST = (1 << 63) - 1  # stands for a null id, after all others

_BLANK = np.zeros(256, bool)
_BLANK[[9, 13, 32]] = True
_VALUES = constants(21, 256)
_BASES = [int(b) for b in constants(22, 2)]
_SIDE = constants(23, 2)
#: Bytes by which two lines one edit apart can differ in length: a character has four at most.
_SLACK = 4


def _computed_powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, np.uint64(base))
    steps[0] = 1
    return np.cumprod(steps)


@functools.cache
def _first_powers(base: int) -> np.ndarray:
    """Powers for all slices but those of a single longer text."""
    return _computed_powers(base, SLICE_BYTES + 1)


def _powers(base: int, count: int) -> np.ndarray:
    return _first_powers(base)[:count] if count <= SLICE_BYTES + 1 else _computed_powers(base, count)


class _Hasher:
    """Hashes of any stretches of some bytes, from one running sum (arithmetic modulo 2**64)."""

    def __init__(self, values: np.ndarray, base: int):
        inverse = pow(base, -1, 1 << 64)
        self.back = _powers(inverse, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values) + 1)[:-1], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, position in the text, begin and end of every line that is not blank; ends trimmed."""
    feeds = np.flatnonzero(data == 10)
    owner = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    begin = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((begin, owner))
    owner, begin = owner[order], begin[order]
    last = np.append(owner[1:] != owner[:-1], True)
    end = np.where(last, offsets[owner + 1], np.append(begin[1:], 0) - 1)
    first = np.searchsorted(owner, owner)
    position = np.arange(len(owner)) - first
    solid = np.flatnonzero(~_BLANK[data] & (data != 10))
    low, high = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    some = high > low
    return owner[some], position[some], solid[low[some]], solid[high[some] - 1] + 1


def _end_lengths(size: np.ndarray) -> list[np.ndarray]:
    """Powers of two, at most half of what an edit leaves, for a line and for lines a little shorter."""
    lengths = [np.maximum(size - slack - 2 * _SLACK, 2) // 2 for slack in range(_SLACK + 1)]
    powers = [1 << np.floor(np.log2(x)).astype(np.int64) for x in lengths]
    return [powers[0], powers[-1]]  # they halve at most once over so few lengths


ENDS = ("_e0", "_e1", "_e2", "_e3")


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for lo, hi in slices(data, offsets):
            part = data[offsets[lo] : offsets[hi]]
            row, position, begin, end = line_spans(part, offsets[lo : hi + 1] - offsets[lo])
            values = _VALUES[part]
            hashers = [_Hasher(values, base) for base in _BASES]
            at = pa.array(row + lo)
            columns = [batch.column("_doc").take(at), batch.column("_code").take(at), pa.array(position.astype(np.int32))]
            columns += [pa.array(h(begin, end).view(np.int64)) for h in hashers]
            size = end - begin
            long, short = _end_lengths(size)
            for k, h in enumerate((long, long, short, short)):
                used = (size >= NEAR_CHARS) & ((k < 2) | (short != long))
                h = np.minimum(h, size)
                key = hashers[0](begin, begin + h) if k % 2 == 0 else hashers[0](end - h, end)
                key = mix(key ^ (h.astype(np.uint64) * _SIDE[k % 2]))
                columns.append(pa.array(key.view(np.int64), mask=~used))
            names = ["_doc", "_code", "_pos", "_line", "_more", *ENDS]
            yield pa.RecordBatch.from_arrays(columns, names)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col).cast("string")
    doc = F.coalesce(col(id_col).cast("long"), F.lit(LAST))
    return small_batches(docs).select(doc.alias("_doc"), F.xxhash64(text).alias("_code"), text.alias("_text"))


_LINE = "_doc bigint, _code bigint, _pos int, _line bigint, _more bigint"


def _at() -> Column:
    return F.struct("_doc", "_code", "_pos")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _chain(blocks: list[str]) -> list[int]:
    """Hashes of all beginnings of a run of blocks, in one pass."""
    state, out = xxhash.xxh64(), [0]
    for block in blocks:
        state.update(block)
        out.append(state.intdigest())
    return out


def windows(text: str) -> Iterator[tuple[int, str]]:
    """Key of its surroundings and content of every window that an edit may lie in."""
    size = len(text)
    before = _chain([text[i : i + WINDOW] for i in range(0, size - size % WINDOW, WINDOW)])
    after = _chain([text[i - WINDOW : i] for i in range(size, size % WINDOW, -WINDOW)])
    for a in range(size // WINDOW + 1):
        last = (size - WINDOW * a) // WINDOW
        for b in {max(last - 1, 0), last}:
            around = xxhash.xxh64_intdigest(f"{a},{b},{before[a]},{after[b]}")
            yield _signed(around), text[WINDOW * a : size - WINDOW * b]


def _windowed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of the lines that are asked for, by text and positions."""
    for batch in batches:
        out = []
        for doc, code, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("_doc", "_code", "_text", "_wanted")), strict=True):
            lines = text.split("\n")
            for one in wanted:
                line = lines[one["_pos"]].strip(" \t\r")
                if len(line) >= NEAR_CHARS:
                    out += [(one["_line"], one["_more"], doc, code, one["_pos"], *window) for window in windows(line)]
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64(), pa.string()]
        names = ["_line", "_more", "_doc", "_code", "_pos", "_around", "_window"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of the lines that are asked for."""
    for batch in batches:
        out = [
            (one["_line"], one["_more"], text.split("\n")[one["_pos"]].strip(" \t\r"))
            for text, wanted in zip(batch.column("_text").to_pylist(), batch.column("_wanted").to_pylist(), strict=True)
            for one in wanted
        ]
        columns = list(zip(*out, strict=True)) or [()] * 3
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_line", "_more", "_text"])


# Kinds of variant keys: the window less a character at one place, less a character wherever, itself.
AT_PLACE, ANYWHERE, ITSELF = 1, 2, 3


def _variants(window: Column, around: Column) -> Column:
    """Keys of all deletion variants of a window."""
    rest = F.length(window)
    less = F.transform(
        F.sequence(F.lit(1), rest),
        lambda i: F.concat(F.substring(window, F.lit(1), i - 1), F.substring(window, i + 1, rest)),
    )

    def key(kind: int, place: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.xxhash64(around, place, text).alias("key"))

    gone = F.transform(less, lambda s, i: F.array(key(AT_PLACE, i + 1, s), key(ANYWHERE, F.lit(0), s)))
    itself = F.array(key(ITSELF, F.lit(0), window))
    return F.coalesce(F.when(rest > 0, F.concat(F.flatten(gone), itself)), itself)


def _asked(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """``_doc, _code, _text, _wanted``: the texts that hold the first occurrence of some lines."""
    keys = ["_doc", "_code"]
    lines = checkpointed(lines.select("_first.*", "_line", "_more"))
    wanted = lines.groupBy(*keys).agg(F.collect_set(F.struct("_pos", "_line", "_more")).alias("_wanted"))
    # The lists of positions are as long as their texts: what counts is the lines, not the texts.
    if lines.count() <= BROADCAST_ROWS:
        return texts.join(F.broadcast(wanted), keys)
    some = texts.join(measured(lines.select(*keys).distinct()), keys, "left_semi")
    return some.join(spread(wanted), keys)


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Keys that at least two different lines have."""
    ends = rows.groupBy(key).agg(F.min("_line").alias("_low"), F.max("_line").alias("_high"))
    return ends.where("_low <> _high").select(key)


def near_lines(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``_line, _more`` of the classes that an earlier line within the edit bound replaces."""
    keys = ["_line", "_more"]
    ends = classes.select(*keys, "_first", F.explode(F.array(*ENDS)).alias("_end")).where("_end is not null")
    alive = ends.join(measured(_shared(ends, "_end")), "_end").select(*keys, "_first").distinct()
    parts = _asked(texts, alive).mapInArrow(
        _windowed, "_line bigint, _more bigint, _doc bigint, _code bigint, _pos int, _around bigint, _window string"
    )
    hit = parts.join(measured(_shared(parts, "_around")), "_around").select(*keys, _at().alias("_first"), "_around", "_window")
    # Texts that repeat id and all give the same windows.
    hit = checkpointed(hit.distinct())
    variants = hit.select(*keys, "_first", F.explode(_variants(F.col("_window"), F.col("_around"))).alias("_v")).select(
        *keys, "_first", "_v.kind", "_v.key"
    )
    variants = variants.join(measured(_shared(variants, "key")), "key")
    mine = F.struct("_first", *keys)
    least = variants.groupBy("key").agg(
        F.min(F.when(F.col("kind") == AT_PLACE, mine)).alias("_S"),
        F.min(F.when(F.col("kind") == ANYWHERE, mine)).alias("_D"),
        F.min(F.when(F.col("kind") == ITSELF, mine)).alias("_I"),
    )
    # An exchange meets its like; the line itself meets lines less a character, and the reverse.
    partner = F.when(F.col("kind") == AT_PLACE, F.col("_S")).when(F.col("kind") == ITSELF, F.col("_D")).otherwise(F.col("_I"))
    found = (
        variants.join(spread(least), "key")
        .withColumn("_partner", partner)
        .where("_partner is not null and _partner._first < _first")
        .groupBy(*keys)
        .agg(F.min("_first").alias("_first"), F.min("_partner").alias("_partner"))
    )
    found = checkpointed(found)
    both = found.select(*keys, "_first").unionByName(found.select("_partner.*").select(*keys, "_first"))
    named = _asked(texts, both.distinct()).mapInArrow(_named, "_line bigint, _more bigint, _text string").distinct()
    named = checkpointed(named)
    mine_text = named.select(*keys, F.col("_text").alias("_mine"))
    their_text = named.select(F.col("_line").alias("_by"), F.col("_more").alias("_by_more"), F.col("_text").alias("_theirs"))
    pairs = found.select(*keys, F.col("_partner._line").alias("_by"), F.col("_partner._more").alias("_by_more"))
    pairs = pairs.join(mine_text, keys).join(spread(their_text), ["_by", "_by_more"])
    return pairs.where(F.levenshtein("_mine", "_theirs", EDITS).between(0, EDITS)).select(*keys)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_doc, _code, _drop``: positions of the lines that go, per document that loses any."""
    texts = _texts(docs, id_col, text_col)
    keys = ["_line", "_more"]
    lines = checkpointed(texts.mapInArrow(_hashed, _LINE + "".join(f", {e} bigint" for e in ENDS)))
    classes = checkpointed(
        lines.select(*keys, _at().alias("_at"), *ENDS)
        .groupBy(*keys)
        .agg(F.min("_at").alias("_first"), (F.min("_at") != F.max("_at")).alias("_again"), *[F.min(e).alias(e) for e in ENDS])
    )
    near = checkpointed(near_lines(texts, classes))
    doomed = classes.select(*keys, "_first", "_again").join(spread(near.withColumn("_near", F.lit(True))), keys, "left")
    doomed = doomed.where("_near or _again")
    gone = lines.drop(*ENDS).join(spread(doomed), keys).withColumn("_at", _at()).where("_near or _at <> _first")
    return gone.groupBy("_doc", "_code").agg(F.collect_set("_pos").alias("_drop"))


def _without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """The texts less the lines at some positions."""
    lost = np.flatnonzero(drops.is_valid().to_numpy(zero_copy_only=False))
    if not len(lost):
        return texts
    out = texts.to_pylist()
    for row in lost:
        gone = set(drops[int(row)].as_py())
        out[row] = "\n".join([line for at, line in enumerate(out[row].split("\n")) if at not in gone])
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row, n_lines, n_removed, new_text`` for every row, ``_row`` holding the input columns.

    Lines end at line feeds; blank lines stay. A null text stays null (no lines), an
    empty one stays empty. Null ids come after all others in the order of lines, as the
    greatest id.
    Rows that repeat id and text lose the same lines. An empty table gives no rows.
    """
    drops = dropped_lines(docs, id_col, text_col)
    field = F.col("_row").getField
    rows = packed(docs).select(
        "_row",
        F.coalesce(field(id_col).cast("long"), F.lit(LAST)).alias("_doc"),
        F.xxhash64(field(text_col).cast("string")).alias("_code"),
    )
    joined = rows.join(drops, ["_doc", "_code"], "left")
    text = F.col("_row").getField(text_col).cast("string")
    # Only texts that lose a line are handed to Python; counting the feeds is a search of bytes.
    losing = F.when(F.col("_drop").isNotNull(), text)
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return joined.select(
        "_row",
        F.coalesce(feeds + 1, F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).alias("n_removed"),
        F.coalesce(F.arrow_udf("string")(_without)(losing, F.col("_drop")), text).alias("new_text"),
    )
