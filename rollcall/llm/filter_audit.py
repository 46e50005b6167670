"""Filter interaction audit on a sparse document-term matrix (operator 13).

1. Every task packs its documents into shards of about ``SHARD_BYTES`` of text. A
   shard is a CSR matrix over the words of its own (row bounds, word numbers,
   counts). Its words are numbered by slot, a hash of the word, and leave it as one
   list per slot, so a word moves once a shard and not once an occurrence.
2. The lists of a slot meet in one task, which numbers the slot's words. Number and
   slot make the global code of a word: the dictionary has ``slots`` parts (the
   session's shuffle partitions), none of which is held but in its own task.
3. The codes go back to the shards, which are rewritten over global columns. Row
   sums and nonzero counts of the matrix decide filters A and B. The flags of C and
   D come from the bytes of the text, those of E from the least id that holds a
   text, found by grouped digests.
4. Documents are counted by part and set of failed filters (32 sets at most). The
   effect of each set in each order of the filters is a fixed table of 32 x 120 x 5
   rows; joined to the counts it gives the audit.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import checkpointed, col, partitions, small_batches, spread, utf8

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_SHARE = 50  # hundredths of the words
CAPITAL_SHARE = 3  # hundredths of the code points
SIGNS = b"#$%&*|"
SHARD_BYTES = 8_000_000

_CAPITALS = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that do not begin a code point

#: A packed piece of a shard: its matrix (slot -1), or its words or their codes in one slot.
PIECES = "shard bigint, slot int, data binary"
MATRIX = -1


def _pieces(shard: list[int], slot: list[int], data: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(shard, pa.int64()), pa.array(slot, pa.int32()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "slot", "data"])


class _Shard:
    """Rows gathered for one shard."""

    def __init__(self):
        self.number = defaultdict()
        self.number.default_factory = self.number.__len__
        self.rows: list[pa.RecordBatch] = []
        self.flags, self.bounds, self.words, self.counts = array("i"), array("i", [0]), array("i"), array("i")
        self.size = 0

    def add(self, rows: pa.RecordBatch, data: np.ndarray, cuts: np.ndarray) -> None:
        raw = data.tobytes()
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            text = raw[a:b]
            # Without an argument, bytes are split at exactly [\x20\x09-\x0D]+.
            found = Counter(text.split())
            self.words.extend(map(self.number.__getitem__, found))
            self.counts.extend(found.values())
            self.bounds.append(len(self.words))
            self.flags.append(_text_flags(text))
        self.rows.append(rows)
        self.size += len(raw)

    def done(self, shard: int, slots: int) -> pa.RecordBatch:
        terms = list(self.number)
        slot = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % slots
        order = np.argsort(slot, kind="stable")
        place = np.empty(len(terms), np.int32)
        place[order] = np.arange(len(terms), dtype=np.int32)
        rows = pa.Table.from_batches(self.rows).combine_chunks()
        flags, bounds, words, counts = (np.frombuffer(x, np.int32) for x in (self.flags, self.bounds, self.words, self.counts))
        lists = [
            *(rows.column(c).combine_chunks() for c in ("_id", "_part", "_digest")),
            *map(pa.array, (flags, bounds, place[words], counts)),
        ]
        packed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        batch = pa.RecordBatch.from_arrays(packed, ["ids", "parts", "digests", "flags", "bounds", "words", "counts"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        pack = zstandard.ZstdCompressor(1).compress
        used, first = np.unique(slot[order], return_index=True)
        at = order.tolist()
        ends = np.append(first, len(at))[1:]
        # No word holds a line feed.
        lines = [pack(b"\n".join(terms[i] for i in at[a:b])) for a, b in zip(first, ends, strict=True)]
        return _pieces([shard] * (len(lines) + 1), [MATRIX, *used.tolist()], [sink.getvalue().to_pybytes(), *lines])


def _text_flags(text: bytes) -> int:
    """Failures of C and D, as bits 4 and 8."""
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return (100 * capitals > CAPITAL_SHARE * points) * 4 + (len(text.translate(None, SIGNS)) < len(text)) * 8


def _sharded(slots: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, now = TaskContext.get().partitionId(), 0, _Shard()
        for batch in batches:
            data, cuts = utf8(batch.column("_text"))
            rows = batch.select(["_id", "_part", "_digest"])
            first = 0
            while first < len(rows):
                room = cuts[first] + SHARD_BYTES - now.size
                last = max(int(np.searchsorted(cuts, room, "right")) - 1, first + 1)
                last = min(last, len(rows))
                own = cuts[first : last + 1] - cuts[first]
                now.add(rows.slice(first, last - first), data[cuts[first] : cuts[last]], own)
                first = last
                if now.size >= SHARD_BYTES:
                    yield now.done((task << 32) | done, slots)
                    done, now = done + 1, _Shard()
        if now.rows:
            yield now.done((task << 32) | done, slots)

    return run


def shards(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> tuple[DataFrame, int]:
    """The table as packed shards (``PIECES``) with words of their own, and the number of slots."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = small_batches(docs).select(
        col(id_col).cast("long").alias("_id"),
        F.coalesce(col(part_col).cast("string"), F.lit("")).alias("_part"),
        F.unhex(F.sha2(text, 256)).alias("_digest"),
        text.alias("_text"),
    )
    slots = partitions(docs.sparkSession)
    return checkpointed(rows.mapInArrow(_sharded(slots), PIECES)), slots


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes], dict[bytes, int]]]:
    """The lists of words, slot by slot, and the numbers of the slot's words so far."""
    unpack = zstandard.ZstdDecompressor().decompress
    now, number = None, {}
    for batch in batches:
        for shard, slot, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "slot", "data")), strict=True):
            if slot != now:
                now, number = slot, defaultdict()
                number.default_factory = number.__len__
            yield shard, slot, unpack(data).split(b"\n"), number


def _by_slot(packed: DataFrame, slots: int) -> DataFrame:
    # Sorted by shard too, so that a task that is run again numbers the words alike.
    return packed.where(f"slot <> {MATRIX}").repartition(slots, "slot").sortWithinPartitions("slot", "shard")


def codes(packed: DataFrame, slots: int) -> DataFrame:
    """For the words of every shard and slot their global codes, 64 bits each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(1).compress
        for shard, slot, terms, number in _numbered(batches):
            code = np.fromiter(map(number.__getitem__, terms), np.int64, len(terms)) * slots + slot
            yield _pieces([shard], [slot], [pack(code.tobytes())])

    return _by_slot(packed, slots).mapInArrow(run, PIECES)


def dictionary(packed: DataFrame, slots: int) -> DataFrame:
    """``term, code``: every word of the table once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, slot, terms, number in _numbered(batches):
            known = len(number)
            new = list(dict.fromkeys(t for t in terms if number[t] >= known))
            code = np.array([number[t] for t in new], np.int64) * slots + slot
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()).cast(pa.string()), pa.array(code)], ["term", "code"])

    return _by_slot(packed, slots).mapInArrow(run, "term string, code bigint")


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, pa.Array]]:
    """Shards with global codes as their columns: matrix piece first, then the codes by slot."""
    unpack = zstandard.ZstdDecompressor().decompress

    def made() -> dict[str, pa.Array]:
        with pa.ipc.open_stream(held) as stream:
            batch = stream.read_next_batch()
        one = {name: batch.column(name).values for name in batch.schema.names}
        code = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, np.int64) for c in coded)])
        return one | {"words": pa.array(code[one["words"].to_numpy()])}

    held, coded = None, []
    for batch in batches:
        for slot, data in zip(batch.column("slot").to_pylist(), batch.column("data").to_pylist(), strict=True):
            if slot == MATRIX:
                if held is not None:
                    yield made()
                held, coded = data, []
            else:
                coded.append(unpack(data))
    if held is not None:
        yield made()


def matrix(packed: DataFrame, slots: int) -> DataFrame:
    """The pieces of every shard behind one another, its words as global codes."""
    pieces = packed.where(f"slot = {MATRIX}").unionByName(codes(packed, slots))
    return pieces.repartition(slots, "shard").sortWithinPartitions("shard", "slot")


def rows_of(coded: DataFrame) -> DataFrame:
    """``_id, columns, counts``: the rows of a ``matrix``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _whole(batches):
            lists = [pa.ListArray.from_arrays(one["bounds"], one[c]) for c in ("words", "counts")]
            yield pa.RecordBatch.from_arrays([one["ids"], *lists], ["_id", "columns", "counts"])

    return coded.mapInArrow(run, "_id bigint, columns array<bigint>, counts array<int>")


def _decided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and nonzero counts of the rows, with what the other filters need."""
    for one in _whole(batches):
        bounds = one["bounds"].to_numpy()
        total = np.concatenate([[0], np.cumsum(one["counts"].to_numpy(), dtype=np.int64)])
        sums, filled = np.diff(total[bounds]), np.diff(bounds).astype(np.int64)
        flags = one["flags"].to_numpy() | (sums < LEAST_WORDS) | (100 * filled < DISTINCT_SHARE * sums) * 2
        yield pa.RecordBatch.from_arrays(
            [one["ids"], one["parts"], one["digests"], pa.array(flags, pa.int32()), pa.array(sums), pa.array(filled)],
            ["_id", "_part", "_digest", "_flags", "_words", "_distinct"],
        )


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``_id, _part, _words, _distinct, failed``: a row per input row.

    ``failed`` has a bit for each filter that the row fails, A the lowest. A null
    text counts as empty (it fails A alone, and E if a smaller id has an empty text
    too), a null part as the empty string. E compares ids: rows that repeat id and
    text do not fail it among themselves, and a row without an id never fails it. An
    empty table gives no rows; texts of any length are one row of the matrix.
    """
    coded = matrix(*shards(docs, id_col, text_col, part_col))
    decided = "_id bigint, _part string, _digest binary, _flags int, _words bigint, _distinct bigint"
    rows = checkpointed(coded.mapInArrow(_decided, decided))
    again = rows.groupBy("_digest").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most")).where("_least < _most")
    repeated = F.coalesce(F.col("_id") > F.col("_least"), F.lit(False)).cast("int") * 16
    joined = rows.join(spread(again), "_digest", "left")
    return joined.select("_id", "_part", "_words", "_distinct", F.col("_flags").bitwiseOR(repeated).alias("failed"))


def effects(spark) -> DataFrame:
    """What becomes of a document by the set of filters it fails: 32 sets x 120 orders x 5 steps."""
    bit = {name: 1 << at for at, name in enumerate(FILTERS)}
    orders = ["".join(order) for order in permutations(FILTERS)]
    rows = []
    for failed in range(1 << len(FILTERS)):
        first = {o: next((x for x in o if failed & bit[x]), None) for o in orders}
        hits = Counter(first.values())
        for order in orders:
            gone = False
            for step, name in enumerate(order, 1):
                removed, redundant = first[order] == name, gone and bool(failed & bit[name])
                gone = gone or removed
                rows.append((failed, order, step, not gone, removed, redundant, failed == bit[name], hits[name]))
    flags = "stays boolean, goes boolean, late boolean, only boolean"
    return spark.createDataFrame(rows, f"failed int, filter_order string, step int, {flags}, orders bigint")


def audit(failed: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Counts per part, order of the filters and step.

    ``failed`` comes from ``failures``; ``labels`` holds ``doc_id``, ``quality`` and
    ``toxic``, of repeated ids any positive label counts. Every part gets all 600
    rows; a table without rows has no parts.
    """
    rows = failed.select("_id", "_part", "failed")
    if labels is None:
        rows = rows.withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    else:
        positive = [F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
        known = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").alias("_id")).agg(*positive)
        rows = rows.join(spread(known), "_id", "left").fillna(False, ["good", "toxic"])
    cells = rows.groupBy("_part", "failed").agg(
        F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic")
    )
    # 19,200 rows whatever the input.
    joined = cells.join(F.broadcast(effects(failed.sparkSession)), "failed")
    total = lambda flag, n="n": F.sum(F.when(F.col(flag), F.col(n)).otherwise(0))
    return joined.groupBy(F.col("_part").alias("part"), "filter_order", "step").agg(
        total("stays").alias("kept"),
        total("goes").alias("removed"),
        total("late").alias("redundant"),
        total("only").alias("unique_fails"),
        total("goes", "n_good").alias("good_lost"),
        total("goes", "n_toxic").alias("toxic_lost"),
        F.sum(F.col("n") * F.col("orders")).alias("shapley"),
    )
