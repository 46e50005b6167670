"""Phrase collocation mining by Toivonen's method (operator 11).

1. A share of the documents (by a hash of id and text) is counted whole: a phrase of
   up to ``LONGEST`` words that reaches ``PROPOSE`` occurrences there is *proposed*.
2. A full pass counts all words, the proposed phrases and their negative border:
   phrases that are not proposed although both their parts (all words but the last,
   all but the first) are.
3. Border phrases and words that reach ``LEAST`` in a pass are failures of the
   border. They join the proposals, and an expansion pass counts the phrases that
   this opens, and only those. When a pass finds no failure the counts are closed:
   by induction over the length every frequent phrase has been counted.

Proposals are handed to the tasks as a bit field of fixed size (``FIELD_BITS``) over
hashes of phrases. Phrases that share a bit only make a pass count more phrases than
it has to; a count is exact, its key being language and phrase. So what is sent
around does not grow with the table, while the sample, the counts and the passes do.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import checkpointed, col, constants, mix, small_batches, spread, utf8

LEAST = 30  # occurrences of a candidate
LONGEST = 4
SCALE = 2_000_000
COVERED = 80  # hundredths of a phrase's occurrences
TOP = 2000
UNKNOWN = "und"

#: One in so many documents proposes; occurrences that a phrase has to reach among them.
ONE_IN = 16
PROPOSE = 2
#: Bits of the field of proposals: 16 MB as bytes, 2,097,152 words of 64 bits.
FIELD_BITS = 1 << 27
#: Bytes of text counted at once in a task.
SLICE = 4_000_000

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_END = 0xFF  # ends a piece; no byte of UTF-8
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[list(_BREAKS)] = _END
_FOLD[9] = 32
_FOLD = _FOLD.tobytes()
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAKS)] = True
_SOLID = np.ones(256, bool)
_SOLID[[32, _END]] = False
_PLACE = constants(11, LONGEST + 1)
_CHUNK, _LENGTH = constants(12, 2)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

#: What a pass counts by: language, line feed, phrase. No phrase holds a line feed, so the last one parts them.
COUNTS = "key string, n bigint"


def _span_hashes(text: np.ndarray, begin: np.ndarray, length: np.ndarray, lang: str) -> np.ndarray:
    """A hash of every span of bytes within its language, eight bytes at a time."""
    eight = np.ndarray(max(len(text) - 7, 0), "<u8", text, strides=(1,))
    salt = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)
    out = mix((eight[begin] & _MASK[np.minimum(length, 8)]) * _CHUNK + length.astype(np.uint64) * _LENGTH + salt)
    more, at = np.flatnonzero(length > 8), 8
    while len(more):
        chunk = eight[begin[more] + at] & _MASK[np.minimum(length[more] - at, 8)]
        out[more] = mix(out[more] * _LENGTH + chunk * _CHUNK)
        at += 8
        more = more[length[more] > at]
    return out


class Words:
    """The words of a slice of one language in the order of the text."""

    def __init__(self, lang: str, raw: bytes):
        self.lang = lang
        self.text = raw.translate(_FOLD)
        text = np.frombuffer(self.text + b" " * 8, np.uint8)
        solid = np.zeros(len(text) + 1, bool)
        solid[1:] = _SOLID[text]
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.begin, self.end = edges[::2], edges[1::2]
        self.piece = np.cumsum(text == _END, dtype=np.int32)[self.begin]
        self.hashes = _span_hashes(text, self.begin, self.end - self.begin, lang)

    def __len__(self) -> int:
        return len(self.begin)

    def phrases(self, size: int) -> np.ndarray:
        """A hash for every place at which ``size`` words could begin."""
        ends = max(len(self) - size + 1, 0)
        return mix(sum((self.hashes[k : k + ends] * _PLACE[k] for k in range(size)), _PLACE[size]))

    def whole(self, size: int) -> np.ndarray:
        """Whether ``size`` words of one piece begin at a place."""
        ends = max(len(self) - size + 1, 0)
        return self.piece[:ends] == self.piece[size - 1 :][:ends]

    @cached_property
    def coded(self) -> tuple[np.ndarray, list[bytes]]:
        """A code for every word, and what the codes stand for."""
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        # No white space but spaces is left, so this gives the same words.
        tokens = self.text.replace(b"\xff", b" ").split()
        return np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens)), list(number)

    def _some(self, at: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The same for a few words only; the other codes mean nothing."""
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        spans = zip(self.begin[at].tolist(), self.end[at].tolist(), strict=True)
        codes = np.zeros(len(self), np.int32)
        codes[at] = [number[self.text[a:b]] for a, b in spans]
        return codes, list(number)

    def counted(self, begin: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """The phrases that begin at some places, and how often each."""
        used = np.zeros(len(self), bool)
        for k in range(size):
            used[begin + k] = True
        at = np.flatnonzero(used)
        codes, names = self.coded if 4 * len(at) > len(self) else self._some(at)
        yield from self._keyed(begin, size, codes, pa.array(names, pa.binary()))

    def _keyed(self, begin: np.ndarray, size: int, codes: np.ndarray, terms: pa.Array) -> Iterator[pa.RecordBatch]:
        used = np.zeros(len(terms), bool)
        for k in range(size):
            used[codes[begin + k]] = True
        words = np.flatnonzero(used)
        if len(words) > 1 << 16:
            # Words in use get 16 bits each, so that four make an exact key; halves use fewer of them.
            half = len(begin) // 2
            yield from self._keyed(begin[:half], size, codes, terms)
            yield from self._keyed(begin[half:], size, codes, terms)
            return
        small = np.zeros(len(terms), np.uint64)
        small[words] = np.arange(len(words), dtype=np.uint64)
        key = np.zeros(len(begin), np.uint64)
        for k in range(size):
            key = (key << np.uint64(16)) | small[codes[begin + k]]
        keys, counts = np.unique(key, return_counts=True)
        names = terms.take(pa.array(words)).cast(pa.string())
        shifts = [np.uint64(16 * (size - 1 - k)) for k in range(size)]
        parts = [names.take(pa.array(((keys >> shift) & np.uint64(0xFFFF)).astype(np.int32))) for shift in shifts]
        yield _keys(self.lang, pc.binary_join_element_wise(*parts, " "), counts)


def _keys(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    keys = pc.binary_join_element_wise(pa.scalar(f"{lang}\n"), phrases, "")
    return pa.RecordBatch.from_arrays([keys, pa.array(counts)], ["key", "n"])


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word of the field and bit in it."""
    at = hashes & np.uint64(FIELD_BITS - 1)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _has(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word, bit = _bits(hashes)
    return (field[word] & bit) != 0


def _cut(raw: bytes) -> Iterator[bytes]:
    """Slices of a long text. No phrase reaches over the end of a piece, so it may be cut there."""
    begin = 0
    if len(raw) >= 2 * SLICE:
        ends = np.flatnonzero(_IS_BREAK[np.frombuffer(raw, np.uint8)])
        while len(raw) - begin >= 2 * SLICE:
            at = int(np.searchsorted(ends, begin + SLICE))
            if at == len(ends):
                break
            yield raw[begin : ends[at]]
            begin = int(ends[at]) + 1
    yield raw[begin:]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[Words]:
    """The texts in slices of one language."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)

    def emptied(names: list[str]) -> Iterator[Words]:
        for name in names:
            size.pop(name)
            for raw in _cut(b"\n".join(held.pop(name))):
                yield Words(name, raw)

    for batch in batches:
        data, cuts = utf8(batch.column("_text"))
        langs = batch.column("_lang").dictionary_encode()
        names, index = langs.dictionary.to_pylist(), langs.indices.to_pylist()
        for at, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a < b:
                name = names[index[at]]
                held[name].append(data[a:b].tobytes())
                size[name] += b - a
                if size[name] >= SLICE:
                    yield from emptied([name])
                elif sum(size.values()) >= 4 * SLICE:
                    yield from emptied(list(held))
    yield from emptied(list(held))


def _sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all phrases of the sample, with their counts in a slice."""
    for words in _slices(batches):
        found = [words.phrases(size)[words.whole(size)] for size in range(1, LONGEST + 1)]
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _field_rows(batch.column("key").to_numpy().view(np.uint64), 0)


FIELD_ROWS = "word bigint, bits bigint, sizes int"


def _field_rows(hashes: np.ndarray, size: int) -> pa.RecordBatch:
    word, bit = _bits(hashes)
    sizes = pa.array(np.full(len(word), 1 << size, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64)), sizes], ["word", "bits", "sizes"])


def _field(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The field with the bits of some rows set, and the sizes of their phrases as bits."""
    # At most FIELD_BITS / 64 rows of three numbers, whatever the table.
    found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits"), F.bit_or("sizes").alias("sizes")).toArrow()
    field = np.zeros(FIELD_BITS // 64, np.uint64)
    field[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return field, int(np.bitwise_or.reduce(found.column("sizes").to_numpy(), initial=0))


def _counter(now, before, sizes: list[int]):
    """A pass: counts of the phrases of some sizes that the proposals ``now`` open and ``before`` did not."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.frombuffer(now.value, np.uint64)
        old = None if before is None else np.frombuffer(before.value, np.uint64)
        for words in _slices(batches):
            if old is None and len(words):
                codes, names = words.coded
                yield _keys(words.lang, pa.array(names, pa.binary()).cast(pa.string()), np.bincount(codes))
                yield _keys(words.lang, pa.array([""]), np.array([len(codes)]))
            for size in sizes:
                parts = words.phrases(size - 1)
                has = _has(field, parts)
                begin = np.flatnonzero(has[:-1] & has[1:] & words.whole(size))
                if old is not None:
                    begin = begin[~(_has(old, parts[begin]) & _has(old, parts[begin + 1]))]
                if len(begin):
                    yield from words.counted(begin, size)

    return run


def _failures(now):
    """Field rows of the frequent phrases that are not among the proposals."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = np.frombuffer(now.value, np.uint64)
        # A phrase is a piece of its own here: split again, it gives the same words.
        for words in _slices(batches):
            begin = np.flatnonzero(np.diff(words.piece, prepend=-1))
            length = np.diff(begin, append=len(words))
            for size in range(1, LONGEST):
                hashes = words.phrases(size)[begin[length == size]]
                yield _field_rows(hashes[~_has(field, hashes)], size)

    return run


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, size, phrase, n``: all phrases of up to ``LONGEST`` words with ``LEAST`` occurrences or more.

    Size 0 (the empty phrase) has the number of words of a language, whatever it is.
    A null language counts as ``und``, a null or empty text has no words, repeated
    rows count again, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = small_batches(docs).select(
        F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("_lang"),
        col(text_col).cast("string").alias("_text"),
        F.xxhash64(F.lit(11), col(id_col), col(text_col)).alias("_code"),
    )
    sample = texts.where(F.pmod("_code", F.lit(ONE_IN)) == 0).select("_lang", "_text")
    texts = texts.select("_lang", "_text")
    proposed = sample.mapInArrow(_sampled, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    field, _ = _field(proposed.where(F.col("n") >= PROPOSE).select("key").mapInArrow(_placed, FIELD_ROWS))
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("left(key, length(key) - length(phrase) - 1)").alias("lang")
    size = F.expr("if(phrase = '', 0, size(split(phrase, ' ')))").alias("size")
    before, passes, sizes = None, [], list(range(2, LONGEST + 1))
    while True:
        now = spark.sparkContext.broadcast(field.tobytes())
        counts = texts.mapInArrow(_counter(now, before, sizes), COUNTS).groupBy("key").agg(F.sum("n").alias("n"))
        frequent = counts.withColumn("phrase", phrase).where(f"n >= {LEAST} OR phrase = ''")
        passes.append(checkpointed(frequent.select(lang, size, "phrase", "n")))
        short = passes[-1].where(f"size BETWEEN 1 AND {LONGEST - 1}")
        failed = short.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_text"))
        more, open_ = _field(failed.mapInArrow(_failures(now), FIELD_ROWS))
        if not open_:
            break
        # A phrase that is new now has a new part, one word shorter.
        sizes = [k for k in range(2, LONGEST + 1) if open_ >> (k - 1) & 1]
        field, before = field | more, now
    found = passes[0]
    for one in passes[1:]:
        found = found.unionByName(one)
    return found


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(found: DataFrame) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language.

    ``found`` comes from ``frequent_phrases``. A phrase is cut where its score is
    least, at the smallest place among equals; one that a longer phrase covers is
    dropped; phrases of equal score go by count, then by their bytes.
    """
    several = found.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))
    words = several.withColumn("words", F.split("phrase", " "))
    inner = F.expr(
        "explode(flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
        "i -> array_join(slice(words, i, s), ' ')))))"
    )
    covers = words.where("size >= 3").select("lang", "a", inner.alias("phrase"))
    cover = covers.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    covered = 100 * _exact("cover") >= COVERED * _exact("a")
    left = words.join(spread(cover), ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    cuts = left.select("lang", "phrase", "a", "size", "words", F.expr("explode(sequence(1, size - 1))").alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(words, k + 1, size - k), ' ')").alias("rest"),
    )
    # Every part of a frequent phrase is frequent, so these joins lose nothing.
    part = found.where(f"size BETWEEN 1 AND {LONGEST - 1}")
    firsts = spread(part.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")))
    rests = spread(part.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")))
    joined = spread(cuts).join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCALE} div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    worst = joined.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= TOP)
    total = found.where("size = 0").select("lang", "n")
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
