"""MinHash near-dedup by an inverted join on signature coordinates (operator 10).

1. A document becomes the set of its distinct five-word shingles (64-bit hashes);
   documents with equal sets form one class, so exact copies cost one row.
2. Classes are posted under the first ``COORDINATES - MATCHES + 1`` coordinates of
   their signature. Two signatures that agree in ``MATCHES`` places or more must
   share one of these (the prefix rule), so the other places need no postings.
3. Each posting list of the prefix first gives one star: its least class against the
   others, one row a posting. Pairs whose signatures agree in ``MATCHES`` places are
   confirmed on the full sets, and classes are joined to components. A second star
   holds what is outside a list's largest component against a row of that one.
4. Then only the lists that still hold several components are merged, for pairs of
   *different* components. A pair belongs to its first common coordinate; a list with
   more than ``LONG_LIST`` rows outside its largest component is posted again under
   the second one, so that rows which share a place by chance part. In what is left, the
   rows outside a list's largest component meet all its rows in blocks; rows of
   pairs that agree in enough places meet once more with their full sets, and a
   block hands on the links that join components. So a group of near copies never
   emits all its pairs, and no link that could join two components is lost.

A pair of similarity 0.75 agrees in 7 of 20 places with probability 0.99997.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import (
    block_numbers,
    checkpointed,
    col,
    constants,
    measured,
    mix,
    packed,
    partitions,
    slices,
    small_batches,
    spread,
    utf8,
    whole_blocks,
)
from rollcall.llm.components import components

WORDS = 5
SIMILARITY = 75  # hundredths
COORDINATES = 20
MATCHES = 7
PREFIX = COORDINATES - MATCHES + 1
BLOCK = 512
#: Lists with more rows outside their largest component are posted again: dealing such a
#: list in blocks would take more rows than that. Near copies share most coordinates, so
#: every further one multiplies their rows; hence one more at most.
LONG_LIST = 4 * BLOCK
DEEPEST = 2

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACE = constants(1, WORDS + 6)
_MULTIPLY, _ADD = constants(2, COORDINATES), constants(3, COORDINATES)
_POWERS = np.ones(1, np.uint64)


def _powers(count: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < count:
        base = np.full(count + 4096, np.uint64(0x9E3779B97F4A7C15))
        base[0] = 1
        _POWERS = np.cumprod(base)
    return _POWERS


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row number of every word (a run of non-space bytes, A-Z in lower case)."""
    solid = ~_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begin[heads] |= solid[heads]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    letters = np.where(solid, _LOWER[data] + np.uint64(1), np.uint64(0))[starts[0] :]
    sums = np.add.reduceat(letters * _powers(int(place.max()) + 1)[place], starts - starts[0])
    return mix(sums), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and where each row's begin."""
    rows = len(offsets) - 1
    words, owner = word_hashes(data, offsets)
    counts = np.bincount(owner, minlength=rows)
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    hashes, owners = [], []
    if len(words) >= WORDS:
        at = np.flatnonzero(owner[WORDS - 1 :] == owner[: len(words) - WORDS + 1])
        hashes.append(sum((words[at + j] * _PLACE[j] for j in range(WORDS)), np.uint64(0)))
        owners.append(owner[at])
    for short in range(1, WORDS):
        which = np.flatnonzero(counts == short)
        at = firsts[which]
        hashes.append(sum((words[at + j] * _PLACE[j] for j in range(short)), _PLACE[WORDS + short - 1]))
        owners.append(which)
    shingles, whose = mix(np.concatenate(hashes)), np.concatenate(owners)
    order = np.lexsort((shingles, whose))
    shingles, whose = shingles[order], whose[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (whose[1:] != whose[:-1])
    shingles, whose = shingles[new], whose[new]
    return shingles, np.searchsorted(whose, np.arange(rows + 1))


def signatures(shingles: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Set keys (two words a row) and signatures of rows; rows without shingles stay zero."""
    rows = len(cuts) - 1
    keys, signs = np.zeros((rows, 2), np.uint64), np.zeros((rows, COORDINATES), np.uint32)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(full):
        at = cuts[:-1][full]
        keys[full, 0] = np.add.reduceat(mix(shingles * _PLACE[-2]), at)
        keys[full, 1] = np.add.reduceat(mix(shingles * _PLACE[-1]), at)
        for c in range(COORDINATES):
            ranks = (shingles * _MULTIPLY[c] + _ADD[c]) >> np.uint64(32)
            signs[full, c] = np.minimum.reduceat(ranks, at)
    return keys, signs


def _binary(values: np.ndarray) -> pa.Array:
    width = values.shape[1] * values.itemsize
    flat = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    cuts = pa.py_buffer(np.arange(0, (len(values) + 1) * width, width, dtype=np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(values), [None, cuts, flat])


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for lo, hi in slices(data, offsets):
            part = data[offsets[lo] : offsets[hi]]
            shingles, cuts = shingle_sets(part, offsets[lo : hi + 1] - offsets[lo])
            keys, signs = signatures(shingles, cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").slice(lo, hi - lo),
                    batch.column("_code").slice(lo, hi - lo),
                    pa.array(np.diff(cuts)),
                    _binary(keys),
                    _binary(signs),
                ],
                ["_id", "_code", "_size", "_set", "_sign"],
            )


def _full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("_text"))
        for lo, hi in slices(data, offsets):
            part = data[offsets[lo] : offsets[hi]]
            shingles, cuts = shingle_sets(part, offsets[lo : hi + 1] - offsets[lo])
            lists = pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_key").slice(lo, hi - lo), lists], ["_key", "_all"])


def _signs(rows: pa.Table) -> np.ndarray:
    column = rows.column("_sign").combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint32).reshape(rows.num_rows, COORDINATES)


def _fits(sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes so unlike that no such pair can be similar enough are skipped."""
    small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
    return 100 * small >= SIMILARITY * large


_BLOCK_KEYS = ("_bucket", "home", "guest")


def _contested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block that may be similar to a row of another component in it."""
    for rows in whole_blocks(batches, _BLOCK_KEYS):
        block = block_numbers(rows, _BLOCK_KEYS)
        signs, sizes = _signs(rows), rows.column("_size").to_numpy()
        place, depth = rows.column("_place").to_numpy(), rows.column("_depth").to_numpy()
        group = rows.column("_component").to_numpy()
        lives, visits = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("lives", "visits"))
        cuts = np.concatenate([np.flatnonzero(np.diff(block, prepend=-1)), [len(block)]])
        marked = np.zeros(len(block), bool)
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            homes = begin + np.flatnonzero(lives[begin:end])
            for one in begin + np.flatnonzero(visits[begin:end]):
                # Two rows that both live and visit here meet once.
                others = homes[~visits[homes] | (homes > one)] if lives[one] else homes
                others = others[(group[others] != group[one]) & _fits(sizes, np.full(len(others), one), others)]
                same = signs[others] == signs[one]
                # A pair belongs to the list of its first common coordinates.
                keep = (same.sum(1) >= MATCHES) & (same[:, : place[one] + 1].sum(1) == depth[one])
                if keep.any():
                    marked[one] = True
                    marked[others[keep]] = True
        if marked.any():
            some = rows.take(pa.array(np.flatnonzero(marked))).combine_chunks()
            yield from some.select([*_BLOCK_KEYS, "_key", "_component"]).to_batches()


def _links(cuts: np.ndarray, shingles: np.ndarray, group: np.ndarray) -> tuple[list[int], list[int]]:
    """Links between rows of different groups, as many as it takes to join what is to be joined."""
    sizes, group = np.diff(cuts), group.copy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(shingles, kind="stable")
    ranked, posted = shingles[order], owner[order]
    low, high = np.searchsorted(ranked, shingles, "left"), np.searchsorted(ranked, shingles, "right")
    found: tuple[list[int], list[int]] = ([], [])
    for row in range(len(sizes)):
        if (group[row + 1 :] == group[row]).all():
            continue
        begin, end = cuts[row], cuts[row + 1]
        lengths = high[begin:end] - low[begin:end]
        at = np.arange(lengths.sum()) + np.repeat(low[begin:end] - np.cumsum(lengths) + lengths, lengths)
        common = np.bincount(posted[at], minlength=len(sizes))
        near = (100 * common >= SIMILARITY * (sizes + sizes[row] - common)) & (group != group[row])
        near[: row + 1] = False
        for other in np.flatnonzero(near):
            if group[other] != group[row]:
                found[0].append(row)
                found[1].append(int(other))
                group[group == group[other]] = group[row]
    return found


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components within a block, found on the full sets."""
    for rows in whole_blocks(batches, _BLOCK_KEYS):
        block = block_numbers(rows, _BLOCK_KEYS)
        group = rows.column("_component").to_numpy()
        keys = rows.column("_key").to_numpy()
        lists = rows.column("_all").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        shingles = lists.flatten().to_numpy()
        found: tuple[list, list] = ([], [])
        cuts = np.concatenate([np.flatnonzero(np.diff(block, prepend=-1)), [len(block)]])
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            inside = ends[begin : end + 1]
            a, b = _links(inside - inside[0], shingles[inside[0] : inside[-1]], group[begin:end])
            found[0].append(keys[begin + np.array(a, np.int64)])
            found[1].append(keys[begin + np.array(b, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], ["_a", "_b"])


def _value(place: Column) -> Column:
    return F.substring(F.col("_sign"), place * 4 + 1, F.lit(4))


def _posted(classes: DataFrame) -> DataFrame:
    """One posting per class and prefix coordinate, under the coordinate and its value."""
    place = F.col("_place")
    several = classes.withColumn("_place", F.explode(F.sequence(F.lit(0), F.lit(PREFIX - 1))))
    return several.withColumn("_bucket", F.xxhash64(place, _value(place)))


def _stars(classes: DataFrame) -> DataFrame:
    """The pairs of each list's least class and another whose signatures agree in enough places."""
    postings = _posted(classes).select("_bucket", "_key")
    centres = postings.groupBy("_bucket").agg(F.min("_key").alias("_a"), F.max("_key").alias("_most")).where("_a < _most")
    pairs = postings.withColumnRenamed("_key", "_b").join(spread(centres), "_bucket").where("_a < _b").select("_a", "_b")
    return _agreeing(pairs, classes)


def _stars_again(labelled: DataFrame) -> DataFrame:
    """The same for rows outside a list's largest component and the greatest class in it."""
    lists = _disputed(_posted(labelled).select("_bucket", "_key", "_component"))
    outside = lists.where(F.col("_component") != F.col("_main"))
    return _agreeing(outside.select(F.least("_key", "_far").alias("_a"), F.greatest("_key", "_far").alias("_b")), labelled)


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = lambda n: spread(classes.select(F.col("_key").alias(f"_{n}"), F.col("_sign").alias(f"_s{n}"), F.col("_size").alias(f"_n{n}")))
    both = pairs.distinct().join(side("a"), "_a").join(side("b"), "_b")
    places = [F.substring("_sa", 4 * c + 1, 4) == F.substring("_sb", 4 * c + 1, 4) for c in range(COORDINATES)]
    agreeing = sum((place.cast("int") for place in places), F.lit(0))
    alike = 100 * F.least("_na", "_nb") >= SIMILARITY * F.greatest("_na", "_nb")
    return both.where(alike & (agreeing >= MATCHES)).select("_a", "_b")


def _sets(ends: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``_key, _all``: the full sets of some classes."""
    wanted = classes.join(ends.distinct(), "_key", "left_semi").select("_key", "_id", "_code")
    same = F.col("d._id").eqNullSafe(F.col("w._id")) & (F.col("d._code") == F.col("w._code"))
    texts = docs.alias("d").join(measured(wanted).alias("w"), same).select("_key", "_text")
    sets = texts.mapInArrow(_full_sets, "_key bigint, _all array<bigint>")
    # One text of each class is enough; texts that share id and hash are the same text.
    return sets.groupBy("_key").agg(F.first("_all").alias("_all"))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    pairs = checkpointed(pairs)
    ends = pairs.select(F.col("_a").alias("_key")).union(pairs.select("_b"))
    sets = _sets(ends, classes, docs)
    # ``_a`` is the middle of a star and may be hot; ``_b`` stands in as many pairs as it has postings.
    left = spread(sets.select(F.col("_key").alias("_a"), F.col("_all").alias("_x")))
    right = sets.select(F.col("_key").alias("_b"), F.col("_all").alias("_y"))
    common = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - F.col("_common")
    return checkpointed(
        pairs.join(left, "_a")
        .join(right, "_b")
        .withColumn("_common", common)
        .where(F.col("_common") * 100 >= union * SIMILARITY)
        .select("_a", "_b")
    )


def _disputed(postings: DataFrame) -> DataFrame:
    """The postings of lists that hold several components, with the list's size and its largest component."""
    parts = postings.groupBy("_bucket", "_component").agg(F.count("*").alias("n"), F.max("_key").alias("_far"))
    lists = parts.groupBy("_bucket").agg(
        F.sum("n").alias("_n"), F.max(F.struct("n", "_component", "_far")).alias("_top"), F.count("*").alias("_parts")
    )
    top = [F.col("_top._component").alias("_main"), F.col("_top.n").alias("_inside"), F.col("_top._far").alias("_far")]
    lists = lists.where("_parts > 1").select("_bucket", "_n", *top)
    return postings.join(spread(lists), "_bucket")


def _parted(labelled: DataFrame) -> DataFrame:
    """Postings of disputed lists; long ones parted by further common coordinates."""
    shown = ["_bucket", "_place", "_key", "_component", "_sign", "_n", "_main", "_inside"]
    now = checkpointed(_disputed(_posted(labelled).drop("_size")).select(*shown))
    done, long = [], F.col("_n") - F.col("_inside") > LONG_LIST
    for depth in range(1, DEEPEST + 1):
        if depth == DEEPEST or now.where(long).isEmpty():
            done.append(now.withColumn("_depth", F.lit(depth)))
            break
        done.append(now.where(~long).withColumn("_depth", F.lit(depth)))
        # The next common coordinate stands behind the last one and leaves room for those that must follow.
        last = COORDINATES - MATCHES + depth
        further = now.where(long & (F.col("_place") < last)).drop("_n", "_main", "_inside")
        further = further.withColumn("_place", F.explode(F.sequence(F.col("_place") + 1, F.lit(last))))
        again = F.xxhash64("_bucket", "_place", _value(F.col("_place")))
        now = checkpointed(_disputed(further.withColumn("_bucket", again)).select(*shown))
    found = done[0]
    for one in done[1:]:
        found = found.unionByName(one)
    return found.drop("_sign")


def _blocks(disputed: DataFrame, classes: DataFrame) -> DataFrame:
    """Blocks of at most about ``2 * BLOCK`` rows in which all pairs meet once that a list is read for.

    A list of up to ``BLOCK`` rows is one block. Of a longer one, the rows outside the
    largest component are dealt into parts that meet each other and themselves, and that
    meet the parts of the component; its rows do not meet each other.
    """
    parts = lambda rows: F.ceil(rows / F.lit(BLOCK)).cast("int")
    outside, small = F.col("_component") != F.col("_main"), F.col("_n") <= BLOCK
    part = F.pmod(F.xxhash64(F.lit(17), "_key"), F.when(F.col("_outside"), F.col("_outer")).otherwise(F.col("_inner")))
    at = """explode(CASE
      WHEN _small THEN array(named_struct('home', 0, 'guest', 0))
      WHEN _outside THEN concat(
        transform(sequence(0, _outer - 1), k -> named_struct('home', greatest(_part, k), 'guest', least(_part, k))),
        transform(sequence(0, _inner - 1), k -> named_struct('home', _outer + k, 'guest', _part)))
      ELSE transform(sequence(0, _outer - 1), k -> named_struct('home', _outer + _part, 'guest', k)) END)"""
    own = F.when(F.col("_small") | F.col("_outside"), F.col("_part")).otherwise(F.col("_outer") + F.col("_part"))
    placed = (
        disputed.withColumns({"_outer": parts(F.col("_n") - F.col("_inside")), "_inner": parts(F.col("_inside"))})
        .withColumns({"_outside": outside, "_small": small})
        .withColumn("_part", F.when(F.col("_small"), 0).otherwise(part.cast("int")))
        .withColumn("_at", F.expr(at))
        .select(
            "_bucket",
            F.col("_at.home").alias("home"),
            F.col("_at.guest").alias("guest"),
            (F.col("_at.home") == own).alias("lives"),
            (F.col("_outside") & (F.col("_at.guest") == F.col("_part"))).alias("visits"),
            "_place",
            "_depth",
            "_key",
            "_component",
        )
    )
    signed = placed.join(spread(classes.select("_key", "_size", "_sign")), "_key")
    return signed.repartition(partitions(classes.sparkSession), *_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "_key")


def _between(labelled: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between the components of ``labelled``, enough of them to join what is similar."""
    blocks = _blocks(_parted(labelled), labelled)
    contested = checkpointed(blocks.mapInArrow(_contested, "_bucket bigint, home int, guest int, _key bigint, _component bigint"))
    whole = contested.join(_sets(contested.select("_key"), classes, docs), "_key")
    dealt = whole.repartition(partitions(docs.sparkSession), *_BLOCK_KEYS).sortWithinPartitions(*_BLOCK_KEYS, "_key")
    return checkpointed(dealt.mapInArrow(_verified, "_a bigint, _b bigint"))


def _labelled(classes: DataFrame, links: DataFrame) -> DataFrame:
    joined = measured(components(links, "_a", "_b").withColumnRenamed("node", "_key"))
    component = F.coalesce("component", "_key").alias("_component")
    return checkpointed(classes.join(joined, "_key", "left").select("_key", "_size", "_sign", component))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col)
    return small_batches(docs).select(
        col(id_col).cast("long").alias("_id"), F.xxhash64(text).alias("_code"), text.cast("string").alias("_text")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id, _code, n_shingles, component_id, kept``, one row per input row.

    ``_code`` is a hash of the text: with ``_id`` it tells rows apart that repeat an
    id. Null, empty and blank texts have no shingles, a component of their own and
    are kept. A null id never is the least of a component unless all its ids are
    null; then the text with the least hash is kept. Rows that repeat id and text both carry the same result. An empty table
    gives no rows.
    """
    texts = keyed(docs, id_col, text_col)
    described = checkpointed(
        texts.mapInArrow(_described, "_id bigint, _code bigint, _size bigint, _set binary, _sign binary")
    )
    worded = described.where("_size > 0")
    least = F.min(F.struct(F.col("_id").isNull(), "_id", "_code", "_size", "_sign")).alias("_least")
    found = worded.groupBy("_set").agg(least).select("_set", "_least.*")
    classes = checkpointed(found.withColumn("_key", F.monotonically_increasing_id()))
    stars = _confirmed(_stars(classes), classes, texts)
    stars = stars.unionByName(_confirmed(_stars_again(_labelled(classes, stars)), classes, texts))
    links = _between(_labelled(classes, stars), classes, texts)
    final = measured(components(stars.unionByName(links), "_a", "_b").withColumnRenamed("node", "_key"))
    first = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_code")
    heads = classes.join(final, "_key").groupBy("component").agg(F.min(first).alias("_head"))
    by_set = (
        classes.join(final, "_key", "left")
        .join(measured(heads), "component", "left")
        .select("_set", F.coalesce("_head", first).alias("_head"))
        .select("_set", F.col("_head._id").alias("component_id"), F.col("_head._code").alias("_least"))
    )
    by_set = spread(by_set)
    kept = F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_id").isNotNull() | (F.col("_code") == F.col("_least")))
    shingles = F.col("_size").alias("n_shingles")
    with_words = worded.join(by_set, "_set").select("_id", "_code", shingles, "component_id", kept.alias("kept"))
    without = described.where("_size = 0").select("_id", "_code", shingles, F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    return with_words.unionByName(without)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of rows that repeat id and text, one.

    Which one does not depend on their order: the one whose other columns, as JSON
    text, come first.
    """
    kept = near_duplicates(docs, id_col, text_col).where("kept").select("_id", "_code").distinct()
    keys = packed(docs).select(
        "_row",
        col(f"_row").getField(id_col).cast("long").alias("_id"),
        F.xxhash64(F.col("_row").getField(text_col)).alias("_code"),
    )
    same = F.col("k._id").eqNullSafe(F.col("d._id")) & (F.col("k._code") == F.col("d._code"))
    found = keys.alias("d").join(spread(kept).alias("k"), same).select("d._id", "d._code", "d._row")
    others = F.to_json(F.struct(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c != text_col]))
    once = found.groupBy("_id", "_code").agg(F.min_by("_row", others).alias("_row"))
    return once.select("_row.*")
