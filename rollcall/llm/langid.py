"""Language ID by Bayesian evidence fusion (operator 5).

Four kinds of evidence meet in one posterior per document:

* text: letter-trigram likelihoods, trained on a bounded sample of labelled rows
  (``TRAINING_ROWS`` per language), and a background model that explains text
  which belongs to none of the languages;
* the language the markup declares, right with probability ``DECLARED``;
* the address suffix (country code), right with probability ``SUFFIX``;
* the host's prior: what the texts of the host's other documents say, smoothed
  towards its domain and that towards all documents. The counts are grouped
  sums over every document.

Neighbouring trigrams are far from independent, so a text counts as
``EFFECTIVE`` independent ones at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, measured, packed, slices, utf8

LANGUAGES = ("en", "de", "fr", "es")
UNKNOWN = "und"
TRAINING_ROWS = 300
GRAMS = 1 << 14
EFFECTIVE = 60.0
DECLARED = 0.9
SUFFIX = 0.7
UNKNOWN_PRIOR = 0.001
STRENGTH = 20.0  # documents a parent's prior counts for

# Country code in an address -> language.
SUFFIXES = {
    "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en",
    "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "cl": "es", "pe": "es",
}

_LETTER = np.full(256, 32, np.uint64)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every trigram of lower-case bytes whose middle is a letter."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = _LETTER[data]
    code = letters[:-2] * np.uint64(65_599**2) + letters[1:-1] * np.uint64(65_599) + letters[2:]
    code = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)
    at = np.flatnonzero(letters[1:-1] != 32)
    owner = np.searchsorted(offsets, at, "right") - 1
    inside = at + 3 <= offsets[owner + 1]
    return code[at[inside]].astype(np.int64), owner[inside]


def _lowered(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(text))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels = np.array(batch.column("_label").to_pylist(), object)
        for label in set(labels):
            rows = batch.column("_text").take(pa.array(np.flatnonzero(labels == label)))
            data, offsets = _lowered(rows)
            for lo, hi in slices(data, offsets):
                found, _ = grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                totals[label] = totals.get(label, 0) + np.bincount(found, minlength=GRAMS)
    for label, counts in totals.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(some), pa.string()), pa.array(some), pa.array(counts[some])],
            ["_label", "_gram", "_count"],
        )


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    languages: tuple[str, ...] = LANGUAGES,
    rows: int = TRAINING_ROWS,
) -> np.ndarray:
    """Log probability of a trigram by language, and of the background in the last column.

    About ``rows`` labelled rows of each language are used, those whose id has the
    least hash. A language without rows gets the background's figures.
    """
    labelled = docs.select(
        F.xxhash64(col(id_col)).alias("_hash"), F.lower(col(label_col)).alias("_label"), col(text_col).alias("_text")
    ).where(F.col("_label").isin(*languages) & F.col("_text").isNotNull())
    bounds = {}
    for language in languages:
        taken = labelled.where(F.col("_label") == language).select("_hash").orderBy("_hash").limit(rows).agg(F.max("_hash"))
        bounds[language] = taken.first()[0]
    chosen = F.lit(False)
    for language, bound in bounds.items():
        if bound is not None:
            chosen = chosen | ((F.col("_label") == language) & (F.col("_hash") <= bound))
    counted = labelled.where(chosen).select("_label", "_text").mapInArrow(
        _counted, "_label string, _gram bigint, _count bigint"
    )
    # At most languages x GRAMS rows, whatever the input.
    table = counted.groupBy("_label", "_gram").agg(F.sum("_count").alias("_count")).collect()
    counts = np.zeros((GRAMS, len(languages)))
    for label, gram, count in table:
        counts[gram, languages.index(label)] = count
    smooth = 0.1
    share = (counts + smooth) / (counts.sum(0) + smooth * GRAMS)
    return np.log(np.column_stack([share, np.full(GRAMS, 1 / GRAMS)])).astype(np.float32)


def likelihoods(text: pa.Array, model: np.ndarray) -> np.ndarray:
    """Tempered log likelihood per row and class; zeros for a text without letters."""
    data, offsets = _lowered(text)
    out = np.zeros((len(offsets) - 1, model.shape[1]))
    for lo, hi in slices(data, offsets):
        found, owner = grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        if len(found):
            begin = np.flatnonzero(np.diff(owner, prepend=-1))
            rows, sizes = owner[begin], np.diff(begin, append=len(owner))
            sums = np.add.reduceat(model[found], begin, axis=0, dtype=np.float64)
            out[lo + rows] = sums * np.minimum(1.0, EFFECTIVE / sizes)[:, None]
    return out


def scorer(model: np.ndarray):
    @F.arrow_udf("array<double>")
    def score(text: pa.Array) -> pa.Array:
        scores = likelihoods(text, model)
        cuts = np.arange(len(scores) + 1, dtype=np.int32) * model.shape[1]
        return pa.ListArray.from_arrays(cuts, pa.array(scores.ravel()))

    return score


def _softmax(logs: Column) -> Column:
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def _known(value: Column, languages: tuple[str, ...], trust: float) -> Column:
    """Log evidence per class of a named language; none if it names no language we know."""
    count = len(languages)
    values = [F.when(value == one, F.lit(trust)).otherwise(F.lit((1 - trust) / max(count - 1, 1))) for one in languages]
    logs = F.array(*[F.log(v) for v in values], F.lit(float(np.log(1 / count))))
    return F.when(value.isin(*languages), logs).otherwise(F.array(*[F.lit(0.0)] * (count + 1)))


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_language(host: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair])
    return F.try_element_at(codes, F.lower(F.substring_index(host, ".", -1)))


def identify(
    docs: DataFrame,
    model: np.ndarray,
    text_col: str = "text",
    declared_col: str | None = "lang",
    host_col: str | None = "source",
    languages: tuple[str, ...] = LANGUAGES,
) -> DataFrame:
    """``_row, language, confidence, accepted`` for every row, ``_row`` holding the input columns.

    ``language`` is ``und`` for rejected rows: texts without a letter (null, empty,
    digits only) and texts the background explains best. A null host shares the
    prior of all null hosts; a null or unknown declared language is no evidence.
    Repeated rows get equal results; an empty table gives no rows.
    """
    classes = len(languages) + 1
    rows = packed(docs)
    field = F.col("_row").getField
    rows = rows.select(
        "_row",
        (F.lower(field(declared_col)) if declared_col else F.lit(None).cast("string")).alias("_declared"),
        (F.lower(field(host_col)) if host_col else F.lit(None).cast("string")).alias("_host"),
        scorer(model)(field(text_col).cast("string")).alias("_text"),
    )
    lettered = F.array_min("_text") < 0
    start = F.array(*[F.lit(float(np.log((1 - UNKNOWN_PRIOR) / (classes - 1))))] * (classes - 1), F.lit(float(np.log(UNKNOWN_PRIOR))))
    own = F.when(lettered, _softmax(F.zip_with(F.col("_text"), start, lambda a, b: a + b))).otherwise(
        F.array(*[F.lit(0.0)] * classes)
    )
    rows = rows.withColumn("_own", own)

    # Grouped sums over all documents: hosts, their domains, everything.
    def sums(prefix: str) -> list[Column]:
        return [F.sum(F.element_at("_own", k + 1)).alias(f"{prefix}{k}") for k in range(classes)]

    hosts = rows.groupBy("_host").agg(*sums("h"))
    domains = hosts.groupBy(domain(F.col("_host")).alias("_domain")).agg(*[F.sum(f"h{k}").alias(f"d{k}") for k in range(classes)])
    world = hosts.agg(*[F.sum(f"h{k}").alias(f"w{k}") for k in range(classes)])

    def counts(prefix: str) -> Column:
        return F.array(*[F.coalesce(F.col(f"{prefix}{k}"), F.lit(0.0)) for k in range(classes)])

    def smoothed(own_counts: Column, parent: Column) -> Column:
        total = F.aggregate(own_counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(own_counts, parent, lambda c, p: (c + STRENGTH * p) / (total + STRENGTH))

    uniform = F.array(*[F.lit(1.0 / classes)] * classes)
    everywhere = world.select(smoothed(counts("w"), uniform).alias("_world"))
    priors = (
        hosts.join(domains, domain(F.col("_host")).eqNullSafe(F.col("_domain")))
        .withColumn("_world", everywhere.scalar())
        .select(F.col("_host").alias("_of"), counts("h").alias("_counts"), smoothed(counts("d"), F.col("_world")).alias("_parent"))
    )
    # One short row a host: broadcast when counted few, so that the texts stay where they are.
    joined = rows.join(measured(priors), F.col("_host").eqNullSafe(F.col("_of")))
    # The document's own text is taken out of its host's counts.
    others = F.transform(F.zip_with("_counts", "_own", lambda a, b: a - b), lambda x: F.greatest(x, F.lit(0.0)))
    prior = F.transform(smoothed(others, F.col("_parent")), lambda p: F.log(p + 1e-9))
    logs = F.col("_text")
    for evidence in (
        prior,
        _known(F.col("_declared"), languages, DECLARED),
        _known(suffix_language(F.col("_host")), languages, SUFFIX),
    ):
        logs = F.zip_with(logs, evidence, lambda a, b: a + b)
    joined = joined.withColumn("_posterior", _softmax(logs))
    best = F.array_max("_posterior")
    names = F.array(*[F.lit(x) for x in (*languages, UNKNOWN)])
    language = F.when(lettered, F.element_at(names, F.array_position("_posterior", best).cast("int"))).otherwise(UNKNOWN)
    return joined.select(
        "_row", language.alias("language"), F.when(lettered, best).otherwise(F.lit(0.0)).alias("confidence")
    ).withColumn("accepted", F.col("language") != UNKNOWN)
