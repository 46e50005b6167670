"""Mixing sources to target weights by iterative proportional fitting (operator 2).

Documents fall into cells of source, language and topic. The cells' token weights
are raked in turn to the target shares of each margin, ``ROUNDS`` times; a cell's
weight over its tokens, scaled to at most one, is the probability with which its
documents are sampled. Sampling goes by a hash of the document id, so it can be
repeated. All of it is DataFrame operations: grouped sums over all documents, and
joins of sums with the much smaller table of cells, dealt anew so that Spark may
split a hot source. The probabilities of the cells are counted before they meet the
texts: few of them are broadcast, so no text moves; more are dealt by key.

Scaling to at most one lets the rarest category set the rate of all. With a token
budget (``sample(budget=...)``, as the pipeline does) the rates are calibrated instead:
categories too small for their target are kept whole, the others share what is left
of the budget, and the cells' rates, none above one, are raked until the largest gap
of a margin is under ``GAP`` of the budget (see ``calibrate``).
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import checkpointed, col, measured, packed, spread

ROUNDS = 6
SEED = 11
MARGINS = ("source", "lang", "topic")
#: Calibration ends when no margin is off by more than this share of the budget, or the gap stalls.
GAP = 1e-3
STALL = 0.98  # a round that leaves more than this of the gap, twice in a row, gains nothing any more

#: Target shares where none are given: a margin's token shares to this power, normalised.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 1.0}

# A document has the topic with the most of these terms in it, the first one among equals.
TOPICS = {
    "legal": ("license", "licence", "copyright", "warranty"),
    "technical": ("token", "password", "http", "key"),
    "tabular": ("| ",),
}
GENERAL = "general"


def topic_of(text: Column) -> Column:
    lower = F.lower(text)

    def hits(terms: tuple[str, ...]) -> Column:
        return sum((F.coalesce(lower.contains(t), F.lit(False)).cast("int") for t in terms), F.lit(0))

    counts = {name: hits(terms) for name, terms in TOPICS.items()}
    most = F.greatest(*counts.values(), F.lit(1))
    choice = F.lit(GENERAL)
    for name in reversed(counts):
        choice = F.when(counts[name] == most, F.lit(name)).otherwise(choice)
    return choice


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def uniform(ident: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from a hash of the id; 52 bits of it."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), ident.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    shares = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("_p"))
    total = shares.agg(F.sum("_p").alias("_t")).select("_t").scalar()
    return shares.select(margin, (F.col("_p") / total).alias("_share"))


def _given(cells: DataFrame, margin: str, targets: dict[str, float]) -> DataFrame:
    """Given shares over the categories that occur; categories without a target get none."""
    if any(v < 0 for v in targets.values()):
        raise ValueError("a target share is negative")
    rows = [(k, float(v)) for k, v in targets.items()]
    wanted = cells.sparkSession.createDataFrame(rows, f"`{margin}` string, _p double")
    there = cells.select(margin).distinct().join(wanted, margin, "left").fillna(0.0, ["_p"])
    total = there.agg(F.sum("_p").alias("_t")).select("_t").scalar()
    return there.select(margin, F.coalesce(F.try_divide(F.col("_p"), total), F.lit(0.0)).alias("_share"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``source, lang, topic, tokens, weight``: weights that add up to one, with the target margins."""
    total = cells.agg(F.sum("tokens").alias("_t")).select("_t").scalar()
    now = cells.withColumn("weight", F.try_divide(F.col("tokens"), total))
    for margin in MARGINS:
        given = (targets or {}).get(margin)
        share = _given(cells, margin, given) if given else _tempered(cells, margin, TEMPER[margin])
        now = now.join(spread(share.withColumnRenamed("_share", f"_{margin}")), margin)
    now = checkpointed(now)
    for _ in range(rounds):
        for margin in MARGINS:
            sums = now.groupBy(margin).agg(F.sum("weight").alias("_sum"))
            factor = F.coalesce(F.try_divide(F.col(f"_{margin}"), F.col("_sum")), F.lit(0.0))
            joined = now.join(spread(sums), margin).withColumn("weight", F.col("weight") * factor)
            # Written at every step: the next one reads the weights twice.
            now = checkpointed(joined.select(now.columns))
    return now.select(*MARGINS, "tokens", "weight")


def residual(raked: DataFrame, targets: dict[str, float], margin: str) -> float:
    """The largest gap between a margin's weights and its targets."""
    wanted = _given(raked, margin, targets)
    got = raked.groupBy(margin).agg(F.sum("weight").alias("_w"))
    return got.join(wanted, margin).agg(F.max(F.abs(F.col("_w") - F.col("_share")))).first()[0] or 0.0


def _amounts(cells: DataFrame, share: DataFrame, margin: str, budget: float) -> DataFrame:
    """``margin, _there, _<margin>``: tokens wanted of each category, ``min(there, level * share)``, adding up to the budget."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("_there"))
    sums = checkpointed(sums.join(spread(share), margin))
    level = budget
    while True:
        whole = F.col("_share") * level >= F.col("_there")
        full, rest = sums.agg(F.sum(F.when(whole, F.col("_there"))), F.sum(F.when(~whole, F.col("_share")))).first()
        if not rest or (budget - (full or 0.0)) / rest <= level * (1 + 1e-12):
            break
        level = (budget - (full or 0.0)) / rest
    wanted = F.least("_there", F.col("_share") * level)
    return sums.select(margin, wanted.alias(f"_{margin}"), (wanted >= F.col("_there")).alias(f"_all_{margin}"))


def _gap(now: DataFrame) -> float:
    """The most tokens by which a category of any margin misses what is wanted of it."""
    kept = F.sum(F.least("_raw", "tokens"))
    gaps = [now.groupBy(m).agg(F.abs(kept - F.first(f"_{m}")).alias("_gap")).select("_gap") for m in MARGINS]
    return gaps[0].unionAll(gaps[1]).unionAll(gaps[2]).agg(F.max("_gap")).first()[0] or 0.0


def _level(full: Column, free: Column, wanted: Column) -> Column:
    """Factor that brings kept tokens to what is wanted, never past it, given tokens of full cells and of others."""
    down = F.try_divide(wanted, full + free)
    up = F.try_divide(wanted - full, free)
    return F.coalesce(F.when(full + free > wanted, down).otherwise(up), F.lit(1.0))


def calibrate(cells: DataFrame, budget: float, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``source, lang, topic, tokens, _rate``: rates in [0, 1] that keep ``budget`` times the tokens.

    A rate is ``min(1, product of a factor per source, language and topic)``. A category
    with fewer tokens than its target asks for is wanted whole, and the others' targets
    grow in proportion. Targets that the margins cannot meet together are met as far as
    raking goes; a gap above ``GAP`` is logged. Cells of a category with target 0 have no row.
    """
    if not 0 < budget <= 1:
        raise ValueError("the budget is a share of the tokens")
    now = cells.withColumn("tokens", F.col("tokens").cast("double"))
    for margin in MARGINS:
        given = (targets or {}).get(margin)
        share = _given(cells, margin, given) if given else _tempered(cells, margin, TEMPER[margin])
        now = now.join(spread(share.where("_share > 0").withColumnRenamed("_share", f"_{margin}")), margin)
    now = checkpointed(now)
    total, there = cells.agg(F.sum("tokens")).first()[0] or 0, now.agg(F.sum("tokens")).first()[0] or 0
    if not there:
        return now.select(*MARGINS, "tokens", F.lit(0.0).alias("_rate"))
    goal = min(budget * float(total), float(there))
    for margin in MARGINS:
        shares = now.groupBy(margin).agg(F.first(f"_{margin}").alias("_p"))
        sum_ = shares.agg(F.sum("_p")).first()[0]
        share = shares.select(margin, (F.col("_p") / sum_).alias("_share"))
        now = now.drop(f"_{margin}").join(spread(_amounts(now, share, margin, goal)), margin)
    now = checkpointed(now.withColumn("_raw", F.col("tokens") * (goal / float(there))))
    gap, stalled = _gap(now), 0
    while gap > GAP * goal and stalled < 2:
        for margin in MARGINS:
            is_full = F.col("_raw") >= F.col("tokens")
            sums = now.groupBy(margin).agg(
                F.sum(F.when(is_full, F.col("tokens")).otherwise(0.0)).alias("_full"),
                F.sum(F.when(is_full, 0.0).otherwise(F.col("_raw"))).alias("_free"),
                F.max(F.col("tokens") / F.col("_raw")).alias("_most"),
            )
            factor = _level(F.col("_full"), F.col("_free"), F.col(f"_{margin}"))
            factor = F.when(F.col(f"_all_{margin}"), F.greatest("_most", F.lit(1.0))).otherwise(factor)
            joined = now.join(spread(sums), margin).withColumn("_raw", F.col("_raw") * factor)
            now = checkpointed(joined.select(now.columns))
        before, gap = gap, _gap(now)
        stalled = stalled + 1 if gap > STALL * before else 0
    if gap > GAP * goal:
        logging.getLogger(__name__).warning("mixing: a margin stays off by %.2g of the budget", gap / goal)
    scale = 1.0  # the budget itself is met whatever the margins allow
    for _ in range(100):
        raw = F.col("_raw") * scale
        is_full = raw >= F.col("tokens")
        full, free = now.agg(
            F.sum(F.when(is_full, F.col("tokens")).otherwise(0.0)), F.sum(F.when(is_full, 0.0).otherwise(raw))
        ).first()
        if abs(full + free - goal) <= GAP * goal / 10 or (full + free < goal and not free):
            break
        scale *= goal / (full + free) if full + free > goal else (goal - full) / free
    return now.select(*MARGINS, "tokens", F.least(F.lit(1.0), F.col("_raw") * scale / F.col("tokens")).alias("_rate"))


def _highest(cells: DataFrame, targets: dict[str, dict[str, float]] | None) -> DataFrame:
    """``source, lang, topic, _rate``: the raked weights over the tokens, the greatest scaled to one."""
    raked = rake(cells, targets)
    ratio = raked.select(*MARGINS, F.try_divide(F.col("weight"), F.col("tokens")).alias("_ratio"))
    top = ratio.agg(F.max("_ratio").alias("_top")).select("_top").scalar()
    return ratio.select(*MARGINS, F.coalesce(F.try_divide(F.col("_ratio"), top), F.lit(0.0)).alias("_rate"))


def sample(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    seed: int = SEED,
    budget: float | None = None,
) -> DataFrame:
    """``_row, topic, tokens, probability, sampled`` for every row, ``_row`` holding the input columns.

    Tokens are words here. Null sources and languages are a category of their own,
    ``(none)``. Texts that are null, empty or blank weigh nothing and have
    probability 0, as have categories with target 0. Rows that repeat an id are
    sampled alike. An empty table gives no rows. With a ``budget`` (share of the tokens
    to keep) the probabilities are calibrated to it; without one the highest is 1.
    """
    field = F.col("_row").getField
    text = field(text_col).cast("string")
    none = F.lit("(none)")
    rows = packed(docs).select(
        "_row",
        F.coalesce(field(source_col).cast("string"), none).alias("source"),
        F.coalesce(field(lang_col).cast("string"), none).alias("lang"),
        topic_of(text).alias("topic"),
        words(text).alias("tokens"),
    )
    cells = checkpointed(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")).where("tokens > 0").coalesce(8))
    rates = calibrate(cells, budget, targets).select(*MARGINS, "_rate") if budget is not None else _highest(cells, targets)
    rated = rows.join(measured(rates), list(MARGINS), "left")
    probability = F.when(F.col("tokens") > 0, F.coalesce("_rate", F.lit(0.0))).otherwise(F.lit(0.0))
    out = rated.select("_row", "topic", "tokens", probability.alias("probability"))
    return out.withColumn("sampled", uniform(F.col("_row").getField(id_col), seed) < F.col("probability"))
