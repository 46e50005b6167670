"""Exact top-k by exhaustive term-at-a-time accumulation (operator 6).

Components are whole numbers ``floor(SCALE * x)``. Queries and candidates are dealt
into blocks of bounded size, and every query block meets every candidate block in
one task: the block's vectors are turned into postings per term (dimension), and
each query term scatters its weighted postings into a dense array of scores. A
partition selection keeps ``k`` candidates per query and block; a merge over the
blocks gives the answer. Nothing is broadcast and nothing pruned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import checkpointed, col

SCALE = 1024
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096


def whole_numbers(vector: Column) -> Column:
    """The vector in whole numbers; null where a component is null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(
        ~odd, F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))
    )


def accumulate(query_ids, queries, ids, vectors, k: int) -> pd.DataFrame:
    """The ``k`` best candidates of each query within a block, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    width = max((len(v) for v in vectors), default=0)
    weights = np.zeros((len(ids), width), np.int64)
    for row, at in enumerate(order):
        weights[row, : len(vectors[at])] = vectors[at]
    postings = [(rows := np.flatnonzero(weights[:, term]), weights[rows, term]) for term in range(width)]
    out: list[tuple] = []
    for query, vector in zip(query_ids, queries, strict=True):
        scores = np.zeros(len(ids), np.int64)
        for term in np.flatnonzero(vector[:width]):
            rows, weight = postings[term]
            scores[rows] += vector[term] * weight
        others = np.flatnonzero(ids != query)
        if len(others) > k:
            kth = np.partition(scores[others], len(others) - k)[len(others) - k]
            others = others[scores[others] >= kth]
        best = others[np.lexsort((ids[others], -scores[others]))][:k]
        out += zip([query] * len(best), ids[best].tolist(), scores[best].tolist(), strict=True)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``queries`` picks, its ``k`` best others.

    ``queries`` is a condition on ``id_col``. Null ids, null vectors and vectors with
    null or non-finite components take no part; an empty vector scores 0 with all.
    Vectors of different length are compared over their common length. Rows that
    repeat an id are one vector, the largest of them; ties go to the smaller id. An
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(col(id_col).cast("long").alias(id_col), whole_numbers(col(vector_col)).alias("_vector"))
    rows = rows.where(col(id_col).isNotNull() & F.col("_vector").isNotNull()).withColumn("_query", queries)
    rows = rows.groupBy(col(id_col).alias("_id")).agg(
        F.max("_vector").alias("_vector"), F.max(F.coalesce("_query", F.lit(False))).alias("_query")
    )
    rows = checkpointed(rows)
    total, asked = rows.agg(F.count("*"), F.count_if("_query")).first()
    query_blocks, blocks = -(-asked // QUERY_BLOCK), -(-total // CANDIDATE_BLOCK)
    if not asked:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")

    def block(salt: int, count: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "_id"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asking = rows.where("_query").select(
        block(1, query_blocks).alias("_q"), every(blocks).alias("_c"), F.lit(True).alias("_asks"), "_id", "_vector"
    )
    answering = rows.select(
        every(query_blocks).alias("_q"), block(2, blocks).alias("_c"), F.lit(False).alias("_asks"), "_id", "_vector"
    )

    def meet(both: pd.DataFrame) -> pd.DataFrame:
        asks = both["_asks"].to_numpy()
        ids, lists = both["_id"].to_numpy(), both["_vector"].to_numpy()
        return accumulate(ids[asks], lists[asks], ids[~asks], lists[~asks], k)

    found = asking.unionByName(answering).groupBy("_q", "_c").applyInPandas(
        meet, "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
