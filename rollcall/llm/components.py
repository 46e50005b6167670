"""Connected components over an edge table, by alternating star rewrites.

Large star hangs every larger neighbour of a node on the least node around it,
small star does the same for the smaller ones; both keep the components, and the
edges settle as one star per component after a logarithmic number of rounds.
Nothing but a row count and a checksum per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BROADCAST_ROWS, checkpointed, spread

ROWS_A_TASK = 25_000


def _checksum(edges: DataFrame) -> tuple:
    code = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    return tuple(edges.agg(F.count("*"), F.sum(code)).first())


def _star(edges: DataFrame, count: int) -> DataFrame:
    # There are at most twice as many nodes as edges, so the size of the sides is known.
    side = F.broadcast if 2 * count <= BROADCAST_ROWS else spread
    # Exploded, not united: a union of a written table with itself trips over its constraints.
    ends = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in ("uv", "vu")]
    both = edges.select(F.explode(F.array(*ends)).alias("edge")).select("edge.*")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(side(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    hung = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return large.join(side(low), "u").select(hung.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has an edge to another node.

    ``component`` is the least node that can be reached. Nodes may be of any
    ordered type; null ends, loops and repeated edges are ignored, an empty edge
    table gives an empty result.
    """
    ends = edges.select(F.greatest(a, b), F.least(a, b), F.col(a).isNotNull() & F.col(b).isNotNull())
    now = checkpointed(ends.toDF("u", "v", "ok").where("ok and u <> v").select("u", "v").distinct())
    seen = _checksum(now)
    while seen[0]:
        # Stars have no more edges than the graph they come from.
        now = checkpointed(_star(now, seen[0]).coalesce(-(-seen[0] // ROWS_A_TASK)))
        state = _checksum(now)
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
