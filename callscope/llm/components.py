"""Connected components of an edge table, by large-star and small-star rounds.

Each round links every node to the smallest node it knows, by pre-aggregated minima and joins,
and ends in the shared scratch folder; no links or nodes come to the driver. The rounds stop when
the edges stay as they were, by count and checksum: then every edge leads to its component's root.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import materialise

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = edges.join(least, F.col("u") == F.col("w")).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("w", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (u, v: long); the root is the smallest node reached."""
    now = materialise(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        now = materialise(_small_star(_large_star(now).distinct()).distinct(), "edges")
        last, state = state, _state(now)
        if state == last:
            break
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
