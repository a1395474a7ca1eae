"""Groups out of pairwise matches: connected components by minimum labels with pointer jumping.

Cases: a null on one side still gives the other side its own group; self-pairs, repeated and reversed pairs add nothing;
other columns are ignored whatever their names; no pairs give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.runtime import discard, stored

HOT_DEGREE = 20_000


def components(pairs: DataFrame, a: str, b: str, node: str, group: str, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """One row per non-null value of a or b with the smallest value that it is linked to, directly or indirectly.

    Each vertex points to a label, the smallest vertex it has heard of. In each round the labels' labels of the neighbours are
    offered to the vertex and to the vertex it points to, and pointers jump to the label of the label, so that whole trees
    are hooked at once and rounds grow with the logarithm of the longest chain. A vertex with more than hot_degree links is salted: its label is
    replicated once per hot_degree links, and its links spread over the replicas; minima are combined before the shuffle.
    """
    raw = pairs.select(F.col(a).cast("string").alias("u"), F.col(b).cast("string").alias("v"))
    nodes = raw.select("u").unionAll(raw.select("v")).where("u is not null").distinct()
    links = stored(raw.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degree = both.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("least"))
    state = stored(with_far(nodes.join(degree, "u", "left").select(F.col("u").alias("v"), F.least("u", "least").alias("near"), F.ceil(F.coalesce("n", F.lit(1)) / hot_degree).cast("int").alias("salts"), F.lit(True).alias("changed"))))
    hot = state.where("salts > 1").select(F.col("v").alias("u"), "salts")
    edges = stored(both.join(hot, "u", "left").select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")))
    discard(links)
    while True:
        spread = state.select(F.col("v").alias("u"), "far", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        heard = edges.join(spread, ["u", "salt"]).groupBy("v").agg(F.min("far").alias("heard"))
        step = stored(state.join(heard, "v", "left").drop("changed"))
        hooks = step.groupBy(F.col("near").alias("v")).agg(F.min("heard").alias("hook"))
        moved = step.join(hooks, "v", "left").select("v", F.least("near", "far", "heard", "hook").alias("to"), "near", "salts")
        moved = moved.select("v", F.col("to").alias("near"), "salts", (F.col("to") < F.col("near")).alias("changed"))
        inner = stored(moved)
        before, state = state, stored(with_far(inner))
        discard(before), discard(step), discard(inner)
        if not state.where("changed").take(1):
            discard(edges)
            return state.select(F.col("v").alias(node), F.col("near").alias(group))


def with_far(state: DataFrame, spread: int = 16) -> DataFrame:
    """Adds the label of each vertex's label. One label may be that of a third of all vertices, so the distinct labels are
    looked up once each, and both sides of the way back are salted."""
    far = state.select(F.col("v").alias("near"), F.col("near").alias("far")).join(state.select("near").distinct(), "near")
    copies = far.select("near", "far", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    return state.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(spread)).cast("int")).join(copies, ["near", "part"]).drop("part")
