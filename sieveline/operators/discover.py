"""Accepting discovered works greedily: a work is a duplicate if any of its keys was accepted before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.joins import salted_lookup
from sieveline.runtime import discard, stored


def greedy_accept(works: DataFrame, registry_keys: DataFrame, order: str, keys: str = "keys", wanted: str = "wanted") -> DataFrame:
    """Columns of order and disposition: known, duplicate, filtered or accepted. Rejected works put no keys into the index.

    The same as a scan in order, by rounds: a wanted work that is the first undecided one of all its keys is accepted, and the later ones that share a key with it are duplicates. What is not
    wanted never takes a key, so it is decided at the end. Minima go to the keys and back, so a key of any number of works is one row on the way, and no group is gathered.
    """
    flat = works.select(F.col(order).alias("at"), F.explode(keys).alias("key"), F.col(wanted).alias("wanted")).distinct()
    known = flat.join(registry_keys.select("key").distinct(), "key").select("at").distinct()
    links = stored(flat.join(known, "at", "left_anti"), "links")
    open_ = stored(links.where("wanted").select("at", "key"), "open")
    accepted = None
    while open_.take(1):
        first = open_.groupBy("key").agg(F.min("at").alias("first"))
        won = stored(salted_lookup(open_, first, "key", "at").groupBy("at").agg(F.every(F.col("first") == F.col("at")).alias("won")).where("won").select("at"), "won")
        accepted = won if accepted is None else accepted.unionAll(won)
        taken = open_.join(won, "at").groupBy("key").agg(F.min("at").alias("taken"))
        lost = salted_lookup(open_, taken, "key", "at").select("at").distinct()  # those accepted among them
        before, open_ = open_, stored(open_.join(lost, "at", "left_anti"), "open")
        discard(before)
    discard(open_)
    base = works.select(F.col(order).alias("at"), F.col(wanted).alias("wanted")).join(known.withColumn("known", F.lit(True)), "at", "left")
    if accepted is None:
        accepted = links.select("at").limit(0)
    yes = accepted.withColumn("accepted", F.lit(True))
    taken = links.join(accepted, "at").groupBy("key").agg(F.min("at").alias("taken"))
    met = salted_lookup(links, taken, "key", "at").where("taken < at").select("at").distinct().withColumn("met", F.lit(True))
    told = base.join(yes, "at", "left").join(met, "at", "left")
    disposition = F.when(F.col("known"), "known").when(F.col("accepted"), "accepted").when(F.col("met"), "duplicate").when(F.col("wanted"), "accepted").otherwise("filtered")
    return told.select(F.col("at").alias(order), disposition.alias("disposition"))
