"""Resolving records to entities by shared keys, and the survivors' fields."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.operators.joins import salted_lookup
from sieveline.runtime import discard, stored


def identity_keys(rows: DataFrame, seq: str, keys: Mapping[str, Column]) -> DataFrame:
    """Columns seq, key: 'kind:value' of each key that a record has."""
    every = F.array_compact(F.array(*(F.concat(F.lit(f"{kind}:"), value) for kind, value in keys.items())))
    return rows.select(F.col(seq).alias("seq"), F.explode(every).alias("key"))


def entities(keyed: DataFrame) -> DataFrame:
    """Columns seq, entity: the least seq among records linked through keys, directly or indirectly.

    Labels go to the keys and back as minima, combined before each shuffle, so that a key of many records is one row on the way; pairs are never built.
    """
    links = stored(keyed.distinct(), "links")
    state = stored(links.select("seq").distinct().select("seq", F.col("seq").alias("entity")), "entities")
    while True:
        at_key = links.join(state, "seq").groupBy("key").agg(F.min("entity").alias("least"))
        heard = salted_lookup(links, at_key, "key", "seq").groupBy("seq").agg(F.min("least").alias("least"))
        near = stored(state.join(heard, "seq").select("seq", F.col("entity").alias("was"), F.least("entity", "least").alias("entity")), "near")
        # A label may itself have moved on; following it halves what is left of a chain.
        moved = near.select(F.col("seq").alias("entity"), F.col("entity").alias("far")).join(near.select("entity").distinct(), "entity").where("far < entity")
        before, state = state, stored(salted_lookup(near, moved, "entity", "seq", "left").select("seq", F.least("entity", "far").alias("entity"), (F.least("entity", "far") < F.col("was")).alias("changed")), "entities")
        discard(before), discard(near)
        if not state.where("changed").take(1):
            return state.select("seq", "entity")


def survived(rows: DataFrame, entity: str, seq: str, fields: Mapping[str, Column]) -> DataFrame:
    """One row of each entity: every field from the member that ranks it highest, the first on ties; fields: names and ranks."""
    return rows.groupBy(entity).agg(*(F.max_by(name, F.struct(rank.alias("rank"), (-F.col(seq)).alias("first"))).alias(name) for name, rank in fields.items()), F.count("*").alias("members"))


def mode_first_seen(rows: DataFrame, group: str, value: str, seq: str) -> DataFrame:
    """Most frequent value of each group, the first seen on ties."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    return counted.groupBy(group).agg(F.max_by(value, F.struct("n", (-F.col("first")).alias("first"))).alias(value), F.max("n").alias("n"))


def title_closure(rows: DataFrame, least: int = 24) -> DataFrame:
    """Columns seq, entity. rows: seq, title, year, author. Records of one title of so many characters are linked if their years are at most one apart or one is null, and their authors equal or one
    is null; closed transitively, so that a null bridges. Equal (title, year, author) are one node, so that only different ones are paired."""
    known = rows.where(F.length("title") >= least)
    node = known.groupBy("title", "year", "author").agg(F.min("seq").alias("node"))
    a, b = node.select("title", *(F.col(c).alias(f"{c}_a") for c in ("year", "author", "node"))), node.select("title", *(F.col(c).alias(f"{c}_b") for c in ("year", "author", "node")))
    years = F.col("year_a").isNull() | F.col("year_b").isNull() | (F.abs(F.col("year_a") - F.col("year_b")) <= 1)
    authors = F.col("author_a").isNull() | F.col("author_b").isNull() | (F.col("author_a") == F.col("author_b"))
    links = a.join(b, "title").where((F.col("node_a") < F.col("node_b")) & years & authors).select(F.col("node_a").alias("x"), F.col("node_b").alias("y"))
    found = entities(links.select(F.explode(F.array("x", "y")).alias("seq"), F.concat_ws("-", "x", "y").alias("key")))
    nodes = node.join(found.withColumnRenamed("seq", "node"), "node", "left").select("title", "year", "author", F.coalesce("entity", "node").alias("entity"))
    same = known["title"].eqNullSafe(nodes["title"]) & known["year"].eqNullSafe(nodes["year"]) & known["author"].eqNullSafe(nodes["author"])
    done = known.join(nodes, same).select("seq", "entity")
    # A null year or author stands for itself, whatever the other records that are null there: those of one node are linked, as null fits null.
    return done.unionAll(rows.where(F.col("title").isNull() | (F.length("title") < least)).select("seq", F.col("seq").alias("entity")))


def merged(members: DataFrame, group: str, seq: str) -> DataFrame:
    """One record of each group of alert rows: the longest title, first year and last venue, united addresses, warnings and provenance, and the state that follows.

    Sets of distinct values are combined before the shuffle; warnings that the merge has answered are dropped, and a conflict of years and the merge itself are noted.
    """
    g = members.groupBy(group).agg(
        F.count("*").alias("members"), F.max_by("title", F.struct(F.length("title"), -F.col(seq))).alias("title"), F.min("year").alias("year"), F.max("year").alias("last_year"), F.max("venue.normalized").alias("venue"),
        F.array_sort(F.collect_set("links.primary_url")).alias("urls"), F.array_sort(F.collect_set(F.concat("source.source_type", F.lit(":"), "candidate_id"))).alias("provenance"),
        F.array_distinct(F.flatten(F.collect_set("parse_status.warnings"))).alias("said"), F.max((F.col("parse_status.state") == "complete").cast("int")).alias("done"),
    )
    noted = F.array_compact(F.array(F.when(~F.col("year").eqNullSafe(F.col("last_year")), "conflicting_year_across_sources"), F.when(F.col("members") > 1, "merged_cross_source_records")))
    answered = lambda w: (w.isin("missing_venue", "unresolved_venue") & F.col("venue").isNotNull()) | ((w == "missing_year") & F.col("year").isNotNull())
    warnings = F.array_sort(F.filter(F.concat("said", noted), lambda w: ~answered(w)))
    whole = F.col("title").isNotNull() & F.col("year").isNotNull() & F.col("venue").isNotNull()
    return g.select(group, "members", "title", "year", "venue", "urls", "provenance", warnings.alias("warnings"), F.when(whole | (F.col("done") == 1), "complete").otherwise("partial").alias("state"))
