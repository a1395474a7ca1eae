"""Queries of the operators in this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import sql
from sieveline.llm.canonical import map_to_list
from sieveline.llm.components import components
from sieveline.llm.history import repeated_works
from sieveline.llm.leakage import leaked
from sieveline.llm.names import linked_names
from sieveline.llm.reading import reading_levels
from sieveline.llm.survivor import merged, survivors
from sieveline.llm.tokenizer import encode_corpus
from sieveline.llm.truncation import truncated, truncation_report
from sieveline.runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_names(table(spark, sf_dir, "optical_zo"), "name")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = truncated(table(spark, sf_dir, "alert_candidate"), seq="delivery_seq", source="source.sender")
    return found.where("lost").select(F.col("seq").alias("delivery_seq"), "field").distinct()


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with content, truncated values and their share by sender and field."""
    return truncation_report(truncated(table(spark, sf_dir, "alert_candidate"), seq="delivery_seq", source="source.sender"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "candidate_pair"), "candidate_id_a", "candidate_id_b", "candidate_id", "group_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = map_to_list(table(spark, sf_dir, "alert_candidate"), "delivery_seq", F.col("venue.raw"), table(spark, sf_dir, "venue_list"), key="venue_id", name="name", affix="publisher")
    return found.select("delivery_seq", "venue_id")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that mean no entry of the list, with how often they occur."""
    found = map_to_list(table(spark, sf_dir, "alert_candidate"), "delivery_seq", F.col("venue.raw"), table(spark, sf_dir, "venue_list"), key="venue_id", name="name", affix="publisher")
    return found.where("venue_id = 0").groupBy("value").agg(F.count("*").alias("n_rows"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_works(table(spark, sf_dir, "openalex_candidate"), key="candidate_id", title="normalized_title", year="year", batch="batch_no", seq="registry_seq")
    return found.select(F.least("candidate_id", "accepted").alias("candidate_id_a"), F.greatest("candidate_id", "accepted").alias("candidate_id_b")).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(table(spark, sf_dir, "duplicate_group"), table(spark, sf_dir, "alert_candidate"), table(spark, sf_dir, "venue_list"), group="group_id", seq="delivery_seq")


def p7_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each group."""
    return merged(table(spark, sf_dir, "duplicate_group"), table(spark, sf_dir, "alert_candidate"), table(spark, sf_dir, "venue_list"), group="group_id", seq="delivery_seq")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"), key="doc_id", text="text", item_key="item_id", item_text="text")
    return found.select("doc_id", "item_id").distinct()


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_label"), key="doc_id", text="text", level="reading_level").distinct()


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_report": p2_report, "p3_found": p3_found, "p4_found": p4_found, "p4_unmatched": p4_unmatched, "p5_found": p5_found, "p7_found": p7_found, "p7_merged": p7_merged, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found}
ORACLE = sql.ORACLE
