"""Queries of the general training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.deliver_once import SeenStore, deliver_in_order
from sieveline.runtime import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Superfluous copies of alert messages, replayed in order of arrival against a store that begins empty."""
    alerts = table(spark, sf_dir, "alert_candidate")
    done = deliver_in_order(alerts, SeenStore(spark), message_id=F.col("source.message_id"), part=F.col("candidate_id"), received_at=F.col("source.received_at"), seq="delivery_seq")
    return done.select(F.col("seq").alias("delivery_seq"))


QUERIES = {"p6_found": p6_found}

ORACLE = {
    "p6_found": r"""
WITH k AS (
  SELECT delivery_seq, candidate_id, regexp_replace(source.message_id, '^[\s<>]+|[\s<>]+$', '', 'g') AS m, TRY_CAST(source.received_at AS TIMESTAMPTZ) AS t
  FROM alert_candidate
), r AS (
  SELECT delivery_seq, row_number() OVER (PARTITION BY m, candidate_id ORDER BY t NULLS LAST, delivery_seq) AS n
  FROM k WHERE m <> '' AND candidate_id IS NOT NULL
)
SELECT delivery_seq FROM r WHERE n > 1
""",
}
