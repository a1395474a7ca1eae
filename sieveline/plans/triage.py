"""More queries of the general operators, each with its SQL: entity merge, enrichment, gates, orders, grounding and text pieces.

Result columns are flat: arrays are joined to strings, and doubles are rounded. NOW is a parameter everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sieveline.functions import pieces as P
from sieveline.functions import text as X
from sieveline.operators import gates as G
from sieveline.operators import resolve as R
from sieveline.runtime import table

NOW = "2026-08-04 00:00:00"
QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate")


def works(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "openalex_candidate")


# ---- entities ----------------------------------------------------------------------------------------------------


@query(
    """WITH RECURSIVE n AS (SELECT registry_seq AS s, normalized_title AS t, year AS y, nullif(lower(trim(authors[1].name, ' ')), '') AS a FROM openalex_candidate),
    e AS (SELECT p.s AS u, q.s AS v FROM n p JOIN n q ON p.t = q.t AND p.s <> q.s WHERE length(p.t) >= 24 AND (p.y IS NULL OR q.y IS NULL OR abs(p.y - q.y) <= 1) AND (p.a IS NULL OR q.a IS NULL OR p.a = q.a)),
    r AS (SELECT s, s AS g FROM n UNION SELECT e.v, r.g FROM r JOIN e ON e.u = r.s)
    SELECT s AS registry_seq, min(g) AS entity FROM r GROUP BY s"""
)
def title_closure(spark: SparkSession, d: str) -> DataFrame:
    """Records of one title with years at most one apart or null and first authors equal or null, closed transitively, so that a null bridges."""
    rows = works(spark, d).select(F.col("registry_seq").alias("seq"), F.col("normalized_title").alias("title"), "year", F.nullif(F.lower(F.trim(F.get("authors.name", F.lit(0)))), F.lit("")).alias("author"))
    return R.title_closure(rows).select(F.col("seq").alias("registry_seq"), "entity")


@query(
    """SELECT candidate_id, delivery_seq FROM (SELECT candidate_id, delivery_seq, row_number() OVER (PARTITION BY candidate_id ORDER BY CASE WHEN parse_status.state = 'complete' THEN 0 ELSE 1 END,
    CASE WHEN source.source_type LIKE '%email%' THEN 0 ELSE 1 END, delivery_seq) AS n FROM alert_candidate) WHERE n = 1"""
)
def canonical_pick(spark: SparkSession, d: str) -> DataFrame:
    """The row that stands for its candidate: complete ones first, then those from mail, then the first."""
    rank = F.struct(F.when(F.col("parse_status.state") == "complete", 0).otherwise(1), F.when(F.col("source.source_type").like("%email%"), 0).otherwise(1), "delivery_seq")
    return alerts(spark, d).groupBy("candidate_id").agg(F.min_by("delivery_seq", rank).alias("delivery_seq"))


@query(
    r"""WITH m AS (SELECT DISTINCT g.group_id, a.* FROM duplicate_group g JOIN alert_candidate a USING (delivery_seq)),
    w AS (SELECT group_id, unnest(parse_status.warnings) AS w FROM m),
    g AS (SELECT group_id, count(*) AS members, max_by(title, (length(title), -delivery_seq)) AS title, min(year) AS year, min(year) IS DISTINCT FROM max(year) AS conflict, max(venue.normalized) AS venue,
      array_to_string(list_sort(list(DISTINCT links.primary_url)), ' ') AS urls, array_to_string(list_sort(list(DISTINCT concat(source.source_type, ':', candidate_id))), ' ') AS provenance, bool_or(parse_status.state = 'complete') AS done FROM m GROUP BY 1),
    k AS (SELECT group_id, list(DISTINCT w) AS ws FROM w GROUP BY 1)
    SELECT g.group_id, members, title, year, venue, urls, provenance,
    array_to_string(list_sort(list_filter(list_concat(coalesce(ws, []), [CASE WHEN conflict THEN 'conflicting_year_across_sources' END, CASE WHEN members > 1 THEN 'merged_cross_source_records' END]),
      lambda x: x IS NOT NULL AND NOT (x IN ('missing_venue', 'unresolved_venue') AND venue IS NOT NULL) AND NOT (x = 'missing_year' AND year IS NOT NULL))), ' ') AS warnings,
    CASE WHEN title IS NOT NULL AND year IS NOT NULL AND venue IS NOT NULL THEN 'complete' WHEN done THEN 'complete' ELSE 'partial' END AS state,
    sha256(concat(coalesce(title, ''), '|', coalesce(CAST(year AS VARCHAR), ''), '|', coalesce(venue, ''))) AS fingerprint FROM g LEFT JOIN k USING (group_id)"""
)
def merged_record(spark: SparkSession, d: str) -> DataFrame:
    """One record of each group: the longest title, united addresses and warnings, provenance, and the state and fingerprint anew."""
    members = table(spark, d, "duplicate_group").select("group_id", "delivery_seq").distinct().join(alerts(spark, d), "delivery_seq")
    g = R.merged(members, "group_id", "delivery_seq")
    return g.select("group_id", "members", "title", "year", "venue", *(F.array_join(c, " ").alias(c) for c in ("urls", "provenance", "warnings")), "state", X.fingerprint(F.col("title"), F.col("year"), F.col("venue")).alias("fingerprint"))


@query("SELECT v AS doi, count(DISTINCT candidate_id) AS n, min(candidate_id) AS first, count(DISTINCT candidate_id) > 1 AS conflict FROM (SELECT candidate_id, lower(identifiers.doi.value) AS v FROM openalex_candidate WHERE identifiers.doi.value IS NOT NULL) GROUP BY 1")
def unique_map(spark: SparkSession, d: str) -> DataFrame:
    """The one candidate of each identifier, and whether there are several. Equal pairs are combined first, so an identifier of many rows is no hot key."""
    pairs = works(spark, d).where("identifiers.doi.value is not null").select(F.lower("identifiers.doi.value").alias("doi"), "candidate_id").distinct()
    return pairs.groupBy("doi").agg(F.count("*").alias("n"), F.min("candidate_id").alias("first"), (F.count("*") > 1).alias("conflict"))


# ---- enrichment --------------------------------------------------------------------------------------------------

TYPED = "SELECT {0} AS seq, '{1}' AS provider, candidate_id, title, year, venue.normalized AS venue, lower(identifiers.doi.value) AS doi, len(authors) AS n_authors, links.primary_url AS url FROM {2}"


@query(TYPED.format("delivery_seq", "mail", "alert_candidate") + " UNION ALL " + TYPED.format("registry_seq", "api", "openalex_candidate"))
def provider_records(spark: SparkSession, d: str) -> DataFrame:
    """The records of both sources in one shape."""
    shape = lambda df, seq, provider: df.select(F.col(seq).alias("seq"), F.lit(provider).alias("provider"), "candidate_id", "title", "year", F.col("venue.normalized").alias("venue"), F.lower("identifiers.doi.value").alias("doi"), F.size("authors").cast("bigint").alias("n_authors"), F.col("links.primary_url").alias("url"))
    return shape(alerts(spark, d), "delivery_seq", "mail").unionByName(shape(works(spark, d), "registry_seq", "api"))


@query(
    """SELECT registry_seq, left(sha256(concat('openalex:', source.work_id)), 24) AS id, sha256(concat(coalesce(title, ''), '|', coalesce(CAST(year AS VARCHAR), ''), '|', coalesce(venue.raw, ''))) AS fingerprint,
    array_to_string(list_filter([CASE WHEN coalesce(title, '') = '' THEN 'missing_title' END, CASE WHEN coalesce(venue.raw, '') = '' THEN 'missing_venue' END, CASE WHEN year IS NULL THEN 'missing_year' END, CASE WHEN len(authors) = 0 THEN 'missing_authors' END], lambda x: x IS NOT NULL), ' ') AS warnings,
    CASE WHEN coalesce(title, '') = '' THEN 'failed' WHEN coalesce(venue.raw, '') = '' OR year IS NULL OR len(authors) = 0 THEN 'partial' ELSE 'complete' END AS state FROM openalex_candidate"""
)
def work_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Records of the API as candidates: a stable id, the fingerprint, what is missing, and the state that follows."""
    missing = {"missing_title": F.coalesce("title", F.lit("")) == "", "missing_venue": F.coalesce("venue.raw", F.lit("")) == "", "missing_year": F.col("year").isNull(), "missing_authors": F.size("authors") == 0}
    warnings = P.flags(missing)
    state = F.when(missing["missing_title"], "failed").when(F.size(warnings) > 0, "partial").otherwise("complete")
    return works(spark, d).select("registry_seq", X.record_id(F.lit("openalex"), F.col("source.work_id")).alias("id"), X.fingerprint(F.col("title"), F.col("year"), F.col("venue.raw")).alias("fingerprint"), F.array_join(warnings, " ").alias("warnings"), state.alias("state"))


@query(
    """WITH e AS (SELECT normalized_title AS t, min_by(venue.normalized, registry_seq) AS venue, min_by(coalesce(year, 0), registry_seq) AS year, min_by(list_transform(authors, lambda a: a.name), registry_seq) AS authors FROM openalex_candidate GROUP BY 1)
    SELECT delivery_seq, coalesce(nullif(e.venue, ''), c.venue.normalized) AS venue, coalesce(nullif(e.year, 0), c.year) AS year,
    array_to_string(list_filter(CASE WHEN len(coalesce(e.authors, [])) > 0 THEN e.authors ELSE list_transform(c.authors, lambda a: a.name) END, lambda n: n IS NOT NULL AND trim(n, ' ') <> ''), '; ') AS authors
    FROM alert_candidate c LEFT JOIN e ON e.t = c.normalized_title"""
)
def resolved_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The enriched value of each field, or the candidate's where that is null, empty or 0; authors of the one that has any, without blanks."""
    found = works(spark, d).groupBy(F.col("normalized_title")).agg(*(F.min_by(c, "registry_seq").alias(n) for n, c in (("e_venue", F.col("venue.normalized")), ("e_year", F.coalesce("year", F.lit(0))), ("e_authors", F.col("authors.name")))))
    names = F.when(F.size(F.coalesce("e_authors", F.array().cast("array<string>"))) > 0, F.col("e_authors")).otherwise(F.col("authors.name"))
    joined = R.salted_lookup(alerts(spark, d), found, "normalized_title", "delivery_seq", "left")
    return joined.select("delivery_seq", F.coalesce(F.nullif("e_venue", F.lit("")), "venue.normalized").alias("venue"), F.coalesce(F.nullif("e_year", F.lit(0)), "year").alias("year"), F.array_join(F.filter(names, lambda n: n.isNotNull() & (F.trim(n) != "")), "; ").alias("authors"))


@query(
    """WITH byd AS (SELECT lower(identifiers.doi.value) AS k, min(candidate_id) AS hit FROM openalex_candidate WHERE identifiers.doi.value IS NOT NULL GROUP BY 1),
    byt AS (SELECT normalized_title AS k, min(candidate_id) AS hit FROM openalex_candidate WHERE normalized_title IS NOT NULL GROUP BY 1)
    SELECT a.delivery_seq, coalesce(byd.hit, byt.hit) AS hit, CASE WHEN byd.hit IS NOT NULL THEN 'doi' WHEN byt.hit IS NOT NULL THEN 'title' ELSE 'unmatched' END AS stage
    FROM alert_candidate a LEFT JOIN byd ON byd.k = lower(a.identifiers.doi.value) LEFT JOIN byt ON byt.k = a.normalized_title"""
)
def provider_chain(spark: SparkSession, d: str) -> DataFrame:
    """Looked up by identifier, and what that doesn't find by title. Only the keys travel; lookups are salted, as a key may be that of a third of all rows."""
    o = works(spark, d)
    a = alerts(spark, d).select("delivery_seq", F.lower("identifiers.doi.value").alias("doi"), F.col("normalized_title").alias("key"))
    by_doi = o.where("identifiers.doi.value is not null").groupBy(F.lower("identifiers.doi.value").alias("doi")).agg(F.min("candidate_id").alias("d"))
    by_title = o.where("normalized_title is not null").groupBy(F.col("normalized_title").alias("key")).agg(F.min("candidate_id").alias("t"))
    both = R.salted_lookup(R.salted_lookup(a, by_doi, "doi", "delivery_seq", "left"), by_title, "key", "delivery_seq", "left")
    return both.select("delivery_seq", F.coalesce("d", "t").alias("hit"), F.when(F.col("d").isNotNull(), "doi").when(F.col("t").isNotNull(), "title").otherwise("unmatched").alias("stage"))


@query(
    """SELECT c AS candidate_id, CASE max(r) WHEN 3 THEN 'exact' WHEN 2 THEN 'confident' WHEN 1 THEN 'weak' ELSE 'unscored' END AS status, count(*) AS attempts FROM
    (SELECT candidate_id_a AS c, CASE WHEN score IS NULL AND method <> 'fingerprint' THEN 0 WHEN method = 'fingerprint' OR score >= 0.999 THEN 3 WHEN score >= 0.9 THEN 2 ELSE 1 END AS r FROM candidate_pair WHERE candidate_id_a IS NOT NULL) GROUP BY 1"""
)
def match_status(spark: SparkSession, d: str) -> DataFrame:
    """The best of a candidate's attempts decides its status."""
    rank = F.when(F.col("score").isNull() & (F.col("method") != "fingerprint"), 0).when((F.col("method") == "fingerprint") | (F.col("score") >= 0.999), 3).when(F.col("score") >= 0.9, 2).otherwise(1)
    best = table(spark, d, "candidate_pair").where("candidate_id_a is not null").groupBy(F.col("candidate_id_a").alias("candidate_id")).agg(F.max(rank).alias("r"), F.count("*").alias("attempts"))
    return best.select("candidate_id", F.get(F.array(*map(F.lit, ("unscored", "weak", "confident", "exact"))), F.col("r")).alias("status"), "attempts")


# ---- gates and incremental state ---------------------------------------------------------------------------------


@query(f"SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN ts END) AS last, coalesce(date_diff('second', max(CASE WHEN event_type = 'purchase' THEN ts END), TIMESTAMP '{NOW}') >= 12 * 3600, true) AS due FROM events GROUP BY 1")
def due_gate(spark: SparkSession, d: str) -> DataFrame:
    """Whether so many hours have passed since the last success; due where there was none."""
    last = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.date_trunc("second", F.col("ts")))).alias("at"), F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last"))
    return last.select("user_id", "last", G.due(F.col("at"), F.lit(NOW).cast("timestamp"), 12).alias("due"))


@query(f"SELECT user_id, coalesce(max(CASE WHEN event_type = 'login' THEN ts END) - INTERVAL 7 DAY, TIMESTAMP '{NOW}' - INTERVAL 30 DAY) AS since, TIMESTAMP '{NOW}' AS until FROM events GROUP BY 1")
def lookback_window(spark: SparkSession, d: str) -> DataFrame:
    """What to poll: from the last success less the overlap, or the first lookback, until now."""
    last = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "login", F.col("ts"))).alias("last"))
    since, until = G.poll_window(F.col("last"), F.lit(NOW).cast("timestamp"), 7, 30)
    return last.select("user_id", since.cast("timestamp_ntz").alias("since"), until.cast("timestamp_ntz").alias("until"))


@query(
    """WITH b AS (SELECT batch_no, count(*) AS rows_read, count(*) FILTER (WHERE title IS NULL OR trim(title, ' ') = '' OR source.message_id IS NULL) AS failures FROM alert_candidate GROUP BY 1)
    SELECT batch_no, rows_read, failures, failures = 0 AS advances, max(CASE WHEN failures = 0 THEN batch_no END) OVER (ORDER BY batch_no) AS checkpoint FROM b"""
)
def checkpoint_advance(spark: SparkSession, d: str) -> DataFrame:
    """The checkpoint goes on only with batches without any failure."""
    failed = F.col("title").isNull() | (F.trim("title") == "") | F.col("source.message_id").isNull()
    return G.checkpoints(alerts(spark, d), "batch_no", failed)


@query("WITH t AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 50 = 0) SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM t) UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 50 = 0")
def replace_by_source(spark: SparkSession, d: str) -> DataFrame:
    """All rows of the sources that came anew are replaced by what came."""
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return G.replaced_by_source(old, old.where("o_orderkey % 50 = 0"), "o_custkey")


@query("SELECT delivery_seq, len(list_filter(['title', 'year', 'venue', 'snippet'], lambda r: NOT list_contains(list_filter([CASE WHEN title IS NOT NULL THEN 'title' END, CASE WHEN year IS NOT NULL THEN 'year' END, CASE WHEN venue.raw IS NOT NULL THEN 'venue' END, CASE WHEN snippet IS NOT NULL THEN 'snippet' END], lambda x: x IS NOT NULL), r))) = 0 AS covered FROM alert_candidate")
def subset_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether all required fields are there."""
    there = P.flags({n: F.col(c).isNotNull() for n, c in (("title", "title"), ("year", "year"), ("venue", "venue.raw"), ("snippet", "snippet"))})
    return alerts(spark, d).select("delivery_seq", (F.size(F.array_except(F.array(*map(F.lit, ("title", "year", "venue", "snippet"))), there)) == 0).alias("covered"))


@query("SELECT batch_no, count(*) AS n, bool_and(parse_status.state = 'complete' AND title IS NOT NULL) AS accepted FROM alert_candidate GROUP BY 1")
def all_or_nothing(spark: SparkSession, d: str) -> DataFrame:
    """A batch is accepted if each of its rows is."""
    return alerts(spark, d).groupBy("batch_no").agg(F.count("*").alias("n"), F.every((F.col("parse_status.state") == "complete") & F.col("title").isNotNull()).alias("accepted"))


@query("SELECT registry_seq, sha256(normalized_title) AS digest, sha256(normalized_title) = sha256(CASE WHEN registry_seq % 97 = 0 THEN concat(normalized_title, ' ') ELSE normalized_title END) AS intact FROM openalex_candidate WHERE normalized_title IS NOT NULL")
def artifact_tamper(spark: SparkSession, d: str) -> DataFrame:
    """Digests computed anew against the kept ones; some texts were changed after."""
    o = works(spark, d).where("normalized_title is not null")
    changed = F.when(F.col("registry_seq") % 97 == 0, F.concat("normalized_title", F.lit(" "))).otherwise(F.col("normalized_title"))
    return o.select("registry_seq", F.sha2("normalized_title", 256).alias("digest"), (F.sha2("normalized_title", 256) == F.sha2(changed, 256)).alias("intact"))


# ---- aggregates and orders ---------------------------------------------------------------------------------------


@query("SELECT o_custkey, round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 0), 2) AS urgent, round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW'), 0), 2) AS low FROM orders GROUP BY 1")
def pivot_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Two variants side by side over the union of their keys."""
    p = table(spark, d, "orders").groupBy("o_custkey").pivot("o_orderpriority", ["1-URGENT", "5-LOW"]).agg(F.sum("o_totalprice"))
    return p.select("o_custkey", F.round(F.coalesce("1-URGENT", F.lit(0)), 2).cast("double").alias("urgent"), F.round(F.coalesce("5-LOW", F.lit(0)), 2).cast("double").alias("low"))


@query("SELECT source, max(retrieved_at) FILTER (WHERE candidate_id IS NOT NULL AND section = 'abstract') AS latest FROM documents GROUP BY 1")
def max_or_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.max(F.when(F.col("candidate_id").isNotNull() & (F.col("section") == "abstract"), F.col("retrieved_at"))).alias("latest"))


@query("SELECT delivery_seq, coalesce(list_max(list_filter([CASE WHEN regexp_matches(concat_ws(' ', title, snippet), '(?i)training') THEN 0.9 END, CASE WHEN regexp_matches(concat_ws(' ', title, snippet), '(?i)sensor') THEN 0.6 END, CASE WHEN regexp_matches(concat_ws(' ', title, snippet), '(?i)imaging') THEN 0.4 END], lambda x: x IS NOT NULL)), 0.0)::DOUBLE AS weight FROM alert_candidate")
def conditional_max(spark: SparkSession, d: str) -> DataFrame:
    """The greatest weight of the patterns that the text holds, 0 without any."""
    text = F.concat_ws(" ", "title", "snippet")
    weights = F.array_compact(F.array(*(F.when(text.rlike(f"(?i){p}"), F.lit(w)) for p, w in (("training", 0.9), ("sensor", 0.6), ("imaging", 0.4)))))
    return alerts(spark, d).select("delivery_seq", F.coalesce(F.array_max(weights), F.lit(0.0)).alias("weight"))


@query("SELECT event_type, count(*) AS calls, round(sum(coalesce(value, 0)), 4) AS total, count(*) FILTER (WHERE value IS NULL) AS without, round(max(coalesce(value, 0)), 4) AS most, sum(length(props)) AS characters FROM events GROUP BY 1")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    v = F.coalesce("value", F.lit(0.0))
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("calls"), F.round(F.sum(v), 4).alias("total"), F.count_if(F.col("value").isNull()).alias("without"), F.round(F.max(v), 4).alias("most"), F.sum(F.length("props")).alias("characters"))


@query("SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def consecutive_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The rows that differ from the one before them in their group."""
    before = F.lag("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("before", before).where("before is null or before <> event_type").select("event_id")


SIX = """row_number() OVER (PARTITION BY batch_no ORDER BY CASE WHEN regexp_matches(title, '(?i)zeroth') THEN 0 ELSE 1 END, CASE parse_status.state WHEN 'complete' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END, len(authors) DESC,
    CAST(left(rpad(regexp_replace(coalesce(source.publication_date, ''), '[^0-9]', '', 'g'), 8, '0'), 8) AS INTEGER) DESC, coalesce(year, 0) DESC, candidate_id)"""


@query(f"SELECT registry_seq, {SIX} AS place FROM openalex_candidate")
def total_order(spark: SparkSession, d: str) -> DataFrame:
    """Six keys down to the id, so that the order is total: mandatory first, decision, score, date digits, year, id."""
    from sieveline.functions.time import sortable_day

    keys = (F.when(F.col("title").rlike("(?i)zeroth"), 0).otherwise(1), F.when(F.col("parse_status.state") == "complete", 0).when(F.col("parse_status.state") == "partial", 1).otherwise(2), F.size("authors").desc(), sortable_day(F.col("source.publication_date")).desc(), F.coalesce("year", F.lit(0)).desc(), "candidate_id")
    return works(spark, d).select("registry_seq", F.row_number().over(W.partitionBy("batch_no").orderBy(*keys)).cast("bigint").alias("place"))


@query("SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY retrieved_at DESC, lower(coalesce(section, '')) DESC, doc_id) AS place FROM documents")
def group_order(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.row_number().over(W.partitionBy("source").orderBy(F.desc("retrieved_at"), F.lower(F.coalesce("section", F.lit(""))).desc(), "doc_id")).cast("bigint").alias("place"))


@query("SELECT registry_seq, query_id FROM (SELECT registry_seq, query_id, row_number() OVER (ORDER BY registry_seq) AS total FROM (SELECT registry_seq, source.query_id AS query_id, row_number() OVER (PARTITION BY source.query_id ORDER BY registry_seq) AS n FROM openalex_candidate) WHERE n <= 10) WHERE total <= 90")
def capped_run(spark: SparkSession, d: str) -> DataFrame:
    """At most 10 of a query and 90 in all, in order. The caps are the operator's result; rows of each query are cut before those of all are ordered."""
    rows = works(spark, d).select("registry_seq", F.col("source.query_id").alias("query_id"))
    return G.capped_run(rows, "query_id", "registry_seq", 10, 90)


@query(
    """WITH c AS (SELECT delivery_seq, list_filter(list_concat([links.primary_url], links.auxiliary_urls, [CASE WHEN identifiers.doi.value IS NOT NULL THEN concat('https://doi.org/', identifiers.doi.value) END]), lambda u: u IS NOT NULL) AS u FROM alert_candidate)
    SELECT delivery_seq, array_to_string(list_slice(list_filter(u, lambda x, i: list_position(u, x) = i), 1, 3), ' ') AS urls FROM c"""
)
def url_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Addresses to try in order of priority, each once, at most three."""
    doi = F.when(F.col("identifiers.doi.value").isNotNull(), F.concat(F.lit("https://doi.org/"), F.col("identifiers.doi.value")))
    every = F.array_compact(F.concat(F.array("links.primary_url"), "links.auxiliary_urls", F.array(doi)))
    return alerts(spark, d).select("delivery_seq", F.array_join(F.slice(F.array_distinct(every), 1, 3), " ").alias("urls"))


@query("SELECT registry_seq, i AS position, name, status FROM (SELECT registry_seq, unnest(generate_series(1, len(authors))) AS i, unnest(list_transform(authors, lambda a: a.name)) AS name, unnest(list_transform(authors, lambda a: a.verification_status)) AS status FROM openalex_candidate)")
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    zipped = works(spark, d).select("registry_seq", F.posexplode(F.arrays_zip(F.col("authors.name").alias("name"), F.col("authors.verification_status").alias("status"))).alias("i", "z"))
    return zipped.select("registry_seq", (F.col("i") + 1).cast("bigint").alias("position"), F.col("z.name").alias("name"), F.col("z.status").alias("status"))


# ---- text pieces -------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, regexp_replace(substr(text, greatest(instr(text, 'sensor') - 60, 1), least(instr(text, 'sensor') - 1, 60) + 66), '\s+', ' ', 'g') AS excerpt FROM documents WHERE instr(text, 'sensor') > 0")
def context_excerpt(spark: SparkSession, d: str) -> DataFrame:
    """60 characters on both sides of the first mention, spaces collapsed."""
    return table(spark, d, "documents").where(F.instr("text", "sensor") > 0).select("doc_id", P.excerpt(F.col("text"), "sensor", 60).alias("excerpt"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, epoch_us(ts) // 1000 AS millis, make_timestamp(epoch_us(ts) // 1000 * 1000) AS back FROM events")
def iso_and_epoch(spark: SparkSession, d: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), millis.alias("millis"), F.timestamp_millis(millis).cast("timestamp_ntz").alias("back"))


@query("SELECT registry_seq, (SELECT string_agg(concat(w, '=', n), ' ' ORDER BY w) FROM (SELECT w, count(*) AS n FROM (SELECT unnest(string_split(normalized_title, ' ')) AS w) GROUP BY w)) AS counts FROM openalex_candidate WHERE normalized_title IS NOT NULL")
def map_by_key(spark: SparkSession, d: str) -> DataFrame:
    """The words of a title with their counts, a map in order of its keys."""
    words = F.split("normalized_title", " ")
    counts = F.map_from_arrays(F.array_distinct(words), F.transform(F.array_distinct(words), lambda w: F.size(F.filter(words, lambda x: x == w))))
    return works(spark, d).where("normalized_title is not null").select("registry_seq", F.array_join(F.transform(P.sorted_entries(counts), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ").alias("counts"))


@query("SELECT delivery_seq, split_part(split_part(title, ': ', 2), ' ', 1) AS after, CASE WHEN instr(raw_metadata_line, ' - ') > 0 AND instr(raw_metadata_line, ', ') > 0 THEN split_part(split_part(raw_metadata_line, ' - ', 2), ', ', 1) END AS inside FROM alert_candidate")
def marker_text(spark: SparkSession, d: str) -> DataFrame:
    """What stands between two markers."""
    line = F.col("raw_metadata_line")
    inside = F.when((F.instr(line, " - ") > 0) & (F.instr(line, ", ") > 0), P.between(line, " - ", ", "))
    return alerts(spark, d).select("delivery_seq", P.between(F.col("title"), ": ", " ").alias("after"), inside.alias("inside"))


@query(
    r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS t, generate_subscripts(string_split(text, chr(10) || chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, i AS paragraph, length(t) AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(t) ORDER BY i) AS k FROM p WHERE length(t) >= 40) WHERE k = 1"""
)
def unique_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of 40 characters and more, each once for its document whatever its case."""
    each = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n\n")).alias("i", "t")).where(F.length("t") >= 40)
    first = each.groupBy("doc_id", F.md5(F.lower("t"))).agg(F.min_by(F.length("t"), "i").alias("n"), (F.min("i") + 1).cast("bigint").alias("paragraph"))
    return first.select("doc_id", "paragraph", F.col("n").cast("bigint").alias("n"))


@query(r"SELECT delivery_seq, nullif(trim(regexp_extract(source.subject, '^New results:\s*(.+)$', 1), ' '), '') AS name, regexp_matches(coalesce(source.subject, ''), '(?i)saved search') AS saved FROM alert_candidate")
def alert_name(spark: SparkSession, d: str) -> DataFrame:
    return alerts(spark, d).select("delivery_seq", F.nullif(F.trim(F.regexp_extract("source.subject", r"^New results:\s*(.+)$", 1)), F.lit("")).alias("name"), F.coalesce("source.subject", F.lit("")).rlike("(?i)saved search").alias("saved"))


@query(r"SELECT delivery_seq, CASE WHEN regexp_matches(a, '^[^@\s<>]+@[^@\s<>]+\.[^@\s<>.]+$') THEN a END AS address FROM (SELECT delivery_seq, lower(trim(CASE WHEN regexp_matches(source.sender, '<[^<>]*>') THEN regexp_extract(source.sender, '<([^<>]*)>', 1) ELSE source.sender END, ' ')) AS a FROM alert_candidate)")
def email_address(spark: SparkSession, d: str) -> DataFrame:
    return alerts(spark, d).select("delivery_seq", P.email_address(F.col("source.sender")).alias("address"))


@query(r"SELECT doc_id, translate(text, '²³', '23') AS plain, translate(text, '²³', '23') <> text AS changed FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '[²³0-9]')")
def unit_glyphs(spark: SparkSession, d: str) -> DataFrame:
    plain = F.translate("text", "²³", "23")
    return table(spark, d, "documents").where(F.col("text").rlike("[²³0-9]")).select("doc_id", plain.alias("plain"), (plain != F.col("text")).alias("changed"))


@query("SELECT delivery_seq, array_to_string(CASE WHEN venue.raw IS NULL OR trim(venue.raw, ' ') IN ('', '-', 'n/a') THEN [] ELSE [venue.raw] END, '|') AS venues, CASE WHEN venue.raw IS NULL OR trim(venue.raw, ' ') IN ('', '-', 'n/a') THEN 0 ELSE 1 END AS n FROM alert_candidate")
def shape_repair(spark: SparkSession, d: str) -> DataFrame:
    """A scalar where a list belongs becomes a list of one; placeholders an empty one."""
    listed = P.as_list(F.col("venue.raw"), ["", "-", "n/a"])
    return alerts(spark, d).select("delivery_seq", F.array_join(listed, "|").alias("venues"), F.size(listed).alias("n"))


@query(r"SELECT delivery_seq, array_to_string(list_filter([CASE WHEN regexp_matches(title, '(?i)^(front|back) cover|^table of contents') THEN 'cover_page' END, CASE WHEN regexp_matches(title, '(…|\.\.\.)\s*$') THEN 'truncated' END, CASE WHEN regexp_matches(title, '^\[(PDF|HTML|BOOK|CITATION)\]') THEN 'direct_document' END, CASE WHEN length(trim(title, ' ')) < 12 THEN 'short' END], lambda x: x IS NOT NULL), ' ') AS warnings FROM alert_candidate")
def title_warnings(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("title")
    rules = {"cover_page": t.rlike("(?i)^(front|back) cover|^table of contents"), "truncated": t.rlike(r"(…|\.\.\.)\s*$"), "direct_document": t.rlike(r"^\[(PDF|HTML|BOOK|CITATION)\]"), "short": F.length(F.trim(t)) < 12}
    return alerts(spark, d).select("delivery_seq", F.array_join(P.flags(rules), " ").alias("warnings"))


NUMBER = r"((?:~|about |approximately )?[0-9]+(?:\.[0-9]+)?\s?(?:percent|%|ms|nm|devices|iterations)?)"


@query(f"SELECT delivery_seq, array_to_string(list_transform(regexp_extract_all(snippet, '{NUMBER}', 1), lambda t: replace(regexp_replace(replace(replace(trim(t, ' '), 'approximately ', '~'), 'about ', '~'), ' ?percent', '%'), ' ', '')), ' ') AS tokens FROM alert_candidate WHERE snippet IS NOT NULL")
def numeric_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with their units in one spelling and a mark of approximation."""
    return alerts(spark, d).where("snippet is not null").select("delivery_seq", F.array_join(P.quantities(F.col("snippet"), NUMBER), " ").alias("tokens"))


@query(
    f"""WITH t AS (SELECT a.delivery_seq, list_distinct(regexp_extract_all(a.snippet, '[0-9]+(?:\\.[0-9]+)?')) AS x, regexp_extract_all(coalesce(o.snippet, ''), '[0-9]+(?:\\.[0-9]+)?') AS y FROM alert_candidate a
    LEFT JOIN (SELECT normalized_title, min_by(snippet, registry_seq) AS snippet FROM openalex_candidate GROUP BY 1) o USING (normalized_title) WHERE a.snippet IS NOT NULL)
    SELECT delivery_seq, array_to_string(list_sort(list_filter(x, lambda v: NOT list_contains(y, v))), ' ') AS ungrounded FROM t"""
)
def strict_grounding(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of a text that its source doesn't hold: the plain set difference."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    # Only the numbers go through the join, not the texts that hold them.
    sources = works(spark, d).groupBy("normalized_title").agg(F.min_by("snippet", "registry_seq").alias("reference")).select("normalized_title", numbers(F.coalesce("reference", F.lit(""))).alias("held"))
    a = alerts(spark, d).where("snippet is not null").select("delivery_seq", "normalized_title", numbers(F.col("snippet")).alias("said"))
    joined = R.salted_lookup(a, sources, "normalized_title", "delivery_seq", "left")
    held = F.coalesce("held", F.array().cast("array<string>"))
    return joined.select("delivery_seq", F.array_join(F.array_sort(F.array_except("said", held)), " ").alias("ungrounded"))


@query("SELECT delivery_seq, source.alert_name IN ('speckle imaging', 'saved search', 'optical zeroth-order') AS scored_only, list_contains(parse_status.warnings, 'missing_year') AS flagged FROM alert_candidate WHERE source.alert_name IS NOT NULL")
def membership_filters(spark: SparkSession, d: str) -> DataFrame:
    return alerts(spark, d).where("source.alert_name is not null").select("delivery_seq", F.col("source.alert_name").isin("speckle imaging", "saved search", "optical zeroth-order").alias("scored_only"), F.array_contains("parse_status.warnings", "missing_year").alias("flagged"))


# ---- nested values and rules -------------------------------------------------------------------------------------

LEAF = "SELECT delivery_seq, '{0}' AS path, {1} AS value FROM alert_candidate"
LEAVES = " UNION ALL ".join([LEAF.format(f"identifiers.{i}.{f}", f"identifiers.{i}.{f}") for i in ("doi", "arxiv_id", "pmid") for f in ("value", "verification_status", "source")] + [LEAF.format(f"venue.{f}", f"venue.{f}") for f in ("raw", "normalized", "verification_status")])
NAMES = "SELECT delivery_seq, concat('authors[', i - 1, '].', f) AS path, v AS value FROM (SELECT delivery_seq, unnest(generate_series(1, len(authors))) AS i, unnest(authors) AS a FROM alert_candidate) CROSS JOIN (VALUES ('name'), ('orcid'), ('verification_status')) n(f) CROSS JOIN LATERAL (SELECT CASE f WHEN 'name' THEN a.name WHEN 'orcid' THEN a.orcid ELSE a.verification_status END AS v)"


def nested(spark: SparkSession, d: str) -> DataFrame:
    doc = F.to_json(F.struct("identifiers", "venue", "authors"))
    return alerts(spark, d).select("delivery_seq", F.explode(P.leaves(doc)).alias("leaf")).select("delivery_seq", "leaf.path", "leaf.value")


@query(f"SELECT * FROM ({LEAVES} UNION ALL {NAMES}) WHERE value IS NOT NULL")
def nested_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Every string leaf of nested values with its path."""
    return nested(spark, d)


@query(f"SELECT delivery_seq, count(*) AS n FROM ({LEAVES} UNION ALL {NAMES}) WHERE value = 'missing' GROUP BY 1")
def sentinel_count(spark: SparkSession, d: str) -> DataFrame:
    """How often a sentinel stands in a nested value."""
    return nested(spark, d).where("value = 'missing'").groupBy("delivery_seq").agg(F.count("*").alias("n"))


@query(
    r"""WITH l AS (SELECT delivery_seq, 'title' AS path, title AS t, snippet AS s FROM alert_candidate UNION ALL SELECT delivery_seq, 'raw_metadata_line', raw_metadata_line, snippet FROM alert_candidate),
    n AS (SELECT delivery_seq, path, t, s, unnest(list_distinct(regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)?'))) AS number FROM l WHERE t IS NOT NULL)
    SELECT delivery_seq, path, number, regexp_replace(substr(t, greatest(instr(t, number) - 20, 1), least(instr(t, number) - 1, 20) + length(number) + 20), '\s+', ' ', 'g') AS excerpt FROM n WHERE NOT list_contains(regexp_extract_all(coalesce(s, ''), '[0-9]+(?:\.[0-9]+)?'), number)"""
)
def grounding_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Numbers that the snippet doesn't hold, with the field they stand in and what is around them."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("path"), F.col(c).alias("t")) for c in ("title", "raw_metadata_line"))))
    each = alerts(spark, d).select("delivery_seq", "snippet", fields.alias("f")).select("delivery_seq", "snippet", "f.path", "f.t").where("t is not null")
    odd = each.withColumn("number", F.explode(F.array_except(numbers(F.col("t")), numbers(F.coalesce("snippet", F.lit(""))))))
    at = F.expr("instr(t, number)")
    before = F.least(at - 1, F.lit(20))
    return odd.select("delivery_seq", "path", "number", F.regexp_replace(F.substring(F.col("t"), at - before, before + F.length("number") + 20), r"\s+", " ").alias("excerpt"))


@query(
    """WITH t AS (SELECT delivery_seq, source.source_type AS s, concat_ws(' ', title, snippet) AS x FROM alert_candidate)
    SELECT delivery_seq, array_to_string(list_filter([CASE WHEN regexp_matches(x, '(?i)on-chip|in-situ') THEN 'hardware' END, CASE WHEN regexp_matches(x, '(?i)zeroth|gradient-free') THEN 'zeroth' END], lambda v: v IS NOT NULL), ' ') AS features,
    round(CASE WHEN regexp_matches(x, '(?i)on-chip|in-situ') THEN 0.25 ELSE 0 END + CASE WHEN regexp_matches(x, '(?i)zeroth|gradient-free') THEN 0.5 ELSE 0 END, 6)::DOUBLE AS weight,
    regexp_matches(x, '(?i)review|survey') AS negative, regexp_matches(x, '(?i)zeroth') AND s LIKE '%email%' AS mandatory FROM t"""
)
def priority_features(spark: SparkSession, d: str) -> DataFrame:
    """Features with weights; negative patterns are recorded and veto nothing; an override holds for one kind of source only."""
    x = F.concat_ws(" ", "title", "snippet")
    rules = {"hardware": (x.rlike("(?i)on-chip|in-situ"), 0.25), "zeroth": (x.rlike("(?i)zeroth|gradient-free"), 0.5)}
    weight = sum((F.when(r, w).otherwise(0.0) for r, w in rules.values()), F.lit(0.0))
    return alerts(spark, d).select("delivery_seq", F.array_join(P.flags({n: r for n, (r, _) in rules.items()}), " ").alias("features"), F.round(weight, 6).alias("weight"), x.rlike("(?i)review|survey").alias("negative"), (x.rlike("(?i)zeroth") & F.col("source.source_type").like("%email%")).alias("mandatory"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def prefix_json(spark: SparkSession, d: str) -> DataFrame:
    """The value that begins a text, whatever stands after it."""
    text = F.concat(F.lit(" "), "props", F.lit(" and what follows }"))
    return table(spark, d, "events").select("event_id", F.get_json_object(P.json_prefix(text), "$.k").cast("bigint").alias("k"))
