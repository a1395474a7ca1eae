"""Queries of the general operators over the literature tables and the star schema, each with its SQL.

Result columns are flat: arrays are joined to strings, and doubles are rounded. NOW is a parameter everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sieveline.functions import text as X
from sieveline.functions import time as TM
from sieveline.operators import incremental as I
from sieveline.operators import manifest as M
from sieveline.operators import resolve as R
from sieveline.operators import rules as RU
from sieveline.operators import score as S
from sieveline.operators import select as SE
from sieveline.operators import textops as TX
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


def now():
    return F.lit(NOW).cast("timestamp")


# ---- projections -------------------------------------------------------------------------------------------------

MATCHABLE = r"trim(regexp_replace(translate(lower({0}), '–—−', '---'), '\s+', ' ', 'g'), ' ')"
UNPUNCTUATED = r"trim(regexp_replace(regexp_replace(" + MATCHABLE + r", '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'), ' ')"


@query("SELECT delivery_seq, title, year FROM alert_candidate WHERE year >= 2020 AND parse_status.state = 'complete' AND length(title) > 60")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").where("year >= 2020 and parse_status.state = 'complete' and length(title) > 60").select("delivery_seq", "title", "year")


@query(f"SELECT delivery_seq, {MATCHABLE.format('title')} AS matchable, {UNPUNCTUATED.format('title')} AS unpunctuated FROM alert_candidate")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").select("delivery_seq", X.matchable(F.col("title")).alias("matchable"), X.unpunctuated(F.col("title")).alias("unpunctuated"))


@query(
    r"SELECT delivery_seq, trim(regexp_replace(regexp_replace(title, '(?i)^\s*(\[(pdf|html|citation|book|doc)\]\s*)+', ''), '\s+', ' ', 'g'), ' ') AS clean, "
    + UNPUNCTUATED.format(r"regexp_replace(trim(lower(title), ' '), '^(19|20)[0-9]{{2}}\s*[-_:]\s*', '')")
    + " AS title_key FROM alert_candidate"
)
def normalize_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").select("delivery_seq", X.clean_title(F.col("title")).alias("clean"), X.normal_title(F.col("title")).alias("title_key"))


VENUE_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(" + MATCHABLE + r", '…|\.\.\.|&', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), '\s+', ' ', 'g'), ' ')"


@query(f"SELECT delivery_seq, {VENUE_KEY.format('venue.raw')} AS venue_key FROM alert_candidate WHERE venue.raw IS NOT NULL")
def normalize_venue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").where("venue.raw is not null").select("delivery_seq", X.normal_venue(F.col("venue.raw")).alias("venue_key"))


DOI_KEY = r"nullif(regexp_replace(regexp_replace(lower(trim({0}, ' ')), '^(https?://(dx\.)?doi\.org/|doi:\s*)', ''), '[.,;:)\]}}]+$', ''), '')"


@query(f"SELECT registry_seq, {DOI_KEY.format('identifiers.doi.value')} AS doi_key FROM openalex_candidate")
def identifier_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "openalex_candidate").select("registry_seq", X.doi_key(F.col("identifiers.doi.value")).alias("doi_key"))


@query(
    r"""SELECT delivery_seq, CASE WHEN title_hit IS NOT NULL THEN 'title' WHEN snippet_hit IS NOT NULL THEN 'snippet' WHEN url_hit IS NOT NULL THEN 'url' END AS source,
    coalesce(title_hit, snippet_hit, url_hit) AS doi FROM (SELECT delivery_seq, nullif(regexp_extract(title, '10\.[0-9]{4,9}/[0-9a-z.]+', 0), '') AS title_hit,
    nullif(regexp_extract(snippet, '10\.[0-9]{4,9}/[0-9a-z.]+', 0), '') AS snippet_hit, nullif(regexp_extract(links.primary_url, '10\.[0-9]{4,9}/[0-9a-z.]+', 0), '') AS url_hit FROM alert_candidate)
    WHERE coalesce(title_hit, snippet_hit, url_hit) IS NOT NULL"""
)
def identifier_first_field(spark: SparkSession, d: str) -> DataFrame:
    p = r"10\.[0-9]{4,9}/[0-9a-z.]+"
    hit = RU.first_match({"title": F.col("title"), "snippet": F.col("snippet"), "url": F.col("links.primary_url")}, p).alias("e")
    return table(spark, d, "alert_candidate").select("delivery_seq", hit).where("e is not null").select("delivery_seq", F.col("e.field").alias("source"), F.col("e.matched_text").alias("doi"))


@query(
    r"""SELECT delivery_seq, substr(sha256(concat_ws(':', source.message_id, CAST(position_in_message AS VARCHAR))), 1, 24) AS id,
    sha256(concat(coalesce(title, ''), '|', coalesce(CAST(year AS VARCHAR), ''), '|', coalesce(venue.raw, ''))) AS fingerprint FROM alert_candidate"""
)
def fingerprint_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").select("delivery_seq", X.record_id(F.col("source.message_id"), F.col("position_in_message").cast("string")).alias("id"), X.fingerprint(F.col("title"), F.col("year"), F.col("venue.raw")).alias("fingerprint"))


@query(r"SELECT delivery_seq, CASE WHEN regexp_matches(links.primary_url, '^https?://') THEN split_part(split_part(links.primary_url, '#', 1), '?', 1) END AS url, lower(regexp_extract(links.primary_url, '^https?://([^/?#:]+)', 1)) AS host FROM alert_candidate")
def url_canonicalize(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("links.primary_url")
    return table(spark, d, "alert_candidate").select("delivery_seq", X.clean_url(u).alias("url"), X.host(u).alias("host"))


@query("SELECT h LIKE '%.example' AS known, count(*) AS n FROM (SELECT regexp_extract(links.primary_url, '^https?://([^/?#:]+)', 1) AS h FROM alert_candidate WHERE links.primary_url IS NOT NULL) GROUP BY 1")
def host_suffix_class(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").where("links.primary_url is not null").select(X.host_in(X.host(F.col("links.primary_url")), ["example"]).alias("known")).groupBy("known").agg(F.count("*").alias("n"))


@query(r"SELECT mention_id, nullif(regexp_replace(regexp_extract(trim(lower(name), ' '), '(\S+)$', 1), '[^\p{L}\p{N}]', '', 'g'), '') AS author_key FROM optical_zo")
def author_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "optical_zo").select("mention_id", X.author_key(F.col("name")).alias("author_key"))


@query(
    r"""WITH s AS (SELECT delivery_seq, regexp_extract(raw_metadata_line, '^(.*) [-–] (.*)$', 2) AS r, regexp_extract(raw_metadata_line, '^(.*) [-–] (.*)$', 1) AS l FROM alert_candidate WHERE raw_metadata_line IS NOT NULL)
    SELECT delivery_seq, len(string_split_regex(regexp_replace(l, '…$', ''), ',\s*')) AS n_names, nullif(regexp_replace(trim(regexp_replace(r, ',?\s*(19|20)[0-9]{2}\s*$', ''), ' '), ',$', ''), '') AS venue,
    TRY_CAST(regexp_extract_all(r, '\b((?:19|20)[0-9]{2})\b', 1)[-1] AS INTEGER) AS year FROM s"""
)
def metadata_split(spark: SparkSession, d: str) -> DataFrame:
    parts = X.split_metadata(F.col("raw_metadata_line"))
    return table(spark, d, "alert_candidate").where("raw_metadata_line is not null").select("delivery_seq", F.size(parts["names"]).cast("bigint").alias("n_names"), parts["venue"].alias("venue"), parts["year"].alias("year"))


@query(
    """SELECT registry_seq, array_to_string(list_filter([array_to_string(list_filter(list_slice(list_transform(authors, lambda a: a.name), 1, 8), lambda n: n IS NOT NULL AND trim(n, ' ') <> ''), ', '),
    array_to_string(list_filter([nullif(trim(venue.raw, ' '), ''), CAST(year AS VARCHAR)], lambda v: v IS NOT NULL), ', ')], lambda v: v <> ''), ' - ') AS line FROM openalex_candidate"""
)
def metadata_line(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "openalex_candidate").select("registry_seq", X.metadata_line(F.col("authors.name"), F.col("venue.raw"), F.col("year")).alias("line"))


@query("SELECT doc_id, length(regexp_replace(text, '[^㐀-䶿一-鿿]', '', 'g')) AS n_han FROM documents WHERE text IS NOT NULL")
def han_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", X.han_count(F.col("text")).cast("bigint").alias("n_han"))


@query(
    """SELECT registry_seq, coalesce(TRY_CAST(substr(rpad(regexp_replace(source.publication_date, '[^0-9]', '', 'g'), 8, '0'), 1, 8) AS INTEGER), 0) AS sort_day,
    CASE WHEN regexp_matches(source.publication_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(substr(source.publication_date, 1, 10) AS DATE) IS NOT NULL THEN greatest(0, DATE '2026-08-04' - CAST(substr(source.publication_date, 1, 10) AS DATE))
    WHEN year IS NOT NULL THEN greatest(0, DATE '2026-08-04' - make_date(year, 1, 1)) END AS age FROM openalex_candidate"""
)
def freshness(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("source.publication_date")
    return table(spark, d, "openalex_candidate").select("registry_seq", TM.sortable_day(p).alias("sort_day"), TM.age_days(p, F.col("year"), now()).cast("bigint").alias("age"))


@query(
    """SELECT o_orderkey, CASE WHEN m BETWEEN 1 AND 12 THEN CASE WHEN TRY_CAST(printf('%04d-%02d-%02d', y, m, dd) AS DATE) IS NOT NULL THEN printf('%04d-%02d-%02d', y, m, dd) ELSE printf('%04d-%02d', y, m) END ELSE printf('%04d', y) END AS partial
    FROM (SELECT o_orderkey, year(o_orderdate) AS y, CAST(month(o_orderdate) + o_orderkey % 3 AS BIGINT) AS m, CAST(day(o_orderdate) + o_orderkey % 5 AS BIGINT) AS dd FROM orders)"""
)
def partial_date_degrade(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select("o_orderkey", TM.partial_date(F.year("o_orderdate"), F.month("o_orderdate") + F.col("o_orderkey") % 3, F.dayofmonth("o_orderdate") + F.col("o_orderkey") % 5).alias("partial"))


# ---- rules, routes, scores ---------------------------------------------------------------------------------------

PRECISE, SUPPORT, CONTEXT = ["holographic", "interferometric", "single-photon"], ["neurons", "perceptrons", "networks"], ["training", "optimization", "tuning"]


def fields() -> dict:
    return {"title": F.col("title"), "snippet": F.col("snippet")}


def first_field(p: str) -> str:
    return f"CASE WHEN regexp_matches(title, '(?i){p}') THEN 'title' WHEN regexp_matches(snippet, '(?i){p}') THEN 'snippet' END"


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT delivery_seq, '{p}' AS pattern, {first_field(p)} AS field, CASE WHEN regexp_matches(title, '(?i){p}') THEN regexp_extract(title, '(?i)({p})', 1) ELSE regexp_extract(snippet, '(?i)({p})', 1) END AS matched FROM alert_candidate" for p in PRECISE) + ") WHERE field IS NOT NULL")
def rule_first_match(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "alert_candidate").select("delivery_seq", F.explode(RU.first_matches(fields(), PRECISE)).alias("e"))
    return e.select("delivery_seq", F.col("e.pattern").alias("pattern"), F.col("e.field").alias("field"), F.col("e.matched_text").alias("matched"))


def any_of(patterns: list[str], columns: tuple[str, ...] = ("title", "snippet")) -> str:
    return "(" + " OR ".join(f"coalesce(regexp_matches({c}, '(?i){'|'.join(patterns)}'), false)" for c in columns) + ")"


LEVEL = f"CASE WHEN {any_of(PRECISE, ('title',))} THEN 'confirmed' WHEN {any_of(PRECISE)} OR ({any_of(SUPPORT)} AND {any_of(CONTEXT)}) THEN 'probable' WHEN {any_of(SUPPORT)} THEN 'uncertain' ELSE 'none' END"


def level():
    return RU.confidence(RU.first_matches(fields(), PRECISE), RU.first_matches(fields(), SUPPORT), RU.first_matches(fields(), CONTEXT))


@query(f"SELECT delivery_seq, {LEVEL} AS level FROM alert_candidate")
def classify_confidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "alert_candidate").select("delivery_seq", level().alias("level"))


@query(
    f"""SELECT delivery_seq, CASE WHEN state <> 'complete' THEN 'review' WHEN level = 'confirmed' THEN 'first' WHEN level = 'none' THEN 'archive' WHEN level = 'uncertain' THEN 'review' WHEN no_venue THEN 'enrich' ELSE 'standard' END AS route,
    CASE WHEN state <> 'complete' THEN 'parser' WHEN level = 'confirmed' THEN 'confirmed' WHEN level = 'none' THEN 'no_match' WHEN level = 'uncertain' THEN 'uncertain' WHEN no_venue THEN 'missing_venue' ELSE 'match' END AS reason
    FROM (SELECT delivery_seq, parse_status.state AS state, {LEVEL} AS level, coalesce(trim(venue.raw, ' '), '') = '' AS no_venue FROM alert_candidate)"""
)
def route_precedence(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "alert_candidate").select("delivery_seq", F.col("parse_status.state").alias("state"), level().alias("level"), (F.coalesce(F.trim("venue.raw"), F.lit("")) == "").alias("no_venue"))
    lv = F.col("level")
    r = RU.route([(F.col("state") != "complete", "review", "parser"), (lv == "confirmed", "first", "confirmed"), (lv == "none", "archive", "no_match"), (lv == "uncertain", "review", "uncertain"), (F.col("no_venue"), "enrich", "missing_venue")], ("standard", "match"))
    return rows.select("delivery_seq", r.alias("r")).select("delivery_seq", "r.route", "r.reason")


TIERS = [("one", ["annals of chromatic signal theory", "letters in quantal devices and control"]), ("two", ["advances in quantal devices and control", "reviews of zeroth gradient methods"])]


@query(
    f"WITH v AS (SELECT delivery_seq, {VENUE_KEY.format('venue.raw')} AS k, (venue.raw LIKE '%…%' OR venue.raw LIKE '%...%' OR rtrim(venue.raw, ' ') LIKE '%&') AS marked FROM alert_candidate WHERE venue.raw IS NOT NULL) SELECT delivery_seq, CASE "
    + " ".join(f"WHEN {' OR '.join(f'''k = '{e}' OR (marked AND length(k) >= 7 AND starts_with('{e}', k))''' for e in es)} THEN '{t}'" for t, es in TIERS)
    + " ELSE 'unresolved' END AS tier FROM v"
)
def tier_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "alert_candidate").where("venue.raw is not null")
    return rows.select("delivery_seq", RU.tier_of(X.normal_venue(F.col("venue.raw")), TIERS, F.col("venue.raw")).alias("tier"))


def contributions() -> dict:
    return {
        "level": F.when(F.col("level") == "confirmed", 0.4).when(F.col("level") == "probable", 0.25).otherwise(0.0),
        "abstract": F.when(F.col("snippet").isNotNull(), 0.1),
        "venue_and_year": F.when(F.coalesce(F.trim("venue.raw"), F.lit("")) != "", 0.05) + F.when(F.col("year").isNotNull(), 0.05).otherwise(0.0),
        "fresh": F.when(F.col("year") >= 2025, 0.2).when(F.col("year") >= 2022, 0.1).otherwise(0.0),
        "incomplete": F.when(F.col("parse_status.state") != "complete", -0.15).otherwise(0.0),
    }


SCORED = f"""SELECT delivery_seq, year, mandatory, round(greatest(0, least(1, c1 + c2 + c3 + c4 + c5)), 6) AS score, c1, c2, c3, c4, c5 FROM (SELECT delivery_seq, year, parse_status.state = 'complete' AND source.alert_name = 'saved search' AS mandatory,
  CASE {LEVEL} WHEN 'confirmed' THEN 0.4::DOUBLE WHEN 'probable' THEN 0.25 ELSE 0 END AS c1, CASE WHEN snippet IS NOT NULL THEN 0.1::DOUBLE ELSE 0 END AS c2,
  CASE WHEN coalesce(trim(venue.raw, ' '), '') <> '' THEN 0.05::DOUBLE + CASE WHEN year IS NOT NULL THEN 0.05::DOUBLE ELSE 0 END ELSE 0 END AS c3,
  CASE WHEN year >= 2025 THEN 0.2::DOUBLE WHEN year >= 2022 THEN 0.1 ELSE 0 END AS c4, CASE WHEN parse_status.state <> 'complete' THEN -0.15::DOUBLE ELSE 0 END AS c5 FROM alert_candidate)"""


def scored(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "alert_candidate").withColumn("level", level())
    mandatory = F.coalesce((F.col("parse_status.state") == "complete") & (F.col("source.alert_name") == "saved search"), F.lit(False))
    return rows.select("delivery_seq", "year", mandatory.alias("mandatory"), S.breakdown(contributions()).alias("parts")).withColumn("score", S.folded(F.col("parts")))


@query(f"SELECT delivery_seq, CASE WHEN coalesce(mandatory, false) THEN greatest(score, 0.85) ELSE score END AS score, CASE WHEN coalesce(mandatory, false) THEN 'mandatory' WHEN score >= 0.7 THEN 'summarize' WHEN score >= 0.5 THEN 'retain' ELSE 'archive' END AS decision FROM ({SCORED})")
def explainable_score(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    verdict = F.when(F.col("mandatory"), "mandatory").otherwise(S.decision(F.col("score"), [(0.7, "summarize"), (0.5, "retain")], "archive"))
    return s.select("delivery_seq", S.overridden(F.col("score"), F.col("mandatory"), 0.85).alias("score"), verdict.alias("decision"))


@query(f"SELECT * FROM ({' UNION ALL '.join(f'''SELECT delivery_seq, '{n}' AS feature, round(c{i}, 6) AS contribution FROM ({SCORED})''' for i, n in enumerate(('level', 'abstract', 'venue_and_year', 'fresh', 'incomplete'), 1))}) WHERE contribution <> 0")
def score_breakdown_long(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select("delivery_seq", F.explode("parts").alias("p")).select("delivery_seq", "p.feature", "p.contribution")


# ---- selection ---------------------------------------------------------------------------------------------------

LIMITS = [("summary_slot", 3), ("candidate", 5), ("retained", 10)]


@query("SELECT o_orderkey, rank, CASE WHEN rank <= 3 THEN 'summary_slot' WHEN rank <= 5 THEN 'candidate' ELSE 'retained' END AS status FROM (SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 10")
def budget_cascade(spark: SparkSession, d: str) -> DataFrame:
    return SE.cascade(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), [F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")], LIMITS).select("o_orderkey", "rank", "status")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 10)")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    chosen = SE.cascade(o.select("o_orderkey", "o_orderpriority", "o_totalprice"), [F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")], LIMITS)
    return SE.carried_forward(o, chosen, "o_orderkey", F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


@query("SELECT doc_id, source, turn FROM (SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS turn FROM documents) ORDER BY turn, source LIMIT 30")
def round_robin_sample(spark: SparkSession, d: str) -> DataFrame:
    return SE.round_robin(table(spark, d, "documents").select("doc_id", "source"), "source", [F.col("doc_id")], 30).select("doc_id", "source", "turn")


@query("SELECT doc_id FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1 OR text IS NULL")
def dedup_first_occurrence(spark: SparkSession, d: str) -> DataFrame:
    return SE.first_of(table(spark, d, "documents").select("doc_id", "text"), F.md5("text"), "doc_id").select("doc_id")


# ---- joins and counts --------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON n_nationkey = c_nationkey")
def join_inner_left(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = table(spark, d, "orders").select("o_orderkey", "o_custkey"), table(spark, d, "customer"), table(spark, d, "nation").where("n_regionkey = 1")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query("SELECT candidate_id, 'right' AS only_in FROM openalex_candidate WHERE candidate_id NOT IN (SELECT candidate_id FROM documents WHERE candidate_id IS NOT NULL)")
def set_equality_check(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("candidate_id is not null")
    return M.set_difference(docs, table(spark, d, "openalex_candidate"), "candidate_id")


@query("SELECT candidate_id, count(*) AS n FROM alert_candidate GROUP BY 1 HAVING count(*) > 1 OR candidate_id IS NULL")
def key_violations(spark: SparkSession, d: str) -> DataFrame:
    return M.key_violations(table(spark, d, "alert_candidate"), "candidate_id")


KINDS = ["view", "click", "purchase", "signup", "never"]


@query("SELECT t.event_type, w.weekday, count(e.event_id) AS n FROM (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('never')) t(event_type) CROSS JOIN (SELECT CAST(range AS INTEGER) AS weekday FROM range(7)) w LEFT JOIN (SELECT event_id, event_type, CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events) e USING (event_type, weekday) GROUP BY 1, 2")
def zero_filled_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.zero_filled(table(spark, d, "events").select("event_type", F.weekday("ts").alias("weekday")), {"event_type": KINDS, "weekday": list(range(7))})


@query("SELECT w AS token, count(*) AS n FROM (SELECT unnest(string_split(normalized_title, ' ')) AS w FROM openalex_candidate) WHERE w <> '' GROUP BY 1 ORDER BY n DESC, w LIMIT 25")
def exploded_counts(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "openalex_candidate").select(F.explode(F.split("normalized_title", " ")).alias("token")).where("token <> ''")
    return t.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(25)


@query("SELECT combination, count(*) AS n FROM (SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), '+') AS combination FROM events GROUP BY 1) GROUP BY 1")
def combination_counts(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "+").alias("combination"))
    return u.groupBy("combination").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS r FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1, 2)) WHERE r = 1")
def mode_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return R.mode_first_seen(table(spark, d, "events"), "user_id", "event_type", "event_id").select("user_id", "event_type", "n")


@query("SELECT l_returnflag, round(sum(CASE WHEN l_discount = 0 AND l_tax = 0 THEN l_quantity * 3.0 ELSE l_discount * 0.025 + l_tax * 3.0 + l_quantity * 6.0 END), 2) AS cost, count(*) AS n FROM lineitem GROUP BY 1")
def usage_cost_model(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    cost = F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.col("l_quantity") * 3.0).otherwise(F.col("l_discount") * 0.025 + F.col("l_tax") * 3.0 + F.col("l_quantity") * 6.0)
    return li.groupBy("l_returnflag").agg(F.round(F.sum(cost), 2).alias("cost"), F.count("*").alias("n"))


@query("SELECT l_orderkey, min(l_returnflag) = max(l_returnflag) AS agree, count(*) AS n FROM lineitem GROUP BY 1")
def categorical_agreement(spark: SparkSession, d: str) -> DataFrame:
    return TX.agreement(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("SELECT source, count(*) AS n, count(*) FILTER (text IS NULL) AS missing, count(*) FILTER (trim(text, ' ') = '') AS blank, count(*) FILTER (length(text) >= 1000) AS long, count(*) FILTER (regexp_matches(text, '[0-9]')) AS numeric FROM documents GROUP BY 1")
def quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("missing"), F.count_if(F.trim("text") == "").alias("blank"), F.count_if(F.length("text") >= 1000).alias("long"), F.count_if(F.col("text").rlike("[0-9]")).alias("numeric"))


@query("WITH f AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) SELECT source, count(*) AS raw, count(*) FILTER (text IS NULL) AS invalid, count(*) FILTER (text IS NOT NULL AND n > 1) AS duplicate, count(*) FILTER (n = 1 AND text IS NOT NULL AND (lang IS NULL OR lang <> 'en')) AS filtered, count(*) FILTER (n = 1 AND text IS NOT NULL AND lang = 'en') AS accepted FROM f GROUP BY 1")
def disposition_counters(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", F.md5("text").alias("digest"))
    first = docs.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("first"))
    what = F.when(F.col("digest").isNull(), "invalid").when(F.col("first").isNull(), "duplicate").when(F.col("lang").isNull() | (F.col("lang") != "en"), "filtered").otherwise("accepted")
    return M.dispositions(docs.join(first, "doc_id", "left"), "source", what, ["invalid", "duplicate", "filtered", "accepted"])


@query(
    """WITH l AS (SELECT doc_id, source, sha256(concat(CAST(doc_id AS VARCHAR), '|', coalesce(text, ''))) AS d FROM documents),
    a AS (SELECT source, doc_id // 4096 AS b, sha256(string_agg(d, chr(10) ORDER BY doc_id)) AS d, count(*) AS n FROM l GROUP BY 1, 2),
    c AS (SELECT source, b // 4096 AS c, sha256(string_agg(d, chr(10) ORDER BY b)) AS d, sum(n) AS n FROM a GROUP BY 1, 2)
    SELECT source, sha256(string_agg(d, chr(10) ORDER BY c)) AS digest, CAST(sum(n) AS BIGINT) AS n_lines FROM c GROUP BY 1"""
)
def artifact_digest(spark: SparkSession, d: str) -> DataFrame:
    return M.digest(table(spark, d, "documents"), "source", F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.coalesce("text", F.lit(""))), "doc_id")


# ---- entities ----------------------------------------------------------------------------------------------------


def keyed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "openalex_candidate")
    title_year = F.when(F.length("normalized_title") >= 24, F.concat_ws("|", F.col("normalized_title"), F.col("year").cast("string")))
    return R.identity_keys(rows, "registry_seq", {"doi": X.doi_key(F.col("identifiers.doi.value")), "work": F.lower(X.last_segment(F.col("source.work_id"))), "title_year": F.when(F.col("year").isNotNull(), title_year), "fingerprint": F.col("content_fingerprint")})


KEYED = f"""SELECT registry_seq AS seq, unnest(list_filter(['doi:' || {DOI_KEY.format('identifiers.doi.value')}, 'work:' || lower(regexp_extract(rtrim(source.work_id, '/'), '([^/]*)$', 1)),
  CASE WHEN year IS NOT NULL AND length(normalized_title) >= 24 THEN 'title_year:' || normalized_title || '|' || year END, 'fingerprint:' || content_fingerprint], lambda k: k IS NOT NULL)) AS key FROM openalex_candidate"""


@query(KEYED)
def identity_keys(spark: SparkSession, d: str) -> DataFrame:
    return keyed(spark, d)


COMPONENTS = f"""WITH RECURSIVE k AS MATERIALIZED ({KEYED}), star AS MATERIALIZED (SELECT key, min(seq) AS hub FROM k GROUP BY 1 HAVING count(*) > 1), e AS MATERIALIZED (SELECT DISTINCT k.seq AS a, hub AS b FROM k JOIN star USING (key) WHERE seq <> hub),
  both_ways AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT DISTINCT seq, seq AS g FROM k UNION SELECT both_ways.b, r.g FROM r JOIN both_ways ON both_ways.a = r.seq) SELECT seq, min(g) AS entity FROM r GROUP BY 1"""


@query(COMPONENTS)
def entity_components(spark: SparkSession, d: str) -> DataFrame:
    return R.entities(keyed(spark, d))


def members(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "openalex_candidate").select(F.col("registry_seq").alias("seq"), "candidate_id", "title", F.col("venue.raw").alias("venue"), F.col("venue.verification_status").alias("status"), "year", F.col("source.query_id").alias("query_id"))
    return rows.join(R.entities(keyed(spark, d)), "seq")


STATUS = "CASE status WHEN 'metadata_verified' THEN 4 WHEN 'doi_extracted' THEN 3 WHEN 'parser_extracted' THEN 2 ELSE 1 END"


@query(
    f"""WITH m AS (SELECT c.*, r.entity FROM (SELECT registry_seq AS seq, candidate_id, title, venue.raw AS venue, venue.verification_status AS status, year, source.query_id AS query_id FROM openalex_candidate) c JOIN ({COMPONENTS}) r USING (seq))
    SELECT entity, arg_max(title, (length(title), -seq)) AS title, arg_max(venue, (CASE WHEN venue IS NULL THEN 0 ELSE {STATUS} END, -seq)) FILTER (venue IS NOT NULL) AS venue, array_to_string(list_sort(list(DISTINCT query_id)), '+') AS queries, count(*) AS members FROM m GROUP BY 1"""
)
def survivorship_merge(spark: SparkSession, d: str) -> DataFrame:
    m = members(spark, d)
    rank = F.when(F.col("venue").isNotNull(), F.expr(STATUS)).otherwise(0)
    merged = R.survived(m, "entity", "seq", {"title": F.length("title"), "venue": rank})
    queries = m.groupBy("entity").agg(F.array_join(F.array_sort(F.collect_set("query_id")), "+").alias("queries"))
    return merged.join(queries, "entity").select("entity", "title", "venue", "queries", "members")


@query(f"SELECT c.candidate_id AS alias, k.candidate_id AS canonical FROM ({COMPONENTS}) r JOIN openalex_candidate c ON c.registry_seq = r.seq JOIN openalex_candidate k ON k.registry_seq = r.entity WHERE r.seq <> r.entity")
def alias_map(spark: SparkSession, d: str) -> DataFrame:
    m = members(spark, d).select("seq", "entity", "candidate_id")
    canonical = m.where("seq = entity").select("entity", F.col("candidate_id").alias("canonical"))
    return m.where("seq <> entity").join(canonical, "entity").select(F.col("candidate_id").alias("alias"), "canonical")


@query("SELECT a.o_custkey, count(*) AS n_pairs FROM (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders) a JOIN (SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders) b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus AND abs(a.day - b.day) <= 1 AND a.o_orderkey < b.o_orderkey GROUP BY 1")
def band_self_join(spark: SparkSession, d: str) -> DataFrame:
    """Days become bins, and a row meets only its own and the next bin: an equi-join with a residual, no product of a block."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus", F.unix_date(F.to_date("o_orderdate")).alias("day"), "o_orderkey")
    a = o.select("o_custkey", "o_orderstatus", F.col("day").alias("da"), F.col("o_orderkey").alias("ka"), F.explode(F.array("day", F.col("day") + 1)).alias("db"))
    b = o.select("o_custkey", "o_orderstatus", F.col("day").alias("db"), F.col("o_orderkey").alias("kb"))
    pairs = a.join(b, ["o_custkey", "o_orderstatus", "db"]).where((F.col("da") < F.col("db")) | (F.col("ka") < F.col("kb")))
    return pairs.groupBy("o_custkey").agg(F.count("*").alias("n_pairs"))


# ---- incremental -------------------------------------------------------------------------------------------------


@query("SELECT CAST(ts + INTERVAL 8 HOURS AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def local_day_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(TM.local_day(F.col("ts")).alias("day")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS run FROM events WHERE ts < TIMESTAMP '2024-01-25'")
def overlap_window_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Two runs; the second polls seven days more than it needs and drops what the first has seen."""
    e = table(spark, d, "events").select("event_id", "ts")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    one = e.where(F.col("ts") < at("2024-01-15"))
    two = I.overlap_run(e, one, "event_id", "ts", at("2024-01-08"), at("2024-01-25"))
    return one.select("event_id", F.lit(1).alias("run")).unionAll(two.select("event_id", F.lit(2).alias("run")))


@query("WITH c AS (SELECT user_id, event_id, ts, value FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND ts + INTERVAL 7 DAYS > TIMESTAMP '2024-01-20'), l AS (SELECT user_id, max((ts, event_id)) AS m FROM c GROUP BY 1) SELECT c_custkey AS user_id, l.user_id IS NOT NULL AS hit, l.m[2] AS event_id FROM customer LEFT JOIN l ON l.user_id = c_custkey")
def ttl_cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    at = F.lit("2024-01-20").cast("timestamp_ntz")
    e = table(spark, d, "events").select("user_id", "event_id", "ts").withColumn("version", F.struct("ts", "event_id"))
    cache = e.where((F.col("ts") <= at) & (F.col("ts") + F.expr("INTERVAL 7 DAYS") > at)).groupBy("user_id").agg(F.max_by("event_id", "version").alias("event_id"))
    return I.looked_up(table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")), cache, "user_id").select("user_id", "hit", "event_id")


@query("SELECT delivery_seq FROM alert_candidate WHERE loaded_at >= TIMESTAMP '2026-08-04' - INTERVAL 120 DAYS")
def retention_prune(spark: SparkSession, d: str) -> DataFrame:
    return I.retained(table(spark, d, "alert_candidate").select("delivery_seq", "loaded_at"), "loaded_at", F.lit(NOW).cast("timestamp_ntz"), 120).select("delivery_seq")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new ' || c_name ELSE c_name END AS c_name FROM customer UNION ALL SELECT c_custkey + 10000000, 'added' FROM customer WHERE c_custkey % 100 = 0")
def overlay_upsert(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    new = c.where("c_custkey % 3 = 0").select("c_custkey", F.concat(F.lit("new "), "c_name").alias("c_name")).unionAll(c.where("c_custkey % 100 = 0").select(F.col("c_custkey") + 10000000, F.lit("added")))
    return I.overlaid(c, new, "c_custkey")


@query("SELECT disposition, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'inserted' WHEN c_custkey % 7 = 0 THEN 'conflict' ELSE 'unchanged' END AS disposition FROM customer) GROUP BY 1")
def immutable_upsert_guard(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.md5("c_name").alias("digest"))
    incoming = c.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit("changed")).otherwise(F.col("digest")).alias("digest"))
    return I.guarded_upsert(c.where("c_custkey % 4 <> 0"), incoming, "c_custkey", "digest").groupBy("disposition").agg(F.count("*").alias("n"))


@query("WITH m AS (SELECT registry_seq, batch_no = 0 AS reused FROM openalex_candidate), p AS (SELECT registry_seq FROM m WHERE NOT reused ORDER BY registry_seq LIMIT 100) SELECT registry_seq, CASE WHEN reused THEN 'reused' WHEN registry_seq IN (SELECT registry_seq FROM p) THEN 'processed' ELSE 'deferred' END AS work FROM m")
def incremental_due_split(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "openalex_candidate").select("registry_seq", "batch_no", F.md5("normalized_title").alias("digest")).withColumn("digest", F.coalesce("digest", F.lit("")))
    return I.due_split(o.drop("batch_no"), o.where("batch_no = 0").drop("batch_no"), "registry_seq", "digest", "registry_seq", 100).select("registry_seq", "work")


# ---- enrichment and text -----------------------------------------------------------------------------------------


@query("WITH s AS (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY 1) SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name WHEN s_name IS NOT NULL THEN s_name ELSE 'unavailable' END AS name, CASE WHEN c_acctbal > 0 THEN 'exact' WHEN s_name IS NOT NULL THEN 'matched' ELSE 'unavailable' END AS source FROM customer LEFT JOIN s ON s_nationkey = c_nationkey LEFT JOIN supplier ON s_suppkey = k")
def field_source_choice(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.min_by("s_name", "s_suppkey").alias("s_name"))
    c = table(spark, d, "customer").join(s, F.col("c_nationkey") == F.col("s_nationkey"), "left")
    slot = lambda c, v, source: F.when(c & v.isNotNull(), F.struct(v.alias("name"), F.lit(source).alias("source")))
    chosen = F.coalesce(slot(F.col("c_acctbal") > 0, F.col("c_name"), "exact"), slot(F.lit(True), F.col("s_name"), "matched"), F.struct(F.lit("unavailable").alias("name"), F.lit("unavailable").alias("source")))
    return c.select("c_custkey", chosen.alias("f")).select("c_custkey", "f.name", "f.source")


@query("SELECT registry_seq, normalized_title AS rebuilt FROM openalex_candidate WHERE normalized_title IS NOT NULL")
def inverted_abstract(spark: SparkSession, d: str) -> DataFrame:
    """A text becomes a map from word to positions and is rebuilt from it."""
    return rebuilt(table(spark, d, "openalex_candidate").where("normalized_title is not null"))


def rebuilt(o: DataFrame) -> DataFrame:
    words = F.split("normalized_title", " ")
    index = F.map_from_arrays(F.array_distinct(words), F.transform(F.array_distinct(words), lambda w: F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == w)))
    return o.select("registry_seq", X.inverted_text(index).alias("rebuilt"))


NUMBERS = r"list_transform(regexp_extract_all({0}, '(-?[0-9]+(?:\.[0-9]+)?)', 1), lambda n: TRY_CAST(n AS DOUBLE))"


@query(f"SELECT delivery_seq, CAST(len(list_filter({NUMBERS.format('snippet')}, lambda o: len(list_filter({NUMBERS.format('reference')}, lambda s: abs(o - s) <= greatest(0.02, abs(s) * 0.02))) = 0)) AS INTEGER) AS unsupported FROM (SELECT delivery_seq, snippet, lag(snippet) OVER (PARTITION BY candidate_id ORDER BY delivery_seq) AS reference FROM alert_candidate) WHERE snippet IS NOT NULL AND reference IS NOT NULL")
def numeric_grounding(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of a delivery's snippet that the candidate's delivery before doesn't support."""
    a = table(spark, d, "alert_candidate").select("delivery_seq", "snippet", F.lag("snippet").over(W.partitionBy("candidate_id").orderBy("delivery_seq")).alias("reference"))
    return a.where("snippet is not null and reference is not null").select("delivery_seq", F.size(X.unsupported_numbers(F.col("snippet"), F.col("reference"))).alias("unsupported"))


@query(r"SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: s <> '' AND regexp_matches(s, '(?i)sensor')))) AS INTEGER) AS n_evidence FROM documents WHERE text IS NOT NULL")
def sentence_evidence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(TX.evidence_sentences(X.sentences(F.col("text")), "sensor")).alias("n_evidence"))


@query("WITH i AS (SELECT user_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + 21600 AS e FROM events), m AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i), g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m) SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY user_id, island")
def window_islands(spark: SparkSession, d: str) -> DataFrame:
    s = F.unix_seconds(F.col("ts").cast("timestamp"))
    return TX.islands(table(spark, d, "events").select("user_id", s.alias("s"), (s + 21600).alias("e")), "user_id", "s", "e")


@query("SELECT doc_id, left(text, CAST(4000 - used AS BIGINT)) AS text FROM (SELECT doc_id, text, coalesce(sum(length(text) + 2) OVER (PARTITION BY candidate_id ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM documents WHERE text IS NOT NULL AND candidate_id IS NOT NULL) WHERE used < 4000")
def char_budget_prefix(spark: SparkSession, d: str) -> DataFrame:
    return TX.within_budget(table(spark, d, "documents").where("text is not null and candidate_id is not null").select("doc_id", "candidate_id", "text"), "candidate_id", "doc_id", "text", 4000).select("doc_id", "text")


@query("SELECT event_id, k AS path, CAST(props::JSON ->> k AS VARCHAR) AS value FROM (SELECT event_id, props, unnest(json_keys(props::JSON)) AS k FROM events)")
def json_leaf_walk(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("path", "value"))
    return e.select("event_id", "path", "value")


@query("SELECT k AS key, registry_seq // 65536 AS block, array_to_string(list_sort(list(DISTINCT registry_seq)), ',') AS ids FROM (SELECT registry_seq, unnest(string_split(normalized_title, ' ')) AS k FROM openalex_candidate) WHERE k <> '' GROUP BY 1, 2")
def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "openalex_candidate")
    return TX.inverted_index(o, F.filter(F.split("normalized_title", " "), lambda w: w != ""), "registry_seq").select("key", "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query("SELECT delivery_seq, array_to_string(list_sort(list_filter([CASE WHEN year >= 2024 THEN 'recent' END, CASE WHEN regexp_matches(title, '(?i)hardware|circuit|chip') THEN 'hardware' END, CASE WHEN len(authors) >= 4 THEN 'team' END, CASE WHEN snippet IS NULL THEN 'bare' END], lambda t: t IS NOT NULL)), ',') AS tags FROM alert_candidate")
def tag_derivation(spark: SparkSession, d: str) -> DataFrame:
    rules = {"recent": F.col("year") >= 2024, "hardware": F.col("title").rlike("(?i)hardware|circuit|chip"), "team": F.size("authors") >= 4, "bare": F.col("snippet").isNull()}
    return table(spark, d, "alert_candidate").select("delivery_seq", F.array_join(RU.tags(rules), ",").alias("tags"))


@query()
def fuzzy_best_match(spark: SparkSession, d: str) -> DataFrame:
    """Best accepted title for each later title of the same year."""
    o = table(spark, d, "openalex_candidate").where("normalized_title is not null and year is not null").select("candidate_id", "batch_no", "year", "normalized_title")
    a = o.where("batch_no > 0").select(F.col("candidate_id").alias("later"), F.col("normalized_title").alias("ta"), "year")
    b = o.where("batch_no = 0").select(F.col("candidate_id").alias("candidate"), F.col("normalized_title").alias("tb"), "year")
    pairs = TX.sharing_words(a, b, "ta", "tb", ["year"], 0.88)  # what is under 0.9 - 0.02 is no match, nor near one
    return TX.best_match(pairs, "later", TX.similarity(F.col("ta"), F.col("tb")), F.lit(0.0), 0.9, 0.02).select("later", "candidate", F.round("ratio", 6).alias("ratio"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup_available_now(spark: SparkSession, d: str) -> DataFrame:
    """The events delivered twice, as files of two batches, through a stream that keeps the first of each."""
    import uuid

    from sieveline.runtime import shared_dir
    from sieveline.streaming.events import deduplicated, run_available

    path = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.write.parquet(path)
    e.where("event_id % 20 = 0").write.mode("append").parquet(path)
    stream = spark.readStream.schema(e.schema).parquet(path)
    return run_available(deduplicated(stream, "event_id", "ts", "3650 days"), spark).select("event_id", "user_id", "event_type")


@query()
def greedy_first_accept(spark: SparkSession, d: str) -> DataFrame:
    """Later API records against accepted history by DOI, work, title and fingerprint, in registry order."""
    from sieveline.operators.discover import greedy_accept

    o = table(spark, d, "openalex_candidate")
    keys = F.array_compact(F.array(F.concat(F.lit("doi:"), X.doi_key(F.col("identifiers.doi.value"))), F.concat(F.lit("title:"), F.col("normalized_title")), F.concat(F.lit("fp:"), F.col("content_fingerprint"))))
    works = o.select("registry_seq", "batch_no", keys.alias("keys"), F.coalesce(F.col("year") >= 2015, F.lit(False)).alias("wanted"))
    history = works.where("batch_no = 0").select(F.explode("keys").alias("key"))
    return greedy_accept(works.where("batch_no > 0"), history, "registry_seq")


@query("SELECT doc_id, sha256(concat('{\"doc_id\":', doc_id, ',\"lang\":', CASE WHEN lang IS NULL THEN 'null' ELSE concat('\"', lang, '\"') END, ',\"source\":\"', source, '\"}')) AS digest FROM documents")
def canonical_record_hash(spark: SparkSession, d: str) -> DataFrame:
    from sieveline.sources.files import canonical_json

    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return docs.select("doc_id", F.sha2(canonical_json(docs), 256).alias("digest"))


@query()
def html_plain_text(spark: SparkSession, d: str) -> DataFrame:
    """Snippets with markup as plain text."""
    return table(spark, d, "alert_candidate").where(F.col("snippet").rlike("[<&]")).select("delivery_seq", X.plain_text(F.col("snippet")).alias("text"))


@query(
    r"""WITH p AS (SELECT doc_id, length(text) AS n, unnest(string_split(lower(text), 'sensor')) AS part, generate_subscripts(string_split(lower(text), 'sensor'), 1) AS i FROM documents WHERE text IS NOT NULL),
    h AS (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id) AS c, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) + 6 * (i - 1) AS x FROM p),
    s AS (SELECT doc_id, greatest(x - 100, 0) AS s, least(x + 200, n) AS e FROM h WHERE i < c),
    m AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
    g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM m)
    SELECT doc_id, CAST(min(s) AS INTEGER) AS s, CAST(max(e) AS INTEGER) AS e FROM g GROUP BY doc_id, i"""
)
def keyword_windows(spark: SparkSession, d: str) -> DataFrame:
    from sieveline.functions.documents import keyword_windows as windows

    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.explode(windows(F.col("text"), "sensor", 100, 200)).alias("w")).select("doc_id", F.col("w.start").alias("s"), F.col("w.end").alias("e"))


@query()
def redacted_snippets(spark: SparkSession, d: str) -> DataFrame:
    """Snippets whose numbers the candidate's delivery before doesn't support lose those sentences."""
    from sieveline.functions.documents import redacted

    a = table(spark, d, "alert_candidate").select("delivery_seq", "snippet", F.lag("snippet").over(W.partitionBy("candidate_id").orderBy("delivery_seq")).alias("reference"))
    return a.where("snippet is not null and reference is not null").select("delivery_seq", redacted(F.col("snippet"), F.col("reference")).alias("text"))
