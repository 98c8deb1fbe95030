"""Queries for the metadata/lineage jobs, run over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import size_label
from ..operators.catalog import (
    HOST_RE,
    HREF_RE,
    daily_delta,
    extract_links,
    job_cost,
    latest_event,
    lineage_closure,
    parse_key_values,
    pivot_labels,
)
from ..sources.tables import Tables
from . import query


@query("extract_links", sql=f"""
WITH l AS (SELECT DISTINCT page_id, NULLIF(regexp_extract(url, '{HOST_RE}', 1), '') AS page_host,
                  unnest(regexp_extract_all(html, '{HREF_RE}', 1)) AS href FROM pages),
h AS (SELECT page_id, page_host, href,
             COALESCE(NULLIF(regexp_extract(href, '{HOST_RE}', 1), ''), page_host) AS link_host FROM l)
SELECT page_id, href, link_host,
       CAST(CASE WHEN link_host IS NOT DISTINCT FROM page_host THEN 0 ELSE 1 END AS BIGINT) AS is_external
FROM h
""")
def q_extract_links(spark, sf_dir):
    """Every distinct link of every page (whole HTML), its host and whether it is external."""
    t = Tables(spark, sf_dir)
    return extract_links(t.pages, "page_id", "url", "html")


_KV_SQL_RE = r'"([A-Za-z_][A-Za-z0-9_]*)"\s*:\s*"?([^",}]*)"?'


def _labels_sql():
    return f"""
WITH kv AS (SELECT event_id, event_type, unnest(regexp_extract_all(props, '{_KV_SQL_RE}', 1)) AS k,
                   unnest(regexp_extract_all(props, '{_KV_SQL_RE}', 2)) AS v FROM events)
SELECT event_id, event_type, max(CASE WHEN k = 'k' THEN v END) AS label_k FROM kv GROUP BY event_id, event_type
"""


@query("parse_labels", sql=_labels_sql())
def q_parse_labels(spark, sf_dir):
    """Key/value labels parsed from free text by regex, the named ones pivoted."""
    t = Tables(spark, sf_dir)
    pairs = parse_key_values(t.events.select("event_id", "event_type", "props"), "props")
    return pivot_labels(pairs, ["event_id", "event_type"], ["k"])


def _audit_rows(conversations):
    """Conversation turns shaped as nested audit records (struct / array-of-struct payload)."""
    c = conversations
    return c.select(
        "conv_id", "turn",
        F.struct(
            F.concat(F.lit("conversation."), F.col("role")).alias("method"),
            F.struct(F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit("@example.org"))
                     .alias("email")).alias("user"),
            F.array(F.struct(F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("resource"),
                             F.upper("role").alias("permission"))).alias("auth"),
            F.struct(F.length("text").cast("long").alias("chars"),
                     F.size(F.split(F.col("text"), " ")).cast("long").alias("words")).alias("stats"),
        ).alias("payload"),
    )


@query("nested_log", sql="""
WITH t AS (SELECT conv_id, turn, role, length(text) AS chars,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations),
agg AS (SELECT conv_id, count(*) AS n_turns, CAST(SUM(chars) AS BIGINT) AS total_chars FROM t GROUP BY conv_id)
SELECT a.conv_id, a.n_turns, a.total_chars, t.turn AS last_turn, 'conversation.' || t.role AS last_method,
       upper(t.role) AS last_permission, 'conv/' || CAST(a.conv_id AS VARCHAR) AS resource,
       'conv' || CAST(a.conv_id AS VARCHAR) || '@example.org' AS user_email
FROM agg a JOIN t ON t.conv_id = a.conv_id AND t.rn = 1
""")
def q_nested_log(spark, sf_dir):
    """Nested audit records: dotted field access, array-of-struct unnest, latest record per key."""
    t = Tables(spark, sf_dir)
    log = _audit_rows(t.conversations)
    flat = log.select("conv_id", "turn", "payload", F.explode("payload.auth").alias("auth"))
    # one aggregation: the latest record's fields and the per-conversation totals together
    out = latest_event(flat, ["conv_id"], ["turn"], {
        "last_turn": F.col("turn"), "last_method": F.col("payload.method"),
        "last_permission": F.col("auth.permission"), "resource": F.get("payload.auth", 0).getField("resource"),
        "user_email": F.col("payload.user.email")},
        extra_aggs={"n_turns": F.count(F.lit(1)), "total_chars": F.sum("payload.stats.chars")})
    return out.select("conv_id", "n_turns", "total_chars", "last_turn", "last_method", "last_permission",
                      "resource", "user_email")


_EDGES_SQL = """
edges AS (
  SELECT 'C:' || CAST(c_custkey AS VARCHAR) AS src, 'N:' || CAST(c_nationkey AS VARCHAR) AS dst FROM customer
  UNION ALL SELECT 'S:' || CAST(s_suppkey AS VARCHAR), 'N:' || CAST(s_nationkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'N:' || CAST(n_nationkey AS VARCHAR), 'R:' || CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'R:' || CAST(n_regionkey AS VARCHAR), 'N:' || CAST(n_nationkey AS VARCHAR) FROM nation),
starts AS (SELECT 'C:' || CAST(c_custkey AS VARCHAR) AS start FROM customer
           UNION ALL SELECT 'S:' || CAST(s_suppkey AS VARCHAR) FROM supplier)"""


@query("lineage_closure", sql=f"""
WITH RECURSIVE {_EDGES_SQL},
walk(start, node, level, path) AS (
  SELECT start, start, 0, [start] FROM starts
  UNION ALL
  SELECT w.start, e.dst, w.level + 1, list_append(w.path, e.dst)
  FROM walk w JOIN edges e ON e.src = w.node
  WHERE NOT list_contains(w.path, e.dst))
SELECT start, node, CAST(min(level) AS BIGINT) AS level FROM walk WHERE level > 0 GROUP BY start, node
""")
def q_lineage_closure(spark, sf_dir):
    """Everything each customer/supplier reaches through nation -> region -> nation edges
    (the back-edges make cycles), with the first level each node is reached at."""
    t = Tables(spark, sf_dir)

    def node(prefix, col):
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    edges = (
        t.customer.select(node("C:", "c_custkey").alias("src"), node("N:", "c_nationkey").alias("dst"))
        .unionByName(t.supplier.select(node("S:", "s_suppkey").alias("src"), node("N:", "s_nationkey").alias("dst")))
        .unionByName(t.nation.select(node("N:", "n_nationkey").alias("src"), node("R:", "n_regionkey").alias("dst")))
        .unionByName(t.nation.select(node("R:", "n_regionkey").alias("src"), node("N:", "n_nationkey").alias("dst")))
    )
    starts = t.customer.select(node("C:", "c_custkey").alias("start")).unionByName(
        t.supplier.select(node("S:", "s_suppkey").alias("start")))
    return lineage_closure(edges, starts)


# Document languages pivoted into count columns.
LANGS = ["de", "en", "es", "fr"]
_LANG_SQL = ", ".join(f"count(*) FILTER (WHERE lang = '{x}') AS n_{x}" for x in LANGS)


@query("table_profile", sql=f"""
WITH s AS (SELECT source, count(*) AS n_docs, CAST(SUM(n_chars) AS BIGINT) AS total_chars,
                  max(n_chars) AS max_chars, CAST(SUM(strlen(text)) AS BIGINT) AS bytes, {_LANG_SQL}
           FROM documents GROUP BY source)
SELECT *, CASE WHEN bytes < 1024.0 * 1024.0 THEN CAST(CAST(round(bytes / 1024.0) AS BIGINT) AS VARCHAR) || ' KB'
               WHEN bytes < 1024.0 * 1024.0 * 1024.0
                 THEN CAST(CAST(round(bytes / 1024.0 / 1024.0) AS BIGINT) AS VARCHAR) || ' MB'
               ELSE CAST(CAST(round(bytes / 1024.0 / 1024.0 / 1024.0) AS BIGINT) AS VARCHAR) || ' GB' END AS size_label
FROM s
""")
def q_table_profile(spark, sf_dir):
    """Per document source: counts, sizes of the whole texts, a size label and per-language counts."""
    t = Tables(spark, sf_dir)
    d = t.documents
    prof = d.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("total_chars"), F.max("n_chars").alias("max_chars"),
        F.sum(F.octet_length("text")).cast("long").alias("bytes"),
        *[F.count_if(F.col("lang") == x).alias(f"n_{x}") for x in LANGS])
    return prof.withColumn("size_label", size_label("bytes"))


# Cost bands of a job.
COST_BANDS = [(0.01, "LOW"), (0.05, "MEDIUM")]
COST_TOP = "HIGH"


@query("job_cost", sql="""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, ts,
                  CAST(CAST(value AS DECIMAL(18,2)) * 1000000000 AS BIGINT) AS billed FROM events),
j AS (SELECT user_id, day, count(*) AS n_events, min(ts) AS start_ts, max(ts) AS end_ts,
             CAST(SUM(billed) AS BIGINT) AS billed_bytes FROM e GROUP BY user_id, day)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, n_events,
       strftime(start_ts, '%Y-%m-%d %H:%M:%S.%f') AS start_ts, strftime(end_ts, '%Y-%m-%d %H:%M:%S.%f') AS end_ts,
       ((date_diff('microsecond', start_ts, end_ts) // 1000 + 5) // 10) / 100 AS seconds, billed_bytes,
       billed_bytes / 1e12 * 6.25 AS cost,
       CASE WHEN billed_bytes / 1e12 * 6.25 < 0.01 THEN 'LOW'
            WHEN billed_bytes / 1e12 * 6.25 < 0.05 THEN 'MEDIUM' ELSE 'HIGH' END AS cost_band
FROM j
""")
def q_job_cost(spark, sf_dir):
    """Events of a user on a day as one job: seconds between first and last event,
    billed bytes from the event values, and the scan cost."""
    t = Tables(spark, sf_dir)
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "ts",
                        (F.col("value").cast("decimal(18,2)") * 1_000_000_000).cast("long").alias("billed"))
    jobs = e.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("start_ts"),
                                          F.max("ts").alias("end_ts"), F.sum("billed").alias("billed_bytes"))
    cost = job_cost(jobs, "start_ts", "end_ts", "billed_bytes")
    band = F.when(F.col("cost") < COST_BANDS[0][0], COST_BANDS[0][1]) \
        .when(F.col("cost") < COST_BANDS[1][0], COST_BANDS[1][1]).otherwise(COST_TOP)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return cost.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_events",
                       F.date_format("start_ts", fmt).alias("start_ts"), F.date_format("end_ts", fmt).alias("end_ts"),
                       F.col("seconds").cast("double").alias("seconds"), "billed_bytes", "cost",
                       band.alias("cost_band"))


@query("daily_delta", sql="""
WITH d AS (SELECT event_type, CAST(ts - INTERVAL 5 HOUR AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1, 2),
l AS (SELECT *, COALESCE(lag(n_events) OVER (PARTITION BY event_type ORDER BY day), 0) AS prev_count FROM d)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n_events, prev_count, n_events - prev_count AS loaded,
       CAST(CASE WHEN abs(n_events - prev_count) > 0 THEN 1 ELSE 0 END AS BIGINT) AS moved
FROM l
""")
def q_daily_delta(spark, sf_dir):
    """Rows loaded per type and local day, compared with the day before."""
    from .changes import _daily_counts

    t = Tables(spark, sf_dir)
    counts = _daily_counts(t).select("event_type", "day", "n_events")
    out = daily_delta(counts, ["event_type"], "day", "n_events")
    return out.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_events", "prev_count",
                      "loaded", "moved")
