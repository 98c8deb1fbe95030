"""Lineage from routine text, option labels, freshness, dictionaries and audit reduction.

Routine text, options, columns and logs are built from rows of the given tables,
so their number grows with the data; the oracles state the expected result from
the tables directly, without reading text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.predicates import in_range, live
from ..operators.catalog import (
    column_profile,
    data_dictionary,
    extract_edges,
    extract_read_tables,
    extract_write_target,
    latest_of_kinds,
    lineage_closure,
    lineage_detail,
    parse_option_labels,
    partition_cluster_profile,
    table_monitor,
    table_profile,
)
from ..operators.changes import flag_soft_deletes, scd1_upsert
from ..sources.tables import Tables, literal_rows
from . import AS_OF_ORDERS, query


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _routines(t):
    """One routine per customer (builds a mart) and per nation (merges a stage), as text."""
    c, n = t.customer, t.nation
    mart = c.select(_text("SP_MART_", F.col("c_custkey")).alias("name"), _text(
        "-- CREATE OR REPLACE TABLE OLD.T", F.col("c_custkey"), " AS\nCREATE OR REPLACE TABLE `prj-a.MART.CUST_", F.col("c_custkey"),
        "` AS\nSELECT EXTRACT(YEAR FROM o.fecha) y FROM prj-a.RAW.ORDERS_", F.col("c_nationkey"), " o /* JOIN RAW.NOT_READ */\n",
        "JOIN `STAGE`.`NATION_", F.col("c_nationkey"), "` n ON n.k = o.k LEFT JOIN RAW.ORDERS_", F.col("c_nationkey"),
        " again ON 1 = 1 JOIN tmp_cte c ON c.k = o.k;").alias("ddl"))
    stage = n.select(_text("SP_STAGE_", F.col("n_nationkey")).alias("name"), _text(
        "MERGE INTO STAGE.NATION_", F.col("n_nationkey"), " t\nUSING (SELECT * FROM RAW.REGION_", F.col("n_regionkey"),
        ", UNNEST(x)) s ON t.k = s.k").alias("ddl"))
    return mart.unionByName(stage)


_DATASETS = [("RAW",), ("STAGE",), ("MART",)]


@query("routine_targets", sql="""
SELECT 'SP_MART_' || c_custkey AS name, 'prj-a.MART.CUST_' || c_custkey AS target, 'MART' AS dataset,
       'CUST_' || c_custkey AS "table" FROM customer
UNION ALL
SELECT 'SP_STAGE_' || n_nationkey, 'STAGE.NATION_' || n_nationkey, 'STAGE', 'NATION_' || n_nationkey FROM nation
""")
def q_routine_targets(spark, sf_dir):
    """Table that each routine writes, read from its text: comments skipped, quotes and projects handled."""
    return extract_write_target(_routines(Tables(spark, sf_dir)))


_READS_SQL = """
reads AS (SELECT 'SP_MART_' || c_custkey AS name, 'RAW' AS dataset, 'ORDERS_' || c_nationkey AS "table" FROM customer
          UNION ALL SELECT 'SP_MART_' || c_custkey, 'STAGE', 'NATION_' || c_nationkey FROM customer
          UNION ALL SELECT 'SP_STAGE_' || n_nationkey, 'RAW', 'REGION_' || n_regionkey FROM nation)"""


@query("routine_reads", sql=f"WITH {_READS_SQL} SELECT * FROM reads")
def q_routine_reads(spark, sf_dir):
    """Tables that each routine reads: known datasets only, one row per two-part name."""
    t = Tables(spark, sf_dir)
    return extract_read_tables(_routines(t), literal_rows(spark, _DATASETS, "dataset string"))


def _lineage(spark, t):
    """(tables, detail): marts, and their raw ancestors through the routines' own text."""
    target, edges = extract_edges(_routines(t), literal_rows(spark, _DATASETS, "dataset string"))
    tables = target.filter(F.col("src").startswith("MART.")).select(F.col("src").alias("start"))
    orders = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    fresh = orders.groupBy(_text("RAW.ORDERS_", F.col("c_nationkey")).alias("table")).agg(F.max("o_orderdate").alias("modified"))
    return tables, lineage_detail(lineage_closure(edges, tables), fresh)


_DETAIL_SQL = """
fresh AS (SELECT c.c_nationkey AS nk, max(o.o_orderdate) AS modified FROM orders o
          JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1),
detail AS (SELECT 'MART.CUST_' || c.c_custkey AS start, 'RAW.ORDERS_' || c.c_nationkey AS node, 1 AS level, f.modified
           FROM customer c LEFT JOIN fresh f ON f.nk = c.c_nationkey
           UNION ALL
           SELECT 'MART.CUST_' || c.c_custkey, 'RAW.REGION_' || n.n_regionkey, 2, NULL
           FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


@query("lineage_detail", sql=f"""WITH {_DETAIL_SQL}
SELECT start, node, CAST(level AS BIGINT) AS level, strftime(modified, '%Y-%m-%d') AS source_modified FROM detail
""")
def q_lineage_detail(spark, sf_dir):
    """Raw ancestors of every mart, from routine text through a stage, with their last change."""
    _, detail = _lineage(spark, Tables(spark, sf_dir))
    return detail.select("start", "node", "level", F.date_format("source_modified", "yyyy-MM-dd").alias("source_modified"))


@query("table_monitor", sql=f"""WITH {_DETAIL_SQL}
SELECT start, string_agg(node, ', ' ORDER BY node) AS sources,
       max(CASE WHEN level = 2 THEN node END) AS oldest_source,
       'user' || (CAST(substr(start, 11) AS BIGINT) % 7) || '@example.org' AS creator
FROM detail GROUP BY start
""")
def q_table_monitor(spark, sf_dir):
    """One row per mart: its raw sources, the one that changed longest ago (unknown counts as that), its creator."""
    t = Tables(spark, sf_dir)
    tables, detail = _lineage(spark, t)
    creators = t.customer.select(_text("MART.CUST_", F.col("c_custkey")).alias("start"),
                                 _text("user", F.col("c_custkey") % 7, "@example.org").alias("creator"))
    return table_monitor(tables, detail, creators).select("start", "sources", "oldest_source", "creator")


@query("option_labels", sql="""
SELECT 'S' || s_nationkey AS dataset, 'T' || s_suppkey AS "table",
       CASE WHEN s_suppkey % 3 <> 0 THEN 'Nation_' || s_nationkey || '_Datos-Base' END AS origen,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'Activa' END AS estado,
       CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS description
FROM supplier
""")
def q_option_labels(spark, sf_dir):
    """Labels parsed from option text and capitalised after every mark, and the description beside them."""
    t = Tables(spark, sf_dir)
    s = t.supplier.join(t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    keys = [_text("S", F.col("s_nationkey")).alias("dataset"), _text("T", F.col("s_suppkey")).alias("table")]
    labels = s.filter(F.col("s_suppkey") % 3 != 0).select(*keys, F.lit("labels").alias("option"), _text(
        '[STRUCT("origen", "', F.lower("n_name"), '_datos-base"), STRUCT( "Estado" , "ACTIVA")]').alias("value"))
    described = s.filter(F.col("s_suppkey") % 2 == 0).select(*keys, F.lit("description").alias("option"), F.col("s_name").alias("value"))
    return parse_option_labels(s.select(*keys), labels.unionByName(described), ["origen", "estado"])


@query("table_freshness", sql=f"""
WITH m AS (SELECT o_custkey, max(o_orderdate) AS modified, CAST(SUM(o_orderkey) AS BIGINT) AS bytes FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN date_sub('day', modified, TIMESTAMP '{AS_OF_ORDERS}') <= 90 THEN 'ACTIVE' ELSE 'LONG_TERM' END
         AS storage_status,
       CASE WHEN date_sub('hour', modified, TIMESTAMP '{AS_OF_ORDERS}') < 24 THEN 'YES' ELSE 'NO' END AS update_status
FROM m
""")
def q_table_freshness(spark, sf_dir):
    """Storage and freshness state of each customer's orders as a table, by their last change."""
    t = Tables(spark, sf_dir)
    m = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("modified"), F.sum("o_orderkey").alias("bytes"))
    return table_profile(m, "bytes", "modified", AS_OF_ORDERS).select("o_custkey", "storage_status", "update_status")


def _columns(t):
    """Parts as a column list: type = dataset, brand = table, name = column, at its least part key."""
    return t.part.groupBy(F.col("p_type").alias("dataset"), F.col("p_brand").alias("table"), F.col("p_name").alias("column")).agg(
        F.min("p_partkey").alias("position"), F.min("p_size").alias("size"))


_COLUMNS_SQL = """
cols AS (SELECT p_type AS dataset, p_brand AS "table", p_name AS "column", min(p_partkey) AS position, min(p_size) AS size
         FROM part GROUP BY 1, 2, 3)"""


@query("column_profile", sql=f"""
WITH {_COLUMNS_SQL}, n AS (SELECT dataset, "table", count(*) AS n_columns, max(position) AS last_position,
  count(CASE WHEN size > 45 THEN 1 END) AS n_partition_columns, max(CASE WHEN size > 45 THEN "column" END) AS partition_column
  FROM cols GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY dataset, "table" ORDER BY position) AS place FROM cols WHERE size BETWEEN 36 AND 45),
k AS (SELECT dataset, "table", max(CASE WHEN place = 1 THEN "column" END) AS cluster_1, max(CASE WHEN place = 2 THEN "column" END) AS cluster_2,
             max(CASE WHEN place = 3 THEN "column" END) AS cluster_3, max(CASE WHEN place = 4 THEN "column" END) AS cluster_4
      FROM placed GROUP BY 1, 2)
SELECT c.dataset, c."table", c."column", n.n_columns, CAST(CASE WHEN c.position = n.last_position THEN 1 ELSE 0 END AS BIGINT)
         AS is_last, n.n_partition_columns, n.partition_column, k.cluster_1, k.cluster_2, k.cluster_3, k.cluster_4
FROM cols c LEFT JOIN k ON k.dataset = c.dataset AND k."table" = c."table" JOIN n ON n.dataset = c.dataset AND n."table" = c."table"
""")
def q_column_profile(spark, sf_dir):
    """Column list with each table's number of columns, its partition column and its first four cluster columns."""
    cols = _columns(Tables(spark, sf_dir)).withColumn("is_partition", F.when(F.col("size") > 45, "YES").otherwise("NO"))
    in_order = Window.partitionBy("dataset", "table").orderBy("position")  # one row per column of a table
    placed = cols.filter(F.col("size").between(36, 45)).withColumn("cluster_position", F.row_number().over(in_order))
    cols = cols.filter(~F.col("size").between(36, 45)).withColumn("cluster_position", F.lit(None).cast("int")).unionByName(placed)
    clusters = [f"cluster_{i}" for i in range(1, 5)]
    parts = partition_cluster_profile(cols).select("dataset", "table", "n_partition_columns", "partition_column", *clusters)
    return column_profile(cols).join(parts, ["dataset", "table"]).select(
        "dataset", "table", "column", "n_columns", "is_last", "n_partition_columns", "partition_column", *clusters)


@query("description_upsert", sql=f"""
WITH {_COLUMNS_SQL}, t AS (SELECT * FROM cols WHERE size <= 25), s AS (SELECT * FROM cols WHERE size >= 20)
SELECT COALESCE(t.dataset, s.dataset) AS dataset, COALESCE(t."table", s."table") AS "table",
       COALESCE(t."column", s."column") AS "column",
       CASE WHEN s.dataset IS NOT NULL THEN 'new ' || s.size ELSE 'old ' || t.size END AS description,
       CASE WHEN t.dataset IS NULL THEN 'insert' WHEN s.dataset IS NULL THEN 'keep' ELSE 'update' END AS action,
       sha256(COALESCE(t.dataset, s.dataset) || '|' || COALESCE(t."table", s."table") || '|' || COALESCE(t."column", s."column"))
         AS sk_column
FROM t FULL JOIN s ON s.dataset = t.dataset AND s."table" = t."table" AND s."column" = t."column"
""")
def q_description_upsert(spark, sf_dir):
    """Descriptions merged by (dataset, table, column), then the dictionary of all described columns."""
    cols = _columns(Tables(spark, sf_dir))
    keys = ["dataset", "table", "column"]
    stored = cols.filter(F.col("size") <= 25).select(*keys, _text("old ", F.col("size")).alias("description"))
    new = cols.filter(F.col("size") >= 20).select(*keys, _text("new ", F.col("size")).alias("description"))
    merged = scd1_upsert(stored, new, keys, dt.date.fromisoformat(AS_OF_ORDERS))
    out = data_dictionary(merged.select(*keys, F.col("_action").alias("action")), merged.select(*keys, "description"))
    return out.select(*keys, "description", "action", "sk_column")


@query("live_code_range", sql="""
SELECT p_partkey, p_brand FROM part
WHERE p_brand BETWEEN 'Brand#13' AND 'Brand#3' AND p_partkey IN (SELECT l_partkey FROM lineitem)
""")
def q_live_code_range(spark, sf_dir):
    """Parts in a range of text codes that are not flagged deleted (a part on no line is)."""
    t = Tables(spark, sf_dir)
    flagged = flag_soft_deletes(t.part.select("p_partkey", "p_brand"),
                                t.lineitem.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return flagged.filter(live() & in_range("p_brand", "Brand#13", "Brand#3")).select("p_partkey", "p_brand")


@query("hash_key_join", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, s.s_name FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
""")
def q_hash_key_join(spark, sf_dir):
    """Lines joined to suppliers by surrogate hash: the same rows as by the business key."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", hash_key("l_suppkey").alias("sk"))
    return li.join(t.supplier.select(hash_key("s_suppkey").alias("sk"), "s_name"), "sk").drop("sk")


@query("segment_suppliers", sql="""
SELECT DISTINCT c.c_mktsegment, s.s_name FROM customer c JOIN supplier s ON s.s_nationkey = c.c_nationkey
""")
def q_segment_suppliers(spark, sf_dir):
    """Many-to-many join, then distinct: both sides are made distinct first, so their product stays small."""
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_mktsegment", F.col("c_nationkey").alias("nk")).distinct()
    return c.join(t.supplier.select("s_name", F.col("s_nationkey").alias("nk")).distinct(), "nk").select("c_mktsegment", "s_name").distinct()


# Conversation roles as kinds of audit event, the kind that tells a creator first.
AUDIT_KINDS = {"system": "created", "user": "changed", "assistant": "read"}
_KIND_COLUMNS = ", ".join(f"CAST(COALESCE(max(CASE WHEN kind = '{k}' AND rn = 1 THEN turn END), -1) AS BIGINT) AS {k}_turn, "
                          f"CAST(COALESCE(max(CASE WHEN kind = '{k}' AND rn = 1 THEN length(text) END), -1) AS BIGINT) AS {k}_chars"
                          for k in AUDIT_KINDS.values())
_KIND_CASE = " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(AUDIT_KINDS))
_KIND_NAME = " ".join(f"WHEN '{r}' THEN '{k}'" for r, k in AUDIT_KINDS.items())


@query("audit_reduction", sql=f"""
WITH e AS (SELECT conv_id, turn, text, CASE role {_KIND_CASE} END AS priority, CASE role {_KIND_NAME} END AS kind FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, kind ORDER BY turn DESC, length(text) DESC) AS rn,
             row_number() OVER (PARTITION BY conv_id ORDER BY priority, turn DESC, length(text) DESC) AS best FROM e WHERE kind IS NOT NULL)
SELECT conv_id, {_KIND_COLUMNS}, max(CASE WHEN best = 1 THEN kind END) AS creator_kind,
       CAST(max(CASE WHEN best = 1 THEN turn END) AS BIGINT) AS creator_turn,
       max(CASE WHEN best = 1 THEN sha256(text) END) AS creator_text, count(*) AS n_events
FROM n GROUP BY conv_id
""")
def q_audit_reduction(spark, sf_dir):
    """One nested log of three event kinds: the newest event of each kind per resource, and the creator by kind, then time."""
    t = Tables(spark, sf_dir)
    event = F.struct(F.col("turn").cast("long").alias("turn"), F.col("text"))
    empty = F.lit(None).cast("struct<turn:bigint,text:string>")
    log = t.conversations.select(F.struct(F.struct(F.col("conv_id").alias("id")).alias("resource"), F.struct(*[
        F.when(F.col("role") == r, event).otherwise(empty).alias(k) for r, k in AUDIT_KINDS.items()]).alias("event")).alias("payload"))
    last = latest_of_kinds(log, F.col("payload.resource.id").alias("conv_id"), {
        k: {"turn": F.col(f"payload.event.{k}.turn"), "chars": F.length(f"payload.event.{k}.text").cast("long"),
            "text": F.sha2(F.col(f"payload.event.{k}.text"), 256)} for k in AUDIT_KINDS.values()}, order=["turn", "chars"])
    return last.select("conv_id", *[F.coalesce(F.col(f"{k}.{x}"), F.lit(-1)).alias(f"{k}_{x}") for k in AUDIT_KINDS.values() for x in ("turn", "chars")],
                       F.col("best.kind").alias("creator_kind"), F.col("best.turn").alias("creator_turn"),
                       F.col("best.text").alias("creator_text"), "n_events")
