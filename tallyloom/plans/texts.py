"""JSON and identifiers by name, keyword search by index, and the build order of tables that read each other."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.json import joined_texts, json_fields, json_kind, name_uuid, struct_text
from ..functions.money import cents, money
from ..operators.catalog import extract_edges
from ..operators.conform import indexed_keyword_match
from ..operators.graph import build_levels, mutual_groups
from ..sources.tables import Tables, literal_rows
from . import query

_UUID_SQL = """lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
       substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12))"""


@query("event_props", sql=f"""
WITH e AS (SELECT *, sha1('\\x6b\\xa7\\xb8\\x11\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || encode('event/' || event_id)) AS h
           FROM events)
SELECT event_id, TRY_CAST(props::JSON->>'$.k' AS BIGINT) AS k, 'OBJECT<k: BIGINT>' AS kind,
       CAST(json_object('event_type', event_type, 'user_id', user_id, 'missing', NULL) AS VARCHAR) AS event_text, {_UUID_SQL} AS event_uuid
FROM e
""")
def q_event_props(spark, sf_dir):
    """Typed fields out of each event's JSON, the event as JSON text, and an identifier by its name."""
    e = Tables(spark, sf_dir).events
    fields = json_fields("props", {"k": "$.k bigint"})
    return e.select("event_id", fields["k"].alias("k"), json_kind("props").alias("kind"),
                    struct_text("event_type", "user_id", F.lit(None).cast("string").alias("missing")).alias("event_text"),
                    name_uuid(F.concat(F.lit("event/"), F.col("event_id").cast("string")), uuid.NAMESPACE_URL).alias("event_uuid"))


@query("job_messages", sql="""
SELECT user_id, string_agg('{"id":' || event_id || ',"kind":"' || event_type || '"}', '; ' ORDER BY event_id) AS message,
       count(*) AS n_errors
FROM events WHERE event_type = 'error' GROUP BY user_id
""")
def q_job_messages(spark, sf_dir):
    """Each user's errors as one message: JSON objects in order, as a run log keeps a stack trace."""
    errors = Tables(spark, sf_dir).events.filter(F.col("event_type") == "error")
    trace = F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))))
    return errors.groupBy("user_id").agg(trace.alias("trace")).select(
        "user_id", joined_texts("trace").alias("message"), F.size("trace").cast("long").alias("n_errors"))


_WORDS_SQL = """
words AS (SELECT p_type AS prefix, p_brand AS module, unnest([substr(p_name, 2, 5), split_part(p_name, ' ', 2), substr(p_name, 1, 2)]) AS word
          FROM part WHERE p_size > 10),
kw AS (SELECT DISTINCT prefix, module, word FROM words)"""


@query("keyword_index", sql=f"""
WITH {_WORDS_SQL}, hit AS (
  SELECT p.p_partkey, kw.module, kw.word, row_number() OVER (PARTITION BY p.p_partkey ORDER BY length(kw.word) DESC, kw.word, kw.module) AS rn
  FROM part p JOIN kw ON kw.prefix = p.p_type AND contains(lower(p.p_name), lower(kw.word)))
SELECT p.p_partkey, COALESCE(hit.module, 'DESCONOCIDO') AS module, hit.word AS keyword
FROM part p LEFT JOIN hit ON hit.p_partkey = p.p_partkey AND hit.rn = 1
""")
def q_keyword_index(spark, sf_dir):
    """Module of every part by the longest word in its name, from a word list as long as the parts themselves."""
    part = Tables(spark, sf_dir).part
    words = part.filter(F.col("p_size") > 10).select(F.col("p_type").alias("prefix"), F.col("p_brand").alias("module"), F.array(
        F.substring("p_name", 2, 5), F.split_part("p_name", F.lit(" "), F.lit(2)), F.substring("p_name", 1, 2)).alias("words")).distinct()
    found = indexed_keyword_match(part.select("p_partkey", "p_name", "p_type"), words, "p_partkey", "p_name", "p_type")
    return found.select("p_partkey", "module", "keyword")


@query("build_order", sql="""
WITH RECURSIVE e AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0
                     UNION SELECT a.p_partkey, a.p_partkey * 2 + 1 FROM part a WHERE a.p_size = 50
                       AND a.p_partkey * 2 + 1 IN (SELECT p_partkey FROM part)),
reach AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach r JOIN e ON e.src = r.dst),
circle AS (SELECT r.src AS node, max('MART.PART_' || r.dst) AS circle FROM reach r
           WHERE EXISTS (SELECT 1 FROM reach b WHERE b.src = r.dst AND b.dst = r.src) GROUP BY 1),
blocked AS (SELECT node FROM circle UNION SELECT r.src FROM reach r JOIN circle c ON c.node = r.dst),
lev AS (SELECT p_partkey AS node, 0 AS d FROM part WHERE p_partkey NOT IN (SELECT src FROM e)
        UNION SELECT e.src, lev.d + 1 FROM lev JOIN e ON e.dst = lev.node WHERE e.src NOT IN (SELECT node FROM blocked))
SELECT 'MART.PART_' || p.p_partkey AS node, CAST(COALESCE(max(lev.d), -1) AS BIGINT) AS level, any_value(c.circle) AS "group"
FROM part p LEFT JOIN lev ON lev.node = p.p_partkey LEFT JOIN circle c ON c.node = p.p_partkey GROUP BY p.p_partkey
""")
def q_build_order(spark, sf_dir):
    """Level at which each table can be built (-1: never), read from routine text, and the circles that stop some of them."""
    part = Tables(spark, sf_dir).part
    name = lambda k: F.concat(F.lit("MART.PART_"), k.cast("string"))
    key = F.col("p_partkey")
    back = part.filter(F.col("p_size") == 50).select((key * 2 + 1).alias("p_partkey")).join(part.select("p_partkey"), "p_partkey") \
        .select(((key - 1) / 2).cast("long").alias("p_partkey"), F.lit(True).alias("_back"))
    routines = part.select("p_partkey").join(back, "p_partkey", "left").select(
        name(key).alias("name"), F.concat_ws("", F.lit("CREATE OR REPLACE TABLE "), name(key), F.lit(" AS SELECT 1 AS x"),
                                             F.when(key > 0, F.concat(F.lit(" FROM "), name(F.floor(key / 2)))),
                                             F.when(F.col("_back"), F.concat(F.lit(" JOIN "), name(key * 2 + 1)))).alias("ddl"))
    target, edges = extract_edges(routines, literal_rows(spark, [("MART",)], "dataset string"))
    edges = edges.checkpoint(eager=True)
    levels = build_levels(edges).checkpoint(eager=True)
    stuck = levels.filter("level is null").select("node")  # only they can be in a circle
    inner = edges.join(stuck.withColumnRenamed("node", "src"), "src", "left_semi").join(
        stuck.withColumnRenamed("node", "dst"), "dst", "left_semi")
    lone = target.select(F.col("src").alias("node")).join(levels.select("node"), "node", "left_anti").withColumn(
        "level", F.lit(0).cast("long"))
    return levels.unionByName(lone).join(mutual_groups(inner), "node", "left").select(
        "node", F.coalesce("level", F.lit(-1)).alias("level"), "group")


@query("statement_notes", sql="""
WITH notes AS (SELECT conv_id % (SELECT count(*) FROM orders) AS o_orderkey, conv_id, turn, role, length(text) AS chars,
                      row_number() OVER (PARTITION BY conv_id % (SELECT count(*) FROM orders) ORDER BY turn DESC, conv_id DESC) AS rn
               FROM conversations WHERE role <> 'system')
SELECT o.o_orderkey, o.o_orderstatus, CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, n.role AS note_reason,
       CAST(COALESCE(n.chars, -1) AS BIGINT) AS note_chars, CAST(COALESCE(n.turn, -1) AS BIGINT) AS note_turn
FROM orders o LEFT JOIN notes n ON n.o_orderkey = o.o_orderkey AND n.rn = 1
""")
def q_statement_notes(spark, sf_dir):
    """Every instalment with its newest note: the notes are reduced to one per instalment before they are joined."""
    from ..operators.dedup import latest_per_key

    t = Tables(spark, sf_dir)
    n = t.orders.count()
    notes = t.conversations.filter(F.col("role") != "system").select(
        (F.col("conv_id") % n).alias("o_orderkey"), F.col("turn").cast("long").alias("note_turn"), F.col("conv_id"),
        F.col("role").alias("note_reason"), F.length("text").cast("long").alias("note_chars"))
    last = latest_per_key(notes, ["o_orderkey"], ["note_turn", "conv_id"])
    return t.orders.join(last, "o_orderkey", "left").select(
        "o_orderkey", "o_orderstatus", cents(money("o_totalprice")).alias("amount"), "note_reason",
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("note_chars", "note_turn")])
