import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.catalog import (
    daily_delta,
    extract_read_tables,
    extract_write_target,
    job_cost,
    latest_event,
    lineage_closure,
    parse_option_labels,
    table_profile,
)
from tallyloom.operators.conform import best_keyword_match
from tallyloom.operators.dedup import latest_by_priority

from conftest import rows

ROUTINES = [
    ("r_create", "CREATE OR REPLACE TABLE `prj-x.MART.T_ONE` AS SELECT * FROM `prj-x.RAW.SRC_A` a "
                 "JOIN RAW.SRC_B b ON a.id = b.id LEFT JOIN tmp_t ON 1=1"),
    ("r_merge", "MERGE DIM.T_TWO AS t USING (SELECT * FROM STAGING.KEYS, UNNEST(x)) s ON t.k = s.k"),
    ("r_insert", "INSERT INTO MART.T_THREE SELECT * FROM MART.T_ONE;"),
    ("r_none", "SELECT 1 FROM (SELECT 2)"),
]


def test_routine_targets_and_reads(spark):
    r = spark.createDataFrame(ROUTINES, "name string, ddl string")
    tgt = {x.name: (x.target, x.dataset, x.table) for x in extract_write_target(r).collect()}
    assert tgt["r_create"] == ("prj-x.MART.T_ONE", "MART", "T_ONE")     # 3-part, quoted
    assert tgt["r_merge"] == ("DIM.T_TWO", "DIM", "T_TWO")              # 2-part
    assert tgt["r_insert"] == ("MART.T_THREE", "MART", "T_THREE")
    assert tgt["r_none"] == (None, None, None)                          # no target
    known = spark.createDataFrame([("RAW",), ("MART",), ("STAGING",)], "dataset string")
    reads = rows(extract_read_tables(r, known), "name", "dataset", "table")
    assert reads == [("r_create", "RAW", "SRC_A"), ("r_create", "RAW", "SRC_B"),
                     ("r_insert", "MART", "T_ONE"), ("r_merge", "STAGING", "KEYS")]


def test_lineage_closure_cycle_diamond(spark):
    edges = spark.createDataFrame([
        ("M.A", "M.B"), ("M.A", "M.C"), ("M.B", "RAW.X"), ("M.C", "RAW.X"),   # diamond
        ("M.B", "M.C"), ("M.C", "M.B"),                                       # cycle
        ("M.D", "M.E"),                                                       # no raw ancestor
    ], "src string, dst string")
    starts = spark.createDataFrame([("M.A",), ("M.D",), ("M.Z",)], "start string")
    got = rows(lineage_closure(edges, starts), "start", "node", "level")
    assert got == [("M.A", "M.B", 1), ("M.A", "M.C", 1), ("M.A", "RAW.X", 2), ("M.D", "M.E", 1)]
    raw = lineage_closure(edges, starts).filter(F.col("node").startswith("RAW."))
    assert rows(raw, "start") == [("M.A",)]
    empty = lineage_closure(edges, spark.createDataFrame([("Q",)], "start string"))
    assert empty.count() == 0 and set(empty.columns) >= {"start", "node", "level"}


def test_table_profile_bounds(spark):
    now = dt.datetime(2024, 6, 30, 12, 0)
    mib, gib = 1024 ** 2, 1024 ** 3
    meta = spark.createDataFrame([
        ("a", mib - 1, now - dt.timedelta(hours=23)), ("b", mib, now - dt.timedelta(hours=25)),
        ("c", gib - 1, now - dt.timedelta(days=90)), ("d", gib, now - dt.timedelta(days=91)),
        ("e", 12 * 1024, now)], "table string, bytes long, modified timestamp")
    got = {r.table: (r.size_label, r.storage_status, r.update_status)
           for r in table_profile(meta, "bytes", "modified", now).collect()}
    assert got == {"a": ("1024 KB", "ACTIVE", "YES"), "b": ("1 MB", "ACTIVE", "NO"),
                   "c": ("1024 MB", "ACTIVE", "NO"), "d": ("1 GB", "LONG_TERM", "NO"),
                   "e": ("12 KB", "ACTIVE", "YES")}


def test_option_labels_description_without_labels(spark):
    tables = spark.createDataFrame([("DS", "T1"), ("DS", "T2"), ("DS", "T3")], "dataset string, table string")
    opts = spark.createDataFrame([
        ("DS", "T1", "labels", '[STRUCT("tipo", "dimension"), STRUCT("estado", "activa")]'),
        ("DS", "T1", "description", "first"),
        ("DS", "T2", "description", "second, no labels"),
    ], "dataset string, table string, option string, value string")
    got = rows(parse_option_labels(tables, opts, ["tipo", "estado"]), "table", "tipo", "estado", "description")
    assert got == [("T1", "Dimension", "Activa", "first"), ("T2", None, None, "second, no labels"),
                   ("T3", None, None, None)]


def test_best_keyword_match_rules(spark):
    kw = spark.createDataFrame([
        ("FIN", "LEDGER", ["cuenta", "balance"]), ("FIN", "CASH", ["caja", "banco"]),
        ("FIN", "ZETA", ["banco"]), ("FIN", "EMPTY", [])],
        T.StructType([T.StructField("prefix", T.StringType()), T.StructField("module", T.StringType()),
                      T.StructField("words", T.ArrayType(T.StringType()))]))
    t = spark.createDataFrame([(1, "FIN", "tbl_cuenta_caja"), (2, "FIN", "tbl_banco"), (3, "FIN", "tbl_otro"),
                               (4, "OPS", "tbl_cuenta")], "id long, prefix string, name string")
    got = rows(best_keyword_match(t, kw, "id", "name", "prefix"), "id", "module", "keyword")
    # two words match: the longer wins; same word in two modules: alphabetical module
    assert got == [(1, "LEDGER", "cuenta"), (2, "CASH", "banco"), (3, "DESCONOCIDO", None),
                   (4, "DESCONOCIDO", None)]


def test_daily_delta_cases(spark):
    d = dt.date
    counts = spark.createDataFrame([("t", d(2024, 1, 1), 10), ("t", d(2024, 1, 2), 10), ("t", d(2024, 1, 5), 7),
                                    ("u", d(2024, 1, 3), 0)], "table string, day date, rows long")
    got = rows(daily_delta(counts, ["table"], "day", "rows"), "table", "day", "prev_count", "loaded", "moved")
    assert got == [("t", d(2024, 1, 1), 0, 10, 1), ("t", d(2024, 1, 2), 10, 0, 0), ("t", d(2024, 1, 5), 10, -3, 1),
                   ("u", d(2024, 1, 3), 0, 0, 0)]


AUDIT = ("ts timestamp, payload struct<method string, user struct<email string>, "
         "auth array<struct<resource string, permission string>>, "
         "job struct<dest struct<dataset string, table string>, start timestamp, end timestamp, billed long>>")


def test_audit_log_reductions(spark):
    t = dt.datetime
    log = spark.createDataFrame([
        (t(2024, 1, 1), ("tables.insert", ("a@x.org",), [("p/ds/T1", "CREATE")], (("DS", "T1"), t(2024, 1, 1),
                                                                                    t(2024, 1, 1, 0, 0, 1, 234567), 10 ** 12))),
        (t(2024, 1, 2), ("jobs.query", ("b@x.org",), [], (None, t(2024, 1, 2), t(2024, 1, 2), None))),
        (t(2024, 1, 2), ("tables.update", ("c@x.org",), [("p/ds/T1", "UPDATE")], (("DS", "T1"), t(2024, 1, 2),
                                                                                   t(2024, 1, 2, 0, 1), 0))),
    ], AUDIT)
    flat = log.select("ts", "payload", F.explode_outer("payload.auth").alias("auth"))
    assert flat.count() == 3  # empty auth array kept by explode_outer
    with_dest = flat.filter(F.col("payload.job.dest").isNotNull()).withColumn("resource", F.col("auth.resource"))
    last = latest_event(with_dest, ["resource"], ["ts", "payload.method"], {"who": F.col("payload.user.email")})
    assert rows(last, "resource", "who") == [("p/ds/T1", "c@x.org")]
    creator = latest_by_priority(log.select("ts", F.col("payload.method").alias("method"),
                                            F.col("payload.user.email").alias("who"), F.lit(1).alias("k")),
                                 ["k"], "method", ["tables.insert", "tables.update"], ["ts"])
    assert rows(creator, "who") == [("a@x.org",)]
    jobs = log.select(F.col("payload.job.start").alias("s"), F.col("payload.job.end").alias("e"),
                      F.col("payload.job.billed").alias("billed"))
    costs = [(r.seconds, r.cost) for r in job_cost(jobs, "s", "e", "billed").collect()]
    assert (0.0, None) in costs  # no billed bytes, no cost
    assert (1.23, 6.25) in costs


def test_routine_text_details(spark):
    r = spark.createDataFrame([
        ("commented", "--CREATE OR REPLACE TABLE A.OLD AS\nMERGE INTO `p`.`B`.`NEW` t USING (SELECT EXTRACT(YEAR FROM t.fecha)\n"
                      "FROM prj.RAW.X /* JOIN RAW.NO */ JOIN RAW.X x JOIN `prj.RAW.Y` y ON 1=1) s"),
        ("spaced", "create table if not exists p . D . T as select 1 from cte"),
    ], "name string, ddl string")
    got = {x.name: (x.target, x.dataset, x.table) for x in extract_write_target(r).collect()}
    assert got == {"commented": ("p.B.NEW", "B", "NEW"), "spaced": ("p.D.T", "D", "T")}
    known = spark.createDataFrame([("RAW",)], "dataset string")
    assert rows(extract_read_tables(r, known), "name", "dataset", "table") == [("commented", "RAW", "X"), ("commented", "RAW", "Y")]


def test_capitalise_after_every_mark(spark):
    from tallyloom.operators.catalog import capitalise

    got = spark.createDataFrame([("gobierno_datos",), ("a-b c.D",), ("o'neil",), ("",), ("ÉTÉ été",)], "v string")
    assert [r.c for r in got.select(capitalise(F.col("v")).alias("c")).collect()] == [
        "Gobierno_Datos", "A-B C.D", "O'neil", "", "Été Été"]


def test_deep_chain_and_column_profile(spark):
    from tallyloom.operators.catalog import column_profile

    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(80)], "src string, dst string")
    got = lineage_closure(edges, spark.createDataFrame([("n0",), ("n79",)], "start string"))
    assert got.filter("start = 'n0'").agg(F.max("level")).first()[0] == 80 and got.filter("start = 'n79'").count() == 1
    cols = spark.createDataFrame([("D", "T", "a", 1), ("D", "T", "b", 2), ("D", "U", "c", 1)],
                                 "dataset string, table string, column string, position int")
    assert rows(column_profile(cols), "table", "column", "n_columns", "is_last") == [
        ("T", "a", 2, 0), ("T", "b", 2, 1), ("U", "c", 1, 1)]


def test_latest_of_kinds(spark):
    """Newest event of each kind with its own fields, and the creator by kind first, then time."""
    from tallyloom.operators.catalog import latest_of_kinds

    schema = "res string, ins struct<ts:int,who:string>, job struct<ts:int,who:string>"
    log = spark.createDataFrame([("t", None, (9, "late")), ("t", (1, "first"), None), ("t", (2, "a"), None), ("t", (2, "b"), None),
                                 ("u", None, (3, "job")), ("v", None, None), ("w", (None, "no time"), None), (None, (4, "x"), None)], schema)
    kinds = {"ins": {"ts": F.col("ins.ts"), "who": F.col("ins.who")}, "job": {"ts": F.col("job.ts"), "who": F.col("job.who")}}
    got = latest_of_kinds(log, F.col("res").alias("res"), kinds, ["ts"]).select(
        "res", "ins.who", F.col("job.who").alias("job"), "best.kind", F.col("best.who").alias("creator"), "n_events")
    assert rows(got) == sorted([("t", "b", "late", "ins", "b", 4), ("u", None, "job", "job", "job", 1), ("v", None, None, None, None, 0),
                                ("w", None, None, None, None, 0), (None, "x", None, "ins", "x", 1)], key=repr)


def test_edges_are_those_of_targets_and_reads(spark):
    from tallyloom.operators.catalog import extract_edges

    r = spark.createDataFrame([
        ("a", "CREATE OR REPLACE TABLE `p.MART.A` AS SELECT * FROM RAW.X x JOIN `RAW`.`Y` y ON 1=1 -- JOIN RAW.Z\nJOIN p.RAW.X again"),
        ("b", "MERGE INTO STAGE.B USING (SELECT * FROM tmp JOIN MART.A) s"), ("c", "SELECT 1 FROM RAW.X"), ("d", None),
        ("e", "CREATE TABLE E AS SELECT * FROM RAW.X"), ("f", "INSERT INTO STAGE.B SELECT * FROM RAW.Q JOIN OTHER.T")], "name string, ddl string")
    known = spark.createDataFrame([("RAW",), ("MART",), ("RAW",)], "dataset string")
    targets, edges = extract_edges(r, known)
    two_part = extract_write_target(r).filter("dataset is not null").select("name", F.concat_ws(".", "dataset", "table").alias("src"))
    reads = extract_read_tables(r, known).select("name", F.concat_ws(".", "dataset", "table").alias("dst"))
    assert rows(targets) == rows(two_part)
    assert rows(edges) == rows(two_part.join(reads, "name").select("src", "dst").distinct())
    assert rows(edges) == [("MART.A", "RAW.X"), ("MART.A", "RAW.Y"), ("STAGE.B", "MART.A"), ("STAGE.B", "RAW.Q")]
