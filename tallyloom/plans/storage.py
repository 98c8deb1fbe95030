"""What a table goes through in storage, read back: rebuild, month partitions, clustering, labels, append; exported metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.money import cents, money
from ..functions.text import size_label
from ..session import shared_path
from ..sources.metadata import SCHEMAS, empty_metadata, read_metadata
from ..sources.tables import (
    Tables,
    append_rows,
    empty_table,
    month_partition,
    read_current,
    read_metadata_of,
    replace_months,
    write_replace,
)
from . import query

_LABELS = {"tipo": "fact", "estado": "estable"}
_FIRST, _SECOND = dt.date(2001, 4, 1), dt.date(2001, 7, 1)


@query("table_rebuild_cycle", sql="""
WITH v AS (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total, strftime(o_orderdate, '%Y-%m') AS month, o_orderdate
           FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'),
first AS (SELECT month, count(*) AS n FROM v WHERE o_orderdate < TIMESTAMP '2001-04-01' GROUP BY month)
SELECT v.month, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, CAST(SUM(total) AS DOUBLE) AS total, 2 AS version,
       'orders by month' AS description, 'fact' AS tipo, COALESCE(any_value(first.n), 0) AS n_in_first_version
FROM v LEFT JOIN first ON first.month = v.month GROUP BY v.month
""")
def q_table_rebuild_cycle(spark, sf_dir):
    """Orders rebuilt twice by month, clustered and labelled, each version's months appended to a log; the current version is read."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", money("o_totalprice").alias("total"), "o_orderdate")
    path, log = shared_path(spark, "orders-table"), shared_path(spark, "orders-log")
    for number, end in enumerate((_FIRST, _SECOND), 1):
        rows = month_partition(orders.filter(F.col("o_orderdate") < F.lit(end)), "o_orderdate")
        version = write_replace(rows, path, ["month"], ["o_custkey"], {"description": "orders by month", "labels": _LABELS})
        months = spark.read.parquet(version).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
        append_rows(months.select(F.col("n").alias("n"), F.lit(number).cast("long").alias("version"), F.col("month").cast("string")), log)
    told = read_metadata_of(spark, version)
    first = spark.read.parquet(log).filter("version = 1").select("month", F.col("n").alias("_first"))
    newest = spark.read.parquet(log).agg(F.max("version")).first()[0]
    now = read_current(spark, path).withColumn("month", F.col("month").cast("string")).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.countDistinct("o_custkey").alias("n_customers"), F.sum("total").alias("total"))
    return now.join(first, "month", "left").select(
        "month", "n_orders", "n_customers", cents("total").alias("total"), F.lit(newest).cast("int").alias("version"),
        F.lit(told["description"]).alias("description"), F.lit(told["labels"]["tipo"]).alias("tipo"),
        F.coalesce("_first", F.lit(0)).alias("n_in_first_version"))


@query("month_window_rebuild", sql="""
WITH o AS (SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders)
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_orders, CAST(SUM(total) AS DOUBLE) AS total
FROM (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '2001-05-15' OR o_orderdate >= TIMESTAMP '2001-07-01'
      UNION ALL SELECT o_orderkey, o_orderdate, total + 10 FROM o
      WHERE o_orderdate >= TIMESTAMP '2001-05-15' AND o_orderdate < TIMESTAMP '2001-06-01' AND o_orderkey % 2 = 0)
GROUP BY 1
""")
def q_month_window_rebuild(spark, sf_dir):
    """A stored table whose rows from mid-May to June are recomputed: a month partly kept, one emptied, the others untouched."""
    orders = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", money("o_totalprice").alias("total"))
    path = shared_path(spark, "orders-months")
    month_partition(orders, "o_orderdate").write.partitionBy("month").parquet(path)
    new = orders.filter((F.col("o_orderdate") < F.lit(dt.date(2001, 6, 1))) & (F.col("o_orderkey") % 2 == 0)).withColumn(
        "total", (F.col("total") + 10).cast("decimal(18,2)"))
    replace_months(new, path, "o_orderdate", "2001-05-15", "2001-06-30")
    return spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"), cents(F.sum("total")).alias("total"))


@query("exported_metadata", sql="""
WITH t AS (SELECT 'N' || c_nationkey AS dataset, c_mktsegment AS "table", count(*) AS rows, CAST(SUM(o.n) AS BIGINT) * 1000 AS bytes
           FROM customer JOIN (SELECT o_custkey, SUM(o_orderkey) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey GROUP BY 1, 2),
p AS (SELECT 'N' || c_nationkey AS dataset, c_mktsegment AS "table", strftime(o_orderdate, '%Y') AS partition_id, count(*) AS n
      FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3),
q AS (SELECT dataset, "table", count(*) AS n_partitions, CAST(max(n) AS BIGINT) AS largest FROM p GROUP BY 1, 2)
SELECT t.dataset, t."table", t.rows, t.bytes, CASE WHEN bytes < 1048576 THEN CAST(CAST(round(bytes / 1024.0) AS BIGINT) AS VARCHAR) || ' KB'
            WHEN bytes < 1073741824 THEN CAST(CAST(round(bytes / 1024.0 / 1024.0) AS BIGINT) AS VARCHAR) || ' MB'
            ELSE CAST(CAST(round(bytes / 1024.0 / 1024.0 / 1024.0) AS BIGINT) AS VARCHAR) || ' GB' END AS size_label,
       q.n_partitions, q.largest, 'no' AS has_options
FROM t JOIN q ON q.dataset = t.dataset AND q."table" = t."table"
""")
def q_exported_metadata(spark, sf_dir):
    """Table and partition metadata exported to files and read by their declared schemas, beside an option table without rows."""
    t = Tables(spark, sf_dir)
    path = shared_path(spark, "exported")
    orders = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment"), "o_custkey").select(
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("dataset"), F.col("c_mktsegment").alias("table"), "o_custkey", "o_orderkey", "o_orderdate")
    tables = orders.groupBy("dataset", "table").agg(F.countDistinct("o_custkey").alias("rows"), (F.sum("o_orderkey") * 1000).alias("bytes"),
                                                    F.max("o_orderdate").cast("timestamp").alias("modified"))
    parts = orders.groupBy("dataset", "table", F.date_format("o_orderdate", "yyyy").alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))
    tables.withColumn("type", F.lit("BASE TABLE")).select(*SCHEMAS["table_meta"].fieldNames()).write.json(f"{path}/tables")
    parts.write.parquet(f"{path}/parts")  # columns that the export lacks are read as NULL
    known = read_metadata(spark, f"{path}/tables", "table_meta", "json")
    sized = read_metadata(spark, f"{path}/parts", "partition_meta").groupBy("dataset", "table").agg(
        F.count(F.lit(1)).alias("n_partitions"), F.max("rows").alias("largest"))
    options = empty_metadata(spark, "option_meta").unionByName(empty_table(spark, SCHEMAS["option_meta"])).select(
        "dataset", "table", F.lit("yes").alias("_some")).distinct()
    return known.join(sized, ["dataset", "table"]).join(options, ["dataset", "table"], "left").select(
        "dataset", "table", "rows", "bytes", size_label("bytes").alias("size_label"), "n_partitions", "largest",
        F.coalesce("_some", F.lit("no")).alias("has_options"))
