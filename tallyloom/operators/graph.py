"""Build order of tables that read each other, and the groups that read each other in a circle.

Both work on an edge table (a table, and one that it reads) in rounds of joins.
Every round's result is written with a reliable checkpoint, so plans stay short
and a lost executor repeats one round.  A self-reading table is no obstacle to its
own build: loops of one are left out of the order, and told as a group of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src is not null and dst is not null").distinct()


def build_levels(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, level): 0 for a table that reads none, else one more than the highest level it reads.

    Peeling: a round takes the tables whose reads all have a level, one level a
    round.  Tables in a circle, or behind one, never come up and have level NULL.
    Each level is written on its own: a union of unwritten levels would run the
    joins of all of them in one task, whose memory grows with the depth.
    """
    e = _edges(edges, src, dst).filter("src <> dst").checkpoint(eager=True)
    nodes = _edges(edges, src, dst).select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    last = nodes.join(e.select(F.col("src").alias("node")), "node", "left_anti").checkpoint(eager=True)
    done, rest, n, level = last.withColumn("level", F.lit(0).cast("long")), e, e.count(), 0
    while n:
        level += 1
        # edges to what came up last are settled; a table with no edge left comes up next
        left = rest.join(last.select(F.col("node").alias("dst")), "dst", "left_anti").checkpoint(eager=True)
        last = rest.select(F.col("src").alias("node")).distinct().join(
            left.select(F.col("src").alias("node")), "node", "left_anti").checkpoint(eager=True)
        done = done.unionByName(last.withColumn("level", F.lit(level).cast("long")))
        rest, n, before = left, left.count(), n
        if n == before:
            break
    return done.unionByName(rest.select(F.col("src").alias("node")).distinct().withColumn("level", F.lit(None).cast("long")))


def _trimmed(e: DataFrame) -> DataFrame:
    """Edges among tables that both read and are read, over and over: a circle's tables always are."""
    n = e.count()
    while n:
        e = e.join(e.select(F.col("dst").alias("src")), "src", "left_semi")
        e = e.join(e.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst").checkpoint(eager=True)
        n, before = e.count(), n
        if n == before:
            break
    return e


def mutual_groups(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, group): tables that reach each other, by the greatest name among them; others have no row.

    Forward and backward reach: every table takes the greatest name that reaches
    it along edges, round by round until none changes.  A table that kept its own
    name is a root; those of its name that reach it back are its group.  Groups
    leave, and what is left is trimmed to tables that still can be in a circle.
    """
    e = _edges(edges, src, dst)
    loops = e.filter("src = dst").select(F.col("src").alias("node"))
    e = _trimmed(e.filter("src <> dst").checkpoint(eager=True))
    groups = []
    while not e.isEmpty():
        color = e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("color", F.col("node")).checkpoint(eager=True)
        while True:
            came = e.join(color.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("color").alias("came"))
            new = color.join(came, "node", "left").select("node", F.greatest("color", "came").alias("color"),
                                                          (F.col("came") > F.col("color")).alias("moved")).checkpoint(eager=True)
            color = new.select("node", "color")
            if new.filter("moved").isEmpty():
                break
        # edges inside one color, walked backward from the roots
        inside = (e.join(color.select(F.col("node").alias("src"), "color"), "src")
                  .join(color.select(F.col("node").alias("dst"), F.col("color").alias("other")), "dst")
                  .filter("color = other").select("src", "dst", "color").checkpoint(eager=True))
        found = color.filter("node = color")
        last = found
        while not last.isEmpty():
            last = (inside.join(last.select(F.col("node").alias("dst")), "dst").select(F.col("src").alias("node"), "color").distinct()
                    .join(found.select("node"), "node", "left_anti").checkpoint(eager=True))
            found = found.unionByName(last)
        found = found.checkpoint(eager=True)
        groups.append(found)
        left = e.join(found.select(F.col("node").alias("src")), "src", "left_anti")
        e = _trimmed(left.join(found.select(F.col("node").alias("dst")), "dst", "left_anti").checkpoint(eager=True))
    out = loops.withColumn("group", F.col("node"))
    for found in groups:
        out = out.unionByName(found.select("node", F.col("color").alias("group")))
    # a root that nothing reads back is a group of one: no circle unless it reads itself
    sizes = out.distinct().groupBy("node").agg(F.max("group").alias("group"))
    counted = sizes.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    kept = sizes.join(counted, "group").join(loops.withColumn("loop", F.lit(True)), "node", "left")
    return kept.filter("n > 1 or loop").select("node", "group")
