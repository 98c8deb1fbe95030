"""Connected components of a link table by alternating large-star and small-star steps.

(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014.)  Each
step is one minimum per node, combined map-side, and one join back on the node;
a node with very many links is split by AQE's skew join.  The links never leave
the cluster, and every step is cut with ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))"),
                  F.expr("sum(cast(xxhash64(lo, hi) as decimal(38,0)))")).first()
    return tuple(r)


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): each node that has a link to another, with the least node it reaches.

    Self links and repeated links are ignored, rows with a null end too; nodes
    without links do not appear.  An empty table gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    links = (edges.where(a.isNotNull() & b.isNotNull() & (a != b))
             .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct().checkpoint())
    before = None
    while (now := _signature(links)) != before:
        before = now
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")))
        lower = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(lower, "hi").where("lo <> m")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionAll(lower.select("hi", F.col("m").alias("lo"))))
        links = small.distinct().checkpoint()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
