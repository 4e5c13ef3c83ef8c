"""Connected components of a link table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an undirected link table; the component is its smallest node.

    Alternates two star steps until nothing changes.  Large star: every node
    passes the smallest node it sees to its larger neighbours.  Small star:
    every node ties its smaller neighbours and itself to the smallest of them.
    Both keep the components, never add links beyond one per node and
    neighbour, and end with every node linked to its component's smallest.
    Smallest neighbours are partial aggregates, written before they are joined:
    joined as plain tables they leave a hub's links to be split by adaptive
    execution, which can't split an aggregate's own exchange.  Null ends, self links and
    repeated links are ignored; an empty table gives an empty result.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    cur = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(u.isNotNull() & v.isNotNull() & (u != v))
    cur = materialise(cur.distinct())
    seen = None
    while True:
        state = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            break
        seen = state
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        low = materialise(low)
        # large star: neighbours above u, tied to the smallest around u
        star = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = materialise(star.distinct())
        # small star: u and its smaller neighbours, tied to the smallest of them
        least = materialise(star.groupBy("u").agg(F.min("v").alias("m")))
        tied = star.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialise(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
