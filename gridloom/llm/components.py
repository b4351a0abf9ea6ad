"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import Run


#: Tasks that the edges of one node are dealt to.
SALTS = 16


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the least node m next to u. A node may have very many edges: they meet their one row of ``least`` in several tasks."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return salted.join(least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["u", "salt"]).drop("salt")


def _step(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return _with_least(large, least).select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u > v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, run: Run) -> DataFrame:
    """(node, root) for every node that has an edge and is not its component's least node.

    ``edges`` has long columns u and v. Each round ends in a table of ``run``; rounds grow with the
    logarithm of the longest path.
    """
    now = run.table(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        following = run.table(_step(now), "edges")
        new = _mark(following)
        run.drop(now)
        now = following
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
