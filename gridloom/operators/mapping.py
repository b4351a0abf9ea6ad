"""Matching mapping entries to columns, and attaching their comments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.errors import MappingFailed
from gridloom.functions.text import snake


def deduplicated(entries: DataFrame) -> DataFrame:
    """The first entry (by position) of each source (case folded), comment and target."""
    key = Window.partitionBy(F.lower("source"), "comment", "target").orderBy("position")
    return entries.withColumn("_n", F.row_number().over(key)).where("_n = 1").drop("_n")


def matches(entries: DataFrame, columns: DataFrame) -> DataFrame:
    """(position, db_name) pairs. ``entries``: position, source, target; ``columns``: source_name, db_name.

    With a target only the target counts, and its snake-case form only where no column has its name.
    Each rule is an equi-join key, so the join never compares all pairs; both sides are as small as a
    table's columns.
    """
    last = F.substring_index(F.col("source"), ".", -1)
    key = lambda tier, kind, k: F.struct(F.lit(tier).alias("tier"), F.lit(kind).alias("kind"), k.alias("key"))
    by_target = F.array(key(0, "name", F.lower(F.trim("target"))), key(1, "name", snake(F.col("target"))))
    unqualified = F.when(~F.contains(F.col("source"), F.lit(".")), F.lower("source"))
    by_source = F.array(key(0, "full", F.lower("source")), key(0, "last", F.lower(last)), key(0, "name", unqualified), key(0, "name", snake(F.lower(last))))
    trimmed = F.lower(F.trim("source_name"))
    offered = F.array(key(0, "full", trimmed), key(0, "last", F.trim(F.substring_index(trimmed, ".", -1))), key(0, "name", F.lower("db_name")))
    left = entries.select("position", F.explode(F.when(F.col("target").isNotNull(), by_target).otherwise(by_source)).alias("k")).select("position", "k.*")
    right = columns.select("db_name", F.explode(offered).alias("k")).select("db_name", "k.kind", "k.key")
    met = left.join(right, ["kind", "key"]).groupBy("position", "db_name").agg(F.min("tier").alias("tier"))
    best = met.groupBy("position").agg(F.min("tier").alias("tier"))
    return met.join(best, ["position", "tier"]).select("position", "db_name")


def resolved(entries: DataFrame, columns: DataFrame) -> DataFrame:
    """Each entry with status matched, unmatched or ambiguous, and the column if one matched."""
    found = matches(entries, columns).groupBy("position").agg(F.count("*").alias("n"), F.min("db_name").alias("db_name"))
    n = F.coalesce("n", F.lit(0))
    status = F.when(n == 0, "unmatched").when(n == 1, "matched").otherwise("ambiguous")
    return entries.join(found, "position", "left").withColumn("status", status).withColumn("db_name", F.when(n == 1, F.col("db_name"))).drop("n")


def comments(found: DataFrame) -> DataFrame:
    """db_name, comment and conflict: equal comments of a column agree, different ones conflict."""
    return found.where("status = 'matched'").groupBy("db_name").agg(F.min_by("comment", "position").alias("comment"), (F.count_distinct("comment") > 1).alias("conflict"))


def merged_comments(found: DataFrame) -> DataFrame:
    """Comments of a column in order, repeats of the text so far left out, joined by "; " (decks)."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("position", "comment"))), lambda x: x["comment"])
    folded = F.aggregate(ordered, F.lit(""), lambda a, c: F.when(a == "", c).when(a == c, a).otherwise(F.concat(a, F.lit("; "), c)))
    return found.where("status = 'matched'").groupBy("db_name").agg(folded.alias("comment"))


@dataclass(frozen=True)
class Attached:
    """Comments by column, the columns by matched source, and the sources that matched nothing."""

    comments: dict[str, str]
    matched: dict[str, str]
    unmatched: list[str]


def attached(entries: DataFrame, columns: DataFrame, merge: bool = False) -> Attached:
    """The comments of a mapping (position, source, target, comment); ambiguity or, without ``merge``, conflict fails."""
    found = resolved(deduplicated(entries), columns)
    rows = found.select("source", "db_name", "status", "position").orderBy("position").collect()  # as many as a mapping file has
    if any(r["status"] == "ambiguous" for r in rows):
        raise MappingFailed("ambiguous_mapping")
    table = (merged_comments(found).withColumn("conflict", F.lit(False)) if merge else comments(found)).collect()
    if any(r["conflict"] for r in table):
        raise MappingFailed("conflicting_comments")
    matched = {r["source"]: r["db_name"] for r in rows if r["status"] == "matched"}
    return Attached({r["db_name"]: r["comment"] for r in table}, matched, list(dict.fromkeys(r["source"] for r in rows if r["status"] == "unmatched")))
