"""Near-duplicate documents by MinHash bands, checked by odd sketches and then on full shingle sets.

1. One pass over the texts gives each row its distinct word shingles (hashed to 64 bits), ``K``
   MinHash values, the hashes of their ``BANDS`` bands, and an odd sketch: every MinHash value flips
   one bit of a bitmap of ``ODD_BITS``, so the population count of the XOR of two bitmaps estimates
   their similarity closely where it is high.
2. Rows with equal sets form a class; only classes go on.
3. In each band bucket every class is paired with the least class, its leader. Pairs whose sizes or
   odd sketches rule the similarity out are dropped; the others are confirmed on the full sets.
4. Components of the links so far. The classes that share a leader's buckets and still are in several components are
   searched again, in memory: each outside the largest component is held against all of other components by
   size and odd sketch, and what passes is counted on full sets. A pair inside one component could not change the
   result and is left out.
5. Components of all links.

With 32 bands of 4 rows a pair at similarity 0.8 shares no band with probability 5e-8, and at the
slack used an odd sketch rules it out with probability below 1e-8; nothing is capped or sampled.

Defined cases: no text or no word: empty set, linked with nothing, its own component; fewer words
than the shingle: the whole sequence is one shingle; repeated rows are in one class; a null doc_id
is compared like others, its component is the least id of its group (null if there is none) and it
is kept only where that is null; ties in the band buckets go to the least class; very long texts are
hashed whole, one text at a time; an empty table gives no rows; other columns, whatever their names,
are neither read nor changed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm.components import components
from gridloom.llm.shingles import MIX, mixed, row_sets
from gridloom.session import Run

K, BANDS, ODD_BITS, ODD_WORDS = 128, 32, 512, 8
#: How far below the threshold an odd-sketch estimate still counts as a candidate.
SLACK = 0.3
#: Shingles of one leader's classes that are searched together at most, about.
CELL = 1_000_000
_random = np.random.default_rng(20)
_MULTIPLY = (_random.integers(0, 1 << 31, K, dtype=np.uint32) << 1) | np.uint32(1)
_ADD = _random.integers(0, 1 << 32, K, dtype=np.uint32)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """K 32-bit MinHash values of a non-empty set of 64-bit hashes."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(K, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 1024):
        np.minimum(least, (np.multiply.outer(_MULTIPLY, high[at : at + 1024]) + _ADD[:, None]).min(axis=1), out=least)
    return least


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """(n, BANDS) 64-bit bucket keys of (n, K) signatures; the band's number is part of the key."""
    rows = signatures.reshape(len(signatures), BANDS, K // BANDS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(rows.shape[2]):
        total = mixed(total * MIX + rows[:, :, k])
    return total.view(np.int64)


def odd_sketches(signatures: np.ndarray) -> np.ndarray:
    """(n, ODD_WORDS) bitmaps: bit p is the parity of the MinHash values that hash to p."""
    salted = signatures.astype(np.uint64) + (np.arange(K, dtype=np.uint64) << np.uint64(32))
    bits = (mixed(salted) >> np.uint64(64 - 9)).astype(np.int64)
    cells = np.bincount((bits + np.arange(len(bits))[:, None] * ODD_BITS).reshape(-1), minlength=len(bits) * ODD_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64).reshape(-1, ODD_WORDS)


def most_odd_bits(similarity: float) -> int:
    """XOR population count at which the odd-sketch estimate of the similarity is ``similarity``."""
    return round(ODD_BITS / 2 * (1 - math.exp(-4 * K * (1 - similarity) / ODD_BITS)))


def set_key(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(hashes) & 0xFFFFFFFF) - (1 << 63)


def signatures(texts: DataFrame, width: int) -> DataFrame:
    """doc_id, row (key of the text), n_shingles, cls (key of the set), bands and odd; the last three null for an empty set."""

    def work(part: pa.RecordBatch) -> dict:
        sizes, keys, rows, at = [], [], [], []
        for i, found in enumerate(row_sets(part.column(2), width)):
            sizes.append(len(found))
            keys.append(set_key(found) if len(found) else None)
            if len(found):
                rows.append(minhash(found))
                at.append(i)
        bands, odd = [None] * len(sizes), [None] * len(sizes)
        if rows:
            matrix = np.array(rows)
            for i, b, o in zip(at, band_hashes(matrix), odd_sketches(matrix), strict=True):
                bands[i], odd[i] = b, o
        return {"doc_id": part.column(0), "row": part.column(1), "n_shingles": sizes, "cls": keys, "bands": bands, "odd": odd}

    return common.map_slices(texts, work, "doc_id long, row long, n_shingles long, cls long, bands array<long>, odd array<long>")


def sets_of(texts: DataFrame, wanted: DataFrame, width: int, shared: common.Shared) -> DataFrame:
    """cls and shingles of the rows whose doc_id is in ``wanted``, and of a few more."""
    held = shared(common.bitmap(wanted, "doc_id"))

    def work(part: pa.RecordBatch) -> dict | None:
        chosen = np.flatnonzero(common.in_bitmap(held.value, part.column(0).to_numpy(zero_copy_only=False)))
        if not len(chosen):
            return None
        sets = [s for s in row_sets(part.column(1).take(pa.array(chosen)), width) if len(s)]
        return {"cls": [set_key(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

    return common.map_slices(texts.select(common.slot(F.col("doc_id")).alias("slot"), "text"), work, "cls long, shingles array<long>")


def alike(threshold: int, a: str, b: str) -> Column:
    """Neither the sizes nor the odd sketches of sides a and b rule the similarity out."""
    bits = " + ".join(f"bit_count({a}_odd[{k}] ^ {b}_odd[{k}])" for k in range(ODD_WORDS))
    return F.expr(f"100 * least({a}_n, {b}_n) >= {threshold} * greatest({a}_n, {b}_n) and {bits} <= {most_odd_bits(threshold / 100 - SLACK)}")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """u, v of the pairs whose full sets have 100 * intersection >= threshold * union."""
    side = lambda c: sets.select(F.col("cls").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = F.size(F.array_intersect("u_set", "v_set")).cast("long")
    union = F.size("u_set").cast("long") + F.size("v_set") - F.col("both")
    joined = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").withColumn("both", both)
    return joined.where(100 * F.col("both") >= threshold * union).select("u", "v").distinct()


def links_between(groups: DataFrame, sizes: DataFrame, sets: DataFrame, threshold: int, run: Run) -> DataFrame:
    """u, v: links between different roots among the classes that share a leader.

    ``groups``: leader, cls, root; ``sets``: cls, shingles, odd. Of a leader's classes, each outside the largest root is held
    against all of other roots: odd sketches give the candidates, full sets decide, in memory; only links leave the task. A leader whose
    classes hold over ``CELL`` shingles is cut into blocks, and each pair of blocks is a cell of its
    own, so what a task holds is bounded however large the group is.
    """
    shares = groups.join(sizes, "cls").groupBy("leader", "root").agg(F.count("*").alias("share"), F.sum("n").alias("held"))
    split = shares.groupBy("leader").agg(F.max_by("root", F.struct("share", "root")).alias("largest"), F.count("*").alias("roots"), F.ceil(F.sum("held") / CELL).cast("int").alias("blocks")).where("roots > 1")
    split = run.table(split.select("leader", "largest", "blocks"), "split")  # written, so that a leader of very many classes is split in the join
    placed = groups.join(split, "leader").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("leader", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cls", "root", (F.col("root") != F.col("largest")).alias("outside"))

    most = most_odd_bits(threshold / 100 - SLACK)

    def whole(column: pa.ChunkedArray) -> pa.ListArray:
        joined = column.combine_chunks()
        return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        cls, root, outside = (group.column(c).to_numpy() for c in ("cls", "root", "outside"))
        held, odd = whole(group.column("shingles")), whole(group.column("odd")).flatten().to_numpy().view(np.uint64).reshape(-1, ODD_WORDS)
        size = np.diff(held.offsets.to_numpy()).astype(np.int64)
        token = np.unique(held.flatten().to_numpy(), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(size)), size)
        order = np.argsort(token, kind="stable")
        owners, lists = owner[order], np.concatenate([[0], np.cumsum(np.bincount(token))])
        first = np.concatenate([[0], np.cumsum(size)])
        found = set()
        for i in np.flatnonzero(outside).tolist():
            maybe = np.flatnonzero((root != root[i]) & (100 * np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i])))
            maybe = maybe[np.bitwise_count(odd[maybe] ^ odd[i]).sum(axis=1) <= most]
            if not len(maybe):
                continue
            mine = token[first[i] : first[i + 1]]
            runs = lists[mine + 1] - lists[mine]
            at = np.repeat(lists[mine] - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(int(runs.sum()))
            both = np.bincount(owners[at], minlength=len(size))[maybe]
            linked = maybe[100 * both >= threshold * (size[maybe] + size[i] - both)]
            found.update((int(cls[i]), int(r)) for r in np.unique(root[linked]))
        rows = sorted(found)
        return pa.table({"u": pa.array([u for u, _ in rows], pa.int64()), "v": pa.array([v for _, v in rows], pa.int64())})

    common.ship(groups.sparkSession)
    return cells.join(sets, "cls").groupBy("leader", "i", "j").applyInArrow(search, "u long, v long").distinct()


def components_of(docs: DataFrame, width: int, threshold: int, run: Run) -> DataFrame:
    """doc_id, row (key of its text), n_shingles, cls, root (of its component; null for an empty set) and component_id of every row."""
    texts, shared = common.texts_of(docs, "row"), common.Shared(docs.sparkSession)
    rows = run.table(signatures(texts, width), "signatures")
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("odd").alias("odd"))
    classes = run.table(classes, "classes")
    postings = classes.select("cls", F.explode("bands").alias("bucket"))
    leaders = run.table(postings.groupBy("bucket").agg(F.min("cls").alias("leader"), F.count("*").alias("size")).where("size > 1").select("bucket", "leader"), "leaders")
    members = run.table(postings.join(leaders, "bucket").select("leader", "cls").distinct(), "members")
    met = classes.join(members.select("cls").distinct(), "cls", "left_semi")
    traits = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"{c}_n"), F.col("odd").alias(f"{c}_odd"))
    found = sets_of(texts, met.select(F.col("rep").alias("doc_id")), width, shared)
    sets = run.table(found.join(met.select("cls", "odd"), "cls").dropDuplicates(["cls"]), "sets")
    shared.release()

    led = members.where("cls != leader").select(F.col("leader").alias("u"), F.col("cls").alias("v"))
    led = led.join(traits("u"), "u").join(traits("v"), "v").where(alike(threshold, "u", "v")).select("u", "v")
    links = run.table(confirmed(led, sets, threshold), "links")
    stars = components(links, run)

    groups = members.join(stars.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    groups = run.table(groups, "groups")
    more = run.table(links_between(groups, classes.select("cls", "n"), sets, threshold, run), "more-links")
    run.drop(leaders, members, sets, links, groups)
    stars = components(stars.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), run)

    ids = classes.select("cls", "rep").join(stars.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    ids = run.table(ids, "ids")
    least = run.table(ids.groupBy("root").agg(F.min("rep").alias("component_id")), "least-ids")
    named = run.table(ids.join(least, "root").select("cls", "root", "component_id"), "named")
    run.drop(classes, more, ids, least)
    found = rows.select("doc_id", "row", "n_shingles", "cls").join(named, "cls", "left")
    return found.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; ``threshold`` in hundredths."""
    found = components_of(docs, width, threshold, Run(docs.sparkSession, "near-duplicates"))
    return found.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


def one_of_each(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` with one row of each component left; rows without a word all stay.

    The row kept has the component's least id (of equal ids, the least key of the text; of equal
    rows, one). Only rows whose id falls into the bitmap of doubtful ids are shuffled.
    """
    run = Run(docs.sparkSession, "one-of-each")
    found = run.table(components_of(docs, width, threshold, run).where("n_shingles > 0").withColumn("kept", F.expr("doc_id <=> component_id")), "verdicts")
    texts = found.where("kept").groupBy("root", "row").agg(F.count("*").alias("copies"), F.first("doc_id").alias("doc_id"))
    texts = run.table(texts, "texts")  # a text or two of each component
    best = run.table(texts.groupBy("root").agg(F.min("row").alias("best"), F.sum("copies").alias("rows")).where("rows > 1"), "best")
    several = texts.join(best, "root").select("doc_id", "row", (F.col("row") == F.col("best")).alias("once"))
    doubtful = run.table(found.where("not kept").select("doc_id", "row", F.lit(False).alias("once")).distinct().unionByName(several), "doubtful")
    words = run.table(common.bitmap_words(doubtful, "doc_id"), "bitmap")
    run.drop(found, texts, best)

    maybe, key, id_, row, once = common.fresh_names(docs, "maybe", "text_key", "doubtful_id", "doubtful_row", "once")
    placed = common.flagged(docs, docs["doc_id"].cast("long"), words, maybe)
    open_ = placed.where(F.col(maybe)).withColumn(key, common.row_key(F.col("text")))
    verdicts = doubtful.select(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("once").alias(once))
    judged = open_.join(verdicts, (F.col(key) == F.col(row)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)), "left")
    clear, one = judged.where(F.col(once).isNull()), judged.where(F.col(once)).dropDuplicates([id_, row])
    columns = [f"`{c}`" for c in docs.columns]
    return placed.where(~F.col(maybe)).select(columns).unionByName(clear.select(columns)).unionByName(one.select(columns))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.documents(spark, sf_dir), width=2)


#: The same links by an exact prefix join of whole sets in SQL, and what is reached along them.
ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () k, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM documents),
sets AS MATERIALIZED (SELECT k, doc_id, coalesce(list_distinct(list_transform(range(1, greatest(len(w) - 1, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i + 1], ' '))), []) s FROM texts),
counted AS (SELECT *, count(*) OVER (PARTITION BY t) df FROM (SELECT k, len(s) n, unnest(s) t FROM sets)),
prefixes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY df, t) r FROM counted) WHERE r <= n - CAST(ceil(80 * n / 100) AS BIGINT) + 1 AND df > 1),
pairs AS (SELECT DISTINCT x.k x, y.k y FROM prefixes x JOIN prefixes y ON x.t = y.t AND x.k <> y.k AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
links AS MATERIALIZED (SELECT x, y FROM (SELECT x, y, len(list_intersect(a.s, b.s)) shared, len(a.s) + len(b.s) total FROM pairs JOIN sets a ON a.k = x JOIN sets b ON b.k = y) WHERE 100 * shared >= 80 * (total - shared)),
reached(k, node) AS (SELECT k, k FROM sets UNION SELECT r.k, l.y FROM reached r JOIN links l ON r.node = l.x)
SELECT s.doc_id, any_value(len(s.s))::BIGINT n_shingles, min(t.doc_id) component_id, s.doc_id IS NOT DISTINCT FROM min(t.doc_id) AS kept
FROM reached r JOIN sets s USING (k) JOIN sets t ON r.node = t.k GROUP BY s.k, s.doc_id
"""
