"""Line deduplication by an exact set-similarity join over word sets of lines.

A line's set is its distinct words (A-Z lower-cased). A line goes if an earlier line (by document id,
then line number) has a set of Jaccard similarity ``threshold`` or more, be that line kept or not.

1. Words are counted in ``SLOTS`` hash slots over all texts; tokens are ordered by that rarity, then
   by hash. Any such order is exact for prefix filtering, so collisions cost speed only.
2. Lines with equal sets form a class that stands at its first place; its prefix is the
   ``n - ceil(0.8 n) + 1`` rarest tokens, less those that no other line can have, and it carries a
   parity bitmap of its tokens.
3. A class is posted under each prefix token. Alike classes share their rarest common token there,
   and, as they share four tokens at least, their second rarest within one token more. So a token
   that occurs over ``HOT`` times is posted together with each that may be that second one, which
   splits its group; lines of over ``LONG`` tokens take it together with their length class and the
   next one instead, lines about that long both.
4. Classes are dealt by posting and sorted by place, in arrays. Within a posting, each is compared with the earlier
   ones, the nearest first, by length, by position in both prefixes and by bitmap (the XOR has no more bits than the
   sets have unlike tokens). Those that pass are taken if they are few; else only the last of the first few, and
   the search for that class ends there, so that a posting of very many alike lines takes linear time.
5. The pairs are confirmed on full sets. Classes whose candidates failed but that had more are
   searched again for all of theirs; a group of alike lines so costs its size, not its square.

Tokens are compared by 64-bit hash. Defined cases: null or empty text and lines without a word: no
line to compare, nothing removed; a null id sorts before all others; repeated rows (same id and
text) stand at the same places, are not later than each other, and lose or keep the same lines; rows
of one id and different texts are told apart by a hash of the text, and of lines that tie at a place
none is later; very long texts and lines are taken whole; an empty table gives no rows; other
columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm.shingles import MIX, column_bytes, hashed_words, mixed, row_words
from gridloom.session import Run

SLOTS, CHUNK, SHIFT = 1 << 22, 1 << 16, np.uint64(64 - 22)
#: 64-bit words of a parity bitmap.
WORDS = 2
BITS = [f"b{w}" for w in range(WORDS)]
#: More lines than a text can have.
LINES = 10_000_000_000
#: Postings that a worker compares at a time, and that a task takes, about: tasks grow in number, not in size.
AT_ONCE, POSTINGS = 150_000, 400_000
#: Occurrences of a token beyond which its postings are split, and the tokens of a line up to which this is by pairs of tokens.
HOT, LONG = 1 << 14, 64
#: Candidates of a line within a token that are all taken at once.
FEW = 3


def word_rarity(texts: DataFrame) -> np.ndarray:
    """How many word occurrences fall into each hash slot, over all texts; a table of fixed size."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(SLOTS, np.uint32)
        for part in common.slices(batches):
            slots = (row_words(part.column(1))[0] >> SHIFT).astype(np.int64)
            np.add.at(table, slots, np.uint32(1))
        for chunk in range(SLOTS // CHUNK):
            counts = table[chunk * CHUNK : (chunk + 1) * CHUNK]
            at = np.flatnonzero(counts)
            if len(at):  # a chunk of few counts names their places
                few = len(at) < CHUNK // 2
                held = [pa.array([chunk], pa.int64()), pa.array([at.astype(np.uint16).tobytes() if few else None], pa.binary()), pa.array([(counts[at] if few else counts).tobytes()])]
                yield pa.RecordBatch.from_arrays(held, names=["chunk", "places", "counts"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held = tables.setdefault(chunk, np.zeros(CHUNK, np.int64))
                held[slice(None) if places is None else np.frombuffer(places, np.uint16)] += np.frombuffer(counts, np.uint32)
        for chunk, held in tables.items():
            whole = np.minimum(held, 0xFFFFFFFF).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([None], pa.binary()), pa.array([whole])], names=["chunk", "places", "counts"])

    common.ship(texts.sparkSession)
    schema = "chunk long, places binary, counts binary"
    merged = texts.mapInArrow(count, schema).repartition(SLOTS // CHUNK, "chunk").mapInArrow(merge, schema)
    whole = np.zeros(SLOTS, np.uint32)
    for chunk, _, counts in merged.collect():  # SLOTS / CHUNK rows
        whole[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(counts, np.uint32)
    return whole


def overlap_needed(n, m, threshold: int):
    """Least intersection of sets of n and m tokens at the threshold: ceil(t (n + m) / (100 + t))."""
    return -(-threshold * (n + m) // (100 + threshold))


@dataclass
class Lines:
    """Lines with a word of a text column, in order, and their distinct tokens, rarest first."""

    row: np.ndarray  # of the column
    number: np.ndarray  # in its text
    first: np.ndarray  # its tokens' place in ``tokens``
    size: np.ndarray
    tokens: np.ndarray
    rarity: np.ndarray  # of each token; 0 where unknown

    def keys(self) -> np.ndarray:
        """64-bit key of each token set."""
        total = np.add.reduceat(mixed(self.tokens), self.first) if len(self.first) else np.zeros(0, np.uint64)
        return mixed(total + self.size.astype(np.uint64) * MIX).view(np.int64)

    def parity(self) -> list[np.ndarray]:
        """Bitmap of each set in 64-bit words: bit p is the parity of the tokens that hash to p."""
        place = (self.tokens >> np.uint64(24)) & np.uint64(64 * WORDS - 1)
        bit = np.uint64(1) << (place & np.uint64(63))
        none = np.zeros(0, np.uint64)
        return [(np.bitwise_xor.reduceat(np.where((place >> np.uint64(6)) == w, bit, np.uint64(0)), self.first) if len(self.first) else none).view(np.int64) for w in range(WORDS)]

    def postings(self, threshold: int) -> pa.Array:
        """The postings of each set, packed: a 32-bit key in the low half, and the place of the rarest common token that it allows above.

        Left out are tokens that occur once in all texts: no other line has them.
        """
        most = self.size - -(-threshold * self.size // 100) + 1
        line = np.repeat(np.arange(len(self.size)), self.size)
        rank = np.arange(len(self.tokens)) - self.first[line] if len(line) else line
        inside, hot = (rank < most[line]) & (self.rarity != 1), self.rarity > HOT
        at = np.flatnonzero(inside & ~hot)
        found = [(at, self.tokens[at], rank[at])]
        long_ = np.flatnonzero(inside & hot & (self.size[line] > LONG))
        class_ = np.floor(np.log(self.size[line[long_]]) / np.log(101 / threshold)).astype(np.uint64)  # alike lengths are of one class or of neighbours
        found += [(long_, mixed(self.tokens[long_] * MIX + class_ + np.uint64(k)), rank[long_]) for k in (0, 1)]
        at, step = np.flatnonzero(inside & hot & (threshold * self.size[line] <= 100 * LONG)), 1
        while len(at):
            at = at[rank[at] + step < np.minimum(most + 1, self.size)[line[at]]]
            second = at + step
            kept = self.rarity[second] != 1
            found.append((at[kept], mixed(self.tokens[at[kept]] * MIX + self.tokens[second[kept]]), rank[second[kept]] - 1))
            step += 1
        at, key, place = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(line[at], kind="stable")
        packed = (place[order].astype(np.int64) << 32) | (key[order] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(line[at], minlength=len(self.size)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(packed))


def in_order(key: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The order by a key, then by another: the first alone sorts several times as fast, and few of its values are equal."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(same) else order[:0]
    rows = order[tied]
    order[tied] = rows[np.lexsort((then[rows], key[rows]))]
    return order


def by_place(token: np.ndarray, place: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The order by token (32 bits), place and line."""
    least = int(place.min())
    if int(place.max()) - least >= 1 << 31:
        return np.lexsort((line, place, token))
    return in_order((token << 31) | (place - least), line)


def column_lines(column: pa.Array, rarity: np.ndarray | None = None) -> Lines:
    raw, bounds = column_bytes(column)
    hashes, starts = hashed_words(raw, bounds)
    newlines = np.flatnonzero(raw == 10)
    line = np.searchsorted(np.sort(np.concatenate([bounds[:-1], newlines + 1])), starts, side="right") - 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    number = line - (np.arange(len(column)) + np.searchsorted(newlines, bounds[:-1]))[row]
    rank = rarity[(hashes >> SHIFT).astype(np.int64)].astype(np.int64) if rarity is not None else np.zeros(len(hashes), np.int64)
    order = in_order((line << 32) + rank, hashes)
    hashes, line, row, number, rank = hashes[order], line[order], row[order], number[order], rank[order]
    opens = np.ones(len(line), bool)
    opens[1:] = line[1:] != line[:-1]
    fresh = opens.copy()
    fresh[1:] |= hashes[1:] != hashes[:-1]
    first = np.flatnonzero(opens[fresh])
    size = np.diff(np.append(first, int(fresh.sum())))
    return Lines(row[opens], number[opens], first, size, hashes[fresh], rank[fresh])


def lines_of(texts: DataFrame, rarity: np.ndarray, threshold: int, shared: common.Shared) -> DataFrame:
    """One row a line with a word: doc_id, row (key of the whole text), line, of (how many its text has), cls, n, bitmap words, prefix (its postings)."""
    held = shared(rarity)

    def work(part: pa.RecordBatch) -> dict:
        found = column_lines(part.column(2), held.value)
        rows = pa.array(found.row)
        bits = {f"b{w}": b for w, b in enumerate(found.parity())}
        return {"doc_id": part.column(0).take(rows), "row": part.column(1).take(rows), "line": found.number, "of": np.bincount(found.row, minlength=1)[found.row], "cls": found.keys(), "n": found.size, **bits, "prefix": found.postings(threshold)}

    return common.map_slices(texts, work, f"doc_id long, row long, line long, of long, cls long, n int, {', '.join(f'{b} long' for b in BITS)}, prefix array<long>")


#: What a posting carries of its class: ``size`` is twice its tokens, and one more where it is wanted.
CARRIED = ("place", "line", "cls", "size", *BITS)


def carried(classes: DataFrame) -> DataFrame:
    return classes.withColumn("size", F.expr("2L * n + if(wanted, 1L, 0L)")).select(*CARRIED, "prefix")


def posted(classes: DataFrame) -> DataFrame:
    """The postings of classes, with what the filters need."""
    return carried(classes).select(*CARRIED, F.explode("prefix").alias("posting"))


def candidates(postings: DataFrame, threshold: int, every: bool, parts: int) -> DataFrame:
    """x, y, more: class x with an earlier class y of the same prefix token that passes the filters.

    ``postings`` (token and place in the prefix, packed, and ``CARRIED``) are dealt by token to ``parts`` tasks, each
    of which sorts its own by token and place. Of the y of a wanted x within a token all are given if they are ``FEW`` at most; else
    one, with ``more``. With ``every`` all are given.
    """
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("more", pa.bool_())])

    def search(held: list[np.ndarray]) -> pa.RecordBatch | None:
        token, pos, cls, size, *bits, place = held
        n, wanted = size >> 1, (size & 1).astype(bool)
        left = n - pos
        nearest, passes, found = np.full((FEW, len(token)), -1, np.int64), np.zeros(len(token), np.int64), []
        rows, lag = np.flatnonzero((token[1:] == token[:-1]) & wanted[1:]) + 1, 1
        while len(rows):
            before = rows - lag
            need = overlap_needed(n[rows], n[before], threshold)
            good = np.minimum(left[rows], left[before]) >= need
            hit, least = rows[good], need[good]
            good = 100 * np.minimum(n[hit], n[hit - lag]) >= threshold * np.maximum(n[hit], n[hit - lag])
            good &= (cls[hit] != cls[hit - lag]) & (place[hit] != place[hit - lag])
            unlike = sum(np.bitwise_count((b[hit] ^ b[hit - lag]).view(np.uint64)).astype(np.int64) for b in bits)
            hit = hit[good & (unlike <= n[hit] + n[hit - lag] - 2 * least)]
            if every:
                found.append((cls[hit], cls[hit - lag]))
            else:
                nearest[1:, hit] = nearest[:-1, hit]
                nearest[0, hit] = hit - lag
                passes[hit] += 1
                rows = rows[passes[rows] <= FEW]
            lag += 1
            rows = rows[rows >= lag]
            rows = rows[token[rows] == token[rows - lag]]
        if every:
            x, y = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in (zip(*found, strict=True) if found else ((), ())))
            more = np.zeros(len(x), bool)
        else:
            of = [np.flatnonzero(passes)]
            of += [np.flatnonzero((passes > k) & (passes <= FEW)) for k in range(1, FEW)]
            x, y = np.concatenate([cls[o] for o in of]), np.concatenate([cls[nearest[k, o]] for k, o in enumerate(of)])
            more = np.concatenate([passes[o] > FEW for o in of])
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(more)], schema=schema) if len(x) else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if waiting:
            place, line, posting, *held = (np.concatenate([w.pop(0) for w in waiting]) for _ in range(len(waiting[0])))
            order = by_place(posting & 0xFFFFFFFF, place, line)
            posting, place, line = posting[order], place[order], line[order]
            token = posting & 0xFFFFFFFF
            held.append(np.cumsum(np.append(0, (place[1:] != place[:-1]) | (line[1:] != line[:-1]))))
            held[-1][order] = held[-1].copy()
            del place, line, waiting
            ends = np.append(np.flatnonzero(token[1:] != token[:-1]) + 1, len(token))
            start = 0
            while start < len(token):  # whole tokens
                stop = int(ends[min(np.searchsorted(ends, start + AT_ONCE), len(ends) - 1)])
                at = order[start:stop]
                if (out := search([token[start:stop], posting[start:stop] >> 32, *[c[at] for c in held]])) is not None:
                    yield out
                start = stop
            del posting, token, held, order
        common.release()

    common.ship(postings.sparkSession)
    dealt = postings.withColumn("token", F.expr("posting & 4294967295L")).repartition(parts, "token")
    return dealt.select("place", "line", "posting", "cls", "size", *BITS).mapInArrow(run, "x long, y long, more boolean")


def postings_with(classes: DataFrame, tokens: np.ndarray, shared: common.Shared) -> DataFrame:
    """The postings whose tokens a bitmap holds."""
    held = shared(tokens)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(CARRIED))
            ends = lists.offsets.to_numpy()
            posting = lists.values.to_numpy()[ends[0] : ends[-1]]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            kept = np.flatnonzero(common.in_bitmap(held.value, posting & (common.FILTER_BITS - 1)))
            if len(kept):
                at = pa.array(owner[kept])
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(len(CARRIED))], pa.array(posting[kept])], names=[*CARRIED, "posting"])

    common.ship(classes.sparkSession)
    return carried(classes).mapInArrow(run, ", ".join(f"{c} long" for c in (*CARRIED, "posting")))


def place_of() -> Column:
    """The id by which texts are ordered; a null id comes first."""
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))


def sets_of(texts: DataFrame, wanted: DataFrame, shared: common.Shared) -> DataFrame:
    """cls and tokens of the classes in ``wanted`` (cls, place, line), read from their first places."""
    docs = shared(common.bitmap(wanted, "place"))

    def work(part: pa.RecordBatch) -> dict | None:
        chosen = np.flatnonzero(common.in_bitmap(docs.value, part.column(1).to_numpy(zero_copy_only=False)))
        if not len(chosen):
            return None
        found = column_lines(part.column(2).take(pa.array(chosen)))
        tokens = pa.ListArray.from_arrays(pa.array(np.append(found.first, len(found.tokens)).astype(np.int32)), pa.array(found.tokens.view(np.int64)))
        return {"place": part.column(0).take(pa.array(chosen[found.row])), "line": found.number, "cls": found.keys(), "tokens": tokens}

    place = place_of()
    read = common.map_slices(texts.select(place.alias("place"), common.slot(place).alias("slot"), "text"), work, "place long, line long, cls long, tokens array<long>")
    return read.join(wanted, ["cls", "place", "line"], "left_semi").dropDuplicates(["cls"]).select("cls", "tokens")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Classes x of the pairs (x, y) whose sets reach the threshold."""
    side = lambda c: sets.select(F.col("cls").alias(c), F.col("tokens").alias(f"{c}_set"))
    both = F.size(F.array_intersect("x_set", "y_set"))
    union = F.size("x_set") + F.size("y_set") - F.col("both")
    joined = pairs.select("x", "y").distinct().join(side("x"), "x").join(side("y"), "y").withColumn("both", both)
    return joined.where(100 * F.col("both") >= threshold * union).select("x").distinct()


def removed_lines(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """doc_id, row, n_lines (with a word), removed (their numbers, in order): one row a text with a word."""
    run, shared = Run(docs.sparkSession, "lines"), common.Shared(docs.sparkSession)
    texts = common.texts_of(docs)
    whole = run.table(lines_of(common.texts_of(docs, "row"), word_rarity(texts), threshold, shared).withColumn("place", place_of()), "lines")
    shared.release()
    # The least place of a class as one number: aggregates of numbers need no sort.
    at = (F.col("place").cast("decimal(20,0)") * F.lit(LINES).cast("decimal(11,0)") + F.col("line")).cast("decimal(38,0)")
    firsts = run.table(whole.groupBy("cls").agg(F.min(at).alias("first")), "firsts")
    classes = run.table(whole.withColumn("first", at).join(firsts, ["cls", "first"]).select("cls", "place", "line", "n", *BITS, "prefix"), "classes")
    lines = run.table(whole.select("doc_id", "row", "line", "of", "cls", at.alias("at")), "places")
    run.drop(whole)
    places = classes.select("cls", "place", "line")
    parts = max(1, -(-(classes.agg(F.sum(F.size("prefix"))).first()[0] or 0) // POSTINGS))
    wanted_of = lambda pairs: run.table(places.join(pairs.select(F.explode(F.array("x", "y")).alias("cls")).distinct(), "cls", "left_semi"), "wanted")

    found = run.table(candidates(posted(classes.withColumn("wanted", F.lit(True))), threshold, False, parts).distinct(), "candidates")
    gone = run.table(confirmed(found, sets_of(texts, wanted_of(found), shared), threshold), "gone")
    shared.release()

    open_ = found.where("more").select(F.col("x").alias("cls")).distinct().join(gone.select(F.col("x").alias("cls")), "cls", "left_anti")
    open_ = run.table(open_.withColumn("open", F.lit(True)), "open")
    # only classes that a bitmap of the open ones lets through are shuffled
    placed = common.flagged(classes, F.col("cls"), run.table(common.bitmap_words(open_, "cls"), "bitmap"), "maybe")
    near = run.table(placed.where("maybe").drop("maybe").join(open_, "cls", "left").withColumn("wanted", F.coalesce("open", F.lit(False))).drop("open"), "marked")
    marked = placed.where("not maybe").drop("maybe").withColumn("wanted", F.lit(False)).select(near.columns).unionByName(near)
    tokens = near.where("wanted").select(F.explode("prefix").alias("posting")).select(F.expr("posting & 4294967295L").alias("token"))
    again = postings_with(marked, common.bitmap(tokens, "token", hashed=True), shared)
    more = run.table(candidates(again, threshold, True, parts).join(found.select("x", "y"), ["x", "y"], "left_anti").distinct(), "more-candidates")
    late = run.table(confirmed(more, sets_of(texts, wanted_of(more), shared), threshold), "late")
    shared.release()
    goes = gone.unionByName(late).distinct().select(F.col("x").alias("cls"), F.lit(True).alias("goes"))
    verdicts = run.table(firsts.join(goes, "cls", "left"), "verdicts")  # written, so that a class of very many lines is split in the join
    run.drop(firsts, classes, near, found, gone, open_, more, late)

    judged = lines.join(verdicts, "cls")
    goes = F.col("goes").isNotNull() | (F.col("first") != F.col("at"))
    return judged.groupBy("doc_id", "row").agg(F.max("of").alias("n_lines"), F.array_sort(F.collect_set(F.when(goes, F.col("line")))).alias("removed"))


def _rewritten():
    @F.arrow_udf("string")
    def rewritten(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, removed in batches:
            yield pa.array([without(t, r) for t, r in zip(texts.to_pylist(), removed.to_pylist(), strict=True)], pa.string())
        common.release()

    return rewritten


def deduplicated(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """``docs`` with the removed lines taken out of ``text``; other columns and rows as they are.

    Only rows whose id falls into the bitmap of ids with a removed line are shuffled.
    """
    common.ship(docs.sparkSession)
    run = Run(docs.sparkSession, "line-dedup")
    gone = run.table(removed_lines(docs, threshold).where(F.size("removed") > 0).drop("n_lines"), "gone")
    words = run.table(common.bitmap_words(gone, "doc_id"), "bitmap")
    maybe, key, id_, row, removed = common.fresh_names(docs, "maybe", "text_key", "gone_id", "gone_row", "gone_lines")
    placed = common.flagged(docs, docs["doc_id"].cast("long"), words, maybe)
    open_ = placed.where(F.col(maybe)).withColumn(key, common.row_key(F.col("text")))
    cuts = gone.select(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("removed").alias(removed))
    judged = open_.join(cuts, (F.col(key) == F.col(row)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)), "left")
    columns = [f"`{c}`" for c in docs.columns]
    untouched = placed.where(~F.col(maybe)).select(columns).unionByName(judged.where(F.col(removed).isNull()).select(columns))
    return untouched.unionByName(judged.where(F.col(removed).isNotNull()).withColumn("text", _rewritten()(F.col("text").cast("string"), F.col(removed))).select(columns))


def without(text: str, removed: Iterable[int]) -> str:
    gone = set(removed)
    return "\n".join(line for number, line in enumerate(text.split("\n")) if number not in gone)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    found = removed_lines(docs)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.row_key(docs["text"]).alias("row"))
    shown = rows.join(found.withColumnRenamed("doc_id", "id").withColumnRenamed("row", "of"), (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    removed = F.coalesce("removed", F.array().cast("array<long>"))
    return shown.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), F.array_join(removed, ",").alias("removed"))


#: The same join by words in SQL: classes of equal word sets, paired where prefixes by rarity meet.
ORACLE_SQL = r"""
WITH texts AS (SELECT row_number() OVER () k, doc_id, string_split(coalesce(text, ''), chr(10)) l FROM documents),
split AS (SELECT k, doc_id, i - 1 line, list_sort(list_distinct(regexp_extract_all(translate(l[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) s
  FROM (SELECT *, unnest(range(1, len(l) + 1)) i FROM texts)),
lines AS (SELECT *, (doc_id, line) place FROM split WHERE len(s) > 0),
classes AS (SELECT row_number() OVER () c, s, len(s) n, min(place) first FROM lines GROUP BY s),
words AS (SELECT c, n, first, unnest(s) w FROM classes),
counted AS (SELECT *, count(*) OVER (PARTITION BY w) df FROM words),
prefixes AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY df, w) r FROM counted) WHERE r <= n - CAST(ceil(80 * n / 100) AS BIGINT) + 1 AND df > 1),
pairs AS (SELECT DISTINCT x.c x, y.c y FROM prefixes x JOIN prefixes y ON x.w = y.w AND y.first < x.first AND x.c <> y.c AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
gone AS (SELECT DISTINCT x FROM (SELECT x, len(list_intersect(a.s, b.s)) shared, a.n + b.n total FROM pairs JOIN classes a ON a.c = x JOIN classes b ON b.c = y) WHERE 100 * shared >= 80 * (total - shared)),
judged AS (SELECT k, line, g.x IS NOT NULL OR first <> place AS goes FROM lines l JOIN classes USING (s) LEFT JOIN gone g ON g.x = c),
found AS (SELECT k, count(*) n_lines, count(*) FILTER (WHERE goes) n_removed, string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (WHERE goes) removed FROM judged GROUP BY k)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT n_lines, coalesce(n_removed, 0)::BIGINT n_removed, coalesce(removed, '') removed FROM texts LEFT JOIN found USING (k)
"""
