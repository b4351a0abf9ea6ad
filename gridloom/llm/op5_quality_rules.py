"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Four rates of a text (symbols, repeated lines and repeated words per thousand, word length in
hundredths) are summarised for each language and source by a sketch: counts of values rounded down
to their six leading binary digits (relative error below 1/32). Sketches merge by adding counts, so
they are partial aggregates in every task. A rate fails beyond ``q75 + spread * (q75 - q25) +
margin`` of its group (word length also below the like bound). Only rows that pass the base rule
count in the sketches. Groups of under ``min_rows`` such rows take the sketch of their language, and
languages of under ``min_rows`` that of all rows, so the verdict of a document can change when its
source grows past ``min_rows``. The thresholds are joined back to the rows.

Defined cases: null text has no words and fails the base rule; null language and source count as
empty strings; an empty table gives no rows; repeated rows each give a row; values that tie share a
bucket of the sketch; very long texts are counted whole, one text at a time; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.session import Run

SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rate: (numerator, scale, denominator, margin, whether a low value fails too).
RATES = {
    "symbols": ("n_symbols", 1000, "n_words", 100, False),
    "lines": ("n_dup_lines", 1000, "n_lines", 400, False),
    "repeats": ("n_repeat_words", 1000, "n_words", 350, False),
    "length": ("word_chars", 100, "n_words", 100, True),
}
SPREAD, MIN_ROWS = 4, 30


def base_counts(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (lines with a word)."""
    words = common.words(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    repeats = 0
    if len(words) > 3:
        index: dict[str, int] = {}
        ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
        _, pair = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)
        _, window, found = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
        again = found[window] > 1
        if again.any():
            covered = np.zeros(len(ids), bool)
            for k in range(3):
                covered[k : k + len(again)] |= again
            repeats = int(covered.sum())
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(Counter(lines)), repeats, len(lines)


def base_table(docs: DataFrame) -> DataFrame:
    def work(part: pa.RecordBatch) -> dict:
        counts = list(zip(*(base_counts(t or "") for t in part.column(1).to_pylist()), strict=True))
        return {"doc_id": part.column(0), "lang": part.column(2), "source": part.column(3), **dict(zip((*BASE, "n_lines"), counts, strict=True))}

    kept = [docs[c].cast("string").alias(c) for c in ("text", "lang", "source")]
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in (*BASE, "n_lines"))
    return common.map_slices(docs.select(docs["doc_id"].cast("long").alias("doc_id"), *kept), work, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rate(name: str) -> Column:
    above, scale, below, _, _ = RATES[name]
    return F.expr(f"({scale} * {above}) div greatest({below}, 1)")


def rounded(value: Column) -> Column:
    """A value of six leading binary digits: the bucket of the sketch."""
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(rows: DataFrame) -> DataFrame:
    """grain (0 language and source, 1 language, 2 all), lang, source, rate, value, n."""
    stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("rate"), rounded(rate(m)).alias("value")) for m in RATES]))
    fine = rows.select("lang", "source", stacked.alias("x")).groupBy("lang", "source", "x.rate", "x.value").agg(F.count("*").alias("n"))
    grains = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), lang.alias("lang"), source.alias("source")) for g, lang, source in ((0, F.col("lang"), F.col("source")), (1, F.col("lang"), F.lit("")), (2, F.lit(""), F.lit("")))]))
    return fine.select(grains.alias("g"), "rate", "value", "n").groupBy("g.grain", "g.lang", "g.source", "rate", "value").agg(F.sum("n").alias("n"))


def thresholds(rows: DataFrame, spread: int, min_rows: int) -> DataFrame:
    """lang, source and the low and high bound of each rate."""
    group = Window.partitionBy("grain", "lang", "source", "rate")
    ranked = sketches(rows).withColumns({"upto": F.sum("n").over(group.orderBy("value")), "total": F.sum("n").over(group)})
    quartile = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("value")))
    found = ranked.groupBy("grain", "lang", "source", "rate").agg(quartile(25).alias("q25"), quartile(75).alias("q75"), F.max("total").alias("total"))
    wide = found.groupBy("grain", "lang", "source").agg(
        F.max("total").alias("total"),
        *[F.max(F.when(F.col("rate") == m, F.col("q75") + spread * (F.col("q75") - F.col("q25")) + RATES[m][3])).alias(f"high_{m}") for m in RATES],
        *[F.max(F.when(F.col("rate") == m, F.col("q25") - spread * (F.col("q75") - F.col("q25")) - RATES[m][3])).alias(f"low_{m}") for m in RATES if RATES[m][4]],
    )
    bounds = [c for c in wide.columns if c.startswith(("high_", "low_"))]
    at = lambda g, *keys: wide.where(F.col("grain") == g).select(*keys, F.col("total").alias(f"total_{g}"), *[F.col(b).alias(f"{b}_{g}") for b in bounds])
    joined = at(0, "lang", "source").join(at(1, "lang"), "lang", "left").join(F.broadcast(at(2)))  # one row
    return joined.select("lang", "source", *[F.when(F.col("total_0") >= min_rows, F.col(f"{b}_0")).when(F.col("total_1") >= min_rows, F.col(f"{b}_1")).otherwise(F.col(f"{b}_2")).alias(b) for b in bounds])


def judge(docs: DataFrame, spread: int = SPREAD, min_rows: int = MIN_ROWS) -> DataFrame:
    """The base counts, base_failed and kept of every row."""
    keyed = base_table(docs).withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source")})
    rows = Run(docs.sparkSession, "quality").table(keyed.withColumn("base_failed", base_failed()), "rows")
    limits = thresholds(rows.where(~F.col("base_failed")), spread, min_rows)
    within = [rate(m) <= F.col(f"high_{m}") for m in RATES] + [rate(m) >= F.col(f"low_{m}") for m in RATES if RATES[m][4]]
    kept = ~F.col("base_failed")
    for one in within:
        kept &= F.coalesce(one, F.lit(True))
    return rows.join(limits, ["lang", "source"], "left").select("doc_id", *BASE, "base_failed", kept.alias("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.documents(spark, sf_dir))


def _oracle() -> str:
    word = r"[^\x20\x09-\x0D]+"
    rates = {m: f"({s} * {a}) // greatest({b}, 1)" for m, (a, s, b, _, _) in RATES.items()}
    bucket = lambda v: f"(({v}) >> greatest(length(bin({v})) - 6, 0)) << greatest(length(bin({v})) - 6, 0)"
    stack = " UNION ALL ".join(f"SELECT lang, source, '{m}' rate, {bucket(v)} v FROM base WHERE NOT base_failed" for m, v in rates.items())
    grains = "SELECT 0 grain, lang, source, rate, v FROM stacked UNION ALL SELECT 1, lang, '', rate, v FROM stacked UNION ALL SELECT 2, '', '', rate, v FROM stacked"
    bounds = ", ".join([f"max(CASE WHEN rate = '{m}' THEN q75 + {SPREAD} * (q75 - q25) + {RATES[m][3]} END) high_{m}" for m in RATES] + [f"max(CASE WHEN rate = '{m}' THEN q25 - {SPREAD} * (q75 - q25) - {RATES[m][3]} END) low_{m}" for m in RATES if RATES[m][4]])
    pick = lambda b: f"CASE WHEN a.total >= {MIN_ROWS} THEN a.{b} WHEN l.total >= {MIN_ROWS} THEN l.{b} ELSE g.{b} END"
    within = " AND ".join([f"coalesce({v} <= {pick('high_' + m)}, true)" for m, v in rates.items()] + [f"coalesce({v} >= {pick('low_' + m)}, true)" for m, v in rates.items() if RATES[m][4]])
    return f"""
WITH split AS (SELECT row_number() OVER () k, doc_id, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '{word}') w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) l FROM split),
windows AS (SELECT k, unnest(range(1, len(w) - 1)) i, w FROM words WHERE len(w) > 2),
keyed AS (SELECT k, i, [w[i], w[i + 1], w[i + 2]] g FROM windows),
again AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) n FROM keyed) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT p) n FROM (SELECT k, unnest([i, i + 1, i + 2]) p FROM again) GROUP BY k),
counts AS (SELECT doc_id, lang, source, len(w)::BIGINT n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines,
  coalesce(n, 0)::BIGINT n_repeat_words, len(l)::BIGINT n_lines FROM words LEFT JOIN covered USING (k)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts),
stacked AS ({stack}),
sketch AS (SELECT grain, lang, source, rate, v, count(*) n FROM ({grains}) GROUP BY ALL),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY grain, lang, source, rate ORDER BY v) upto, sum(n) OVER (PARTITION BY grain, lang, source, rate) total FROM sketch),
quartiles AS (SELECT grain, lang, source, rate, min(CASE WHEN 100 * upto >= 25 * total THEN v END) q25, min(CASE WHEN 100 * upto >= 75 * total THEN v END) q75, max(total) total FROM ranked GROUP BY ALL),
bounds AS (SELECT grain, lang, source, max(total) total, {bounds} FROM quartiles GROUP BY ALL)
SELECT doc_id, {", ".join(BASE)}, base_failed, NOT base_failed AND {within} AS kept
FROM base b LEFT JOIN bounds a ON a.grain = 0 AND a.lang = b.lang AND a.source = b.source LEFT JOIN bounds l ON l.grain = 1 AND l.lang = b.lang LEFT JOIN bounds g ON g.grain = 2
"""


ORACLE_SQL = _oracle()
