"""Language identification with a byte convolutional network, trained and applied in numpy.

The network: byte filters of several widths over a window of fixed length, ReLU, max pooling over
the window, a softmax over the learned languages. A text is cut into windows (the last padded with
zero bytes); its probabilities are the mean over its windows, weighted by their bytes.

Training takes a bounded, stratified sample of labelled rows: at most ``rows_per_lang`` rows of each
language, those of the least hashes of id and text, two excerpts of ``excerpt`` characters from each.
Every label is learned: only rows are bounded, so the sample grows with the languages, and labels
beyond ``max_langs`` are an error, never left out. Everything else covers whole texts. Ids, sources
and labels are never inputs of a prediction.

Defined cases: null text or a text without a letter (Unicode category L): ``und`` with score 0; no
labelled row at all: ``und`` for every row; an empty table gives no rows; repeated ids and null ids: a
row for each row, and repeated rows count once in the sample; very long texts are cut into
windows whole, one text at a time; ties go to the first language by name; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common

UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")
#: ASCII capitals are read as small letters.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Windows in one block of the forward pass.
BLOCK = 256
#: The most languages of a model: the driver holds the excerpts of all (about 0.8 MB of text a language).
MAX_LANGS = 512


@dataclass
class ByteConvNet:
    langs: list[str]
    window: int
    filters: dict[int, np.ndarray]  # width -> (width, 256, F)
    bias: dict[int, np.ndarray]
    out: np.ndarray  # (widths * F, langs)
    out_bias: np.ndarray

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (n, langs) of uint8 windows (n, window)."""
        pairs = {w: [self._pair(f, k) for k in range(0, w - 1, 2)] for w, f in self.filters.items()}
        result = np.empty((len(windows), len(self.langs)), np.float32)
        for at in range(0, len(windows), BLOCK):
            block = windows[at : at + BLOCK]
            one = block.reshape(-1).astype(np.intp)
            two = one * 256
            two[:-1] += one[1:]
            pooled = []
            for width, f in self.filters.items():
                n = len(one) - width + 1
                total = np.take(pairs[width][0], two[:n], axis=0)
                for j, table in enumerate(pairs[width][1:], 1):
                    total += np.take(table, two[2 * j : 2 * j + n], axis=0)
                if width % 2:
                    total += np.take(f[width - 1], one[width - 1 :], axis=0)
                size = f.shape[2]
                grid = np.full((len(one), size), -np.inf, np.float32)
                grid[:n] = total
                pooled.append(grid.reshape(len(block), self.window, size)[:, : self.window - width + 1].max(axis=1) + self.bias[width])
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            result[at : at + BLOCK] = softmax(hidden @ self.out + self.out_bias)
        return result

    @staticmethod
    def _pair(f: np.ndarray, k: int) -> np.ndarray:
        """The joint table of filter positions k and k + 1, by byte pair."""
        return (f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, -1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; the caller bounds how much text is given at a time."""
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        at = [i for i, text in enumerate(texts) if text and self.langs and LETTER.search(text)]
        for i, row in zip(at, self._mean([texts[i] for i in at]) if at else [], strict=True):
            best = int(row.argmax())
            langs[i], scores[i] = self.langs[best], float(min(1.0, max(0.0, row[best])))
        return langs, scores

    def _mean(self, texts: list[str]) -> np.ndarray:
        raw = [t.encode("utf-8", "replace").translate(FOLD) for t in texts]
        windows, counts = cut_windows(raw, self.window)
        weights = np.full(len(windows), self.window, np.float64)
        ends = np.cumsum(counts)
        weights[ends - 1] = [(len(b) - 1) % self.window + 1 for b in raw]
        totals = np.add.reduceat(self.scores(windows) * weights[:, None], ends - counts, axis=0)
        return totals / np.array([len(b) for b in raw])[:, None]


def cut_windows(raw: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([-(-len(b) // window) for b in raw])
    parts = []
    for b in raw:
        parts += (b, bytes(-len(b) % window))
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, window), counts


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], window: int = 128, widths: tuple[int, ...] = (2, 3, 4), size: int = 8, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 7) -> ByteConvNet:
    """Adam on the cross-entropy; each epoch sees every excerpt once, cropped at random."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    net = ByteConvNet(
        langs, window, {w: rng.normal(0, 0.1, (w, 256, size)).astype(np.float32) for w in widths}, {w: np.zeros(size, np.float32) for w in widths},
        rng.normal(0, 0.1, (len(widths) * size, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32),
    )
    if len(langs) < 2:
        return net
    raw = [t.encode("utf-8", "replace").translate(FOLD) for t in texts]
    y = np.searchsorted(np.array(langs), labels)
    params = [*net.filters.values(), *net.bias.values(), net.out, net.out_bias]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(raw))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x = np.zeros((len(rows), window), np.intp)
            for i, r in enumerate(rows):
                length = int(rng.integers(min(12, window), window + 1))
                start = int(rng.integers(0, max(1, len(raw[r]) - length + 1)))
                crop = np.frombuffer(raw[r][start : start + length], np.uint8)
                x[i, : len(crop)] = crop
            grads = gradients(net, x, y[rows])
            step += 1
            for p, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def gradients(net: ByteConvNet, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy; through max pooling only the winning position of a filter learns."""
    n, at, pooled, size = len(x), {}, [], next(iter(net.filters.values())).shape[2]
    for width, f in net.filters.items():
        valid = net.window - width + 1
        total = f[0][x[:, :valid]]
        for k in range(1, width):
            total = total + f[k][x[:, k : k + valid]]
        at[width] = total.argmax(axis=1)
        pooled.append(np.take_along_axis(total, at[width][:, None, :], axis=1)[:, 0] + net.bias[width])
    hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
    delta = softmax(hidden @ net.out + net.out_bias)
    delta[np.arange(n), y] -= 1
    delta /= n
    back = (delta @ net.out.T) * (hidden > 0)
    by_filter, by_bias = [], []
    for i, (width, f) in enumerate(net.filters.items()):
        part = back[:, i * size : (i + 1) * size]
        grad = np.empty_like(f)
        for k in range(width):
            byte = np.take_along_axis(x, at[width] + k, axis=1)
            grad[k] = np.bincount((byte * size + np.arange(size)).reshape(-1), part.reshape(-1), 256 * size).reshape(256, size)
        by_filter.append(grad)
        by_bias.append(part.sum(axis=0))
    return [*by_filter, *by_bias, hidden.T @ delta, delta.sum(axis=0)]


def held_out() -> Column:
    """Rows kept for testing: crc32 of the id as text, mod 5, is 0 (a null id counts as learned from)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, rows_per_lang: int = 1500, excerpt: int = 256, max_langs: int = MAX_LANGS, **options) -> ByteConvNet:
    """Train on rows that are not held out, of every language.

    Bound: ``rows_per_lang`` rows a language reach the driver, whatever repeats there are; more than
    ``max_langs`` languages raise ValueError.
    """
    columns = [docs[c].cast(t).alias(c) for c, t in (("doc_id", "long"), ("text", "string"), ("lang", "string"))]
    labelled = docs.select(*columns).where(~held_out() & F.col("lang").isNotNull()).withColumn("draw", F.xxhash64("doc_id", "text"))
    counts = {r["lang"]: max(1, r["n"]) for r in labelled.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than max_langs = {max_langs} languages to learn")
    if not counts:
        return train([], [], **options)
    # Twice the share that is wanted, by a hash, repeats once, and of these the least hashes: only they meet in one task.
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * rows_per_lang / n))]), F.col("lang"))
    drawn = labelled.where((F.pmod("draw", F.lit(1 << 30)) / (1 << 30) < share) & F.col("text").rlike(r"\p{L}"))
    starts = [F.pmod(F.xxhash64("draw", F.lit(i)), F.greatest(F.length("text") - excerpt + 1, F.lit(1))) + 1 for i in range(2)]
    parts = F.array_distinct(F.array(*[F.substring("text", s.cast("int"), F.lit(excerpt)) for s in starts]))
    found = drawn.select("lang", "draw", parts.alias("parts")).groupBy("lang", "draw").agg(F.min("parts").alias("parts"))
    least = found.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("draw", "parts"))), 1, rows_per_lang).alias("rows"))
    rows = [(r["draw"], lang, part) for lang, taken in least.orderBy("lang").collect() for r in taken for part in r["parts"]]
    return train([r[2] for r in rows], [r[1] for r in rows], **options)


def language(net: ByteConvNet, text: Column) -> Column:
    """struct<lang_pred, score> of a text."""

    def work(texts: pa.Array) -> pa.Array:
        langs, scores = net.predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return common.text_function(work, "lang_pred string, score double")(text)


def identify(docs: DataFrame, net: ByteConvNet) -> DataFrame:
    common.ship(docs.sparkSession)
    found = docs.select(docs["doc_id"].cast("long").alias("doc_id"), language(net, docs["text"].cast("string")).alias("found"))
    return found.select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return identify(docs, fit(docs))
