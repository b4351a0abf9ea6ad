"""The pipeline's stages, each on what its predecessor kept."""

import unicodedata
from collections import Counter

import corpus_pipeline
import numpy as np
from gridloom.llm import common, op1_language_id
from gridloom.session import Run
from helpers import prose
from test_pairs import expected_lines, groups, shingle_set

SF = "/root/testdata/sf0.001"


def plain_language(net, text):
    """The most probable language of a whole text and its mean probability, window by window; None without a letter."""
    if not any(unicodedata.category(c)[0] == "L" for c in text):
        return None, 0.0
    raw, total = text.encode().translate(op1_language_id.FOLD), 0
    for at in range(0, len(raw), net.window):
        part = raw[at : at + net.window]
        window = np.frombuffer(part.ljust(net.window, b"\0"), np.uint8)
        hidden = []
        for width, f in net.filters.items():
            sums = sum(f[j, window[j : net.window - width + 1 + j]] for j in range(width))
            hidden.append(np.maximum(sums.max(axis=0) + net.bias[width], 0))
        out = np.concatenate(hidden) @ net.out + net.out_bias
        odds = np.exp(out - out.max())
        total = total + odds / odds.sum() * len(part)
    mean = total / len(raw)
    return net.langs[int(mean.argmax())], float(mean.max())


def test_language_verdicts_row_by_row(spark):
    docs = common.documents(spark, SF)
    rows = docs.collect() + [(-1, None), (-2, ""), (-3, "12 .. 34"), (-4, "\u0ba4\u0bae\u0bbf" * 30)]
    extra = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows[-4:]], docs.schema)
    docs = docs.unionByName(extra)
    net = op1_language_id.fit(docs)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    for doc_id, text, *_ in rows:
        name, score = plain_language(net, text or "")
        if abs(score - corpus_pipeline.MIN_LANGUAGE_SCORE) > 1e-3:
            assert (doc_id in kept) == (name is not None and score >= corpus_pipeline.MIN_LANGUAGE_SCORE), doc_id
    assert not kept & {-1, -2, -3}


def test_stages(spark):
    docs = common.documents(spark, SF)
    columns, seen, run = docs.columns, {}, Run(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs.collect()
        docs = run.table(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
    seen["end"] = docs.collect()
    names = [*dict(corpus_pipeline.STAGES), "end"]
    ids = {n: sorted(r["doc_id"] for r in seen[n]) for n in names if n != "end"}

    assert len(ids["line_dedup"]) >= 0.97 * len(ids["language_id"])
    tuples = [tuple(r) for r in seen["line_dedup"]]
    gone, _ = expected_lines(tuples)
    texts = {r["doc_id"]: r["text"] for r in seen["near_dedup"]}
    for doc_id, text, *_ in tuples:
        drop = gone.get((doc_id, text), ())
        assert texts[doc_id] == "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
    tuples = [tuple(r) for r in seen["near_dedup"]]
    sets, roots = groups(tuples, 5)
    assert len(ids["decontaminate"]) == len({r for r, s in zip(roots, sets, strict=True) if s}) + sum(not s for s in sets)
    items = [shingle_set(r["text"], 5) for r in common.documents(spark, SF, "benchmark").collect()]
    clean = [r["doc_id"] for r in seen["decontaminate"] if not any(i and 100 * len(i & shingle_set(r["text"], 5)) >= 80 * len(i) for i in items)]
    assert sorted(clean) == ids["packing"]
    assert sorted(r["doc_id"] for r in seen["end"] if r["start"] == 0) == ids["packing"]


def test_odd_rows_and_clashing_columns_pass_through(spark, clashing, empty):
    before = Counter(tuple(r) for r in clashing.drop("text", "n_chars").collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
        found = stage(spark, clashing, SF)
        if name == "packing":
            assert found.where("start = 0").count() == clashing.count()
            continue
        assert found.columns == clashing.columns
        after = Counter(tuple(r) for r in found.drop("text", "n_chars").collect())
        assert after and not after - before, name
        assert after == before or name != "line_dedup"


def test_a_row_each_of_repeated_documents(spark):
    text = prose(1, 80)
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, prose(2, 80), "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == [1, 3]
