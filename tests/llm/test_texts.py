"""Operators on single texts, against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from gridloom.llm import op1_language_id as lang
from gridloom.llm import op2_quality as quality
from gridloom.llm import op3_packing as packing
from gridloom.llm import op5_quality_rules as rules
from gridloom.llm import op7_token_counts as tokens
from gridloom.llm import shingles
from gridloom.llm.differencing import difference, near_equal_windows
from hypothesis import given, settings
from hypothesis import strategies as st

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_word_hashes_follow_words(rows):
    texts = [r[1] for r in rows]
    hashes, bounds = shingles.row_words(pa.array(texts, pa.string()).slice(0))
    lower = {c: c + 32 for c in range(65, 91)}
    words = [WORD.findall((t or "").translate(lower)) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    known = {}
    for word, h in zip((w for ws in words for w in ws), hashes.tolist(), strict=True):
        assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=60))
def test_windows_hold_everything_and_never_overflow(sizes):
    bins = near_equal_windows(sizes, 256)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in b) for b in bins) <= 256
    assert sorted(i for b in difference(sizes, 3) for i in b) == list(range(len(sizes)))


def test_packing_round_trip(spark, docs, clashing, empty, rows):
    from tokenizers import Tokenizer

    files = packing.tokenizer_files()
    found = packing.pack(clashing, *files).toPandas()
    encoder = Tokenizer.from_file(files[0])
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(encoder.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        wanted[(-1 if doc_id is None else doc_id, len(ids), zlib.crc32(ids[:1024].tobytes()) if len(ids) >= 1024 else None)] += 1
        pieces = found[found.doc_id.isna() if doc_id is None else found.doc_id == doc_id]
        pieces = pieces[pieces.doc_tokens == len(ids)]
        for start, length, crc in {(p.start, p.length, p.ids_crc32) for p in pieces.itertuples()}:
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc
        assert pieces.length.sum() % len(ids) == 0
    assert found[found.start == 0].shape[0] == len(rows)
    fills = []
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group.offset.tolist() == [0, *np.cumsum(group.length)[:-1]]
        fills.append(group.length.sum())
    assert max(fills) <= 1024 and packing.padding(np.array(fills), 1024) < 0.1 * sum(fills)
    assert packing.pack(empty, *files).count() == 0


def test_language_model_learns_and_rejects(spark, empty, clashing):
    rng = random.Random(1)
    syllables = {"aa": ["ban", "kor", "tul", "mi"], "bb": ["sch", "ung", "ei", "ver"], "cc": ["oui", "eau", "tré", "la"]}
    make = lambda l: " ".join("".join(rng.choice(syllables[l]) for _ in range(rng.randrange(1, 4))) for _ in range(60))
    labels = [l for l in syllables for _ in range(200)]
    docs = spark.createDataFrame([(i, make(l), l, "s", 0) for i, l in enumerate(labels)], "doc_id long, text string, lang string, source string, n_chars long")
    net = lang.fit(docs)
    found = lang.identify(docs, net).toPandas().set_index("doc_id")
    held = found[found.held_out]
    assert len(held) > 50 and (held.lang_pred == [labels[i] for i in held.index]).mean() > 0.95
    assert found.score.between(0, 1).all()
    assert net.predict([None, "", "123 !!", "ban"])[0][:3] == ["und"] * 3
    assert lang.identify(empty, lang.fit(empty)).count() == 0
    odd = lang.identify(clashing, lang.fit(clashing)).toPandas()
    assert len(odd) == clashing.count() and odd.lang_pred.isin(["en", "und"]).all()


def test_thresholds_count_rows_that_pass_the_base_rule(spark):
    plain, marked = [" ".join(f"{m}w{i}x{k}" for k in range(60)) for m in ("", "#") for i in (1,)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def kept(n_marked, n_failing):
        rows = [(i, plain, "en", "a", 0) for i in range(120)] + [(200 + i, marked, "en", "b", 0) for i in range(n_marked)] + [(300 + i, "# " * 20, "en", "b", 0) for i in range(n_failing)]
        return {r["doc_id"]: r["kept"] for r in rules.judge(spark.createDataFrame(rows, schema)).collect()}[200]

    assert kept(30, 0) and not kept(29, 0) and not kept(29, 40)


def test_every_language_is_learned_or_refused(spark):
    labels = [f"l{i:03}" for i in range(70)]
    text = lambda l: f"{l} {l}x {l}y " * 20
    docs = spark.createDataFrame([(i, text(l), l, "s", 0) for i, l in enumerate(labels * 6)], "doc_id long, text string, lang string, source string, n_chars long")
    learned = sorted({r["lang"] for r in docs.where(~lang.held_out()).select("lang").collect()})
    assert len(learned) > 64 and lang.fit(docs, epochs=1).langs == learned
    with pytest.raises(ValueError, match="max_langs = 64"):
        lang.fit(docs, max_langs=64, epochs=1)
    assert lang.fit(docs.where("lang < 'l064'"), max_langs=64, epochs=1).langs == [l for l in learned if l < "l064"]


def naive_scores(net, windows):
    """The network by loops over windows, filters and places."""
    out = []
    for window in windows:
        hidden = []
        for width, f in net.filters.items():
            for k in range(f.shape[2]):
                best = max(sum(float(f[j, window[at + j], k]) for j in range(width)) for at in range(net.window - width + 1))
                hidden.append(max(0.0, best + float(net.bias[width][k])))
        out.append([sum(h * float(w) for h, w in zip(hidden, net.out[:, c], strict=True)) + float(net.out_bias[c]) for c in range(len(net.langs))])
    shifted = np.exp(np.array(out) - np.max(out, axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def test_scores_match_a_naive_forward_pass():
    net = lang.train(["ab cd ef " * 9, "wx yz äö " * 9] * 8, ["a", "b"] * 8, window=24, epochs=2)
    texts = ["ab cd", "Wx yz äö ab cd ef wx yz", "ef" * 40, "äö" * 13 + "x"]
    langs, scores = net.predict(texts)
    for text, name, score in zip(texts, langs, scores, strict=True):
        raw = text.encode().translate(lang.FOLD)
        parts = [raw[i : i + 24] for i in range(0, len(raw), 24)]
        windows = [list(p.ljust(24, b"\0")) for p in parts]
        mean = (naive_scores(net, windows) * np.array([len(p) for p in parts])[:, None]).sum(axis=0) / len(raw)
        assert name == net.langs[int(mean.argmax())] and score == pytest.approx(mean.max(), abs=1e-4)


def test_only_letters_have_a_language(spark):
    net = lang.train(["ab cd ef " * 9, "wx yz " * 9] * 8, ["a", "b"] * 8, epochs=1)
    assert net.predict(["²³ ½", "Ⅷ", "१२३", "_ 12", "é", "漢"])[0] == [lang.UNDETERMINED] * 4 + [net.predict(["é"])[0][0], net.predict(["漢"])[0][0]]
    docs = spark.createDataFrame([(i, "x", None, None, None) for i in range(50)], "doc_id long, text string, lang string, source string, n_chars long")
    found = lang.identify(docs, net).toPandas()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.itertuples())


@pytest.mark.parametrize("same", [False, True])
def test_the_sample_is_bounded_for_null_and_repeated_ids(spark, monkeypatch, same):
    taken = []
    monkeypatch.setattr(lang, "train", lambda texts, labels, **_: taken.append(Counter(labels)))
    rows = spark.range(20_000).selectExpr("cast(null as bigint) doc_id", "concat('words of text ', cast(id as string))" if not same else "'words of text'", "if(id % 2 = 0, 'aa', 'bb') lang").toDF("doc_id", "text", "lang")
    lang.fit(rows, rows_per_lang=100)
    assert taken[0] == ({"aa": 1, "bb": 1} if same else {"aa": 100, "bb": 100})


def test_gradients_match_differences():
    net = lang.train(["abcd" * 9, "wxyz" * 9] * 4, ["a", "b"] * 4, window=16, epochs=1)
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 123, (5, 16)), np.array([0, 1, 0, 1, 1])

    def loss():
        return -np.log(net.scores(x.astype(np.uint8))[np.arange(5), y].astype(np.float64)).mean()

    grads = lang.gradients(net, x, y)
    for p, g in ((net.out, grads[-2]), (net.filters[3], grads[1])):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-2
        high = loss()
        p[at] -= 2e-2
        low = loss()
        p[at] += 1e-2
        assert abs((high - low) / 2e-2 - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_base_counts(rows):
    for text in [r[1] or "" for r in rows]:
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        grams = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
        expected = (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), len(lines))
        assert rules.base_counts(text) == expected


def test_quality_rules_keep_every_row(clashing, empty, rows):
    found = rules.judge(clashing).toPandas()
    assert len(found) == len(rows) and not (found.base_failed & found.kept).any()
    assert rules.judge(empty).count() == 0


def plain_count(word, scores):
    text = tokens.MARK + word
    best = [(0, 0)]
    for end in range(1, len(text) + 1):
        width = len(text[end - 1].encode())
        options = [(-(best[end - 1][0] - width * tokens.BYTE_NATS * tokens.UNIT), best[end - 1][1] + width)]
        options += [(-(best[s][0] + scores[text[s:end]]), best[s][1] + 1) for s in range(end) if text[s:end] in scores]
        score, count = min(options)
        best.append((-score, count))
    return best[-1][1]


def test_token_counts(clashing, empty, rows):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = tokens.zipf_scores(tokens.public_pieces(path))
    found = tokens.token_counts(clashing, path).toPandas()
    totals = Counter()
    memo = {}
    for doc_id, text, *_ in rows:
        words = [w for w in WORD.findall(text or "") if len(w) <= 5000]
        totals[(-1 if doc_id is None else doc_id, len(words), sum(memo.setdefault(w, plain_count(w, scores)) for w in words))] += 1
    assert totals == Counter((-1 if np.isnan(r.doc_id) else int(r.doc_id), r.n_pretokens, r.n_tokens) for r in found.itertuples())
    small = tokens.TrieCounter(scores, max_nodes=50)
    assert [small.count(w) for w in ("river", "rivers", "stone", "river")] == [plain_count(w, scores) for w in ("river", "rivers", "stone", "river")]
    assert tokens.token_counts(empty, path).count() == 0


def test_long_words_take_bounded_memory():
    import random
    import tracemalloc

    scores = {**{c: -9_000_000 for c in "abcdefghij"}, "ab": -5_000_000, "abc": -7_000_000, "cde": -6_100_000, "fghij": -9_300_000}
    rng, counter = random.Random(2), tokens.TrieCounter(scores)
    for size in (60, 63, 64, 65, 70, 500):
        word = "".join(rng.choice("abcdefghijxé") for _ in range(size))
        assert counter.count(word) == plain_count(word, scores)
    word = "".join(rng.choice("abcdefghij") for _ in range(300_000))
    tracemalloc.start()
    assert counter.count(word) > 0
    assert tracemalloc.get_traced_memory()[1] < 5_000_000 and len(counter._best) < 1000
    tracemalloc.stop()


def test_upper_case_counts_in_tokens():
    scores = {"▁ab": -1, "▁AB": -1, **{c: -9_000_000 for c in "▁abAB"}}
    pretokens, found = tokens.TrieCounter(scores).counts(pa.array(["ab AB aB", None, "AB"]))
    assert pretokens.tolist() == [3, 0, 1] and found.tolist() == [1 + 1 + 3, 0, 1]


def test_unigram_agrees_with_a_public_implementation():
    from tokenizers.models import Unigram

    scores = {**{c: -9_000_000 for c in "▁abcdefghij"}, "▁ab": -5_000_000, "abc": -7_000_000, "cde": -6_100_000, "fghij": -9_300_000, "ij": -8_000_000}
    model = Unigram([("<unk>", -99.0), *[(p, s / tokens.UNIT) for p, s in scores.items()]], 0, False)
    counter = tokens.TrieCounter(scores)
    for word in ("abcde", "fghij", "ab", "cdeij", "jihgfedcba", "abcabcabc"):
        assert counter.count(word) == len(model.tokenize("▁" + word))


def test_importance_resampling(spark, docs, clashing, empty, rows):
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(60)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.resample(docs, labels, fraction=0.5).toPandas()
    known = found[found.gumbel_key.notna()]
    assert len(found) == len(rows) and not found[found.n_ngrams == 0].selected.any()
    assert known[known.selected].gumbel_key.min() >= known[~known.selected].gumbel_key.max()
    assert known.selected.sum() >= round(0.5 * len(known))
    good = {i for i in range(60) if i % 4}
    raw, target = np.ones(quality.BUCKETS), np.ones(quality.BUCKETS)
    for doc_id, text, *_ in rows:
        at = np.bincount(quality.features(shingles.text_words(text)), minlength=quality.BUCKETS)
        raw += at
        target += at * (doc_id in good)
    ratios = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for r in known.drop_duplicates("doc_id").itertuples():
        if not np.isnan(r.doc_id):
            text = next(t for i, t, *_ in rows if i == r.doc_id)
            assert r.log_weight == pytest.approx(ratios[quality.features(shingles.text_words(text))].sum())
    assert quality.resample(empty, labels.limit(0)).count() == 0
    k = round(0.5 * len(known))
    least = sorted(known.gumbel_key, reverse=True)[k - 1]
    assert found.selected.tolist() == [bool(x >= least) for x in found.gumbel_key.fillna(-np.inf)]
    noise = (known.gumbel_key - known.log_weight).drop_duplicates()
    assert len(noise) > 60 and 0.1 < noise.mean() < 1.1 and noise.min() > -2.5  # a standard Gumbel variable has mean 0.58
    scaled = quality.resample(docs, labels, fraction=0.5, effective=30).toPandas()
    both = known.merge(scaled[scaled.n_ngrams > 0], on=["doc_id", "n_ngrams"]).drop_duplicates("doc_id")
    assert np.allclose(both.log_weight_x, both.log_weight_y * both.n_ngrams / 30)
    odd = quality.resample(clashing, labels, fraction=0.5).toPandas()
    assert Counter(odd.selected) == Counter(found.selected)


def test_null_ids_have_draws_of_their_own(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", None, None, None) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    found = quality.resample(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), fraction=0.5).toPandas()
    assert found.gumbel_key.nunique() == 40 and found.selected.sum() == 20


@pytest.mark.parametrize("k", [0, 1, 2, 5, 9, 12, 99])
def test_kth_greatest(spark, k):
    values = [5, -3, 5, 10**15, 7, 7, -(10**15), 0, 2]
    found = quality.kth_greatest(spark.createDataFrame([(v,) for v in values] + [(None,)], "v long"), "v", k)
    assert found == (sorted(values, reverse=True)[min(k, len(values)) - 1] if k else None)
