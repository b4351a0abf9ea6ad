"""Operators that compare documents, against all pairs."""

import re
from collections import Counter

import pytest
from gridloom.llm import op4_near_dedup as near
from gridloom.llm import op6_decontaminate as leaks
from gridloom.llm import op8_line_dedup as lines
from gridloom.llm.components import components
from gridloom.session import Run
from helpers import SCHEMA, edited, prose

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingle_set(text, width):
    w = words(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def groups(rows, width):
    sets = [shingle_set(r[1], width) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_all_pairs(clashing, rows, width):
    sets, roots = groups(rows, width)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots)}
    expected = Counter((r[0], len(s), r[0] if not s else least[root]) for r, s, root in zip(rows, sets, roots, strict=True))
    found = near.near_duplicates(clashing, width).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_one_of_each_group_stays(clashing, rows):
    sets, roots = groups(rows, 5)
    kept = near.one_of_each(clashing).collect()
    assert len(kept) == len({r for r, s in zip(roots, sets, strict=True) if s}) + sum(not s for s in sets)
    assert {r["text"] for r in kept} <= {r[1] for r in rows} and {r["_key"] for r in kept} == {"x"}
    assert kept[0].asDict().keys() == set(clashing.columns)


def test_groups_of_null_ids_stay_apart(spark):
    texts = [prose(i, 60) for i in range(4)]
    found = [(None, t, None, None, None) for t in texts] + [(None, texts[0] + " more", None, None, None), (None, texts[1], None, None, None), (7, texts[2], None, None, None), (7, texts[2], None, None, None)]
    kept = near.one_of_each(spark.createDataFrame(found, SCHEMA)).collect()
    assert len(kept) == 4 and len({r["text"].split()[0] + r["text"].split()[7] for r in kept}) == 4 and sum(r["doc_id"] == 7 for r in kept) == 1


def test_large_open_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near, "CELL", 300)
    base = prose(5, 90)
    texts = [edited(edited(base, i % 7, 0.08), 50 + i, 0.03) for i in range(60)]
    found = [(i, t, None, None, None) for i, t in enumerate(texts)]
    sets, roots = groups(found, 2)
    least = {r: min(i for i, x in enumerate(roots) if x == r) for r in set(roots)}
    got = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(spark.createDataFrame(found, SCHEMA), 2).collect()}
    assert got == {i: least[r] for i, r in enumerate(roots)} and 1 < len(least) < 60


def test_empty_table(empty):
    assert near.near_duplicates(empty).count() == 0 and near.one_of_each(empty).count() == 0
    assert lines.removed_lines(empty).count() == 0 and lines.deduplicated(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    assert {tuple(r) for r in components(edges, Run(spark, "test")).collect()} == {(i, 0) for i in range(1, 41)} | {(101, 100)}


def test_sketches_estimate_high_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:356], rng.integers(0, 1 << 63, 44, dtype=np.uint64)])  # similarity 0.8
    c = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sketches = near.odd_sketches(np.array([near.minhash(x) for x in (a, b, c)]))
    unlike = lambda i, j: int(np.bitwise_count((sketches[i] ^ sketches[j]).view(np.uint64)).sum())
    assert unlike(0, 1) < near.most_odd_bits(0.8 - near.SLACK) < unlike(0, 2)


def expected_lines(rows):
    seen, order = [], sorted(((-1 << 63) if r[0] is None else r[0], i) for i, r in enumerate(rows))
    gone, count = {}, {}
    for place, i in order:
        for number, line in enumerate((rows[i][1] or "").split("\n")):
            s = frozenset(words(line))
            if s:
                count.setdefault((rows[i][0], rows[i][1]), set()).add(number)
                if any(p < (place, number) and 100 * len(s & o) >= 80 * len(s | o) for p, o in seen):
                    gone.setdefault((rows[i][0], rows[i][1]), set()).add(number)
                seen.append(((place, number), s))
    return gone, count


@pytest.mark.parametrize("hot", [None, (1, 8)])
def test_line_dedup_matches_all_pairs(clashing, rows, hot, monkeypatch):
    if hot:  # every token in pairs, longer lines by length classes
        monkeypatch.setattr(lines, "HOT", hot[0])
        monkeypatch.setattr(lines, "LONG", hot[1])
    gone, count = expected_lines(rows)
    found = lines.removed_lines(clashing).collect()
    totals = Counter()
    for (doc_id, _), numbers in count.items():
        totals[doc_id] += len(numbers)
    assert Counter({k: v for k, v in totals.items()}) == Counter({k: sum(r["n_lines"] for r in found if r["doc_id"] == k) for k in totals})
    expected = Counter((doc_id, tuple(sorted(gone.get((doc_id, text), ())))) for doc_id, text in count)
    assert Counter((r["doc_id"], tuple(r["removed"])) for r in found) == expected
    texts = Counter(lines.without(r[1], gone.get((r[0], r[1]), ())) if r[1] is not None else None for r in rows)
    left = lines.deduplicated(clashing).collect()
    assert Counter(r["text"] for r in left) == texts and {r[n] for r in left for n in ("_gone", "_gone_key", "maybe", "text_key")} == {"x"}


@pytest.mark.parametrize("hot", [None, (0, 6)])
def test_many_alike_lines_match_all_pairs(spark, hot, monkeypatch):
    import random

    if hot:
        monkeypatch.setattr(lines, "HOT", hot[0])
        monkeypatch.setattr(lines, "LONG", hot[1])
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(24)]
    line = lambda: " ".join(rng.sample(vocabulary, rng.randrange(1, 14)))
    lined = [line() for _ in range(500)]
    lined += [" ".join(x for x in rng.choice(lined).split() if rng.random() > 0.1) for _ in range(500)]
    rng.shuffle(lined)
    found = [(i, "\n".join(lined[8 * i : 8 * i + 8]), None, None, None) for i in range(125)]
    gone, _ = expected_lines(found)
    got = {(r["doc_id"]): tuple(r["removed"]) for r in lines.removed_lines(spark.createDataFrame(found, SCHEMA)).collect() if r["removed"]}
    assert got == {i: tuple(sorted(v)) for (i, _), v in gone.items()} and sum(map(len, got.values())) > 300


def test_alike_lines_that_tie_at_a_place_both_stay(spark):
    texts = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i k"), (2, "a b c d e f g h i l"), (None, "q r s t u v w x y z"), (None, "q r s t u v w x y 0")]
    found = lines.removed_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_lines"], tuple(r["removed"])) for r in found) == Counter({(1, 1, ()): 2, (2, 1, (0,)): 1, (None, 1, ()): 2})


@pytest.mark.parametrize("far", [0, 1 << 40])
def test_postings_in_order_of_token_place_and_line(far):
    import numpy as np

    rng = np.random.default_rng(1)
    token, place, line = rng.integers(0, 50, 3000) + (1 << 32) - 50, rng.integers(-9, 9, 3000) * (far or 1), rng.integers(0, 5, 3000)
    found, expected = lines.by_place(token, place, line), np.lexsort((line, place, token))
    assert all((c[found] == c[expected]).all() for c in (token, place, line))


def test_line_dedup_query(spark, rows, monkeypatch):
    from gridloom.llm import common

    extra = [(3, "first line here now\nsecond line there then", None, None, None), (3, "another text alone", None, None, None), (3, "another text alone", None, None, None)]
    found = [*rows, *extra]
    gone, count = expected_lines(found)
    monkeypatch.setattr(common, "documents", lambda *_: spark.createDataFrame(found, SCHEMA))
    expected = Counter((r[0], len(count.get((r[0], r[1]), ())), len(gone.get((r[0], r[1]), ())), ",".join(map(str, sorted(gone.get((r[0], r[1]), ()))))) for r in found)
    assert Counter(map(tuple, lines.op8_line_dedup(spark, "").collect())) == expected


def test_decontamination_matches_brute_force(spark, clashing, empty, rows):
    whole = words(rows[40][1])
    items = [(0, " ".join(whole[10:40])), (1, " ".join(whole[5:14]).upper()), (2, "not found in any of these texts at all"), (3, None), (4, ""), (5, "one two"), (None, " ".join(words(rows[-8][1])[50:120]) or "x"), (6, " ".join([*whole[10:38], "other", "end"]))]
    long_text = next(r[1] for r in rows if r[1] and len(r[1]) > 30_000)
    items.append((7, " ".join(words(long_text)[4000:4030])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = Counter()
    for doc_id, text, *_ in rows:
        have = shingle_set(text, 5)
        for item_id, item in items:
            wanted = shingle_set(item, 5)
            if wanted and 100 * len(wanted & have) >= 80 * len(wanted):
                expected[doc_id, item_id, len(wanted), len(wanted & have)] += 1
    assert Counter(map(tuple, leaks.contained(clashing, benchmark).collect())) == expected and len(expected) > 4
    left = leaks.decontaminated(clashing, benchmark).collect()
    clean = Counter(r["text"] for r in left)
    assert left[0].asDict().keys() == set(clashing.columns) and {r[n] for r in left for n in ("maybe", "text_key", "found_row")} == {"x"}
    holds = lambda t: any(w and 100 * len(w & shingle_set(t, 5)) >= 80 * len(w) for w in (shingle_set(i, 5) for _, i in items))
    assert clean == Counter(r[1] for r in rows if not holds(r[1]))
    assert leaks.contained(empty, benchmark).count() == 0 and leaks.contained(clashing, benchmark.limit(0)).count() == 0


def test_short_and_scattered_items_are_all_found(spark):
    fresh = lambda name, n: [f"{name}x{k}" for k in range(n)]
    items, texts = [], []
    for i in range(600):  # one shingle, in the first block, the last or between
        item, filler = fresh(f"a{i}", 5), fresh(f"b{i}", 120)
        at = (0, len(filler), 50)[i % 3]
        items.append((i, " ".join(item)))
        texts.append((i, " ".join(filler[:at] + item + filler[at:])))
    for i in range(600, 1000):  # 257 shingles, 237 of them in six pieces far apart
        item, filler = fresh(f"a{i}", 261), fresh(f"b{i}", 6000)
        items.append((i, " ".join(item)))
        texts.append((i, " ".join(w for k in range(6) for w in item[k * 44 : k * 44 + 44] + filler[k * 1000 : k * 1000 + 1000])))
    docs, benchmark = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = [(i, i, len(w), len(w & shingle_set(text, 5))) for (i, item), (_, text) in zip(items, texts, strict=True) for w in [shingle_set(item, 5)]]
    assert all(100 * shared >= 80 * n for _, _, n, shared in expected)
    assert sorted(map(tuple, leaks.contained(docs, benchmark).collect())) == expected
    assert leaks.decontaminated(docs, benchmark).count() == 0


def test_items_shorter_than_a_shingle_match_whole_documents_only(spark):
    benchmark = spark.createDataFrame([(1, "one two"), (2, "one two three four five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "One  TWO"), (2, "one two three"), (3, "zero one two three four five six")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.contained(docs, benchmark).collect()) == [(1, 1), (3, 2)]


def test_a_sketch_cannot_lose_a_contained_item():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in [*range(1, 40), 63, 64, 65, 500]:
        found = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for _ in range(20):
            least, hits = leaks.sketch(found, 80)
            kept = rng.permutation(found)[: n - leaks.missing(n, 80)]
            assert 100 * len(kept) >= 80 * n and 1 <= hits <= np.isin(least, kept).sum()
