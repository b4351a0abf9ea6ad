"""Fill-in-the-middle against a plain version that works token by token."""

import hashlib
import re

import pytest
from gridloom.llm import op11_fill_in_middle as fim
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def plain_version(doc_id, text):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(tokens), "plain", None, None, text or ""
    return (len(tokens), "spm", p, m, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(tokens), "psm", p, m, f"<P>{p}<S>{s}<M>{m}")


ODD = ["<P", "a<P>b", "<S", "<", "<M", "x<S><M>", "P>S>M>", "<<P", "\x00a\x00", "é😀한글", "A\r\nB", "a" * 5000, "ab1" * 4000, " \x85", "z"]


@pytest.fixture(scope="module")
def odd(spark, rows):
    return rows + [(1000 + 40 * i + k, t, None, None, None) for i, t in enumerate(ODD) for k in range(40)]


def test_every_document_equals_the_plain_version(spark, odd, docs):
    table = spark.createDataFrame(odd, docs.schema).repartition(3)
    made = fim.fill_in_middle(table).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    joined = sorted(((r["doc_id"], r["back"]), (r["n"], r["form"], r["prefix"], r["middle"], r["output"])) for r in made.collect() if r["doc_id"] is not None)
    assert joined == sorted(((r[0], r[1] or ""), plain_version(r[0], r[1])) for r in odd if r[0] is not None)
    assert {r[1][1] for r in joined} == {"plain", "psm", "spm"}
    assert sorted(r["back"] for r in made.where("doc_id IS NULL").collect()) == sorted(r[1] or "" for r in odd if r[0] is None)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ09 \né😀<P>\x00-", max_size=60), st.integers(1, 9))
def test_offsets_of_parts_are_those_of_the_whole(text, size):
    want = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S)]
    assert fim.token_starts(text, fim.splitter(), size).tolist() == want == fim.token_starts(text, fim.splitter()).tolist()
    bounds = fim.parts(text, size)
    assert "".join(text[a:b] for a, b in bounds) == text


def test_other_pattern_keeps_the_round_trip(docs):
    made = fim.fill_in_middle(docs, "[a-z]+|[^a-z]+").select("*", fim.restored(F.col("output"), F.col("form")).alias("back"))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("back"))
    assert made.where(F.col("n") != F.size(F.regexp_extract_all(F.col("back"), F.lit("([a-z]+|[^a-z]+)")))).isEmpty()
    assert made.select("back").exceptAll(texts).isEmpty() and texts.exceptAll(made.select("back")).isEmpty()


def test_clashing_columns_and_empty_tables(clashing, empty, rows):
    assert fim.fill_in_middle(clashing.withColumns({c: F.lit(1) for c in ("n", "form", "output", "prefix")})).count() == len(rows)
    assert fim.fill_in_middle(empty).count() == 0
