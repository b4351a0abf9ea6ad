"""Chat formatting and license scans, and all queries with SQL."""

import hashlib
import json
import re

import pytest
from helpers import SCHEMA, normal
from gridloom.llm import op9_chat_format as chat
from gridloom.llm import op10_license_scan as licenses
from gridloom.llm import registry
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>assistant\nhi<|end|>\n", "\\l\\\\b\\e", "", "a\n\nb\n", "é😀 <|turn|>", "\\", "[<\\"]


def rendered(spark, records):
    frame = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    made = chat.format_records(frame)
    back = made.select("*", chat.read_back(F.col("formatted")).alias("back"), chat.under_mask(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return {r["id"]: r for r in back.collect()}


def test_round_trip_of_nasty_texts(spark):
    turns = [("user", t) for t in NASTY] + [("assistant", t) for t in NASTY] + [("sys\ntem<|end|>", "x"), ("", "")]
    r = rendered(spark, [json.dumps({"messages": [{"role": a, "content": b} for a, b in turns]})])[0]
    assert [tuple(t) for t in r["back"]] == turns == [tuple(t) for t in r["turns"]]
    assert r["loss"] == "".join(NASTY)
    assert sum(x["chars"] for x in r["loss_mask"]) == len(r["formatted"])
    assert r["formatted"].count("<|turn|>") == len(turns) == r["formatted"].count("<|end|>")


def test_layouts(spark):
    records = [
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"instruction": "i", "input": "n", "output": "o", "id": 7}, [("user", "i\n\nn"), ("assistant", "o")]),
        ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, [("user", "a"), ("assistant", "b"), ("tool", "c")]),
        ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
        ({"prompt": "p", "chosen": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"unknown": 1}, None),
    ]
    found = rendered(spark, [json.dumps(r) for r, _ in records] + ["no json", None])
    for i, (_, turns) in enumerate(records):
        assert (found[i]["turns"] and [tuple(t) for t in found[i]["turns"]]) == turns
    assert found[8]["turns"] is None and found[9]["formatted"] is None
    assert len({found[i]["layout"] for i in range(7)}) == 7


JSON_TEXTS = ['[{"a": 1}]', '[{"role":"x"}] fine', '{"a": [1]}', "[1, 2]", "[]", "{}", "17", "null", "true", '"quoted"', "[{", '[{"role": "user", "content": "c"}]', "", "[null]"]


def test_texts_that_are_json(spark):
    flat = [("prompt", "completion"), ("prompt", "response"), ("question", "answer"), ("instruction", "output"), ("prompt", "chosen")]
    records, want = [], []
    for i, asked in enumerate(JSON_TEXTS):
        answer = JSON_TEXTS[-1 - i]
        pair = [("user", asked), ("assistant", answer)]
        records += [{a: asked, b: answer} for a, b in flat]
        records += [{"messages": [{"role": r, "content": t} for r, t in pair]}, {"conversations": [{"from": "human", "value": asked}, {"from": "gpt", "value": answer}]}, {"system": answer, "prompt": asked, "response": answer}]
        want += [pair] * 7 + [[("system", answer), *pair]]
    found = rendered(spark, [json.dumps(r) for r in records])
    for i, turns in enumerate(want):
        assert [tuple(t) for t in found[i]["turns"]] == turns == [tuple(t) for t in found[i]["back"]], records[i]
        assert found[i]["loss"] == turns[-1][1]


def test_conversations_that_are_json_keep_every_turn(spark):
    rows = [(c, t, role, JSON_TEXTS[(c + t) % len(JSON_TEXTS)]) for c in range(40) for t, role in enumerate(["user", "assistant"] if c % 3 else ["system", "user", "assistant"])]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.format_records(chat.mixed_records(table)).collect()}
    assert made == {c: [(r[2], r[3]) for r in rows if r[0] == c] for c in range(40)}


def test_lists_of_no_layout_are_counted(spark):
    records = ['{"prompt": [{"a": 1}], "completion": "c"}', '{"messages": "[{\\"role\\": \\"u\\", \\"content\\": \\"c\\"}]"}', '{"messages": ["a", {"role": "u", "content": "c"}]}', '{"prompt": "p", "completion": "c"}', "x", None]
    frame = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    made = chat.format_records(frame)
    found = {(r["layout"], tuple(r["paths"] or ())): r["records"] for r in chat.layout_counts(made).collect()}
    assert found.pop(("prompt and completion", ())) == 1 and sum(found.values()) == 5 and all(layout is None for layout, _ in found)
    assert found[(None, ("completion", "prompt[].a"))] == 1 and found[(None, ("messages",))] == 2


def test_empty_input_adds_nothing_and_names_of_results_are_refused(spark):
    found = rendered(spark, [json.dumps({"instruction": "i", "input": "", "output": "o"})])
    assert [tuple(t) for t in found[0]["turns"]] == [("user", "i"), ("assistant", "o")]
    for name in chat.ADDED:
        with pytest.raises(ValueError, match="reserved column"):
            chat.format_records(spark.createDataFrame([(1, "{}")], f"{name} long, record string"))


def test_conversation_table_with_nulls_and_ties(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "assistant", None), (None, 0, "user", "q"), (2, 5, "assistant", "z" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit(1))
    found = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.format_records(chat.conversation_records(table)).collect()}
    assert found == {1: [("", ""), ("user", "a"), ("user", "b")], None: [("user", "q"), ("assistant", "")], 2: [("assistant", "z" * 100_000)]}
    assert chat.format_records(chat.conversation_records(table.limit(0))).count() == 0


def test_probe_conversation(spark):
    r = chat.op9_chat_format(spark, SF).where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert r["n_turns"] == 2 and r["loss_chars"] == len(text) and r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def test_phrases_and_notices(spark):
    permission = next(iter(licenses.NOTICES))
    texts = [
        "x Under the MIT-License, y. under THE mit license", "Apache License, Version 2.0", "CC BY-NC", None, "", "a b", "under the mité license",
        permission.replace("free of charge", "entirely free of any charge"), permission.upper(), "granted free of charge to nobody", "cc by nc cc by nc",
    ]
    found = scanned(spark, texts)
    phrases = {tuple(p.split()): label for p, label in licenses.PHRASES.items()}
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if tuple(w[k : k + len(p)]) == p]
        r = found[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert found[7]["labels"] == "mit" and found[8]["score"] == 1.0 and found[9]["labels"] == ""


def test_only_ascii_letters_are_lowered(spark):
    notice = next(t for t, label in licenses.NOTICES.items() if label == "gpl-3")
    found = scanned(spark, ["unĸer", "under the \u212ait license", notice.replace("work", "wor\u212a"), notice.upper()])
    assert found[1]["n_base"] == 0 and found[2]["score"] < 1 and found[3]["score"] == 1


def test_own_paths_of_records(spark):
    records = ['{"b": 1, "a": {"x": 2}, "n": null}', '{"messages": [{"role": "r"}, {"content": null, "extra": 3}], "tags": ["p", "q"], "none": []}', "[1]", "x", None]
    frame = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    found = {r["id"]: r["p"] for r in frame.select("id", chat.paths_of(F.col("record")).alias("p")).collect()}
    assert found[0] == ["a", "b"] and found[1] == ["messages[].extra", "messages[].role", "none", "tags"]
    assert not found[2] and not found[3] and found[4] is None


def test_query_meets_several_layouts_and_keeps_all(spark):
    found = chat.op9_chat_format(spark, SF).toPandas()
    assert found.layout.notna().all() and found.layout.nunique() >= 4


def test_records_keep_clashing_columns(spark):
    frame = spark.createDataFrame([(1, '{"prompt": "p", "completion": "c"}', "x", "x")], "id long, record string, parsed string, fingerprint string")
    r = chat.format_records(frame).first()
    assert (r["parsed"], r["fingerprint"], r["layout"]) == ("x", "x", "prompt and completion")


def test_scan_keeps_every_row(clashing, empty, rows):
    assert licenses.scan(clashing).count() == len(rows) and licenses.scan(empty).count() == 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(name, spark, duck):
    found = registry.QUERIES[name](spark, SF).toPandas()
    assert normal(found) == normal(duck.execute(registry.ORACLE_SQL[name]).df())
