import json
import zipfile

import pytest
from gridloom.errors import GridloomError, MappingFailed, NameError_, ProposalError, PublishFailed, UnsafeIdentifier
from gridloom.functions import naming, types
from gridloom.operators import propose
from gridloom.plans import ddl, documents, profile, publish
from gridloom.sources import mapping
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    ("header", "name"),
    [("VOC_PUCODE", "voc_pucode"), ("MANDT", "mandt_field"), ("123abc", "col_123abc_field"), ("Foo Bar", "foo_bar"), ("orderDate", "order_date"), ("alpha_beta_" + "x" * 60, "alpha_beta"), ("a" * 70, "a" * 57 + "_field"), ("a" * 62 + "_bc", "a" * 61 + "_b")],
)
def test_snake_names(header, name):
    assert naming.snake_name(header) == name
    assert naming.safe_identifier(name) == name


def test_names_that_fail():
    assert naming.table_name("simple") == "simple_table"
    for bad in ("", "  ", "한글", None):
        with pytest.raises(NameError_):
            naming.snake_name(bad)
    for bad in ("single", "Upper_case", "a__b", "a_b;drop", "x" * 40 + "_" + "y" * 40):
        with pytest.raises(UnsafeIdentifier):
            naming.safe_identifier(bad)
    assert naming.sql_literal("a'b\\c\n") == "E'a''b\\\\c\\n'"


@pytest.mark.parametrize(("header", "name"), [("HTTPResponseCode", "http_response_code"), ("select", "select_field"), ("123", "source_123"), ("MANDT", "client_code"), ("한글 열", "한글_열"), ("ＡＢ_1", "ab_1"), ("mandt", "client_code"), (" Guid ", "global_identifier"), ("current_date", "current_date_field"), ("x__y", "x_y")])
def test_proposal_names(header, name):
    assert naming.proposal_name(header) == name


def test_proposal_name_fits_63_bytes():
    assert naming.proposal_name("!!!").startswith("source_field_")
    for header in ("열" * 50 + "_끝", "a" * 100 + "_" + "b" * 100):
        assert len(naming.proposal_name(header).encode()) <= 63
    assert len(naming.collision_name("a" * 63, "h", 1)) <= 63


CASES = {
    "BOOLEAN": (["true", "F", "Yes", "n"], ["1", "0", "maybe"]),
    "BIGINT": (["1", "-7", "1,234", "0007"], ["12,34", "9223372036854775808", "1.0", "+"]),
    "NUMERIC": (["1.5", "1e5", "1,234.5", "1_000", "-.5", "0.123456789012345", "1e-18", "12345678901234567890", "0e99", "1.50000000000000000000", "-0", "5."],
                ["12,34.5", "abc", "1,2", "NaN", "Infinity", "1e30", "1e-19", "123456789012345678901", "0.1234567890123456789", "e5", ".", "1e99999999999"]),
    "DATE": (["2026-02-20", "2026/2/3", "20260220", "20.02.2026"], ["2026-02-30", "2026", "20.2026"]),
    "TIME": (["09:48", "09:48:09", "094809", "9:48:09"], ["24:00:00", "09:48:09+09:00", "9"]),
    "TIMESTAMP": (["2026-02-20 09:48:09", "2026-02-20T09:48", "2026/02/20 09:48:09"], ["2026-02-20", "2026-02-20T09:48:09+09:00", "x y"]),
}


@pytest.mark.parametrize("kind", CASES)
def test_type_predicates(kind, spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    good, bad = CASES[kind]
    rows = spark.createDataFrame([(v,) for v in good + bad], "v string").select("v", types.conforms(F.col("v"), kind).alias("ok")).collect()
    assert {r["v"]: bool(r["ok"]) for r in rows} == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_texts_of_typed_values(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    cases = {
        "NUMERIC": {"1.50": "1.50", "+1,234.0": "1234.0", "007": "7", "-.5": "-0.5", "5.": "5", "1_000": "1000", "1e3": "1000", "1.5e-2": "0.015", "-0.0": "0.0", "0": "0", "NaN": "NaN", "1e30": "1e30", "0.123456789012345": "0.123456789012345"},
        "TIME": {"09:48": "09:48:00", "09:48:09.25": "09:48:09.25", "9:48:09": "09:48:09"},
        "TEXT": {"1.50": "1.50"},
        "BOOLEAN": {"Yes": "true"},
    }
    for kind, values in cases.items():
        rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", types.text_form(F.col("v"), kind).alias("t")).collect()
        assert {r["v"]: r["t"] for r in rows} == values
    assert spark.range(1).select(types.time_text(F.lit("09:48:09.123456"))).first()[0] == "09:48:09.123456"


def test_promotion_never_narrows():
    assert profile.promoted(None, "BIGINT", False) == "BIGINT"
    assert profile.promoted("BIGINT", "NUMERIC", False) == "TEXT"
    assert profile.promoted("BIGINT", "BIGINT", True) == "TEXT"
    assert profile.promoted("TEXT", "BIGINT", False) == "TEXT"


def decide(spark, header, values, complete=True):
    cells = spark.createDataFrame([(0, v) for v in values], "ordinal int, value string")
    found = propose.propose(cells, [header], "0" * 64, complete=complete).columns[0]
    return found.proposed_type, found.review_reasons, found.nullable


def test_proposal_decisions(spark):
    assert decide(spark, "x_value", [None]) == ("text", ("empty_column",), True)
    assert decide(spark, "x_flag", ["true", "FALSE"]) == ("boolean", (), False)
    assert decide(spark, "flag_id", ["true"]) == ("text", ("identifier_semantics",), False)
    assert decide(spark, "due_date", ["20260220", None]) == ("date", (), True)
    assert decide(spark, "x_value", ["20260220"]) == ("text", ("date_semantics_missing",), False)
    assert decide(spark, "x_value", ["0007"]) == ("text", ("leading_zero_identifier",), False)
    assert decide(spark, "x_value", ["9223372036854775807"]) == ("bigint", (), False)
    assert decide(spark, "x_value", ["9223372036854775808"]) == ("numeric", ("bigint_range_exceeded",), False)
    assert decide(spark, "x_value", ["1.50", "22.5"]) == ("numeric", (), False)
    assert decide(spark, "x_value", ["1", "1.5"]) == ("text", ("mixed_or_unrecognized_values",), False)
    assert decide(spark, "x_value", ["1"], complete=False) == ("bigint", ("sample_only_nullability",), True)


def test_proposal_inputs(spark):
    cells = spark.createDataFrame([(0, "1")], "ordinal int, value string")
    for headers, sha, code in ((["a"], "x", "invalid_source_hash"), ([], "0" * 64, "invalid_input"), (["a" * 5000], "0" * 64, "header_too_large"), (["a"] * 5000, "0" * 64, "too_many_columns")):
        with pytest.raises(ProposalError) as found:
            propose.propose(cells, headers, sha)
        assert found.value.code == code


def test_proposal_identity_is_independent_of_partitions(spark):
    cells = spark.createDataFrame([(i % 2, str(i)) for i in range(50)], "ordinal int, value string")
    ids = {propose.propose(cells.repartition(n), ["a", "b"], "0" * 64).schema_proposal_id for n in (1, 8)}
    assert len(ids) == 1


def test_proposals_of_all_archives_equal_single_ones(spark):
    from gridloom.functions.text import canonical_json
    from gridloom.operators import tables
    from gridloom.sources.parse import parse

    head = "MIME-Version: 1.0\nContent-Type: text/html; charset=utf-8\n\n"
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    pages = {
        "a": "<table>" + row("MANDT", "한글", "due_date", "x", "x") + row("1", "é", "20260220", "", "1.5") + row("2", "", "20260221", "", "2.25") + "</table>",
        "b": "<table>" + row("only") + "</table>", "c": "<table></table>", "d": "no table", "e": "<table>" + row("a") + "</table><table>" + row("b") + "</table>", "f": "<table><tr><td colspan=0></table>",
        "g": "<table>" + row("h" * 5000) + row("1") + "</table>",
    }
    known = spark.createDataFrame([(k, bytearray((head + v).encode())) for k, v in pages.items()], "name string, content binary").withColumn("artifact_sha256", F.sha2("content", 256))
    rows = parse(known, "strict", carry=("name",)).cache()
    found = {r["name"]: r for r in propose.proposals(rows, "name").collect()}
    assert {k: r["error_code"] for k, r in found.items()} == {"a": None, "b": None, "c": "schema_proposal_failed", "d": "schema_proposal_failed", "e": "schema_proposal_failed", "f": "invalid_table_span", "g": "header_too_large"}
    data = tables.data_rows(tables.only_table(rows.where("name = 'a'")))
    one = data.first()
    single = propose.propose(tables.long_cells(data), one["headers"], one["artifact_sha256"])
    assert found["a"]["proposal"] == canonical_json(single.to_dict()) and found["a"]["schema_proposal_id"] == single.schema_proposal_id and found["a"]["review_required"] == single.review_required
    assert json.loads(found["b"]["proposal"])["columns"][0]["review_reasons"] == ["empty_column"] and found["d"]["proposal"] is None


@pytest.fixture(scope="module")
def proposal(spark):
    cells = spark.createDataFrame([(0, "1"), (1, "x")], "ordinal int, value string")
    return propose.propose(cells, ["row_count", "TITLE"], "a" * 64)


def test_documents(proposal):
    graph = documents.manifest(proposal, " Name ")
    assert [n["kind"] for n in graph.nodes] == ["dataset", "column", "column"] and len(graph.edges) == 2
    sent = documents.envelope(graph, "tenant", "actor", "approval")
    assert sent.envelope_id != documents.envelope(graph, "tenant", "other", "approval").envelope_id
    assert documents.dbml(proposal, "my rows") == "Table my_rows {\n  row_count bigint [not null]\n  title_field text [not null]\n}"
    for bad in ("", "a\nb", None):
        with pytest.raises(GridloomError):
            documents.manifest(proposal, bad)


class Recorder(publish.Transport):
    def __init__(self, fail_at=None, accepted=True):
        self.sent, self.fail_at, self.accepted = [], fail_at, accepted

    def send(self, request):
        if len(self.sent) == self.fail_at:
            return publish.Response(500, "r", True)
        self.sent.append(request)
        return publish.Response(200, f"r{len(self.sent)}", self.accepted)


def test_publishing_in_order_and_its_failures(proposal):
    sent = documents.envelope(documents.manifest(proposal, "n"), "t", "a", "b")
    proof = publish.Evidence(True, True, True, "audit:1")
    transport = Recorder()
    done = publish.publish(sent, proof, transport)
    assert [r.request_index for r in done.receipts] == list(range(5)) and transport.sent == list(sent.requests)
    assert done.to_dict()["accepted_request_count"] == 5 and done.to_dict()["privacy_mode"] == "value_free" and "body" not in json.dumps(done.to_dict())
    for broken, code in (({"method": "PUT"}, "invalid_catalog_request"), ({"idempotency_key": "other:1"}, "invalid_idempotency_key")):
        transport = Recorder()
        with pytest.raises(PublishFailed) as found:
            publish.publish(documents.Envelope(sent.envelope_id, (*sent.requests[:3], sent.requests[3] | broken)), proof, transport)
        assert (found.value.code, found.value.request_index, found.value.accepted, len(transport.sent)) == (code, 3, 3, 3)
    with pytest.raises(PublishFailed) as found:
        publish.publish(sent, proof, Recorder(fail_at=2))
    assert (found.value.code, found.value.request_index, found.value.accepted) == ("remote_status_not_success", 2, 2)
    for evidence, code in ((publish.Evidence(False, True, True, "a"), "actor_authentication_required"), (publish.Evidence(True, True, True, ""), "immutable_audit_reference_required")):
        with pytest.raises(PublishFailed) as found:
            publish.publish(sent, evidence, Recorder())
        assert found.value.code == code
    with pytest.raises(PublishFailed) as found:
        publish.publish(sent, proof, Recorder(), most=2)
    assert found.value.code == "request_limit_exceeded"


def test_ddl():
    table = ddl.table_of("my_rows", ["A", "a"], ["BIGINT", "TEXT"]).commented({"a_field": "it's"})
    assert [c.name for c in table.columns] == ["a_field", "a_field_2"]
    assert ddl.comment_ddl(table) == ["COMMENT ON COLUMN my_rows.a_field IS E'it''s';"]
    assert "a_field BIGINT" in ddl.ddl(table) and len(table.struct().fields) == 6
    assert naming.legacy_names(["MANDT", "123abc", "a b", "A_B"]) == ["mandt", "col_123abc", "a_b", "a_b_2"] and naming.legacy_table_name("orders_table") == "orders"


def test_mapping_files(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"columns": [{"source": "T . A", "description": "one"}, {"field": "B", "comment": "two", "target": "b_field"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"A": "one", "B": {"comment": "two"}}))
    (tmp_path / "c.csv").write_text("﻿source,target,comment\nA,,one\n,,\nB,b_field,two\n", encoding="utf-8")
    assert [(e.source, e.comment, e.target) for e in mapping.load(tmp_path / "a.json").entries] == [("T.A", "one", None), ("B", "two", "b_field")]
    assert [e.source for e in mapping.load(tmp_path / "b.json").entries] == ["A", "B"]
    assert [(e.source, e.target) for e in mapping.load(tmp_path / "c.csv").entries] == [("A", None), ("B", "b_field")]
    deck = tmp_path / "d.pptx"
    slide = '<p:sld xmlns:p="p" xmlns:a="a"><a:p><a:t>1. Title</a:t></a:p><a:p><a:t>TABLE.ONE / TWO + ZCRHT999, THREE</a:t></a:p></p:sld>'
    with zipfile.ZipFile(deck, "w") as out:
        out.writestr("ppt/slides/slide1.xml", slide)
    found = mapping.load(deck)
    assert [e.source for e in found.entries] == ["TABLE.ONE", "TABLE.TWO", "TABLE.THREE"] and found.entries[0].context == "1. Title (slide 1)"
    assert mapping.qualified_sources("T.ERDAT text / ERZET, u.x & T2.Y + ZCRHT001 + APV") == ["T.ERDAT", "T.ERZET", "U.X", "T2.Y", "T2.APV"]
    assert mapping.qualified_sources("/ ALONE, T .\tA") == ["T.A"]
    with zipfile.ZipFile(deck, "w") as out:
        for slide, body in ((2, "T.B / A"), (10, "T.A"), (1, "3. Late</a:t></a:p><a:p><a:t>T.A + B")):
            out.writestr(f"ppt/slides/slide{slide}.xml", f'<p:sld xmlns:p="p" xmlns:a="a"><a:p><a:t>{body}</a:t></a:p></p:sld>')
    assert [(e.source, e.slide) for e in mapping.load(deck).entries] == [("T.A", 1), ("T.A", 2), ("T.A", 10), ("T.B", 1), ("T.B", 2)]
    assert mapping.load(deck).entries[0].comment == "VOC mapping: 3. Late (slide 1) — T.A" and mapping.load(deck).entries[1].context == "VOC column mapping (slide 2)"
    for name, text in (("x.json", "{"), ("x.txt", ""), ("x.csv", "source,comment\n")):
        (tmp_path / name).write_text(text)
        with pytest.raises(MappingFailed):
            mapping.load(tmp_path / name)
    with pytest.raises(MappingFailed):
        mapping.slide_texts(b"<!DOCTYPE a><a/>")


def test_mapping_files_of_other_shapes(tmp_path):
    def read(name, text):
        (tmp_path / name).write_text(text, newline="")
        return [(e.source, e.comment, e.target) for e in mapping.load(tmp_path / name).entries]

    assert read("a.csv", 'source,comment\r\nA,"one\ntwo"\r\n,,\r\nB,"three\r\n\r\nfour, five"\r\n') == [("A", "one\ntwo", None), ("B", "three\r\n\r\nfour, five", None)]
    assert read("a.json", '{"A": {"comment": "one", "target": "t"}, "B": "two"}') == [("A", "one", "t"), ("B", "two", None)]
    assert read("b.json", '{"K": {"source": "A", "comment": "one"}}') == [("A", "one", None)]
    for text in ('{"columns": {"A": "one"}}', '{"mappings": ["A"]}', '{"columns": []}', '{"description": "one"}', "[]", "3", '{"columns": null}'):
        with pytest.raises(MappingFailed):
            read("c.json", text)
    for text in ("", "source,comment\n", "source,comment\n,,x\n"):
        with pytest.raises(MappingFailed):
            read("c.csv", text)


def test_slide_texts_by_paragraph():
    wrap = lambda body: f'<a:r xmlns:a="u">{body}</a:r>'.encode()
    assert mapping.slide_texts(wrap("<a:p><a:t>T.</a:t><a:x><a:t>A</a:t></a:x></a:p><a:t>loose</a:t><a:p><a:t> </a:t></a:p><a:p><a:t>B </a:t></a:p>")) == ["T.A", "B"]
    assert mapping.slide_texts(wrap("<a:p/><a:t> one </a:t><a:t/><a:t>two</a:t>")) == ["one", "two"] and mapping.slide_texts(wrap("")) == []
    with pytest.raises(MappingFailed):
        mapping.slide_texts(b"<a><b></a>")


def test_names_that_are_cut_keep_their_end():
    assert naming.ending("abc", "end") == "abc_end" and naming.ending("x" * 80, "end") == "x" * 59 + "_end"
    assert naming.ending("x" * 58 + "_" + "y" * 9, "end") == "x" * 58 + "_end" and naming.ending("é" * 80, "end") == "é" * 29 + "_end"
    assert naming.ending("front", "e" * 61, "source") == "f_" + "e" * 61
    assert naming.ending("front", "e" * 80, "source") == "source_" + "e" * 56
