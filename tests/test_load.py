import json

import pytest
from gridloom import cli
from gridloom.errors import LoadFailed
from gridloom.limits import Budgets
from gridloom.operators.runtime_filter import bitmap, passing
from gridloom.plans import load, snapshot
from gridloom.plans.ddl import Column, Table
from gridloom.plans.jdbc import JdbcTable
from gridloom.plans.sink import downgraded, upgraded
from gridloom.queries import fresh_sink
from pyspark.sql import functions as F

TABLE = "MIME-Version: 1.0\nContent-Type: text/html\n\n<html><table>{}</table></html>"


def page(rows):
    return TABLE.format("".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)).encode()


def frame(spark, pages):
    return spark.createDataFrame([(p, bytearray(c)) for p, c in pages.items()], "path string, content binary")


def test_skip_replace_and_widening(spark):
    sink = fresh_sink(spark)
    one = page([["AMOUNT", "DAY"], ["1", "2026-02-20"], ["2", "2026-02-21"]])
    done = load.load(spark, sink, frame(spark, {"a": one, "b": one, "c": b"nothing here"}))
    assert done.summary()["inserted_rows"] == 2
    by = {r["skipped"]: r for r in done.outcomes.collect() if r["ok"]}
    assert by[True]["inserted_rows"] == 0 and by[False]["rows"] == 2
    assert done.summary()["failure_count"] == 1
    again = load.load(spark, sink, frame(spark, {"a": one}))
    assert again.summary()["skipped_count"] == 1 and sink.count() == 2
    replaced = load.load(spark, sink, frame(spark, {"a": one}), on_duplicate="replace")
    assert replaced.outcomes.first()["replaced"] and sink.count() == 2
    load.load(spark, sink, frame(spark, {"d": page([["AMOUNT", "MORE"], ["n/a", "x"]])}))
    rows = sink.rows().collect()
    assert {r["amount_field"] for r in rows} == {"1", "2", "n/a"} and sum(r["more_field"] == "x" for r in rows) == 1
    assert [c.type for c in sink.table().columns] == ["TEXT", "DATE", "TEXT"]
    with pytest.raises(LoadFailed):
        load.load(spark, sink, frame(spark, {"a": one}), on_duplicate="append")


def test_loads_are_by_content_whatever_the_filter_lets_through(spark, monkeypatch):
    pages = [page([["A_B"], [str(i)], [str(i + 1)]]) for i in range(6)]
    rows = [("same", pages[0]), ("same", pages[1]), ("same", pages[2]), ("same", pages[1]), ("other", pages[1]), ("x", pages[3]), (None, pages[4])]
    found = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    results = []
    for bits in (load.BITS, 64):
        monkeypatch.setattr(load, "FILTER_BITS", bits)
        sink = fresh_sink(spark)
        load.load(spark, sink, frame(spark, {"y": pages[5], "x": pages[3]}))
        done = load.load(spark, sink, found)
        results.append(sorted((r["sha256"], r["ok"], r["skipped"], r["rows"], r["inserted_rows"]) for r in done.outcomes.collect()))
        assert sink.count() == 12 and done.inserted == 8 and sink.catalog().count() == 6
        assert done.summary()["artifact_count"] == 7 and done.summary()["skipped_count"] == 3 and done.summary()["inserted_rows"] == 8
        stored = sink.rows().groupBy("source_artifact_sha256").agg(F.collect_set("a_b").alias("v")).collect()
        assert all(len(r["v"]) == 2 for r in stored)
    assert results[0] == results[1]


def test_contents_are_not_shuffled(spark):
    wanted = spark.range(5).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("k"), F.lit(b"content").alias("content"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = passing(rows, bitmap(wanted, "k"), "k")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and not [line for line in plan.splitlines() if "Exchange" in line and "content" in line] and "SortMergeJoin" not in plan
        assert {r["k"] for r in kept.collect()} >= {str(i) for i in range(5)} and kept.count() < 50
        assert passing(rows, bitmap(wanted, "k", bits=64), "k", bits=64).count() > 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nothing_to_load(spark, tmp_path):
    sink = fresh_sink(spark)
    for found, n in ((spark.createDataFrame([], "path string, content binary"), 0), (spark.createDataFrame([("a", None)], "path string, content binary"), 1)):
        done = load.load(spark, sink, found)
        assert done.summary()["artifact_count"] == done.summary()["failure_count"] == n and done.outcomes.count() == n
    assert load.batch(spark, str(tmp_path), sink).summary()["artifact_count"] == 0 and sink.version() == 0


def test_more_columns_than_the_budget(spark, monkeypatch):
    monkeypatch.setattr(load, "Budgets", lambda: Budgets(columns=2))
    sink = fresh_sink(spark)
    with pytest.raises(LoadFailed) as found:
        load.load(spark, sink, frame(spark, {"a": page([["A_B", "C_D", "E_F"], ["1", "2", "3"]])}))
    assert found.value.code == "too_many_columns" and sink.version() == 0


def test_numbers_keep_their_digits(spark):
    sink = fresh_sink(spark)
    rows = [["P_Q", "R_S", "T_U"], ["1.50", "NaN", "09:48:09.5"], ["0.123456789012345", "1e30", "10:00"]]
    load.load(spark, sink, frame(spark, {"a": page(rows)}))
    assert [c.type for c in sink.table().columns] == ["NUMERIC", "TEXT", "TIME"]
    first = sink.rows().orderBy("source_row_number").collect()
    assert [str(r["p_q"].normalize()) for r in first] == ["1.5", "0.123456789012345"] and [r["r_s"] for r in first] == ["NaN", "1e30"] and [r["t_u"] for r in first] == ["09:48:09.5", "10:00:00"]
    load.load(spark, sink, frame(spark, {"b": page([["P_Q"], ["n/a"]])}))
    assert {r["p_q"] for r in sink.rows().collect()} == {"1.50", "0.123456789012345", "n/a"}


def test_many_loads_compaction_and_vacuum(spark, monkeypatch):
    monkeypatch.setattr(snapshot, "CHECKPOINT", 3)
    sink = fresh_sink(spark)
    pages = {c: page([["A_B", "C_D"], [str(i), c]]) for i, c in enumerate("abcde")}
    for c, content in pages.items():
        load.load(spark, sink, frame(spark, {c: content}))
    assert len(sink.state()["catalog"]) < 3 and sink.catalog().count() == 5 and not sink.state()["hidden"]
    load.load(spark, sink, frame(spark, {"a": pages["a"]}), on_duplicate="replace")
    assert len(sink.state()["hidden"]) == 1 and sink.count() == 5 and sink.catalog().count() == 5
    before = sorted(tuple(r) for r in sink.rows().collect())
    sink.compact()
    sink.vacuum()
    assert sorted(tuple(r) for r in sink.rows().collect()) == before and len(sink._names(sink._path("rows"))) == 1 and not sink.state()["hidden"]
    done = load.load(spark, sink, frame(spark, {"a": pages["a"], "z": page([["A_B"], ["9"]])}))
    assert done.summary()["skipped_count"] == 1 and sink.count() == 6


def test_comments_of_a_mapping(spark, tmp_path, capsys):
    (tmp_path / "x.mhtml").write_bytes(page([["ERDAT", "TITLE"], ["1", "a"]]))
    (tmp_path / "m.csv").write_text("source,target,comment\nORDERS.ERDAT,,day\nother,TITLE,name\nnowhere,,lost\n")
    store = f"file://{tmp_path}/store"
    assert cli.main(["load", str(tmp_path / "x.mhtml"), "--store", store, "--json", "--column-mapping", str(tmp_path / "m.csv"), "--lineage-json", str(tmp_path / "l.json"), "--ddl-out", str(tmp_path / "d.sql")], spark) == 0
    out = json.loads(capsys.readouterr().out)["column_mapping"]
    assert out["matched"] == {"ORDERS.ERDAT": "erdat_field", "other": "title_field"} and out["unmatched"] == ["nowhere"] and out["format"] == "csv" and "m.csv" not in json.dumps(out)
    table = snapshot.SnapshotTable(spark, store, load.DEFAULT_TABLE).table()
    assert table.comments() == {"erdat_field": "day", "title_field": "name"} and "COMMENT ON COLUMN" in (tmp_path / "d.sql").read_text()
    lineage = json.loads((tmp_path / "l.json").read_text())
    assert lineage["row_count"] == 1 and lineage["loaded_at"].startswith("20") and lineage["source_artifact_mtime_ns"] == (tmp_path / "x.mhtml").stat().st_mtime_ns
    for text, code in (("source,comment\nA.ERDAT,one\nB.ERDAT,two\n", "conflicting_comments"), ("source,target,comment\nx,ERDAT,one\ny,erdat_field,two\n", "conflicting_comments")):
        (tmp_path / "m.csv").write_text(text)
        assert cli.main(["load", str(tmp_path / "x.mhtml"), "--store", f"{store}-2", "--column-mapping", str(tmp_path / "m.csv")], spark) == 1
        assert json.loads(capsys.readouterr().err)["error_code"] == code


def test_exact_targets_come_before_their_snake_form(spark):
    from gridloom.operators import mapping

    columns = spark.createDataFrame([("A", "title_field"), ("B", "title")], "source_name string, db_name string")
    entries = spark.createDataFrame([(0, "x", "title", "one")], "position int, source string, target string, comment string")
    assert mapping.attached(entries, columns).comments == {"title": "one"}


def test_required_headers_by_table_name(spark):
    sink = fresh_sink(spark, "my_zcrht811_rows")
    done = load.load(spark, sink, frame(spark, {"a": page([["X", "Y"], ["1", "2"]])}))
    assert done.outcomes.first()["error"] == "missing_headers" and sink.count() == 0
    assert load.load(spark, sink, frame(spark, {"a": page([["X", "Y"], ["1", "2"]])}), required=[]).inserted == 1


def test_old_names_are_not_split(spark):
    sink = fresh_sink(spark, "orders_table")
    table = Table("orders_table", (Column("AMOUNT", "amount", "BIGINT"),))
    sink.commit(table, None, {}, None, sink.version())
    with pytest.raises(LoadFailed) as found:
        load.load(spark, sink, frame(spark, {"a": page([["Amount"], ["1"]])}))
    assert found.value.code == "legacy_column_requires_migration"
    other = snapshot.SnapshotTable(spark, sink.store, "rows_table")
    old = snapshot.SnapshotTable(spark, sink.store, "rows")
    old.commit(Table("rows", ()), None, {}, None, 0)
    with pytest.raises(LoadFailed) as found:
        load.load(spark, other, frame(spark, {"a": page([["Amount"], ["1"]])}))
    assert found.value.code == "legacy_table_requires_migration"


def test_catalog_names_up_and_down(spark):
    entry = spark.createDataFrame([("a", "loaded")], "sha string, load_status_code string")
    old = downgraded(entry)
    assert old.columns == ["sha", "status"] and upgraded(old).columns == entry.columns and upgraded(entry).columns == entry.columns
    with pytest.raises(LoadFailed) as found:
        upgraded(entry.withColumn("status", entry["sha"]))
    assert found.value.code == "ambiguous_catalog"


def test_the_same_loads_over_jdbc(spark, tmp_path):
    sink = JdbcTable(spark, f"jdbc:derby:{tmp_path}/db;create=true", "web_table_rows", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    one, two = page([["AMOUNT", "DAY"], ["1", "2026-02-20"], ["2.5", "2026-02-21"]]), page([["AMOUNT", "MORE"], ["7", "x"]])
    assert load.load(spark, sink, frame(spark, {"a": one})).inserted == 2
    assert load.load(spark, sink, frame(spark, {"a": one, "b": two})).summary()["skipped_count"] == 1
    assert [c.type for c in sink.table().columns] == ["TEXT", "DATE", "TEXT"] and sink.count() == 3
    assert load.load(spark, sink, frame(spark, {"b": two}), on_duplicate="replace").outcomes.first()["replaced"] and sink.count() == 3
    rows = sink.rows().collect()
    assert {r["more_field"] for r in rows} == {None, "x"} and {str(r["day_field"]) for r in rows} == {"2026-02-20", "2026-02-21", "None"} and sink.catalog().count() == 2
    assert not [t for t in sink.tables() if t.startswith("stage_")]
    sink.downgrade_catalog()
    assert "status" in sink.columns_of("gridloom_ingest_artifact")
    assert sink.catalog().where("load_status_code = 'loaded'").count() == 2
    with pytest.raises(LoadFailed):
        sink._run(["CREATE TABLE half (a INT)", "nonsense"])
    assert "half" not in sink.tables()


def test_a_crash_before_the_commit_changes_nothing(spark, monkeypatch):
    sink = fresh_sink(spark)
    load.load(spark, sink, frame(spark, {"a": page([["A", "B"], ["1", "2"]])}))

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(sink, "commit", crash)
    with pytest.raises(RuntimeError):
        load.load(spark, sink, frame(spark, {"b": page([["A", "B"], ["3", "4"]])}))
    monkeypatch.undo()
    assert sink.count() == 1 and sink.catalog().count() == 1


def test_command_line(spark, tmp_path, capsys):
    file = tmp_path / "x.mhtml"
    file.write_bytes(page([["ROW_COUNT", "TITLE"], ["1", "a"]]))
    assert cli.main(["inspect", str(file)], spark) == 0
    report = json.loads(capsys.readouterr().out)
    assert report["table_count"] == 1 and "ROW_COUNT" not in json.dumps(report)
    assert cli.main(["propose", str(file)], spark) == 0
    assert [c["proposed_type"] for c in json.loads(capsys.readouterr().out)["columns"]] == ["bigint", "text"]
    assert cli.main(["load", str(file), "--store", f"file://{tmp_path}/store", "--json", "--ddl-out", str(tmp_path / "d.sql")], spark) == 0
    assert json.loads(capsys.readouterr().out)["inserted_rows"] == 1 and "title_field TEXT" in (tmp_path / "d.sql").read_text()
    assert cli.main(["batch", str(tmp_path), "--dry-run", "--json"], spark) == 0
    assert cli.main(["inspect", str(tmp_path / "none.mhtml")], spark) == 2
    assert cli.main(["load", str(file)], spark) == 2
    with pytest.raises(SystemExit) as exit_:
        cli.main(["load"], spark)
    assert exit_.value.code == 2
    assert cli.header_list(None) is None and cli.header_list("none") == [] and cli.header_list("a, b") == ["a", "b"]


def test_summaries_and_exit_codes(spark, tmp_path, capsys):
    file, store = tmp_path / "_x [1].mhtml", f"file://{tmp_path}/store"
    file.write_bytes(page([["ROW_COUNT", "TITLE"], ["1", "a"], ["2", "b"]]))

    def run(*args):
        code = cli.main([*args], spark)
        return code, *capsys.readouterr()

    code, out, _ = run("load", str(file), "--store", store, "--json", "--lineage-json", str(tmp_path / "l.json"))
    summary = json.loads(out)
    assert code == 0 and list(summary) == ["artifact_ref", "data_row_count", "headers", "inserted_rows", "queryable_row_count", "sha256", "skipped", "table_name"]
    assert summary["headers"] == ["ROW_COUNT", "TITLE"] and summary["data_row_count"] == summary["inserted_rows"] == summary["queryable_row_count"] == 2
    assert summary["artifact_ref"] == f"artifact:{summary['sha256'][:16]}" and not summary["skipped"] and out.startswith("{\n  ")
    code, out, _ = run("load", str(file), "--store", store, "--lineage-json", str(tmp_path / "l.json"))
    lines = dict(line.split(": ", 1) for line in out.strip().splitlines())
    assert code == 0 and lines["skipped"] == "True" and lines["headers (2)"] == "ROW_COUNT, TITLE" and lines["inserted_rows"] == "0" and lines["data_row_count"] == "2"
    assert json.loads((tmp_path / "l.json").read_text())["skipped"] is True
    code, out, _ = run("batch", str(tmp_path), "--store", store, "--json")
    assert code == 0 and json.loads(out) == {"discovered": 1, "failure_count": 0, "skipped_count": 1, "success_count": 1, "total_data_rows": 2, "total_inserted_rows": 0}
    assert run("load", str(tmp_path / "none.mhtml"), "--store", store)[0] == 2 and run("load", str(tmp_path), "--store", store)[0] == 2
    (tmp_path / "bad.mhtml").write_bytes(b"nothing here")
    code, out, err = run("load", str(tmp_path / "bad.mhtml"), "--store", store)
    assert code == 1 and not out and json.loads(err)["error_code"] == "load_failed" and "bad" not in err
    code, out, _ = run("inspect", str(file))
    assert code == 0 and out == json.dumps(json.loads(out), sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"
    code, out, _ = run("propose", str(file), "--pretty")
    assert code == 0 and out == json.dumps(json.loads(out), sort_keys=True, indent=2, ensure_ascii=False) + "\n"
    code, _, err = run("inspect", str(file), "--max-source-bytes", "10")
    assert code == 2 and json.loads(err)["error_code"] == "source_too_large"


def test_full_result_of_one_artifact(spark):
    sink, one = fresh_sink(spark), frame(spark, {"a": page([["AMOUNT", "DAY"], ["1", "2026-02-20"]])})
    first = load.load(spark, sink, one).details(lineage_json="l.json")
    assert first["headers"] == ["AMOUNT", "DAY"] and first["on_duplicate"] == "skip" and first["lineage_json"] == "l.json" and "skipped" not in first["lineage"]
    assert first["queryable"] == {"table_name": sink.name, "row_count": 1, "db_row_count": 1} and first["catalog"]["row_count"] == 1
    again = load.load(spark, sink, one).details(headers=["AMOUNT", "DAY"])
    assert again["skipped"] and again["headers"] == ["AMOUNT", "DAY"] and again["lineage"]["skipped"] is True and again["data_row_count"] == 1
    replaced = load.load(spark, sink, one, on_duplicate="replace").details()
    assert replaced["replaced"] and replaced["on_duplicate"] == "replace" and set(first) == set(again) == set(replaced)


def test_a_batch_stops_at_its_first_failure(spark, tmp_path, capsys):
    one, two, bad = page([["A", "B"], ["1", "2"]]), page([["A", "B"], ["3", "4"], ["5", "6"]]), b"nothing here"
    sink = load.SnapshotTable(spark, f"file://{tmp_path}/store", load.DEFAULT_TABLE)

    def run(folder, **files):
        (tmp_path / folder).mkdir()
        for name, content in files.items():
            (tmp_path / folder / f"{name}.mhtml").write_bytes(content)
        return cli.main(["batch", str(tmp_path / folder), "--store", f"file://{tmp_path}/store", "--json", "--no-continue-on-error"], spark)

    assert run("first", a=one, b=one, c=bad, d=two) == 1
    out = capsys.readouterr()
    assert json.loads(out.err)["error_code"] == "batch_failed" and not out.out
    assert sink.count() == 1 and sink.catalog().count() == 1
    assert run("second", a=one, d=two) == 0
    assert json.loads(capsys.readouterr().out)["total_inserted_rows"] == 2 and sink.count() == 3
