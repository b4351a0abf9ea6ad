"""Files of every name are found, judged on the listing, and streamed."""

import os

import pytest
from gridloom.errors import ParseError
from gridloom.limits import Budgets
from gridloom.plans import load
from gridloom.queries import fresh_sink
from gridloom.sources import archives, scan
from gridloom.streaming import ingest as streaming
from pyspark.sql import functions as F

NAMES = ["a.mhtml", "_b.mhtml", ".c.MHTML", "x [1].mhtml", "{p,q}.Mhtml", "s*?.mhtml", "50%20 #.mhtml", "é.mhtml", "d/_e.mhtml", ".f/g [2]/h.mhtml"]
PAGE = b"MIME-Version: 1.0\nContent-Type: text/html\n\n<html><table><tr><td>A_B</td></tr><tr><td>%d</td></tr></table></html>"


@pytest.fixture
def folder(tmp_path):
    home = tmp_path / "in [x]"
    for i, name in enumerate(NAMES):
        (home / name).parent.mkdir(parents=True, exist_ok=True)
        (home / name).write_bytes(PAGE % i)
    (home / "other.txt").write_bytes(b"no archive")
    (home / "empty.mhtml").mkdir()
    return home


def found(frame, folder):
    return {r["path"].removeprefix(f"file:{folder}/"): r["content"] and bytes(r["content"]) for r in frame.collect()}


def test_every_file_is_a_row(spark, folder):
    want = {name: PAGE % i for i, name in enumerate(NAMES)}
    for source in (str(folder), f"file://{folder}", f"file:{folder}"):
        assert found(scan.artifacts(spark, source), folder) == want
    assert set(found(scan.artifacts(spark, str(folder), recursive=False), folder)) == {n for n in NAMES if "/" not in n}
    for name in NAMES:
        assert found(scan.artifacts(spark, f"{folder}/{name}"), folder) == {name: want[name]}
    assert found(scan.artifacts(spark, f"{folder}/other.txt"), folder) == {"other.txt": b"no archive"}
    assert scan.artifacts(spark, f"{folder}/none").count() == 0 == scan.artifacts(spark, f"{folder}/empty.mhtml").count()


def test_globs(spark, folder):
    of = lambda pattern: set(found(scan.artifacts(spark, f"{str(folder).replace('[', '?').replace(']', '?')}/{pattern}", recursive=False), folder))
    assert of("[ax]*.mhtml") == {"a.mhtml", "x [1].mhtml"} and of("{a,_b,other}.*") == {"a.mhtml", "_b.mhtml"}
    assert of("d*") == {"d/_e.mhtml"} and of("*/g*/*") == {".f/g [2]/h.mhtml"} and of("none*") == set()


def test_large_and_lost_files_are_rows_without_content(spark, folder):
    (folder / "big.mhtml").write_bytes(b"x" * 5000)
    os.chmod(folder / "big.mhtml", 0)
    (folder / "gone.mhtml").symlink_to(folder / "nowhere")
    rows = {r["path"].rpartition("/")[2]: r for r in scan.judged(scan.artifacts(spark, str(folder), limit_bytes=4000), Budgets(source_bytes=4000)).collect()}
    assert rows["big.mhtml"]["error_code"] == "source_too_large" and rows["big.mhtml"]["length"] == 5000 and rows["big.mhtml"]["content"] is None
    assert rows["a.mhtml"]["error_code"] is None and sum(r["error_code"] is None for r in rows.values()) == len(NAMES)


def test_files_that_vanish_are_outcomes(spark, folder, monkeypatch):
    listed = archives.listed(str(folder), True, ".mhtml")
    os.remove(folder / "a.mhtml")
    batches = list(archives.batches(str(folder), tuple(listed), None))
    content = {p: c for b in batches for p, c in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True)}
    assert [p for p, c in content.items() if c is None] == [f"file:{folder}/a.mhtml"]
    rows = [(p, bytearray(c) if c else None) for p, c in content.items()]
    done = load.load(spark, fresh_sink(spark), spark.createDataFrame(rows, "path string, content binary"))
    assert done.summary()["failure_count"] == 1 and done.inserted == len(NAMES) - 1
    assert [r["error"] for r in done.outcomes.collect() if not r["ok"]] == ["source_read_failed"]


def test_filters_reach_the_listing(spark, folder):
    (folder / "big.mhtml").write_bytes(b"x" * 5000)
    frame = scan.artifacts(spark, str(folder)).where((F.col("length") < 1000) & F.col("path").contains("d/_e"))
    assert set(found(frame, folder)) == {"d/_e.mhtml"}
    reader = archives.ArchiveReader({"path": str(folder), "partitionBytes": "100"})
    rest = list(reader.pushFilters([archives.LessThanOrEqual(("length",), 1000), archives.EqualTo(("content",), b"x"), archives.StringEndsWith(("path",), "html")]))
    assert [f.attribute for f in rest] == [("content",)]
    kept = [f.path.rpartition("/")[2] for part in reader.partitions() for f in part.files]
    assert "big.mhtml" not in kept and sorted(kept) == sorted(n.rpartition("/")[2] for n in NAMES if n.endswith("html"))


def test_partitions_are_of_like_size():
    files = [archives.File(str(i), str(i), size, 0) for i, size in enumerate([900, 10, 10, 500, 400, 300, 5])]
    parts = [sum(f.length for f in p.files) for p in archives.planned(files, 1000, 1, 2)]
    assert sum(parts) == 2125 and max(parts) <= 1000 and len(parts) == 3
    assert archives.planned([], 1000, 1, 2) == [] and len(archives.planned(files, 10**9, 1, 1)) == 1


def test_stream_offsets_are_batches_of_a_ledger(folder, tmp_path):
    options = {"path": str(folder), "ledger": str(tmp_path / "ledger"), "filesAtATime": "4"}
    stream = archives.ArchiveStream(options)
    ends = [stream.latestOffset()["batch"] for _ in range(4)]
    assert ends == [1, 2, 3, 3] and stream.initialOffset() == {"batch": 0}
    names = lambda s, a, b: sorted(f.path for p in s.partitions({"batch": a}, {"batch": b}) for f in p.files)
    assert len(names(stream, 0, 3)) == len(NAMES) and len(names(stream, 1, 2)) == 4
    again = archives.ArchiveStream(options)
    (folder / "late.mhtml").write_bytes(b"late")
    assert names(again, 0, 2) == names(stream, 0, 2) and again.latestOffset() == {"batch": 4} and names(again, 3, 4) == [f"file:{folder}/late.mhtml"]


def test_a_batch_that_runs_again_is_recognised(spark, folder, tmp_path, monkeypatch):
    sink, progress, parsed = fresh_sink(spark), f"file://{tmp_path}/progress", []
    streaming.ingest(spark, str(folder), sink, progress).awaitTermination()
    assert sink.count() == len(NAMES) and len(sink.state()["stamps"]) == 1
    # the stream died between the load's commit and its own
    [os.remove(tmp_path / "progress" / "commits" / n) for n in os.listdir(tmp_path / "progress" / "commits")]
    run = streaming.load
    monkeypatch.setattr(streaming, "load", lambda *a, **k: parsed.append(1) or run(*a, **k))
    streaming.ingest(spark, str(folder), sink, progress).awaitTermination()
    assert not parsed and sink.count() == len(NAMES) and sink.version() == 1
    (folder / "late.mhtml").write_bytes(PAGE % 99)
    (folder / "copy.mhtml").write_bytes(PAGE % 0)
    streaming.ingest(spark, str(folder), sink, progress).awaitTermination()
    assert parsed == [1] and sink.count() == len(NAMES) + 1 and list(sink.state()["stamps"].values()) == [1]


def test_stores_that_only_spark_opens(spark, folder, monkeypatch):
    monkeypatch.setattr(scan, "reachable", lambda source: False)
    with pytest.raises(ParseError):
        scan.artifacts(spark, str(folder))
    with pytest.raises(ParseError):
        scan.artifacts(spark, f"{folder}/_b.mhtml")
    for name in NAMES:
        if name[0] in "_." or "/" in name:
            os.remove(folder / name)
    plain = [n for n in NAMES if n[0] not in "_." and "/" not in n]
    assert {r["path"].rpartition("/")[2] for r in scan.artifacts(spark, str(folder)).select("path").collect()} == set(plain)
    assert len(scan.artifacts(spark, f"{folder}/x [1].mhtml").collect()) == 1 and scan.artifacts(spark, f"{folder}/none").count() == 0
    (folder / "big.mhtml").write_bytes(b"x" * 5000)
    assert [r["length"] for r in scan.artifacts(spark, str(folder), limit_bytes=4000).collect() if r["content"] is None] == [5000]
