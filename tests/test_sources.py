import json
import os

import pytest

from tidemark.operators.relational import latest
from tidemark.sources import documents, fetch, gazette, ledger, release, store
from tidemark.streaming.ingest import dropped, first_seen, ingest, parse_pending
from tests.test_operators import notice


def test_ledger_last_status_counts(spark):
    rows = [("a", "error", 1), ("a", "parsed", 2), ("b", "parsed", 1), ("b", "error", 2), ("c", "missing_pdf", 1)]
    log = spark.createDataFrame(rows, "filename string, status string, line_no long")
    assert [r["filename"] for r in ledger.done_files(log).collect()] == ["a"] and latest(log.limit(0), ["filename"], "status", "line_no").count() == 0
    manifest = spark.createDataFrame([("a", "2024-01-01", "daily", "downloaded"), ("b", "2024-01-02", "daily", "downloaded"), ("d", "2024-01-03", "weekly_outcome", "downloaded"), ("e", "2024-01-04", "daily", "error")], "filename string, gazette_date string, gazette_type string, status string")
    assert [r["filename"] for r in ledger.pending_files(manifest, log, ["daily"]).collect()] == ["b"]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "log.csv")
    df = spark.createDataFrame([("a", "x,\"y\"", None), ("b", "", "z")], "filename string, gazette_date string, status string")
    ledger.write_csv(df, path)
    assert open(path, newline="").read().startswith('"filename"') and "\r\n" in open(path, newline="").read()
    assert ledger.read_csv(spark, path, "filename string, gazette_date string, status string").count() == 2
    assert ledger.read_csv(spark, str(tmp_path / "none.csv"), ledger.PARSE_LOG).count() == 0


def test_ledgers_grow_and_empty_tables_are_written(spark, tmp_path):
    path, schema = str(tmp_path / "log.csv"), "filename string, status string"
    ledger.append_csv(spark.createDataFrame([("b", "x, \"y\""), ("a", None)], schema), path, schema)
    ledger.append_csv(spark.createDataFrame([("b", "parsed")], schema), path, schema)
    assert [(r["filename"], r["status"]) for r in ledger.read_csv(spark, path, schema).orderBy("line_no").collect()] == [("b", 'x, "y"'), ("a", None), ("b", "parsed")]
    ledger.write_csv(spark.createDataFrame([], schema), path)
    assert open(path, newline="").read() == '"filename","status"\r\n' and sorted(os.listdir(tmp_path)) == [x for x in sorted(os.listdir(tmp_path)) if "log.csv" in x]
    rows = "gazette_date string, vacancy_no string"
    place = str(tmp_path / "all.parquet")
    ledger.append_sorted(None, spark.createDataFrame([(None, "z"), ("2024-01-02", "b")], rows), place)
    ledger.append_sorted(spark.createDataFrame(spark.read.parquet(place).collect(), rows), spark.createDataFrame([("2024-01-02", "a")], rows), place)
    assert sorted(map(tuple, spark.read.parquet(place).collect()), key=str) == [("2024-01-02", "a"), ("2024-01-02", "b"), (None, "z")]


def test_store_pull_push_and_archive(spark, tmp_path):
    near, far, third = (store.Store(spark, str(tmp_path / n)) for n in ("near", "far", "third"))
    near.write("r.csv", b"one")
    near.write("pdfs/2024/a.pdf", b"pdf")
    assert store.push(near, ["r.csv", "none"], far, dry_run=True) == {"r.csv": "pushed", "none": "missing"} and not far.exists("r.csv")
    assert store.push(near, ["r.csv"], far) == {"r.csv": "pushed"} and store.push(near, ["r.csv"], far) == {"r.csv": "same"}
    near.write("r.csv", b"two")
    done = store.push_release(near, {"public": ["r.csv"], "private": ["pdfs/2024/a.pdf"]}, {"public": far, "private": third}, "2024-05-06", ["r.csv"])
    assert done == {"public": {"r.csv": "pushed", "snapshots/r-20240506.csv": "pushed"}, "private": {"pdfs/2024/a.pdf": "pushed"}} and far.read("r.csv") == b"two"
    assert store.pull(far, ["r.csv", "none"], third) == {"r.csv": "pulled", "none": "missing"} and third.read("r.csv") == b"two"
    assert store.archived(near, far, "pdfs", "*.pdf") == ["pdfs/2024/a.pdf"] and store.archived(near, far, "pdfs", "*.pdf") == [] and store.archived(near, far, "nothing") == []
    assert far.digest("pdfs/2024/a.pdf") == release.file_hash(str(tmp_path / "near/pdfs/2024/a.pdf"))


def test_audit_is_written_under_two_names(spark, tmp_path):
    audit = spark.createDataFrame([("b", 10.0, "k"), ("a", 5.0, "k"), ("a", 50.0, "j")], "body string, pct_of_bin double, key string")
    for rows in (audit, audit.limit(0)):
        release.write_audit(rows, str(tmp_path), "audit", "2024-05-06")
        texts = {open(tmp_path / n, newline="").read() for n in ("audit.csv", "audit-20240506.csv")}
        assert len(texts) == 1
    release.write_audit(audit, str(tmp_path), "audit", "2024-05-06")
    assert [line.split(",")[0] for line in open(tmp_path / "audit.csv")][1:] == ['"a"', '"a"', '"b"']


def test_planner(spark):
    days = gazette.business_days(spark, "2024-01-01", "2024-01-10")
    assert days.count() == 8
    manifest = spark.createDataFrame([("2024-01-02", "downloaded"), ("2024-01-03", "not_found"), ("2023-01-01", "not_found")], "gazette_date string, status string")
    left = {str(r["day"]) for r in gazette.to_probe(days, manifest, "2024-01-10").collect()}
    assert "2024-01-02" not in left and "2024-01-03" in left
    late = {str(r["day"]) for r in gazette.to_probe(days, manifest, "2024-03-10").collect()}
    assert "2024-01-03" not in late


class Files:
    def __init__(self, fail=0):
        self.fail = fail

    def head(self, url):
        if "boom" in url:
            raise OSError
        return "yes" in url

    def get(self, url):
        if self.fail:
            self.fail -= 1
            raise OSError
        return iter([b"x"])


def test_fetching(spark):
    assert fetch.exists(Files(), "yes") and not fetch.exists(Files(), "no") and not fetch.exists(Files(), "boom")
    slept, out = [], []
    assert fetch.download(Files(2), "u", lambda parts: out.append(b"".join(parts)), sleep=slept.append) and slept == [5.0, 10.0] and out == [b"x"]
    assert not fetch.download(Files(3), "u", lambda parts: None, sleep=slept.append)
    names = spark.createDataFrame([("yes",), ("no",)], "url string")
    assert {r["url"]: r["is_there"] for r in fetch.probe(names, Files, "url", 0).collect()} == {"yes": True, "no": False}


def test_release_and_push(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    for _ in range(2):  # a second release replaces the first
        release.write_release(df, str(tmp_path), "r", release.provenance(str(tmp_path), "test", 2, method=""))
    assert spark.read.parquet(str(tmp_path / "r.parquet")).count() == 2
    assert release.notes_of(spark.read.parquet(str(tmp_path / "r.parquet")))["row_count"] == "2" and release.notes_of(df) == {}
    sidecar = json.loads((tmp_path / "r.json").read_text())
    assert sidecar["row_count"] == "2" and sidecar["git_sha"] == "unknown" and sidecar["method"] == "unknown"
    for entry in sidecar["files"]:
        assert release.file_hash(str(tmp_path / entry["key"])) == entry["sha256"] and os.path.getsize(tmp_path / entry["key"]) == entry["bytes"]
    local = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "key string, sha256 string")
    remote = spark.createDataFrame([("a", "1"), ("b", "9")], "key string, sha256 string")
    assert sorted(r["key"] for r in release.to_push(local, remote).collect()) == ["b", "c"]
    release.write_snapshot(df, str(tmp_path / "s"), "20240101")
    release.write_snapshot(df, str(tmp_path / "s"), "20240102")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4


def test_required_settings():
    with pytest.raises(SystemExit, match="A, B"):
        release.required(["A", "B", "C"], {"C": "x"})


def test_summary(spark):
    assert "| 1 |  |" in release.step_summary(spark.createDataFrame([(1, None)], "a int, b string"), "T")


def test_summary_says_what_it_leaves_out(spark):
    assert "The first 50 of 60 rows." in release.step_summary(spark.range(60).toDF("a"), "T") and "first" not in release.step_summary(spark.range(50).toDF("a"), "T")
    found = spark.createDataFrame([("WARN", "w", "d", 1), ("FAIL", "f", "d", 2)], "severity string, label string, detail string, n long")
    assert release.warnings_of(found) == ["::error::f: 2 (d)", "::warning::w: 1 (d)"] and release.warnings_of(found, 1)[-1] == "::warning::more than 1 findings"


def test_extraction_logs_failures(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"good")
    (tmp_path / "b.pdf").write_bytes(b"bad")

    def extract(content):
        if content == b"bad":
            raise RuntimeError("broken")
        return content.decode()

    files = documents.binary_files(spark, str(tmp_path))
    got = {r["path"][-5:]: (r["text"], r["status"], r["error"]) for r in documents.extracted(files, extract).collect()}
    assert got == {"a.pdf": ("good", "parsed", None), "b.pdf": (None, "error", "broken")}


def test_stream_takes_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.txt").write_text(notice(1, "Agency\n\n") + notice(2, "Agency\n\n"))
    places = [str(tmp_path / x) for x in ("rows", "log", "state")]
    ingest(spark, str(folder), *places).awaitTermination()
    (folder / "2.txt").write_text(notice(3, "Agency\n\n"))
    (folder / "3.txt").write_text("nothing here")
    ingest(spark, str(folder), *places, most=1).awaitTermination()
    assert spark.read.parquet(places[0]).count() == 3
    log = spark.read.parquet(places[1])
    assert log.count() == 3 and log.where("vn_count <> record_count").count() == 0


def test_first_seen_in_stream(spark, tmp_path):
    spark.sql("SELECT 'a' AS k, TIMESTAMP'2024-01-01 00:00:00' AS ts UNION ALL SELECT 'a', TIMESTAMP'2024-01-02 00:00:00' UNION ALL SELECT 'b', TIMESTAMP'2024-01-02 00:00:00'").write.parquet(str(tmp_path / "in"))
    stream = first_seen(spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in")), ["k"], "ts")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_batch_from_the_ledger(spark):
    manifest = spark.createDataFrame([("a", "2024-01-01", "g1", "daily", "downloaded"), ("b", "2024-01-02", "g2", "daily", "downloaded"), ("c", "2024-01-03", "g3", "daily", "downloaded")], "filename string, gazette_date string, gazette_id string, gazette_type string, status string")
    log = spark.createDataFrame([], ledger.PARSE_LOG + ", line_no long")
    files = spark.createDataFrame([("a", bytearray(notice(1, "Agency\n\n").encode())), ("b", bytearray(b"bad"))], "filename string, content binary")

    def extract(content):
        if content == b"bad":
            raise RuntimeError("broken")
        return content.decode()

    rows, entries = parse_pending(manifest, log, files, extract, ["daily"])
    assert [(r["vacancy_no"], r["gazette_id"], r["raw_vn_count"]) for r in rows.collect()] == [("VN-1", "g1", 1)]
    assert {r["filename"]: (r["status"], r["record_count"]) for r in entries.collect()} == {"a": ("parsed", 1), "b": ("error", 0), "c": ("missing_pdf", 0)}
    assert dropped(entries).count() == 0
    from pyspark.sql import functions as F

    again = log.unionByName(entries.withColumn("line_no", F.lit(1).cast("bigint")))
    assert [r["filename"] for r in ledger.pending_files(manifest, again, ["daily"]).collect()] == ["b", "c"]
    assert [r["filename"] for r in ledger.pending_files(manifest, again, ["daily"], 1).collect()] == ["b"]


def test_manifest_after_a_round(spark):
    schema = "gazette_date string, gazette_id string, gazette_type string, filename string, url string, status string"
    old = spark.createDataFrame([("2024-01-02", None, "none", None, None, "not_found"), ("2024-01-03", "g", "daily", "f", "u", "downloaded")], schema)
    found = spark.createDataFrame([("2024-01-02", "g2", "daily", "f2", "u2", "downloaded")], schema)
    tried = spark.createDataFrame([("2024-01-02",), ("2024-01-04",)], "day string")
    got = {(r["gazette_date"], r["status"]) for r in gazette.probed(old, found, tried).collect()}
    assert got == {("2024-01-02", "downloaded"), ("2024-01-03", "downloaded"), ("2024-01-04", "not_found")}
