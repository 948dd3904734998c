"""Folders of documents as a data source: listing in tasks, bins, versions, batch and stream."""

import os

import pytest
from pyspark.sql import functions as F

from lexigrove.plans import catalog
from lexigrove.plans.runtime import scratch_path
from lexigrove.sources import files, listed, tables


def texts(parsed):
    return {r.file_name: r.text for r in parsed.collect()}


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "docs"
    for place, content in {
        "a.txt": " one ", "b/c.json": '{"text": "two"}', "b/d/e.txt": "three", "b/d/empty.txt": "", "b/d/odd name%20é.txt": "four",
        "skip.csv": "no", ".hidden/f.txt": "no", "_temp/g.txt": "no", "b/.h.txt": "no", "p=1/_k/i.txt": "no", "p=1/j.txt": "five",
    }.items():
        (root / place).parent.mkdir(parents=True, exist_ok=True)
        (root / place).write_text(content)
    return root


def test_listing_equals_the_built_in_reader(spark, folder):
    ours = {(r.path, r.length) for r in listed.list_files(spark, str(folder), ["*.txt", "*.json"]).collect()}
    built_in = spark.read.format("binaryFile").option("pathGlobFilter", "{*.txt,*.json}").option("recursiveFileLookup", "true").load(str(folder))
    # which leaves out empty files
    assert {r for r in ours if r[1]} == {(r.path, r.length) for r in built_in.select("path", "length").collect()}
    assert {os.path.basename(p) for p, n in ours if not n} == {"empty.txt"}
    flat = listed.list_files(spark, str(folder), recursive=False).collect()
    assert [os.path.basename(r.path) for r in flat] == ["a.txt"]


def test_parsing_equals_the_built_in_reader(spark, folder, tmp_path):
    listed.refresh(spark, str(folder), str(tmp_path / "m"))
    columns = ["doc_id", "file_path", "file_name", "file_size", "format", "text", "success", "error", "word_count"]
    ours = listed.parse_manifest(spark, str(tmp_path / "m")).select(columns).collect()
    theirs = files.parse_directory(spark, str(folder)).select(columns).collect()
    empty = [r for r in ours if not r.file_size]
    assert sorted(r for r in ours if r.file_size) == sorted(theirs) and len(ours) == 6
    assert [(r.text, r.success, r.word_count) for r in empty] == [("", True, 0)]


def test_missing_and_empty_folders(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFoundError"):
        listed.refresh(spark, str(tmp_path / "none"), str(tmp_path / "m"))
    (tmp_path / "empty").mkdir()
    assert listed.refresh(spark, str(tmp_path / "empty"), str(tmp_path / "m")) == 0
    assert listed.parse_manifest(spark, str(tmp_path / "m")).collect() == []


def test_bins_hold_about_the_stated_bytes_and_every_file_once(spark, tmp_path):
    root, manifest = tmp_path / "docs", str(tmp_path / "m")
    root.mkdir()
    for i in range(40):
        (root / f"{i:02}.txt").write_text("x" * (i * 10))
    listed.refresh(spark, str(root), manifest, bin_bytes=4 * listed.OPEN_BYTES)
    rows = spark.read.parquet(f"{manifest}/files").collect()
    assert len({r.path for r in rows}) == len(rows) == 40
    per_bin = {b: sum(r.bin == b for r in rows) for b in {r.bin for r in rows}}
    assert set(per_bin) == set(range(max(per_bin) + 1)) and max(per_bin.values()) <= 5
    spark.dataSource.register(listed.DocumentFiles)
    read = spark.read.format("document_files").load(manifest)
    assert read.rdd.getNumPartitions() == len(per_bin) and read.count() == 40


def test_small_files_share_a_bin_and_few_files_use_all_cores(spark, tmp_path):
    root, manifest = tmp_path / "docs", str(tmp_path / "m")
    root.mkdir()
    for i in range(400):
        (root / f"{i:03}.txt").write_text("x" * 10)
    assert 900 < listed.BIN_BYTES // (listed.OPEN_BYTES + 3000) < 1100
    listed.refresh(spark, str(root), manifest)
    bins = [r["count"] for r in spark.read.parquet(f"{manifest}/files").groupBy("bin").count().collect()]
    least = listed.BINS_PER_CORE * spark.sparkContext.defaultParallelism
    assert sum(bins) == 400 and least <= len(bins) <= 2 * least and max(bins) <= 2 * min(bins) + 1


def test_texts_are_decoded_once_where_failed_rows_go(spark, folder, tmp_path):
    listed.refresh(spark, str(folder), str(tmp_path / "m"))
    parsed = tables.structured_documents(listed.parse_manifest(spark, str(tmp_path / "m"), extractors={}))
    # stripping takes two replacements, cleaning two more
    assert parsed._jdf.queryExecution().executedPlan().toString().split("(1) Scan")[0].count("regexp_replace(") == 4
    assert {r.raw_text for r in parsed.collect()} == {"one", "two", "three", "four", "five", ""}


def test_versions_hold_what_is_new_or_changed(spark, folder, tmp_path):
    manifest = str(tmp_path / "m")
    assert listed.refresh(spark, str(folder), manifest) == 1
    assert listed.refresh(spark, str(folder), manifest) == 1
    (folder / "a.txt").write_text("another")
    (folder / "new.txt").write_text("six")
    assert listed.refresh(spark, str(folder), manifest) == 2
    found = texts(listed.parse_manifest(spark, manifest))
    assert found["a.txt"] == "another" and found["new.txt"] == "six" and len(found) == 7
    os.remove(folder / "new.txt")
    gone = listed.parse_manifest(spark, manifest).filter("file_name = 'new.txt'").first()
    assert not gone.success and gone.error == "file is gone"


def test_a_version_without_its_commit_does_not_count(spark, folder, tmp_path):
    manifest = str(tmp_path / "m")
    begun = spark.createDataFrame([("file:/nowhere.txt", 1, 1, 0, 0)], "path string, length long, modified long, bin int, slice int")
    begun.write.partitionBy("slice").parquet(f"{manifest}/files/version=1")
    assert listed.refresh(spark, str(folder), manifest) == 2
    assert len(texts(listed.parse_manifest(spark, manifest))) == 6


def test_stream_reads_each_version_once(spark, folder, tmp_path):
    manifest, out, state = (str(tmp_path / n) for n in ("m", "out", "state"))

    def drain():
        parsed = listed.stream_manifest(spark, manifest)
        parsed.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        return sorted(r.file_name for r in spark.read.schema(parsed.schema).parquet(out).select("file_name").collect())

    listed.refresh(spark, str(folder), manifest)
    first = drain()
    assert len(first) == 6 and drain() == first
    (folder / "new.txt").write_text("six")
    (folder / "a.txt").write_text("another")
    listed.refresh(spark, str(folder), manifest)
    assert drain() == sorted([*first, "new.txt", "a.txt"])


def test_written_files_come_back(spark, tmp_path):
    docs = spark.createDataFrame([("a/b", "x\n y", 1), ("é %", "", 2), ("n", None, 3)], "doc_id string, text string, path int")
    written = {r.doc_id: r.length for r in listed.write_files(docs, str(tmp_path / "t"), per_folder=1).collect()}
    assert written == {"a/b": 4, "é %": 0, "n": 0}
    assert len(listed.list_files(spark, str(tmp_path / "t")).collect()) == 3
    assert listed.write_files(docs.limit(0), str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="without an id"):
        listed.write_files(spark.createDataFrame([(None, "x")], "doc_id string, text string"), str(tmp_path / "t"))


def test_no_file_list_in_the_plan(spark, sf_dir):
    plan = catalog.files_roundtrip(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan document_files" in plan and ".txt" not in plan.split("BatchScan document_files")[1].splitlines()[0]
