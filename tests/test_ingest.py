import json
import zipfile

import pytest

from lexigrove.operators import evaluate as V
from lexigrove.plans import stages
from lexigrove.sources import files, tables


def write_docx(path, paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    xml = (
        '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">'
        f"<w:body>{body}</w:body></w:document>"
    )
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("word/document.xml", xml)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("  Plain text here. \n")
    (tmp_path / "sub" / "b.json").write_text(json.dumps({"content": "body text", "body": "b", "k": 1, "o": {"x": 2}}))
    (tmp_path / "list.json").write_text("[1,2]")
    (tmp_path / "latin.txt").write_bytes(bytes([0x63, 0x61, 0x66, 0xE9]))
    (tmp_path / "U.TXT").write_text("upper")
    (tmp_path / ".hid.txt").write_text("hidden")
    (tmp_path / "p.pdf").write_bytes(b"%PDF")
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    write_docx(tmp_path / "d.docx", ["First one", "Second one"])
    return tmp_path


def test_directory_scan_parses_every_format(spark, folder):
    rows = {r.file_name: r for r in files.parse_directory(spark, str(folder)).collect()}
    assert set(rows) == {"a.txt", "b.json", "list.json", "latin.txt", "p.pdf", "d.docx", "broken.docx"}
    assert rows["a.txt"].text == "Plain text here." and rows["a.txt"].word_count == 3 and rows["a.txt"].char_count == 16
    assert rows["latin.txt"].text == "café"
    assert rows["b.json"].text == "body text" and dict(rows["b.json"].metadata) == {"k": "1", "o": '{"x":2}'}
    assert rows["d.docx"].text == "First one\nSecond one"
    for name in ("list.json", "p.pdf", "broken.docx"):
        assert not rows[name].success and rows[name].error and rows[name].word_count is None
    assert rows["a.txt"].format == ".txt" and rows["a.txt"].error is None


def test_patterns_recursion_and_missing_folder(spark, folder):
    assert [r.file_name for r in files.parse_directory(spark, str(folder), ["a.*", "*.txt"], recursive=False).orderBy("file_name").collect()] == ["a.txt", "latin.txt"]
    assert files.parse_directory(spark, str(folder), ["*.none"]).count() == 0
    with pytest.raises(Exception):
        files.parse_directory(spark, str(folder / "absent")).count()


def test_batch_and_own_extractor(spark, folder):
    rows = files.parse_batch(spark, [str(folder / "p.pdf"), str(folder / "U.TXT")], extractors={".pdf": lambda b: b.decode()}).collect()
    assert {r.file_name: r.text for r in rows} == {"p.pdf": "%PDF", "U.TXT": "upper"}
    with pytest.raises(Exception):
        files.parse_batch(spark, [str(folder / "absent.txt")]).count()


def test_text_and_json_need_no_python(spark, folder):
    rows = files.parse_directory(spark, str(folder), ["*.txt", "*.json"])
    assert "ArrowEvalPython" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.filter("success").count() == 3
    everything = files.parse_directory(spark, str(folder), ["*"], recursive=False)
    assert "First one" in {r.text.split("\n")[0] for r in everything.collect()}


def test_unsupported_suffix_is_a_failed_row(spark, folder):
    (folder / "x.csv").write_text("a,b")
    row = files.parse_directory(spark, str(folder), ["*.csv"]).first()
    assert not row.success and row.error == "Unsupported format: .csv"


@pytest.mark.parametrize("doc,text", [
    ('{"text":5}', "5"), ('{"text":null,"content":"c"}', "None"), ('{"text":true}', "True"), ('{"k":1}', ""), ('"str"', None), ("{bad", None),
])
def test_json_text_rules(spark, doc, text):
    rows = spark.createDataFrame([(1, doc)], "id long, doc string")
    row = files.parse_json_documents(rows, content="doc", key="id").first()
    assert row.text == text and row.success == (text is not None)


def test_sinks_and_readers_round_trip(spark, folder, tmp_path):
    out = tmp_path / "out"
    results = stages.process_and_save(spark, str(folder), str(out / "corpus"), include_metadata=False)
    corpus = tables.read_corpus_jsonl(spark, str(out / "corpus"))
    assert {r.doc_id for r in corpus.collect()} == {"a.txt", "b.json", "latin.txt", "d.docx"}
    stages.process_and_save(spark, str(folder), str(out / "nothing"), patterns=["*.none"])
    assert not (out / "nothing").exists()
    docs = {r.file_name: r for r in tables.structured_documents(results).collect()}
    assert docs["a.txt"].raw_text == "Plain text here." and docs["a.txt"].text == "plain text here"


def test_ingest_reports_accuracy(spark, folder, tmp_path):
    report = stages.ingest(spark, str(folder), str(tmp_path / "out")).first()
    assert (report.total_processed, report.successful, report.failed) == (7, 4, 3)
    assert report.avg_time_per_doc > 0
    assert tables.read_table(spark, str(tmp_path / "out" / "documents")).count() == 4


def test_accuracy_report_of_nothing_has_all_columns(spark):
    empty = spark.createDataFrame([], "success boolean, extraction_time double")
    row = V.accuracy_report(empty).first()
    assert row.total_processed == 0 and row.accuracy == 0.0 and row.docs_per_second == 0.0


def test_jsonl_reader_skips_bad_lines(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"doc_id":"a","text":"one"}\nnot json\n{"doc_id":"b","text":"  "}\n{"doc_id":"c"}\n')
    assert [r.doc_id for r in tables.read_corpus_jsonl(spark, str(tmp_path / "c.jsonl")).collect()] == ["a"]


def test_documents_and_clusters_json(spark, tmp_path):
    (tmp_path / "documents.json").write_text(json.dumps([
        {"id": 3, "file_name": "a", "format": ".txt", "text": "t", "metadata": {"k": 1}, "word_count": 1}], indent=2))
    row = tables.read_documents_json(spark, str(tmp_path / "documents.json")).first()
    assert row.doc_id == 3 and row.metadata == {"k": "1"}
    (tmp_path / "clusters.json").write_text(json.dumps({"clusters": {
        "0": {"cluster_id": 0, "label": "L", "size": 2, "document_indices": [1, 2], "top_terms": [["data", 0.5]], "formats": {".txt": 2}},
        "1": {"cluster_id": 1, "label": "M", "size": 1, "document_indices": [7], "top_terms": []}},
        "silhouette_score": 0.1, "total_documents": 3, "num_clusters": 2}, indent=2))
    clusters = tables.read_clusters_json(spark, str(tmp_path / "clusters.json"))
    assert {(r.doc_id, r.cluster_id) for r in tables.cluster_members(clusters).collect()} == {(1, 0), (2, 0), (7, 1)}
    term = clusters.filter("cluster_id = 0").first().top_terms[0]
    assert (term.term, term.weight) == ("data", 0.5)
