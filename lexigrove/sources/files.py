"""Documents from files: text, JSON and DOCX, one row per file, errors kept as rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigrove.functions import text as X
from lexigrove.functions.constants import SUPPORTED_FORMATS

DEFAULT_PATTERNS = ["*.pdf", "*.docx", "*.txt", "*.json"]
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

BytesExtractor = Callable[[bytes], str]


def docx_text(content: bytes) -> str:
    """Body paragraphs of a DOCX file, one per line."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_WORD}body")
    marks = {f"{_WORD}tab": "\t", f"{_WORD}br": "\n", f"{_WORD}cr": "\n", f"{_WORD}noBreakHyphen": "-"}
    holders = {f"{_WORD}hyperlink", f"{_WORD}ins", f"{_WORD}smartTag"}

    def runs(parent):
        """Runs of a paragraph in order; settings, where a tab stop has the tag of a tab, hold none."""
        for child in parent:
            if child.tag == f"{_WORD}r":
                yield child
            elif child.tag in holders:
                yield from runs(child)

    lines = [
        "".join((node.text or "") if node.tag == f"{_WORD}t" else marks.get(node.tag, "") for run in runs(paragraph) for node in run)
        for paragraph in body.findall(f"{_WORD}p")
    ]
    return "\n".join(lines).strip()


def _needed(names: list[str], extractors: dict[str, BytesExtractor] | None) -> dict[str, BytesExtractor]:
    """The extractors that files with these names or patterns can need; often none, and then no Python runs."""
    offered = {".docx": docx_text, **(extractors or {})}
    suffixes = {re.search(r"(\.\w+)?$", name.lower()).group(0) for name in names}
    return {s: f for s, f in offered.items() if s in suffixes or "" in suffixes}


def _extractor_column(extractors: dict[str, BytesExtractor]):
    """One pass over the bytes of the formats that need Python; other rows send nulls only."""

    @F.pandas_udf("text string, error string")
    def extract(format: pd.Series, content: pd.Series) -> pd.DataFrame:
        texts, errors = [], []
        for suffix, raw in zip(format, content):
            text = error = None
            if raw is not None:
                try:
                    text = extractors[suffix](bytes(raw))
                except Exception as problem:  # the row fails, the batch goes on
                    error = f"{type(problem).__name__}: {problem}"
            texts.append(text)
            errors.append(error)
        return pd.DataFrame({"text": texts, "error": errors})

    wanted = F.col("format").isin(list(extractors))
    return extract(F.when(wanted, F.col("format")), F.when(wanted, F.col("content")))


def parse_files(files: DataFrame, *, extractors: dict[str, BytesExtractor] | None = None) -> DataFrame:
    """Parse ``binaryFile`` rows; one without content is a failed row.

    ``extractors`` maps suffixes (``.pdf``) to functions from bytes to text, DOCX alone by default;
    without one such a file is a failed row.
    """
    extractors = {".docx": docx_text} if extractors is None else extractors
    nothing = F.lit(None).cast("struct<text:string,error:string>")
    name = F.element_at(F.split("path", "/"), -1)
    named = files.select(
        F.col("path").alias("file_path"),
        name.alias("file_name"),
        F.col("length").alias("file_size"),
        F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)).alias("format"),
        "content",
    )
    decoded = named.select(
        "*",
        F.when(F.col("format") == ".txt", X.decode_bytes("content")).alias("_plain"),
        F.when(F.col("format") == ".json", X.json_object(F.col("content").cast("string"))).alias("_json"),
        (_extractor_column(extractors) if extractors else nothing).alias("_other"),
    )
    text = F.coalesce("_plain", X.json_document_text(F.col("_json")), F.col("_other.text"))
    # the outer generator keeps a filter on success from decoding every text a second time
    parsed = decoded.select(
        F.xxhash64("file_path").alias("doc_id"), "file_path", "file_name", "file_size", "format",
        F.explode_outer(F.array(text)).alias("text"),
        F.coalesce(
            X.json_document_metadata(F.col("_json")), F.create_map().cast("map<string,string>")
        ).alias("metadata"),
        F.lit(None).cast("double").alias("extraction_time"),
        F.col("_other.error").alias("_problem"),
        F.col("content").isNull().alias("_gone"),
    )
    failed = F.col("text").isNull()
    error = (
        F.when(~F.col("format").isin(SUPPORTED_FORMATS + list(extractors)), F.concat(F.lit("Unsupported format: "), "format"))
        .when(F.col("_gone"), F.lit("file is gone"))
        .when(F.col("format") == ".json", F.lit("not a JSON object"))
        .when(F.col("_problem").isNotNull(), F.col("_problem"))
        .otherwise(F.concat(F.lit("no text extractor for "), "format"))
    )
    return parsed.select(
        "doc_id", "file_path", "file_name", "file_size", "format",
        F.coalesce("text", F.lit("")).alias("text"),
        "metadata", "extraction_time",
        (~failed).alias("success"),
        F.when(failed, error).alias("error"),
        F.when(~failed, X.char_count("text")).alias("char_count"),
        F.when(~failed, X.word_count("text")).alias("word_count"),
    )


def parse_directory(
    spark: SparkSession, directory: str, patterns: list[str] | None = None, *, recursive: bool = True,
    extractors: dict[str, BytesExtractor] | None = None,
) -> DataFrame:
    """Every matching file below a directory; a missing one raises, none matching gives no rows.

    One glob joins the patterns, so a file that matches two of them is one row.
    """
    patterns = DEFAULT_PATTERNS if patterns is None else patterns
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "{" + ",".join(patterns) + "}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(directory)
    )
    return parse_files(files, extractors=_needed(patterns, extractors))


def parse_batch(
    spark: SparkSession, paths: list[str], *, extractors: dict[str, BytesExtractor] | None = None
) -> DataFrame:
    """The named files; a missing one raises."""
    return parse_files(spark.read.format("binaryFile").load(paths), extractors=_needed(paths, extractors))


def parse_json_documents(rows: DataFrame, *, content: str, key: str) -> DataFrame:
    """JSON documents held in a column, with the same rules as JSON files."""
    parsed = rows.select(key, X.json_object(content).alias("_json"))
    return parsed.select(
        key,
        X.json_document_text(F.col("_json")).alias("text"),
        X.json_document_metadata(F.col("_json")).alias("metadata"),
        F.col("_json").isNotNull().alias("success"),
    )
