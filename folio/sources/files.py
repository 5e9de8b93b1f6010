"""Input files as a DataFrame of documents (file_index, source_doc, stem, path, suffix, markdown, error).

Text files are read by Spark. Word and PDF files go through Python, one Arrow batch at a time, with an extractor for
each suffix that can be replaced; a file that can't be decoded gives a row with an error instead of ending the job."""

from __future__ import annotations

import io
import os
import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.functions import text as T

TEXT = ("md", "markdown", "txt")
BINARY = ("pdf", "docx", "doc")
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def suffix_of(path: str | F.Column) -> F.Column:
    return F.lower(F.regexp_extract(path, r"[^/.]\.([^./]+)\z", 1))


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, suffix) of the supported files under a folder, or of one file. A missing path gives no rows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return spark.createDataFrame([], "path string, suffix string, length long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", suffix_of(F.col("path")).alias("suffix"), "length").filter(F.col("suffix").isin(*TEXT, *BINARY))


def numbered(files: DataFrame) -> DataFrame:
    """Adds source_doc, stem and file_index, files being in order of lower-case name, then lower-case path. Only names go
    through the window, never contents."""
    name = F.regexp_extract("path", r"([^/]*)\z", 1)
    order = Window.orderBy(F.lower("source_doc"), F.lower("path"))
    return files.withColumn("source_doc", name).withColumn("stem", T.file_stem(F.col("source_doc"))).withColumn("file_index", F.row_number().over(order) - 1)


def _attribute(node, path: str, name: str = "val") -> str | None:
    found = node.find("/".join(f"{_WORD}{x}" for x in path.split("/"))) if node is not None else None
    return None if found is None else found.get(f"{_WORD}{name}")


def _list_formats(numbering: bytes | None) -> dict[tuple[str, str], str]:
    """The kind of list ("bullet", "decimal", ...) for each (list, level)."""
    if not numbering:
        return {}
    root = ElementTree.fromstring(numbering)
    kinds = {x.get(f"{_WORD}abstractNumId"): {v.get(f"{_WORD}ilvl"): _attribute(v, "numFmt") for v in x.findall(f"{_WORD}lvl")} for x in root.findall(f"{_WORD}abstractNum")}
    return {(x.get(f"{_WORD}numId"), level): kind or "bullet" for x in root.findall(f"{_WORD}num") for level, kind in kinds.get(_attribute(x, "abstractNumId"), {}).items()}


def docx_text(content: bytes) -> str:
    """Paragraphs, headings, lists, links and tables of a Word file as Markdown. Tables within a cell are read as the
    cell's words; a cell over several columns is repeated in each; what was deleted under tracking is left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        part = lambda name: z.read(name) if name in names else None
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_WORD}body")
        formats = _list_formats(part("word/numbering.xml"))
        relations = part("word/_rels/document.xml.rels")
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(relations)} if relations else {}
    counts: dict[tuple[str, int], int] = {}

    def said(node) -> str:
        if node.tag == f"{_WORD}t":
            return node.text or ""
        if node.tag in (f"{_WORD}tab", f"{_WORD}br"):
            return "\t" if node.tag == f"{_WORD}tab" else "\n"
        if node.tag == f"{_WORD}pPr":
            return ""
        text = "".join(map(said, node))
        target = targets.get(node.get(f"{_LINK}id")) if node.tag == f"{_WORD}hyperlink" else None
        return f"[{text}]({target})" if target and text.strip() else text

    def parts(node) -> Iterator:
        """Paragraphs and tables, those in content controls and tracked insertions too."""
        for child in node if node is not None else ():
            if child.tag in (f"{_WORD}p", f"{_WORD}tbl"):
                yield child
            elif child.tag in (f"{_WORD}sdt", f"{_WORD}sdtContent", f"{_WORD}ins", f"{_WORD}customXml"):
                yield from parts(child)

    def cell(node) -> str:
        inner = (" ".join(cell(c) for c in x.iter(f"{_WORD}tc")) if x.tag == f"{_WORD}tbl" else said(x) for x in parts(node))
        return " ".join(" ".join(inner).split())

    def row(node) -> list[str]:
        return [cell(c) for c in node.findall(f"{_WORD}tc") for _ in range(int(_attribute(c, "tcPr/gridSpan") or 1))]

    def list_mark(node, style: str) -> str:
        """The mark of a list's item, with its indent; empty for other paragraphs."""
        number = _attribute(node, "pPr/numPr/numId")
        if number is None:
            kind = "decimal" if style.startswith("ListNumber") else "bullet" if style.startswith("ListBullet") else None
            number = style
        else:
            kind = None if number == "0" else formats.get((number, _attribute(node, "pPr/numPr/ilvl") or "0"), "bullet")
        if kind in (None, "none"):
            return ""
        level = int(_attribute(node, "pPr/numPr/ilvl") or 0)
        counts[number, level] = counts.get((number, level), 0) + 1
        for deeper in [k for k in counts if k[0] == number and k[1] > level]:
            del counts[deeper]
        return "    " * level + ("- " if kind == "bullet" else f"{counts[number, level]}. ")

    out: list[str] = []
    in_list = False
    for node in parts(body):
        mark = ""
        if node.tag == f"{_WORD}tbl":
            rows = [row(r) for r in node.findall(f"{_WORD}tr")]
            if not rows:
                continue
            line = lambda r: "| " + " | ".join(r) + " |"
            text = "\n".join([line(rows[0]), line(["---"] * len(rows[0])), *map(line, rows[1:])])
        else:
            text = said(node).strip()
            if not text:
                continue
            style = _attribute(node, "pPr/pStyle") or ""
            level = "".join(c for c in style if c.isdigit()) if "eading" in style else ""
            mark = "" if level else list_mark(node, style)
            text = f"{'#' * min(int(level), 6)} {text}" if level else mark + text
        if mark and in_list:
            out[-1] += "\n" + text
        else:
            out.append(text)
        in_list = bool(mark)
    return "\n\n".join(out)


def doc_text(content: bytes) -> str:
    """An older Word file, turned into .docx by an office suite on the worker."""
    office = shutil.which("soffice") or shutil.which("libreoffice")
    if not office:
        raise RuntimeError("reading .doc needs an office suite (soffice) on the workers; turn the file into .docx first")
    with tempfile.TemporaryDirectory() as at:
        source = os.path.join(at, "source.doc")
        with open(source, "wb") as f:
            f.write(content)
        subprocess.run([office, "--headless", "--convert-to", "docx", "--outdir", at, source], check=True, capture_output=True)
        made = [x for x in os.listdir(at) if x.endswith(".docx")]
        if not made:
            raise RuntimeError("the office suite made no .docx")
        with open(os.path.join(at, made[0]), "rb") as f:
            return docx_text(f.read())


def pdf_lines(content: bytes) -> list[str]:
    """The embedded text lines of a PDF, page by page; needs docling-parse on the workers."""
    from docling_parse.pdf_parser import DoclingPdfParser

    document = DoclingPdfParser(loglevel="fatal").load(path_or_stream=io.BytesIO(content))
    return [text for n in range(1, document.number_of_pages() + 1) for cell in document.get_page(n).textline_cells if (text := cell.text.strip())]


#: For each suffix what makes Markdown, or the lines of a page-oriented text, of a file's bytes.
EXTRACTORS: dict[str, Callable[[bytes], str | list[str]]] = {"docx": docx_text, "doc": doc_text, "pdf": pdf_lines}


def extracted(files: DataFrame, extractors: dict[str, Callable] | None = None) -> DataFrame:
    """files has path, suffix and content; returns path, markdown (of lines: after their compaction) and error."""
    use = EXTRACTORS | (extractors or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, suffix, content in zip(pdf["path"], pdf["suffix"], pdf["content"], strict=True):
                try:
                    got = use[suffix](bytes(content))
                    rows.append((path, got, None, None) if isinstance(got, str) else (path, None, list(got), None))
                except Exception as e:  # noqa: BLE001 one bad file must not end the job
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "text", "lines", "error"])

    out = files.select("path", "suffix", "content").mapInPandas(run, "path string, text string, lines array<string>, error string")
    return out.select("path", F.coalesce("text", F.when(F.col("lines").isNotNull(), T.compact_lines(F.col("lines"))), F.lit("")).alias("markdown"), "error")


def read_documents(spark: SparkSession, path: str, extractors: dict[str, Callable] | None = None) -> DataFrame:
    """All supported files under a path, in order. Line ends become \\n; bytes that aren't UTF-8 give an error row."""
    files = numbered(listed(spark, path))
    have = {r[0] for r in files.select("suffix").distinct().collect()}  # at most the six suffixes
    if not have:
        return files.select("file_index", "source_doc", "stem", "path", "suffix", F.lit("").alias("markdown"), F.lit(None).cast("string").alias("error"))
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", suffix_of(F.col("path")).alias("suffix"), "content")
    text = F.regexp_replace(F.col("content").cast("string"), "\r\n?", "\n")
    plain = raw.filter(F.col("suffix").isin(*TEXT)).select("path", F.when(F.is_valid_utf8(F.col("content").cast("string")), text).otherwise("").alias("markdown"), F.when(~F.is_valid_utf8(F.col("content").cast("string")), F.lit("not UTF-8")).alias("error"))
    parts = [plain] if have & set(TEXT) else []
    if have & set(BINARY):
        parts.append(extracted(raw.filter(F.col("suffix").isin(*BINARY)), extractors))
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return files.join(found, "path").select("file_index", "source_doc", "stem", "path", "suffix", "markdown", "error")
