"""Documents from files: a folder, a list, or one path."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from posixpath import commonprefix
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import strip
from gleaner.operators.ranking import positions
from gleaner.runtime import fits_broadcast, materialize

# The file types that are read.
PLAIN = (".txt", ".md")
PARSED = (".pdf", ".docx")
SUFFIXES = (*PLAIN, *PARSED)

# Names of a folder up to which a pattern lists them one by one.
PATTERN_NAMES = 1_000
# Spark plans a small file as 4 MB, a task for 32 of them; so many such tasks are made one.
TASKS_TOGETHER = 16

_FILES = "path string, content binary"
# An extractor turns the bytes of one file into its parts: pages or paragraphs.
Extractor = Callable[[bytes], list[str]]

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_paragraphs(content: bytes) -> list[str]:
    """Texts of the body paragraphs of a word document."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    marks = {f"{_W}tab": "\t", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}

    def text_of(node: ElementTree.Element) -> str:
        if node.tag == f"{_W}t":
            return node.text or ""
        if node.tag == f"{_W}br":
            return "\n" if node.get(f"{_W}type", "textWrapping") == "textWrapping" else ""
        return marks.get(node.tag, "")

    runs = f"./{_W}r/*", f"./{_W}hyperlink/{_W}r/*"
    paragraphs = [] if body is None else body.findall(f"./{_W}p")
    texts = []
    for paragraph in paragraphs:
        wanted = {id(n) for path in runs for n in paragraph.findall(path)}
        texts.append("".join(text_of(n) for n in paragraph.iter() if id(n) in wanted))
    return texts


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """Last dot-suffix in lower case; empty for names that only start or end with a dot."""
    return F.lower(F.regexp_extract(file_name(path), r"(?s)^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?s)(?<=.)\.[^.]+\z", "")


def local_path(path: Column) -> Column:
    return F.regexp_replace(path, r"^file:/+", "/")


def file_metadata(path: Column) -> Column:
    return F.create_map(F.lit("source"), local_path(path), F.lit("filename"), file_name(path))


def join_parts(parts: Column, kind: Column) -> Column:
    """Parts of one document, separated by blank lines: non-blank paragraphs, or pages that are not empty."""
    return F.array_join(F.filter(parts, lambda p: F.when(kind == ".docx", strip(p)).otherwise(p) != ""), "\n\n")


def assemble_parts(parts: DataFrame, doc: str, order: str, text: str = "text") -> DataFrame:
    """One document per `doc` from a table of ordered parts; empty parts are dropped."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text).alias("_text"))))
    return (
        parts.where(F.col(text) != "")
        .groupBy(doc)
        .agg(rows.alias("_rows"))
        .select(doc, F.array_join(F.transform("_rows", lambda r: r["_text"]), "\n\n").alias("text"))
    )


@dataclass(frozen=True)
class FileDocuments:
    """`documents` (doc_id, text, metadata, doc_ord) and `rejects` (path, error)."""

    documents: DataFrame
    rejects: DataFrame

    @classmethod
    def split(
        cls, extracted: DataFrame, missing: DataFrame | None = None, name: Column | None = None
    ) -> "FileDocuments":
        """`name` is the document id, by default the file's name without its suffix."""
        good = extracted.where(F.col("error").isNull()).select(
            (stem(F.col("path")) if name is None else name).alias("doc_id"), "text", file_metadata(F.col("path")).alias("metadata"), "doc_ord"
        )
        bad = extracted.where(F.col("error").isNotNull()).select("path", "error")
        return cls(good, bad if missing is None else bad.unionByName(missing))


def _extract(files: DataFrame, extractors: dict[str, Extractor]) -> DataFrame:
    """(path, doc_ord, text, error) in one pass: text files stay inside the JVM, others go through an extractor."""
    known = {".docx": docx_paragraphs, **extractors}

    @F.pandas_udf("parts array<string>, error string")
    def parse(kinds: pd.Series, contents: pd.Series) -> pd.DataFrame:
        parts, errors = [], []
        for kind, content in zip(kinds, contents):
            made = error = None
            if content is not None:
                try:
                    if kind not in known:
                        raise ValueError(f"no extractor for '{kind}'")
                    made = list(known[kind](content))
                except Exception as problem:  # a broken file must not stop the others
                    error = f"{type(problem).__name__}: {problem}"
            parts.append(made)
            errors.append(error)
        return pd.DataFrame({"parts": parts, "error": errors})

    # A condition on what it returns must not be asked below the scan's tasks again: each file is parsed once.
    parse = parse.asNondeterministic()
    kind = suffix(F.col("path"))
    content = F.col("content")
    rows = files.select(
        "path", "doc_ord", kind.alias("kind"),
        F.when(kind.isin(*PLAIN), F.make_valid_utf8(content.cast("string"))).alias("plain"),
        parse(kind, F.when(kind.isin(*PARSED), content)).alias("made"),
    )
    kind = F.col("kind")
    unsupported = F.when(~kind.isin(*SUFFIXES), F.format_string("unsupported file type: %s", kind))
    return rows.select(
        "path", "doc_ord",
        F.coalesce("plain", join_parts(F.col("made.parts"), kind)).alias("text"),
        F.coalesce("made.error", unsupported).alias("error"),
    )


def fewer_tasks(files: DataFrame) -> DataFrame:
    """A scan of many small files without a task for every few of them."""
    planned = files.rdd.getNumPartitions()
    wanted = max(4 * files.sparkSession.sparkContext.defaultParallelism, planned // TASKS_TOGETHER)
    return files.coalesce(wanted) if wanted < planned else files


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder as the operating system names it, where the path lies on a disk; None for other storage."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return root.toUri().getPath() if system.getUri().getScheme() == "file" else None


def read_directory(
    spark: SparkSession,
    directory: str,
    extractors: dict[str, Extractor] | None = None,
    *,
    recursive: bool = True,
    ids: str = "stem",
) -> FileDocuments:
    """Every supported file below a folder, in path order; unreadable ones become rejects.

    With `ids="path"` a document is named by its path within the folder, so that files of one name in several
    folders stay apart. Spark's readers pass over names that begin with "_" or "."; such files are rejects.
    """
    if ids not in ("stem", "path"):
        raise ValueError("ids is 'stem' or 'path'")
    kinds = ",".join(s[1:] for s in SUFFIXES)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{kinds}}}")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        files = reader.load(directory)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], _FILES)
    # Only paths are sorted, from a table of their own: each pass over the files asks for the status of every one.
    order = positions(materialize(fewer_tasks(files.select("path")), "paths"), "path", into="doc_ord")
    numbered = fewer_tasks(files.select("path", "content")).join(F.broadcast(order) if fits_broadcast(order, "path") else order, "path")
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    full = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    name = None if ids == "stem" else F.substr(local_path(F.col("path")), F.length(local_path(F.lit(full))) + 2)
    hidden = [(p, "hidden file names are not read; rename the file") for p in _hidden_files(spark, directory, recursive)]
    rejected = spark.createDataFrame(hidden, "path string, error string")
    return FileDocuments.split(_extract(numbered, extractors or {}), rejected, name)


def _hidden_files(spark: SparkSession, directory: str, recursive: bool) -> list[str]:
    """Supported files that Spark's listing leaves out; asked level by level, only hidden names are returned."""
    folder = local_folder(spark, directory)
    if folder is not None:
        return _hidden_on_disk(folder, recursive)
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(directory).getFileSystem(spark._jsc.hadoopConfiguration())
    found, level = [], escaped(directory.rstrip("/"))
    while True:
        for status in system.globStatus(jvm.org.apache.hadoop.fs.Path(level + "/{_,.}*")) or ():
            path = status.getPath().toString()
            if status.isFile() and path.lower().endswith(SUFFIXES):
                found.append(path)
        level += "/[!_.]*"
        # Only folders have something below them; files are not asked one by one.
        if not recursive or not len(system.globStatus(jvm.org.apache.hadoop.fs.Path(level + "/*")) or ()):
            return found


def _hidden_on_disk(folder: str, recursive: bool) -> list[str]:
    """The same from the names alone: Hadoop would ask for the status of each file, once per level."""
    found = []
    for at, below, names in os.walk(folder, followlinks=True):
        hidden = [os.path.join(at, n) for n in names if n.startswith(("_", ".")) and n.lower().endswith(SUFFIXES)]
        found += [f"file:{p}" for p in hidden if os.path.isfile(p)]
        below[:] = [b for b in below if not b.startswith(("_", "."))] if recursive else []
    return found


def escaped(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_files(
    spark: SparkSession, paths: list[str], extractors: dict[str, Extractor] | None = None
) -> FileDocuments:
    """The listed files in list order; missing and unsupported ones become rejects.

    Each folder is listed once, whatever the number of its files, and all files are read by one scan; a table of wanted
    paths gives them their places and tells what is missing. Of a folder of which many files are wanted, all that begin
    alike are read: a pattern of all names would be compared with every file name there.
    """
    names: dict[str, list[str]] = {}
    for path in paths:
        folder, _, name = path.rpartition("/")
        names.setdefault(folder or ("/" if path.startswith("/") else "."), []).append(name)
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    full, patterns, crowded, common = {}, [], [], None
    for folder, own in names.items():
        root = jvm.org.apache.hadoop.fs.Path(folder)
        system = root.getFileSystem(settings)
        full[folder] = system.makeQualified(root).toString().rstrip("/")
        if len(own) > PATTERN_NAMES:
            common = commonprefix(own if common is None else [common, *own])
            if system.exists(root):
                crowded.append(full[folder])
            continue
        choice = ",".join(sorted({escaped(n).replace(",", "\\,") for n in own}))
        pattern = f"{escaped(full[folder])}/{{{choice}}}"
        if system.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)):
            patterns.append(pattern)
    wanted = []
    for path in paths:
        folder, _, name = path.rpartition("/")
        wanted.append(f"{full[folder or ('/' if path.startswith('/') else '.')]}/{name}")
    columns = {"path": pa.array(wanted, pa.string()), "given": pa.array(paths, pa.string()), "doc_ord": pa.array(range(len(paths)), pa.int64())}
    table = spark.createDataFrame(pa.table(columns))
    files = spark.createDataFrame([], _FILES)
    # Folders that a pattern meets are no tables by partition.
    reader = lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if patterns:
        files = reader().load(patterns).select("path", "content")
    if crowded:
        # The folder is listed, not its files one by one.
        many = reader().option("pathGlobFilter", escaped(common) + "*").load([escaped(c) for c in crowded]).select("path", "content")
        # A folder may lie below another one; a file is read for its own.
        own = F.regexp_replace("path", r"(?s)/[^/]*\z", "").isin(crowded)
        files = files.where(~own).unionByName(many.where(own)) if patterns else many
    places = table.select("path", "doc_ord")
    found = fewer_tasks(files).join(F.broadcast(places) if fits_broadcast(places, "path") else places, "path")
    hidden = file_name(F.col("path")).rlike("^[_.]")
    reason = F.when(hidden, "hidden file names are not read; rename the file").otherwise(F.concat(F.lit("FileNotFoundError: "), F.col("given")))
    missing = table.join(files.select("path").distinct(), "path", "left_anti").select(F.col("given").alias("path"), reason.alias("error"))
    return FileDocuments.split(_extract(found, extractors or {}), missing)


def _one_file(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.format("binaryFile").load(escaped(path)).select("path", "content")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise


def read_file(spark: SparkSession, path: str, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    """One file as documents; a path that is missing or cannot be read is an error at once."""
    kind = "." + path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    files = _one_file(spark, path)
    if kind not in SUFFIXES:
        raise ValueError(f"unsupported file type: {kind}")
    read = FileDocuments.split(_extract(files.withColumn("doc_ord", F.lit(0).cast("bigint")), extractors or {}))
    reject = read.rejects.first()
    if reject is not None:
        raise ValueError(f"{path}: {reject['error']}")
    if path.rsplit("/", 1)[-1].startswith(("_", ".")):
        raise ValueError(f"{path}: hidden file names are not read; rename the file")
    return read.documents
