import io
import zipfile

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from gleaner.operators.chunk import chunk_documents
from gleaner.sources.files import assemble_parts, docx_paragraphs, read_directory, read_file, read_files
from gleaner.sources.tables import from_table, from_texts, inline_text, string_map

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx(*paragraphs):
    body = "".join(f"<w:p>{p}</w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document {W}><w:body>{body}<w:sectPr/></w:body></w:document>')
    return out.getvalue()


def run(text):
    return f"<w:r><w:t>{text}</w:t></w:r>"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "b.txt").write_text("Plain été", encoding="utf-8")
    (tmp_path / "a.MD").write_text("upper case suffix")
    (tmp_path / "sub dir" / "c.tar.md").write_text("# Title\n\nbody")
    (tmp_path / "bad.txt").write_bytes(b"a\xffb\xe2\x82b")
    (tmp_path / "d.docx").write_bytes(docx(run("One") + "<w:r><w:tab/></w:r>" + run("two"), run("  "), run("Three")))
    (tmp_path / "broken.docx").write_bytes(b"not a zip")
    (tmp_path / "e.pdf").write_bytes(b"p1|p2||p3")
    (tmp_path / "x.xyz").write_text("no")
    (tmp_path / ".txt").write_text("hidden")
    return tmp_path


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_directory(spark, folder):
    read = read_directory(spark, str(folder), {".pdf": lambda b: b.decode().split("|")})
    got = {r["doc_id"]: r for r in read.documents.collect()}
    assert {k: r["text"] for k, r in got.items()} == {
        "b": "Plain été",
        "c.tar": "# Title\n\nbody",
        "bad": "a�b�b",
        "d": "One\ttwo\n\nThree",
        "e": "p1\n\np2\n\np3",
    }
    assert got["c.tar"]["metadata"] == {"source": f"{folder}/sub dir/c.tar.md", "filename": "c.tar.md"}
    paths = sorted((r["metadata"]["source"], r["doc_ord"]) for r in got.values())
    assert [o for _, o in paths] == sorted(o for _, o in paths)
    rejects = {r["path"].rsplit("/", 1)[-1]: r["error"] for r in read.rejects.collect()}
    assert set(rejects) == {"broken.docx"} | ({".txt"} & set(rejects)) and "BadZipFile" in rejects["broken.docx"]


def test_flat_directory_and_missing_extractor(spark, folder):
    read = read_directory(spark, str(folder), recursive=False)
    assert set(texts(read.documents)) == {"b", "bad", "d"}
    assert "no extractor" in {r["path"].rsplit("/", 1)[-1]: r["error"] for r in read.rejects.collect()}["e.pdf"]


def test_empty_and_missing_directory(spark, tmp_path):
    assert read_directory(spark, str(tmp_path)).documents.count() == 0
    assert read_directory(spark, str(tmp_path / "none")).documents.count() == 0


def test_file_list_keeps_its_order_and_goes_on_after_failures(spark, folder):
    names = ["d.docx", "missing.txt", "a.MD", "x.xyz", "b.txt"]
    read = read_files(spark, [str(folder / n) for n in names])
    assert [r["doc_id"] for r in read.documents.orderBy("doc_ord").collect()] == ["d", "a", "b"]
    errors = {r["path"].rsplit("/", 1)[-1]: r["error"] for r in read.rejects.collect()}
    assert set(errors) == {"missing.txt", "x.xyz"} and "unsupported" in errors["x.xyz"]
    assert read_files(spark, []).documents.count() == 0


def test_single_file(spark, folder):
    assert texts(read_file(spark, str(folder / "a.MD"))) == {"a": "upper case suffix"}
    with pytest.raises(FileNotFoundError):
        read_file(spark, str(folder / "missing.txt"))
    with pytest.raises(ValueError):
        read_file(spark, str(folder / "x.xyz"))


def test_docx_runs_links_and_breaks():
    link = f"<w:hyperlink>{run('link')}</w:hyperlink>"
    marks = '<w:r><w:br/><w:t>x</w:t><w:br w:type="page"/><w:noBreakHyphen/><w:cr/></w:r>'
    assert docx_paragraphs(docx(run("a ") + link, marks, "")) == ["a link", "\nx-\n", ""]


def test_texts_in_memory(spark):
    got = from_texts(spark, ["one", "two", "three"], ["x"]).orderBy("doc_ord").collect()
    assert [r["doc_id"] for r in got] == ["x", "text_1", "text_2"]
    row = inline_text(spark, "one", metadata={"year": 2024}).first()
    assert row["doc_id"] == "inline" and row["metadata"] == {"year": "2024"}
    frame = chunk_documents(inline_text(spark, "a short text that is still longer than fifty characters"))
    assert frame.first()["chunk_id"] == "inline_0"


def test_tables(spark):
    table = spark.createDataFrame([(7, "t", 3)], "id long, body string, year int")
    row = from_table(table, "id", "body", metadata=["year"]).first()
    assert row.asDict() == {"doc_id": "7", "text": "t", "metadata": {"year": "3"}, "doc_ord": 7}
    assert from_table(table, "id", "body").first()["metadata"] == {}
    numbers = spark.createDataFrame([({"a": 1},)], "m map<string,int>")
    assert numbers.select(string_map(F.col("m")).alias("m")).first()["m"] == {"a": "1"}


def test_parts(spark):
    rows = [(1, 2, "b"), (1, 0, "a"), (1, 1, ""), (2, 0, "")]
    got = assemble_parts(spark.createDataFrame(rows, "d long, n long, text string"), "d", "n").collect()
    assert [(r["d"], r["text"]) for r in got] == [(1, "a\n\nb")]


def test_long_file_list_is_one_scan(spark, tmp_path):
    """Names with signs that patterns use, repeated, missing and hidden ones; one listing a folder, one scan."""
    odd = ["a,b.txt", "c{d}.txt", "e[f].md", "g*h.txt", "i j.txt", "k\\l.txt"]
    for sub in ("one", "two"):
        (tmp_path / sub).mkdir()
        for n in odd:
            (tmp_path / sub / n).write_text(f"{sub} {n}")
        for k in range(300):
            (tmp_path / sub / f"f{k}.txt").write_text(f"{sub} {k}")
        (tmp_path / sub / "_hidden.txt").write_text("x")
    names = [f"{sub}/{n}" for sub in ("one", "two") for n in [*odd, *(f"f{k}.txt" for k in range(0, 300, 2))]]
    asked = [*names, "one/none.txt", names[0], "three/a.txt", "two/_hidden.txt"]
    read = read_files(spark, [str(tmp_path / n) for n in asked])
    assert plan_of(read.documents).count("FileScan binaryFile") == 1
    got = [r["text"] for r in read.documents.orderBy("doc_ord").collect()]
    want = [f"{n.split('/')[0]} {n.split('/')[1].removeprefix('f').removesuffix('.txt') if n.split('/')[1][1:2].isdigit() else n.split('/')[1]}" for n in [*names, names[0]]]
    assert got == want
    rejects = {r["path"].removeprefix(f"{tmp_path}/"): r["error"] for r in read.rejects.collect()}
    assert set(rejects) == {"one/none.txt", "three/a.txt", "two/_hidden.txt"} and "hidden" in rejects["two/_hidden.txt"]
    none = read_files(spark, [str(tmp_path / "three" / "x.txt")])
    assert none.documents.count() == 0 and none.rejects.count() == 1


def test_invalid_text_is_read_as_before(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"ok \xff\xe2\x28 end")
    assert texts(read_file(spark, str(tmp_path / "a.txt"))) == {"a": b"ok \xff\xe2\x28 end".decode("utf-8", "replace")}
