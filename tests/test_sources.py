import io
import os
import re
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formweave.operators.chunking import chunks_per_document
from formweave.operators.daterange import ranges_of_documents
from formweave.operators.status import observed, run_stats
from formweave.plans.fill import fill_from_folders, template_sheet
from formweave.plans.search import open_folder, open_index, search, search_folder
from formweave.sinks.tables import (
    output_name,
    write_filled,
    write_filled_many,
    write_markdown,
    write_ranges,
    write_records,
    write_slices,
    write_table,
)
from formweave.sources import files, workbook
from formweave.sources.docx import block_rows, decode_batches, decode_docx
from formweave.sources.files import convert_folder, decoded, read_folder, read_markdown, read_texts, scan_files
from formweave.sources.records import read_objects, read_range, read_record_lists, read_template, read_text_objects
from formweave.sources.workbook import (
    date_columns,
    filter_rows,
    headers,
    decode_workbooks,
    long_cells,
    records,
    wide,
)
from formweave.queries.office import docx, xlsx


def put(folder, files):
    for name, content in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def read_workbooks(spark, folder, **options):
    return decode_workbooks(scan_files(spark, folder, (".xlsx",)), **options)


def read_docx(spark, folder):
    return decode_docx(scan_files(spark, folder, (".docx",)))


def by_name(rows, column, key="path"):
    return {os.path.basename(r[key]): r[column] for r in rows.collect()}


def test_text_scan_is_flat_and_takes_any_case(spark, tmp_path):
    folder = put(tmp_path, {"a.txt": "x\r\ny", "b.TXT": "z", "c.md": "no", "sub/d.txt": "no", "e.txt": b"\xff\xfe"})
    texts = read_texts(spark, folder)
    assert by_name(texts, "text") == {"a.txt": "x\ny", "b.TXT": "z", "e.txt": None}
    assert by_name(texts, "status")["e.txt"] == "failed"


def test_markdown_scan_tries_encodings(spark, tmp_path):
    folder = put(tmp_path, {"a.md": "中文", "s/b.MD": "中文".encode("gbk"), "c.md": b"\xff\xff\xe9"})
    assert by_name(read_markdown(spark, folder), "text") == {"a.md": "中文", "b.MD": "中文", "c.md": "ÿÿé"}
    assert by_name(read_markdown(spark, folder, ("utf-8",)), "status") == {
        "a.md": "done", "b.MD": "failed", "c.md": "failed",
    }


def test_valid_utf8_needs_no_python(spark, tmp_path, capsys):
    folder = put(tmp_path, {"a.txt": "x"})
    files = spark.read.format("binaryFile").load(folder)
    files.select(decoded(F.col("content"), ("utf-8",))).explain()
    assert "Python" not in capsys.readouterr().out


BOOK = {
    "first": [["名称", "UpdateTime", None, "名称", "n"], ["a", ("date", 44013), "gap", "b", 5], [], ["c", ("date", 44014.5), None, True, 2.5]],
    "plain": [["x", "y"], ["1", ("error", "#DIV/0!")], [("inline", "NA"), "q"]],
    "empty": [["only", "header"]],
}


def test_workbook_rows(spark, tmp_path):
    folder = put(tmp_path, {"book.xlsx": xlsx(BOOK), "bad.xlsx": b"no zip"})
    rows = read_workbooks(spark, folder)
    got = {(r.sheet, r.row_idx): r for r in rows.collect() if r.error is None}
    first = got["first", 1]
    assert first.header == ["名称", "UpdateTime", "Unnamed: 2", "名称.1", "n"]
    assert first.cells == ["a", "2020-07-01 00:00:00", "gap", "b", "5"]
    assert got["first", 3].cells == ["c", "2020-07-02 12:00:00", None, "True", "2.5"]
    assert got["plain", 1].cells == ["1", None]
    assert got["empty", 1].cells is None
    assert [r.path.endswith("bad.xlsx") for r in rows.filter("error is not null").collect()] == [True]


def test_workbook_options(spark, tmp_path):
    folder = put(tmp_path, {"book.xlsx": xlsx(BOOK, shared=False)})
    assert {r.sheet for r in read_workbooks(spark, folder, sheet=1).collect()} == {"plain"}
    assert {r.sheet for r in read_workbooks(spark, folder, sheet="empty").collect()} == {"empty"}
    cut = read_workbooks(spark, folder, sheet=0, columns=["n"]).collect()
    assert [(r.header, r.cells) for r in cut] == [(["n"], ["5"]), (["n"], ["2.5"])]
    head = headers(read_workbooks(spark, folder, header_only=True))
    assert {r.sheet: r.header for r in head.collect()}["plain"] == ["x", "y"]
    later = read_workbooks(spark, folder, sheet=1, header_row=1, start_row=2).collect()
    assert [(r.header, r.cells) for r in later] == [(["1", "Unnamed: 1"], ["NA", "q"])]


def test_workbook_1904_dates(spark, tmp_path):
    folder = put(tmp_path, {"b.xlsx": xlsx({"s": [["d"], [("date", 0)]]}, date1904=True)})
    assert read_workbooks(spark, folder).first().cells == ["1904-01-01 00:00:00"]


def test_workbook_tables(spark, tmp_path):
    folder = put(tmp_path, {"book.xlsx": xlsx(BOOK)})
    rows = read_workbooks(spark, folder)
    table = wide(rows.filter("sheet = 'plain'"), ["x", "y"])
    assert [(r.x, r.y) for r in table.orderBy("row_idx").collect()] == [("1", None), (None, "q")]
    assert long_cells(rows.filter("sheet = 'plain'")).count() == 3
    maps = {(r.sheet, r.row_idx): r.record for r in records(rows).collect()}
    assert maps["first", 1]["名称.1"] == "b" and maps["plain", 2] == {"x": None, "y": "q"}


def test_sheet_date_columns_and_filter(spark, tmp_path):
    dates = [[f"2020-07-{d:02d}", "5"] for d in range(1, 9)]
    book = {
        "byname": [["id", "UpdateTime", "日期"], ["1", "2020-07-01", "x"], ["2", "2020-08-31 10:00:00", "x"], ["3", "bad", "x"]],
        "bycontent": [["w", "v"], *dates, ["x", "6"], ["y", "7"]],
        "weak": [["w", "v"], *dates[:7], ["x", "6"], ["y", "7"], ["z", "8"]],
    }
    rows = read_workbooks(spark, put(tmp_path, {"b.xlsx": xlsx(book)}))
    assert {r.sheet: r.date_idx for r in date_columns(rows).collect()} == {"byname": 1, "bycontent": 0, "weak": None}
    request = spark.sql("select date'2020-07-01' start_date, date'2020-08-31' end_date")
    kept = filter_rows(rows, request).groupBy("sheet").count().collect()
    assert {r["sheet"]: r["count"] for r in kept} == {"byname": 1, "bycontent": 8, "weak": 10}
    whole_day = filter_rows(rows, request, inclusive_day=True).filter("sheet = 'byname'")
    assert whole_day.count() == 2


def test_docx_blocks(spark, tmp_path):
    content = docx([" one ", "", "two"], [["c1", "c2"], ["", "c3"]], header="head", footer="foot")
    folder = put(tmp_path, {"d.docx": content, "bad.docx": b"x"})
    docs = read_docx(spark, folder)
    blocks = [(r.block_kind, r.text) for r in block_rows(docs).orderBy("pos").collect()]
    assert blocks == [
        ("body", "one"), ("body", "two"), ("table", "c1"), ("table", "c2"), ("table", "c3"),
        ("header", "head"), ("footer", "foot"),
    ]
    assert docs.filter("error is not null").count() == 1


def test_convert_folder(spark, tmp_path):
    files = {
        "a.txt": "plain", "b.md": "# t", "c.docx": docx(["p1", "p2"]), "d.xlsx": xlsx({"S": [["h", "i"], [1, None]]}),
        "e.log": "line", "f.docx": b"broken", "sub/g.txt": "deep",
    }
    folder = put(tmp_path, files)
    out = convert_folder(
        spark, folder, (".docx", ".md", ".txt", ".xlsx", ".log"), handlers={".log": lambda path, data: data.decode().upper()}
    )
    got = {r.key: (r.markdown, r.status) for r in out.collect()}
    assert got["a.txt.md"] == ("```text\nplain\n```", "done")
    assert got["b.md.md"] == ("# t", "done")
    assert got["c.docx.md"] == ("p1\n\np2", "done")
    assert got["d.xlsx.md"][0] == "<!-- 工作表: S -->\n\n| h | i |\n| --- | --- |\n| 1 |  |\n\n"
    assert got["e.log.md"] == ("LINE", "done")
    assert got["f.docx.md"] == (None, "failed")
    assert len(got) == 6
    deep = convert_folder(spark, folder, (".txt",), recursive=True)
    assert {r.key for r in deep.collect()} == {"a.txt.md", "sub/g.txt.md"}


def test_markdown_sink_skips_existing(spark, tmp_path):
    folder = put(tmp_path / "in", {f"{n}.md": n for n in "abcd"})
    put(tmp_path / "in", {"bad.docx": b"x"})
    out = str(tmp_path / "out")
    write_markdown(convert_folder(spark, folder, (".md",)).filter("key like 'a%'"), out)
    marked = convert_folder(spark, folder, existing=spark.read.parquet(out))
    assert run_stats(marked).first().asDict() == {"total": 5, "success": 4, "failed": 1, "skipped": 1}
    write_markdown(marked, out, append=True)
    assert sorted(r.key for r in spark.read.parquet(out).collect()) == ["a.md.md", "b.md.md", "c.md.md", "d.md.md"]
    watched, seen = observed(marked)
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["skipped"] == 1


def test_record_files(spark, tmp_path):
    folder = put(
        tmp_path,
        {"a.json": '[{"k":1},{"k":2,"z":"x"}]', "b.json": '{"k":3}', "c.json": '[{"text":"t"}]', "d.json": "[{", "e.json": '{"text":"a"},{"text":"b"},'},
    )
    assert read_record_lists(spark, folder).count() == 3
    assert read_objects(spark, folder).count() == 6
    texts = read_text_objects(spark, folder).orderBy("source_file", "pos")
    assert [r.text for r in texts.collect()] == ["t", "a", "b"]


def test_template_file(spark, tmp_path):
    assert read_template(spark, put(tmp_path / "1", {"t.json": '{"b":"","a":""}'})) == ["b", "a"]
    for n, (text, error) in enumerate([("[1]", ValueError), ("{}", ValueError), ("{", ValueError)]):
        with pytest.raises(error):
            read_template(spark, put(tmp_path / f"x{n}", {"t.json": text}))
    with pytest.raises(FileNotFoundError):
        read_template(spark, put(tmp_path / "none", {"t.txt": ""}))


def test_range_file_must_be_the_only_one(spark, tmp_path):
    good = '{"start_date":"2020-07-01","end_date":"2020-08-31"}'
    row = read_range(spark, put(tmp_path / "1", {"r.json": good})).first()
    assert (str(row.start_date), str(row.end_date)) == ("2020-07-01", "2020-08-31")
    for n, files in enumerate([{"a.json": good, "b.json": good}, {"a.txt": ""}]):
        with pytest.raises(Exception, match="exactly one"):
            read_range(spark, put(tmp_path / f"x{n}", files)).collect()
    with pytest.raises(Exception, match="end_date"):
        read_range(spark, put(tmp_path / "y", {"r.json": '{"start_date":"2020-07-01"}'})).collect()


def test_range_and_record_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "2020-07-01 2020/8/3"), ("d2", "2020-07-01")], "doc string, text string")
    write_ranges(ranges_of_documents(docs, "doc"), str(tmp_path / "r"), "doc", per_document=True)
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "r")).select("doc", "start_date", "end_date").collect()] == [
        ("d1", "2020-07-01", "2020-08-03")
    ]
    write_records(spark.createDataFrame([("a", None)], "x string, y string"), str(tmp_path / "j"), single_file=True)
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"x":"a","y":null}'


def test_folder_nodes_and_index_reuse(spark, tmp_path):
    folder = put(tmp_path / "in", {"a.txt": "red apple apple", "b.md": "green pear", "c.docx": docx(["red wine"])})
    assert read_folder(spark, folder).select(F.col("metadata")["file_name"].alias("f")).distinct().count() == 3
    path = str(tmp_path / "index")
    index, texts = open_index(spark, path, folder)
    queries = spark.createDataFrame([(1, "apple")], "query_id long, query string")
    hits = search(queries, index, texts, threshold=0.01).collect()
    assert [r.metadata["file_name"] for r in hits] == ["a.txt"]
    put(tmp_path / "in", {"d.txt": "apple"})
    again, _ = open_index(spark, path, folder)
    assert again.nodes.count() == 3


def test_skipped_files_are_not_read(spark, tmp_path):
    """Contents are read of the files still to do only; no exchange carries them; names may hold any sign."""
    folder = put(tmp_path / "in", {"a[1].txt": "one", "b {x}*.txt": "two", "c.md": "# three", "d.txt": "four"})
    done = spark.createDataFrame([("d.txt.md",), ("gone.txt.md",)], "key string")
    out = convert_folder(spark, folder, existing=done)
    got = {r.key: (r.status, r.markdown) for r in out.collect()}
    assert got == {
        "a[1].txt.md": ("done", "```text\none\n```"), "b {x}*.txt.md": ("done", "```text\ntwo\n```"),
        "c.md.md": ("done", "# three"), "d.txt.md": ("skipped", None),
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "Exchange" in line and "content" in line]
    everything = convert_folder(spark, folder, existing=out.select("key"))
    assert {r.status for r in everything.collect()} == {"skipped"}


def test_folder_search_in_all_modes(spark, tmp_path):
    """Stored vectors and postings over ids made of paths; vectors can be added later."""
    folder = put(tmp_path / "in", {"a.txt": "red apple apple", "b.md": "green pear", "c.docx": docx(["red wine"])})
    path = str(tmp_path / "index")

    def model(text):
        return F.array(*[F.length(F.regexp_replace(text, f"[^{c}]", "")) * 1.0 for c in "aegr"])

    queries = spark.createDataFrame([(1, "apple"), (2, "zzz")], "query_id long, query string")
    plain = open_folder(spark, path, folder)
    with pytest.raises(ValueError, match="needs an index with vectors"):
        search_folder(queries, plain, "vector")
    index = open_folder(spark, path, folder, model)
    with pytest.raises(ValueError, match="a model"):
        search_folder(queries, index, "hybrid")

    def found(mode, **options):
        hits = search_folder(queries, index, mode, model, **options).collect()
        return [(r.query_id, r.metadata["file_name"], r.text) for r in hits]

    assert found("bm25", threshold=0.01) == [(1, "a.txt", "red apple apple")]
    # No letter of the second query counts, so it has no vector.
    assert [f for _, f, _ in found("vector", threshold=0.1)] == ["a.txt", "b.md", "c.docx"]
    assert found("hybrid", candidates_k=1) == [(1, "a.txt", "red apple apple")]
    assert open_folder(spark, path, folder, lambda text: pytest.fail("embedded twice")).vectors.count() == 3


def test_whole_job_over_folders(spark, tmp_path):
    """Ten documents, a request and a template book, filled end to end."""
    request = put(tmp_path / "req", {"r.txt": "请汇总 2020-07-01 至 2020/8/31 的数据"})
    template = put(tmp_path / "tpl", {"t.xlsx": xlsx({"S": [["国家/地区", "大洲", "GDP", "日期"], [None, "旧", "9"], ["x"]]})})
    files = {
        f"t{i}.xlsx": xlsx({"S": [["日期", "GDP", "other"], [f"2020-07-0{i}", i, "o"], ["2021-01-01", 99, "o"]]})
        for i in range(1, 6)
    }
    files["n.xlsx"] = xlsx({"S": [["unrelated"], ["v"]]})
    files |= {f"d{i}.txt": f"**湖北省** GDP 约 {i} 万元。日期 2020-07-1{i}" for i in range(1, 4)}
    files["e.docx"] = docx(["广东省 GDP: 1,234 元"])
    files["f.md"] = "nothing here"
    filled = fill_from_folders(spark, request, put(tmp_path / "data", files), template)
    rows = {r.pos: tuple(r)[1:] for r in filled.collect()}
    assert len(rows) == 9
    assert rows[1] == (None, "旧", "1", "2020-07-01")
    assert rows[2] == ("x", None, "2", "2020-07-02")
    assert rows[6] == ("湖北省", "Asia", "10000", "2020-07-11")
    assert rows[9] == ("广东省", "Asia", "1234", "")


def test_template_sheet_keeps_gaps_and_repeats(spark, tmp_path):
    book = xlsx({"S": [["title"], [" 省份", "GDP", None, "省份"], [None, "9"], [], ["x"]]})
    header, rows = template_sheet(spark, put(tmp_path, {"t.xlsx": book}), header_row=1, start_row=2)
    assert header == ["省份", "GDP", None, "省份"]
    assert rows.columns == ["pos", "省份", "GDP", "省份.1"]
    assert {tuple(r) for r in rows.collect()} == {(1, None, "9", None), (3, "x", None, None)}


def test_slices_of_a_docx(spark, tmp_path):
    from formweave.functions.chunks import semantic_chunks
    from formweave.operators.chunking import slice_documents

    folder = put(tmp_path, {"d.docx": docx(["一二。三四。五六七八九。", "短"])})
    chunks = F.flatten(F.transform("blocks", lambda b: semantic_chunks(b["text"], 6)))
    row = slice_documents(read_docx(spark, folder), F.col("path"), chunks, 6).first()
    assert row.slice_count == 3
    assert [(s.id, s.text) for s in row.slices] == [(1, "一二。三四。"), (2, "五六七八九。"), (3, "短")]
    per = chunks_per_document(read_docx(spark, folder), chunks, ["path"])
    assert [r.id for r in per.collect()] == [1, 2, 3]


def test_table_sinks(spark, value, tmp_path):
    from formweave.operators.chunking import slice_documents

    sheet = spark.createDataFrame([(1, None, "9"), (2, "t", None)], "pos long, a string, b string")
    records = spark.createDataFrame([(1, "x", None)], "pos long, a string, b string")
    write_filled(sheet, records, ["a", "b"], str(tmp_path / "filled"))
    back = spark.read.option("header", True).csv(str(tmp_path / "filled"))
    assert {tuple(r) for r in back.collect()} == {("x", "9"), ("t", None)}

    write_filled_many(records, {"one": ["a"], "two": ["b", "a"]}, ["pos"], str(tmp_path / "many"))
    assert sorted(os.listdir(tmp_path / "many"))[-2:] == ["template=one", "template=two"]
    assert spark.read.parquet(str(tmp_path / "many")).count() == 3

    write_table(sheet, str(tmp_path / "by"), "json", by=["pos"])
    assert spark.read.json(str(tmp_path / "by")).count() == 2
    assert value(output_name(F.lit("/in/book.xlsx"), "_Extracted.xlsx")) == "book_Extracted.xlsx"

    docs = spark.createDataFrame([("/in/d.docx",)], "path string")
    write_slices(slice_documents(docs, F.col("path"), F.array(F.lit("s1"), F.lit("s2")), 10), str(tmp_path / "slices"))
    row = spark.read.json(str(tmp_path / "slices")).first()
    assert row.output == "d_Sliced.json" and [(s.id, s.text) for s in row.slices] == [(1, "s1"), (2, "s2")]


def _rezipped(content: bytes, change=lambda name, data: data, **options) -> bytes:
    """The parts of a book in an archive written by the standard library."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", **options) as new:
        for name in old.namelist():
            new.writestr(name, change(name, old.read(name)))
    return out.getvalue()


def _book_rows(content: bytes) -> list:
    book = workbook._Book(content)
    return [(name, *row) for name, part in book.sheets for row in book.rows(part)]


def test_ordinary_books_need_no_reader_of_parts(monkeypatch):
    content = xlsx(BOOK)
    expected = _book_rows(b"in front" + content)  # found by the library's reader
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda *a, **k: pytest.fail("a reader was opened"))
    assert _book_rows(content) == expected and len(expected) == 7


def test_other_archives_give_the_same_rows():
    content = xlsx(BOOK)
    for options in ({"compression": zipfile.ZIP_STORED}, {"compression": zipfile.ZIP_BZIP2}, {"compression": zipfile.ZIP_DEFLATED}):
        assert _book_rows(_rezipped(content, **options)) == _book_rows(content)
    spaced = _rezipped(content, lambda name, data: data + b" " * (workbook._SMALL_PART if "sheet" in name else 0), compression=zipfile.ZIP_DEFLATED)
    assert _book_rows(spaced) == _book_rows(content)


def test_rows_before_a_break_are_kept(spark, tmp_path):
    broken = _rezipped(xlsx({"s": [["h"], [1], [2]]}), lambda name, data: data.replace(b'<row r="3">', b'<row r="3"><') if "sheet1" in name else data)
    rows = read_workbooks(spark, put(tmp_path, {"b.xlsx": broken})).collect()
    assert sorted((r.error is None, r.cells) for r in rows) == [(False, None), (True, ["1"])]


def test_decoded_documents_leave_in_small_batches():
    files = [docx(["word " * 50] * 200 + [str(i)]) for i in range(300)] + [b"x"]
    paths = [str(i) for i in range(len(files))]
    out = list(decode_batches([pa.record_batch([pa.array(paths), pa.array(files, pa.binary())], names=["path", "content"])]))
    assert len(out) > 5 and max(b.nbytes for b in out) < 4 << 20
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["path"] for r in rows] == paths and [r["blocks"][-1]["text"] for r in rows[:-1]] == paths[:-1]
    assert rows[-1]["blocks"] is None and rows[-1]["error"].startswith("BadZipFile")


def test_a_mixed_folder_is_listed_once(spark, tmp_path, monkeypatch):
    folder = put(tmp_path, {"a.md": "one", "b/c.TXT": "two", "b/d.DOCX": docx(["three"]), "e.pdf": "no"})
    scans, scan = [], files.scan_files
    monkeypatch.setattr(files, "scan_files", lambda *a, **k: scans.append(a) or scan(*a, **k))
    nodes = read_folder(spark, folder, recursive=True)
    assert {os.path.basename(r.node_id): r.text for r in nodes.collect()} == {"a.md": "one", "c.TXT": "two", "d.DOCX": "three"}
    assert len(scans) == 1


def test_rows_of_one_id_share_a_file(spark, tmp_path, monkeypatch):
    from formweave.queries import tables

    rows = [(i % 40, f"line {i // 40}") for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "line")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    made = []
    keep = tables.kept_path
    monkeypatch.setattr(tables, "kept_path", lambda s, kind: made.append(keep(s, kind)) or made[-1])
    tables.folder_search(spark, str(tmp_path))
    parts = [f for d, _, names in os.walk(made[0]) for f in names if f.endswith(".txt")]
    tasks = {f.split("-")[1] for f in parts}
    assert len(parts) == 40 and len(tasks) > 1


def test_documents_are_written_into_few_folders(spark, tmp_path):
    """Files of many ids share folders named so that paths keep the order of the ids; no file is left half written."""
    from formweave.queries.folders import put_texts

    rows = [(i, f"text {i}") for i in range(150)] + [(7, "again"), (8, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    put_texts(docs, str(tmp_path / "out"))
    found = {os.path.relpath(os.path.join(d, f), tmp_path / "out"): open(os.path.join(d, f)).read() for d, _, names in os.walk(tmp_path / "out") for f in names}
    texts = {re.match(r"\w{1,4}/doc_id=(\w+)-\d{5}\.txt$", path)[1]: text for path, text in found.items()}
    expected = {str(i): f"text {i}\n" for i in range(150)} | {"null": "no id\n"}
    assert sorted(texts.pop("7").split("\n")) == ["", "again", "text 7"] and sorted(texts.pop("8").split("\n")) == ["", "", "text 8"]
    assert texts == {k: v for k, v in expected.items() if k not in ("7", "8")}
    assert len(os.listdir(tmp_path / "out")) <= 101
    ids = [re.search("doc_id=(\\d+)", p)[1] for p in sorted(found) if "null" not in p]
    assert ids == sorted(ids, key=lambda i: i + "/")


def test_small_files_share_tasks(spark, tmp_path):
    folder = put(tmp_path / "in", {f"{i}.txt": "some word" for i in range(200)})
    index = open_folder(spark, str(tmp_path / "index"), folder)
    assert index.texts.count() == 200
    assert len([f for f in os.listdir(tmp_path / "index" / "texts") if f.startswith("part-")]) <= 4


def test_dated_rows_are_filtered_where_they_lie(spark, tmp_path, monkeypatch):
    """The date column found while decoding is that of date_columns(); no group, join or copy is made."""
    dates = [[f"2020-07-{d:02d}", "5"] for d in range(1, 9)]
    long = [["x", "1"] for _ in range(workbook._ROWS_PER_BATCH - 50)]
    books = {
        "a": {
            "byname": [["id", "UpdateTime", "日期"], ["1", "2020-07-01", "x"], ["2", "2020-09-30", "x"], ["3", "bad", "x"]],
            "bycontent": [["w", "v"], *dates, ["x", "6"], ["y", "7"]], "weak": [["w", "v"], *dates[:7], ["x", "6"], ["y", "7"], ["z", "8"]],
            "second": [["w", "v"], ["q"], *[[str(i), "2020-07-03"] for i in range(9)]], "empty": [["date"]], "bare": [],
        },
        "b": {"long": [["w", "v"], *dates * 12, *long, *dates * 12], "gap": [["w"], *[[] for _ in range(120)], ["2020-07-04"], ["2021-01-01"]]},
    }
    files = {f"{k}.xlsx": xlsx(v, shared=False) for k, v in books.items()} | {"bad.xlsx": b"no zip"}
    swap = lambda name, data: re.sub(rb'(<row r="2">.*?</row>)(.*)(</sheetData>)', rb"\2\1\3", data) if "sheet" in name else data
    files["c.xlsx"] = _rezipped(files["b.xlsx"], swap)
    folder = put(tmp_path, files)
    plain, dated = read_workbooks(spark, folder), read_workbooks(spark, folder, dated=True)
    found = {(r.path, r.sheet): r.date_idx for r in dated.filter("cells is not null").select("path", "sheet", "date_idx").distinct().collect()}
    assert found == {(r.path, r.sheet): r.date_idx for r in date_columns(plain.filter("cells is not null")).collect()}
    request = spark.sql("select date'2020-07-01' start_date, date'2020-08-31' end_date")
    expected = filter_rows(plain, request)
    monkeypatch.setattr(workbook, "materialise", lambda *a, **k: pytest.fail("a copy was written"))
    kept = filter_rows(dated, request)
    assert kept.columns == plain.columns and sorted(map(str, kept.collect())) == sorted(map(str, expected.collect()))
    assert "Exchange" not in kept._jdf.queryExecution().sparkPlan().toString()


def test_ordinary_parts_need_no_parser(monkeypatch):
    books = [xlsx({k: BOOK[k] for k in ("first", "empty")}), xlsx({"s": [["a", 7], [True, ("date", 44013.25)]]}, date1904=True)]
    expected = [_book_rows(_rezipped(b, lambda name, data: data + b"<!-- -->")) for b in books]
    monkeypatch.setattr(workbook.ElementTree, "fromstring", lambda *a: pytest.fail("a part was parsed"))
    monkeypatch.setattr(workbook.zipfile, "ZipFile", lambda *a: pytest.fail("a reader was made"))
    assert [_book_rows(b) for b in books] == expected and len(expected[0]) == 4


def test_other_parts_read_as_the_parser_reads_them(monkeypatch):
    """Parts changed in all ways give the rows, or the failure, that the parser gives."""

    def outcome(content):
        try:
            return _book_rows(content)
        except Exception as e:  # noqa: BLE001
            return f"{type(e).__name__}: {e}"

    changes = [
        (b"<v>", b"<v>&#49;"), (b"<v>", b"<v>\x01"), (b"<v>", b"<v>]]>"), (b"<v>", b"<!-- c --><v>"), (b"<v>", b"<f>A1</f><v>"), (b"</v>", b"</w>"),
        (b"<c r=", b'<c r="A1" r='), (b"<c r=", b'<c x="1" r='), (b"<c r=", b"<x:c r="), (b"<row ", b'<row spans="1:3" '), (b"<row ", b'<row ht="3" '),
        (b"</row>", b"</row><row/>"), (b"</row>", b'<c s="1"/><c/></row>'), (b"<t>", b"<t>\r\n"), (b"<t>", b"<t> "), (b"<t>", b"<t>\xff"), (b"<t>", b"<r><t>z</t></r><t>"),
        (b"<sheets>", b"<bookViews/><sheets>"), (b' r:id="', b' q:id="'), (b' r:id="', b' id="rId1" r:id="'), (b'Target="', b'Target="/xl/'), (b"numFmtId", b"numfmtId"),
        (b'"yyyy/mm/dd"', b'"0.00"'), (b'"yyyy/mm/dd"', b"\"[d]0 'm'\""), (b'xmlns="http://', b'xmlns="https://'), (b'xmlns="http', b'xmlns:x="http'),
        (b"<worksheet", b'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\r\n<worksheet'), (b"<worksheet", b'<?xml version="1.0" encoding="latin-1"?><worksheet'),
        (b"</worksheet>", b"</worksheet>\xc2\xa0"), (b"</worksheet>", b"</worksheet> \n"), (b"</worksheet>", b""), (b"</sst>", b"</sst><sst/>"), (b"<v>", b"<v>9"), (b"<v>", b"<v> "),
    ]
    books = [xlsx(BOOK), xlsx(BOOK, shared=False, date1904=True)]
    made = [_rezipped(b, lambda name, data, old=old, new=new: data.replace(old, new)) for b in books for old, new in changes]
    found = [outcome(m) for m in made]
    monkeypatch.setattr(workbook, "_plain", lambda raw, whole: None)
    assert found == [outcome(m) for m in made]
    assert sum(isinstance(f, str) for f in found) > 10 and sum(isinstance(f, list) for f in found) > 30


def test_parts_of_written_books_are_packed_once():
    from formweave.queries import office

    office._kept_part.cache_clear()
    books = [xlsx({"s": [["key"], [i]], "notes": [["empty"]]}) for i in range(50)]
    assert [_book_rows(b)[1][2] for b in books] == [[str(i)] for i in range(50)]
    # Of six parts of a book, the sheet alone differs.
    assert office._kept_part.cache_info().misses == 5 + 50
