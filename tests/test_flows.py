"""Sources, writers, streaming and stateful flows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import load, queueing, ranking, sync
from corpusloom.sources import readers, writers
from corpusloom.streaming import deltas


def test_json_lines_with_errors(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "t": "x"}\n\nnot json\n{"id": 2}\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    rows, bad = readers.json_lines_with_errors(spark, str(tmp_path), schema)
    assert sorted(r.id for r in rows.collect()) == [1, 2] and [r.value for r in bad.collect()] == ["not json"]


def test_markdown_tree_and_manifest(spark, tmp_path):
    for name in ("x/a.md", "x/index.md", "y/b.md", "y/c.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    files = readers.markdown_tree(spark, str(tmp_path), skip=["index.md"])
    assert sorted(r.text for r in files.collect()) == ["x/a.md", "y/b.md"]
    assert [r.text for r in readers.markdown_tree(spark, str(tmp_path), under=["/y/"]).collect()] == ["y/b.md"]
    root = files.filter("text = 'x/a.md'").first().path.rsplit("/x/", 1)[0]
    good = spark.createDataFrame([(f"{root}/x/a.md",)], "path string")
    assert readers.manifest_files(files, good, root).count() == 1
    with pytest.raises(Exception, match="listed twice"):
        readers.manifest_files(files, good.unionAll(good), root).collect()
    with pytest.raises(Exception, match="no such file"):
        readers.manifest_files(files, spark.createDataFrame([(f"{root}/z.md",)], "path string"), root).collect()


def test_archive_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("가.txt", "one")
        z.writestr("dir/", "")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert [(r.member, bytes(r.content)) for r in readers.archive_members(files).collect()] == [("가.txt", b"one")]


def test_members_of_one_archive_go_to_many_tasks(spark, tmp_path):
    import zipfile

    from corpusloom.sources import archives

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k in range(40):
            z.writestr(f"가/{k}.txt", f"text {k} " * 100)
        z.writestr("empty/", "")
        z.writestr("none.txt", "")
    with zipfile.ZipFile(tmp_path / "b.zip", "w"):
        pass
    raw = zipfile.ZipInfo("x.txt")
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr(raw, "old")
    content = (tmp_path / "c.zip").read_bytes().replace(b"x.txt", "가.t".encode("cp949") + b"x")
    (tmp_path / "c.zip").write_bytes(content)
    files = archives.listed(spark, str(tmp_path))
    assert files.count() == 3
    rows = archives.split_members(files, run=2000, tasks=6).withColumn("task", F.spark_partition_id()).collect()
    got = {r.member: bytes(r.content) for r in rows}
    assert got == {f"가/{k}.txt": b"text %d " % k * 100 for k in range(40)} | {"none.txt": b"", "가.tx": b"old"}
    assert len({r.task for r in rows if r.path.endswith("a.zip")}) > 2
    assert list(archives.runs_of([5, 5, 1, 9, 0], 10)) == [(0, 2, 10), (2, 4, 10), (4, 5, 0)] and not list(archives.runs_of([], 3))


def test_workbook_cells(spark, tmp_path):
    import io

    from corpusloom.sources import archives, workbooks

    book = {"가 & <b>": [["t", None, "x & y"], [], [None, " 한글 "]], "two": [["t"]], "none": []}
    (tmp_path / "a.xlsx").write_bytes(workbooks.workbook(book))
    rows = workbooks.cells(archives.listed(spark, str(tmp_path), "*.xlsx"), tasks=5).withColumn("task", F.spark_partition_id()).collect()
    got = sorted((r.sheet, r.row, r.column, r.value) for r in rows)
    assert got == sorted([("가 & <b>", 1, 1, "t"), ("가 & <b>", 1, 3, "x & y"), ("가 & <b>", 3, 2, " 한글 "), ("two", 1, 1, "t")])
    sheet = f"""<worksheet xmlns="{workbooks.MAIN[1:-1]}"><sheetData><row><c><v>1.50</v></c><c t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c></row>
    <row r="7"><c r="AB7" t="b"><v>1</v></c><c t="str"><f>x</f><v>y</v></c><c r="AD7"/></row><row><c t="s"><v>1</v></c></row></sheetData></worksheet>"""
    found = list(workbooks.cells_of(io.BytesIO(sheet.encode()), ["zero", "one"]))
    assert found == [(1, 1, "1.50"), (1, 2, "ab"), (7, 28, "1"), (7, 29, "y"), (8, 1, "one")]
    assert [workbooks.column_number(workbooks.column_letters(n)) for n in (1, 26, 27, 702, 703)] == [1, 26, 27, 702, 703]


def test_paged_source(spark):
    def fetch(page):
        yield from ((page * 10 + i % 2, f"r{page}") for i in range(3))

    rows = readers.paged_source(spark, fetch, "id int, name string", 2, ["id"])
    assert sorted(r.id for r in rows.collect()) == [10, 11, 20, 21]


def test_csv_and_documents(spark, tmp_path):
    rows = spark.createDataFrame([('a"b', None)], "x string, y string")
    assert writers.csv_lines(rows).first()[0] == '"a""b",""'
    writers.write_csv(rows, str(tmp_path / "c"))
    parts = [p.read_text() for p in (tmp_path / "c").glob("part-*") if p.stat().st_size]
    assert parts == ['\ufeff"x","y"\n"a""b",""\n']
    document = rows.select(writers.markdown_document(F.col("x"), F.lit("body"), source=F.col("y"))).first()[0]
    assert document == "---\ntitle: 'a\"b'\n---\n\nbody\n"


def test_deltas_replace_documents(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "body", "corpus")])
    table, source = str(tmp_path / "table"), str(tmp_path / "in")

    def add(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        query = deltas.apply_deltas(spark, source, schema, table, str(tmp_path / "ckpt"))
        query.awaitTermination(120)
        assert query.exception() is None

    add([("ca:1", "old", "ca"), ("ca:2", "old", "ca"), ("legal:1", "old", "legal")])
    add([("ca:1", "new", "ca"), ("ca:3", "new", "ca")])
    got = {(r.doc_id, r.body) for r in spark.read.parquet(table).collect()}
    assert got == {("ca:1", "new"), ("ca:2", "old"), ("ca:3", "new"), ("legal:1", "old")}
    add([("legal:1", "moved", "bylaws"), ("ca:2", "moved", "bylaws")])  # one leaves its partition empty
    got = [(r.doc_id, r.body, r.corpus) for r in spark.read.parquet(table).collect()]
    assert sorted(got) == [("ca:1", "new", "ca"), ("ca:2", "moved", "bylaws"), ("ca:3", "new", "ca"), ("legal:1", "moved", "bylaws")]


def test_delta_of_another_corpus_fails(spark):
    old = spark.createDataFrame([("ca:1", "x")], "doc_id string, body string")
    with pytest.raises(Exception, match="not in the corpus"):
        load.replace_documents(old, old, spark.createDataFrame([("legal:1",)], "doc_id string"), "ca").collect()


def test_gate_raises(spark):
    docs = spark.createDataFrame([("d", 1)], "doc_id string, n_articles int")
    articles = spark.createDataFrame([("d", 1, "t", "a\tb"), ("e", 1, "t", "x\0")], "doc_id string, seq int, title string, text string")
    row = load.gate(docs, articles).first()
    assert (row.nul, row.control, row.orphans, row.passed) == (1, 0, 1, False)
    with pytest.raises(ValueError, match="gate failed"):
        load.require(load.gate(docs, articles))
    load.require(load.gate(docs, articles.filter("doc_id = 'd'")))


def test_wildcard_target_takes_all(spark):
    columns = "inst_code string, report_no string, disclosure_no string"
    rows = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", "2", "z")], columns)
    targets = spark.createDataFrame([("a", "1", "x"), ("a", "1", None), ("a", "2", "q")], columns)
    assert sorted(r.disclosure_no for r in sync.by_targets(rows, targets).collect()) == ["x", "y"]


def test_fusion_adds_within_an_arm(spark):
    columns = "id long, rel_path string, doc_title string, art_ref string, art_title string, score double"
    arm = spark.createDataFrame([(1, "p", "t", "", "t", 0.9), (2, "p", "t", "", "t", 0.8), (3, "q", "t", "", "t", 0.7)], columns)
    order = [F.desc("score"), F.col("id")]
    found = ranking.reciprocal_rank_fusion([arm], [order], 5).collect()
    assert [(r.id, r.rrf) for r in found] == [(1, round(1 / 61 + 1 / 62, 4)), (3, round(1 / 63, 4))]


def test_worklist_order(spark):
    rows = spark.createDataFrame(
        [("a", "CANONICAL", 1.0), ("b", "CANONICAL", 2.0), ("c", "DEDUP", 9.0), ("d", "CDEDUP", 5.0), ("e", "CANONICAL", 0.5)],
        "id string, class string, score double",
    )
    first = spark.createDataFrame([("e",)], "id string")
    assert [r.id for r in queueing.worklist(rows, first).collect()] == ["c", "e", "b", "a", "d"]


def test_windowed_counts_stream(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:30", "a")], "ts string, kind string")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    query = deltas.counts_by_window(stream, "ts", "1 minute", ["kind"]).writeStream.format("memory").queryName("counted")
    query = query.outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [r.n for r in spark.table("counted").collect()] == [2]




def test_sheet_headers_are_not_broadcast(spark, sf_dir):
    from corpusloom.plans.queries_flow import sheet_records

    found = sheet_records(spark, sf_dir)
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_sheet_headers_with_gaps_and_repeated_columns(spark):
    cells = [(0, 2, "x"), (1, 1, "M"), (1, 3, "n"), (1, 3, "again"), (2, 1, "a"), (2, 3, "b"), (2, 2, "no name"), (3, 3, "no key"), (3, 1, "")]
    for sheet, rows in (("gaps", cells), ("dense", [c for c in cells if c[2] != "again" and c[1] != 3])):
        frame = spark.createDataFrame([("f", sheet, *c) for c in rows], "file string, sheet string, row int, column int, value string")
        got = sorted((r.row, r.column, r.value, r.name) for r in readers.sheet_records(frame, "M").collect())
        assert got == ([(2, 1, "a", "M"), (2, 3, "b", "again"), (2, 3, "b", "n")] if sheet == "gaps" else [(2, 1, "a", "M")])


def test_runs_carry_their_entries_of_the_directory(spark, tmp_path):
    import zipfile

    from corpusloom.sources import archives

    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        for k, method in enumerate((zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)):
            z.writestr(f"{k}.txt", f"text {k} " * 300, method)
        z.writestr("d/", "")
    files = archives.listed(spark, str(tmp_path))
    runs = archives.archive_runs(files, run=2000).collect()
    assert [[e.name for e in r.entries] for r in sorted(runs, key=lambda r: r.first)] == [["0.txt"], ["1.txt"], ["2.txt"], ["3.txt"], []]
    got = {r.member: bytes(r.content).decode() for r in archives.split_members(files, run=2000, tasks=3).collect()}
    assert got == {f"{k}.txt": f"text {k} " * 300 for k in range(4)}
    system, name = archives.opened(runs[0].path)
    with system.open_input_file(name) as source:
        whole = next(e.asDict() for r in runs for e in r.entries if e.name == "1.txt")
        assert archives.content_of(source, runs[0].path, whole) == b"text 1 " * 300
        with pytest.raises(zipfile.BadZipFile, match="damaged"):
            archives.content_of(source, runs[0].path, whole | {"crc": 1})


def test_sheets_are_read_in_runs_as_large_as_their_strings(spark, tmp_path):
    from corpusloom.sources import archives, workbooks

    book = {f"s{k}": [["M", "n"], *([f"{k} {i}", f"{k} {i}"] for i in range(30))] for k in range(12)}
    (tmp_path / "a.xlsx").write_bytes(workbooks.workbook(book))
    listed = archives.listed(spark, str(tmp_path), "*.xlsx")
    runs = [r.run for r in workbooks.sheets(listed).orderBy("place").collect()]
    assert runs == sorted(runs) and len(set(runs)) == 2  # a run for each sheet before
    found = readers.sheet_records(workbooks.cells(listed, tasks=3), "M").collect()
    assert sorted((r.sheet, r.row, r.name, r.value) for r in found) == sorted(
        (s, i, n, v) for s, rows in book.items() for i, row in enumerate(rows[1:], 2) for n, v in zip("Mn", row, strict=True)
    )
