"""From files to search results."""

from pyspark.sql import functions as F

from corpusloom.operators import load, search
from corpusloom.plans import build, service

REGULATION = "---\ntitle: '인사규정'\n---\n제1장 총칙\n제1조(목적) 이 규정은 연차휴가의 기준을 정한다.\n제2조(연차휴가) 열다섯 날로 한다.\n"


def test_build_and_search(spark, tmp_path):
    for code, name in (("C1", "가원"), ("C2", "나원")):
        folder = tmp_path / "md" / f"[부처]{name}_{code}"
        folder.mkdir(parents=True)
        (folder / "인사규정_20240101.md").write_text(REGULATION)
    docs, articles = build.stage(spark, str(tmp_path / "md"), "bylaws")
    assert sorted(r.inst_code for r in docs.collect()) == ["C1", "C2"]
    tables = build.store(docs, articles, str(tmp_path / "db"))
    assert [r.id for r in tables["articles"].orderBy("id").collect()] == [1, 2, 3, 4]
    assert tables["embed_queue"].count() == 2 and tables["institutions"].count() == 2
    stored = service.Tables(
        tables["articles"], tables["documents"].withColumns({"alias": F.lit(None).cast("string"),
                                                             "usecases": F.lit(None).cast("array<string>")}).drop("inst_name", "ministry"),
        tables["institutions"], tables["article_hash"], tables["embed_queue"],
        load.embed(tables["embed_queue"].join(tables["articles"].select("id", "body"), "id"),
                   lambda texts: [[float(len(t)), 1.0] for t in texts], "length", "body"),
    )
    found = service.run(stored, search.http_spec(keyword="연차휴가")).collect()
    assert [(r.id, r.score) for r in found] == [(2, 1.0), (4, 1.0)]
    assert [r.id for r in service.run(stored, search.http_spec(keyword="연차휴가", group=True)).collect()] == [2, 4]
    assert {r.art_no for r in service.run(stored, search.http_spec(keyword="제1조"), "hybrid").collect()} == {1}
    near = service.run(stored, search.tool_spec(keyword="길이"), "semantic", lambda _: [13.0, 1.0]).collect()
    assert {r.id for r in near} == {1, 2}
    both = service.run(stored, search.http_spec(keyword="연차휴가"), "hybrid", lambda _: [13.0, 1.0]).collect()
    assert both[0].id == 2 and both[0].rrf > both[-1].rrf


def test_chunked_build(spark, tmp_path):
    (tmp_path / "a.md").write_text("word " * 900)
    (tmp_path / "b.md").write_text("\n")
    docs, articles = build.stage(spark, str(tmp_path), "disclosure", chunked=True)
    assert {r.rel_path: r.parse_status for r in docs.collect()} == {"a.md": "chunked", "b.md": "empty"}
    load.require(load.gate(docs, articles))


def test_stored_index_answers_and_follows_deltas(spark, tmp_path, monkeypatch):
    """Searches from the stored index give what scoring every title gives, before and after a delta; no title is scanned."""
    for code, name in (("C1", "가원"), ("C2", "나원"), ("C3", "다원")):
        folder = tmp_path / "md" / f"[부처]{name}_{code}"
        folder.mkdir(parents=True)
        (folder / "인사규정_20240101.md").write_text(REGULATION)
    root = str(tmp_path / "db")
    build.store(*build.stage(spark, str(tmp_path / "md"), "bylaws"), root)

    def compare():
        db = build.database(spark, root)
        now = build.tables(db)
        documents = now["documents"].withColumn("usecases", F.lit(None).cast("array<string>")).drop("inst_name", "ministry")
        found = []
        for keyword in ("연차휴가", "인사규정", "목적", "보수"):
            for store in (None, db):
                stored = service.Tables(now["articles"], documents, now["institutions"], store=store)
                got = service.run(stored, search.http_spec(keyword=keyword))
                found.append(sorted((r.doc_id, r.art_ref, r.score) for r in got.collect()))
            assert found[-2] == found[-1], keyword
        return found[1::2], now

    before, tables = compare()
    assert [len(f) for f in before] == [3, 3, 3, 0] and tables["articles"].count() == 6
    path = tmp_path / "md" / "[부처]나원_C2" / "인사규정_20240101.md"
    path.write_text(REGULATION.replace("연차휴가", "보수").replace("인사규정", "보수규정") + "제3조(연차휴가) 더한다.\n")
    docs, articles = build.stage(spark, str(tmp_path / "md"), "bylaws")
    changed = F.col("doc_id").contains("C2")
    build.refresh(docs.filter(changed), articles.filter(changed), root)
    after, tables = compare()
    assert [len(f) for f in after] == [3, 2, 3, 2] and tables["articles"].count() == 7
    ids = [r.id for r in tables["articles"].collect()]
    assert len(set(ids)) == 7 and sorted(r.id for r in tables["article_hash"].collect()) == sorted(ids)
    assert build.database(spark, root).versions() == [1, 2]


def test_a_killed_table_writer_loses_nothing(spark, tmp_path):
    rows = spark.range(3).withColumnRenamed("id", "x")
    load.write_tables({"t": rows}, str(tmp_path))
    (tmp_path / "t").rename(tmp_path / "_t.old")  # as if killed between the two moves
    load.recover(spark, str(tmp_path), "t")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    load.write_tables({"t": rows.limit(1)}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1 and [p.name for p in tmp_path.iterdir()] == ["t"]
