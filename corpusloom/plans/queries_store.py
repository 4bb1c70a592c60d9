"""Queries over snapshot tables and stored indexes, each with what a plain scan of the tables gives as its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators import ledger, search, title_index, vector_index
from corpusloom.operators.snapshots import Store
from corpusloom.plans import views
from corpusloom.plans.queries_flow import _folder
from corpusloom.plans.queries_search import (
    _COLUMNS,
    _NEAR,
    _NEAR_COLUMNS,
    _ORDER,
    _Q,
    KEYWORD,
    RESULT,
    _hits_sql,
    _rows,
    _semantic_tables,
    _vector,
)
from corpusloom.plans.registry import Registry
from corpusloom.sources import archives, readers, workbooks, writers

REGISTRY = Registry()


def _store(spark: SparkSession) -> Store:
    return Store(spark, _folder(spark))


@REGISTRY(f"WITH {_hits_sql()} SELECT {_COLUMNS} FROM hits ORDER BY {_ORDER} LIMIT 20")
def kw_indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword search of ``kw_title_search``, answered from stored postings of all titles."""
    db, articles, documents = _store(spark), views.articles(spark, sf_dir), views.documents(spark, sf_dir)
    made = title_index.built(db, "a", articles, ["title"])
    db.commit(db.state(), made | title_index.built(db, "d", documents, ["doc_title", "alias"], "doc_id"))
    # scores, and the rows that they name, are stored: both are read several times
    indexed = search.IndexScores(*(db.rows(db.write(title_index.search(db, name, KEYWORD))) for name in "ad"))
    named = search.joined(search.named_articles(articles, indexed), documents, views.institutions(spark, sf_dir))
    rows = db.rows(db.write(named.drop("body")))
    return search.keyword_search(rows, search.cli_spec(keyword=KEYWORD, limit=20), documents, indexed).select(RESULT)


_BLUE = "small blue ring"


@REGISTRY(f"""WITH now AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '{_BLUE} ' || p_partkey WHEN 2 THEN p_brand ELSE p_name END AS name
FROM part WHERE p_partkey % 5 <> 1) SELECT * FROM (SELECT p_partkey AS id, round({views.similarity_sql("name", f"'{_BLUE}'")}, 6) AS similarity
FROM now) WHERE similarity >= 0.3""")
def index_after_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title index after three deltas: every fifth part gets another name, the next ones go, the next get their brand's."""
    db, parts = _store(spark), views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", F.col("p_name").alias("name"))
    db.commit(db.state(), title_index.built(db, "p", parts, ["name"]))
    named = F.concat(F.lit(f"{_BLUE} "), F.col("id").cast("string"))
    for rest, name in ((0, named), (1, None), (2, F.col("p_brand"))):
        own = parts.filter(F.col("id") % 5 == rest)
        delta = own.limit(0) if name is None else own.withColumn("name", name)
        state = db.state()
        db.commit(state, title_index.updated(db, state, "p", delta, own.select("id"), ["name"]))
    return title_index.search(db, "p", _BLUE).withColumn("similarity", F.round("similarity", 6))


@REGISTRY("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'moved' ELSE p_brand END AS p_brand, CASE WHEN p_partkey % 7 = 0 THEN NULL
ELSE p_size END AS p_size FROM part WHERE p_partkey % 11 <> 1 OR p_partkey % 7 = 0""")
def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned snapshot table: some keys move to another partition, some go, all else stays where it is."""
    db, rows = _store(spark), views.read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    base = db.overwrite({"t": rows}, {"t": "p_brand"})
    moved = rows.filter("p_partkey % 7 = 0").withColumns({"p_brand": F.lit("moved"), "p_size": F.lit(None).cast("int")})
    moved = moved.select(*(F.col(f.name).cast(f.dataType) for f in rows.schema))
    gone = rows.filter("p_partkey % 11 = 1")
    db.commit(base, {"t": db.replaced(base.tables["t"], moved, "p_partkey", gone)})
    return db.read("t")


@REGISTRY("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def snapshot_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of a table that has been written anew and replaced since."""
    db, rows = _store(spark), views.read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    first = db.overwrite({"t": rows}, {"t": "p_brand"})
    later = db.overwrite({"t": rows.filter("p_partkey % 2 = 0")})
    db.commit(later, {"t": db.replaced(later.tables["t"], rows.filter("p_partkey % 3 = 0"), "p_partkey")})
    return db.read("t", first.version).groupBy("p_brand").agg(F.count("*").alias("n"))


def _cells(spark: SparkSession, sf_dir: str) -> Store:
    db = _store(spark)
    db.commit(db.state(), vector_index.built(db, "v", views.read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id"))
    return db


_SCORED = f"scored AS (SELECT vec_id, {views.cosine_sql('embedding', 'qe')} AS c FROM embeddings CROSS JOIN (SELECT embedding AS qe FROM embeddings WHERE vec_id = 7))"


@REGISTRY(f"WITH {_SCORED} SELECT vec_id, round(c, 3) AS score FROM scored WHERE vec_id % 200 = 3 ORDER BY c DESC, vec_id")
def cells_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours among the few vectors that pass a filter: probing goes on until all that pass are found."""
    allowed = views.read(spark, sf_dir, "embeddings").filter("vec_id % 200 = 3").select("vec_id")
    found = vector_index.search(_cells(spark, sf_dir), "v", _vector(spark, sf_dir, 7), 1_000_000, "vec_id", probes=1, allowed=allowed)
    return found.select("vec_id", F.round("cosine", 3).alias("score"))


@REGISTRY(f"WITH {_SCORED} SELECT vec_id, round(c, 3) AS score FROM scored ORDER BY c DESC, vec_id LIMIT 15")
def cells_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact mode of the vector index."""
    found = vector_index.search(_cells(spark, sf_dir), "v", _vector(spark, sf_dir, 7), 15, "vec_id", exact=True)
    return found.select("vec_id", F.round("cosine", 3).alias("score"))


@REGISTRY()
def cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the ten nearest the probed cells hold: the vectors whose id leaves 50 by 100 as queries, after the number of
    probes was tuned on those whose id is divisible by 100. No SQL fits cells; tests hold the recall to 0.9."""
    db, rows = _cells(spark, sf_dir), views.read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    state = vector_index.tuned(db, "v", rows.filter("vec_id % 100 = 0"), "vec_id")
    ranks = vector_index.cell_ranks(db, state, "v", rows.filter("vec_id % 100 = 50"), "vec_id", 10)
    found = F.count(F.when(F.col("rank") <= state.marks["v:probes"], 1))
    return ranks.groupBy(F.col("asked").alias("vec_id")).agg(F.count("*").alias("asked"), found.alias("found"))


@REGISTRY(f"""WITH {views.SQL}, {_Q}, {_NEAR} SELECT {_NEAR_COLUMNS} FROM (SELECT *, round(c, 3) AS score FROM near
WHERE corpus = 'legal' AND inst_name ILIKE '%src3%') ORDER BY c DESC, id LIMIT 25""")
def semantic_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered semantic search whose first stage counts the ids that pass and narrows the second to them."""
    links, vectors = _semantic_tables(spark, sf_dir)
    spec = search.http_spec(corpus="legal", inst="src3", limit=25)
    rows = search.narrowed(_rows(spark, sf_dir), spec)
    return search.nearest(rows, vectors, links, _vector(spark, sf_dir, 7), spec).select(_NEAR_COLUMNS.split(", "))


@REGISTRY("SELECT '문서/' || doc_id || '.txt' AS member, octet_length(encode(coalesce(text, '')))::BIGINT AS size, md5(coalesce(text, '')) AS md5 FROM documents")
def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written into a few archives, whose members many tasks read back."""
    folder = f"{_folder(spark)}/zip"
    name = F.concat(F.lit("문서/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = views.read(spark, sf_dir, "documents").select(name.alias("name"), F.col("text").alias("content"))
    archives.write_archives(rows, folder).collect()  # a row an archive
    return archives.split_members(archives.listed(spark, folder), run=1 << 18).select("member", "size", F.md5("content").alias("md5"))


_ROWS_A_BOOK = 20_000


@REGISTRY("""SELECT p_brand AS sheet, p_partkey::VARCHAR AS part, unnest(['기관명', 'size', 'name']) AS name,
unnest([p_partkey::VARCHAR, p_size::VARCHAR, p_name]) AS value FROM part""")
def workbook_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts written into workbooks with a sheet for each brand, read back as records below the header."""
    folder = f"{_folder(spark)}/books"
    head = [["unit: piece"], ["기관명", "size", "name"]]
    parts = views.read(spark, sf_dir, "part")
    books = max(1, -(-parts.count() // _ROWS_A_BOOK))  # a workbook is held whole, so each gets so many rows, about
    workbooks.write_workbooks(parts.repartition(books, "p_partkey"), folder, "p_brand", ["p_partkey", "p_size", "p_name"], head).collect()  # a row a workbook
    cells = workbooks.cells(archives.listed(spark, folder, "*.xlsx"))
    found = readers.sheet_records(cells, "기관명")
    part = F.max(F.when(F.col("name") == "기관명", F.col("value"))).over(Window.partitionBy("file", "sheet", "row"))
    return found.select("sheet", part.alias("part"), "name", "value")


@REGISTRY("""SELECT CASE WHEN doc_id % 2 = 0 THEN 'done' WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'queued' END AS state, doc_id::VARCHAR AS key
FROM documents""")
def progress_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last states of documents that were queued, some of them then failed, and some are done."""
    db, key = _store(spark), F.col("doc_id")
    docs = views.read(spark, sf_dir, "documents").select("doc_id")
    for state, chosen in (("queued", F.lit(True)), ("failed", key % 3 == 0), ("done", key % 2 == 0)):
        ledger.record(db, "work", docs.filter(chosen).select(key.alias("key"), F.lit(state).alias("state")))
    return ledger.current(db, "work")


@REGISTRY("""SELECT CASE WHEN doc_id % 3 = 1 THEN NULL ELSE doc_id END AS id, CASE WHEN doc_id % 3 = 0 THEN source END AS name,
CASE WHEN doc_id % 3 = 1 THEN '{"id": ' || doc_id || ', broken' END AS bad FROM documents""")
def json_lines_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a field missing in every third and every third broken: rows, and the broken lines' text."""
    folder, key = f"{_folder(spark)}/lines", F.col("doc_id")
    rows = views.read(spark, sf_dir, "documents")
    whole = F.when(key % 3 == 0, F.to_json(F.struct(key.alias("id"), F.col("source").alias("name")))).otherwise(F.to_json(F.struct(key.alias("id"))))
    broken = F.concat(F.lit('{"id": '), key.cast("string"), F.lit(", broken"))
    rows.select(F.when(key % 3 == 1, broken).otherwise(whole).alias("value")).write.text(folder)
    good, bad = readers.json_lines_with_errors(spark, folder, T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))
    return good.withColumn("bad", F.lit(None).cast("string")).unionByName(bad.select(F.col("value").alias("bad")), allowMissingColumns=True)


@REGISTRY("""SELECT p_partkey::VARCHAR AS part, '"' || p_name || '", ' || p_type AS name, CASE WHEN p_size % 2 = 0 THEN p_brand END AS brand FROM part""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with quotes, commas and nulls as quoted CSV, a header in each part file, read back; null is an empty field."""
    folder = f"{_folder(spark)}/csv"
    rows = views.read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("part"), F.concat(F.lit('"'), "p_name", F.lit('", '), "p_type").alias("name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand"),
    )
    writers.write_csv(rows, folder)
    return spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(folder)


@REGISTRY("""SELECT substr(p_brand, 7) AS brand, count(*) AS n, sum(length(p_name))::BIGINT AS chars FROM part WHERE p_brand LIKE 'Brand#1%'
OR p_brand LIKE 'Brand#3%' GROUP BY 1""")
def tree_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of text files, a folder for each brand, of which those of two kinds are read whole."""
    folder = f"{_folder(spark)}/tree"
    rows = views.read(spark, sf_dir, "part").select(F.substring("p_brand", 7, 9).alias("brand"), F.col("p_name").alias("value"))
    rows.repartition("brand").write.partitionBy("brand").text(folder)
    files = readers.markdown_tree(spark, folder, "*.txt", under=["/brand=1", "/brand=3"])
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    found = files.select(F.regexp_extract("path", "brand=([0-9]+)/", 1).alias("brand"), F.explode(lines).alias("line"))
    return found.groupBy("brand").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))
