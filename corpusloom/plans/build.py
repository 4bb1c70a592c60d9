"""Corpus build: Markdown files to staged tables, through the gate, to snapshot tables with hashes, queue and title indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import document_type, front_matter, without_front_matter
from corpusloom.operators import catalog, chunk, load, segment, title_index
from corpusloom.operators.search import IndexScores
from corpusloom.operators.snapshots import Store
from corpusloom.sources import readers


def stage(spark: SparkSession, root: str, corpus: str, chunked: bool = False, **walk) -> tuple[DataFrame, DataFrame]:
    """(documents, articles) of the files below a folder: articles by boundaries, or chunks where ``chunked``."""
    files = readers.markdown_tree(spark, root, **walk)
    base = root.rstrip("/") + "/"
    path = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + base, "")
    meta = front_matter(F.col("text"))
    files = files.select(
        F.concat(F.lit(f"{corpus}:"), path).alias("doc_id"), F.lit(corpus).alias("corpus"), path.alias("rel_path"),
        meta.alias("meta"), without_front_matter(F.col("text")).alias("text"),
    )
    docs = catalog.path_metadata(files)
    docs = docs.withColumn("doc_title", F.coalesce(F.try_element_at("meta", F.lit("title")), "doc_title"))
    docs = docs.withColumn("doc_type", document_type(F.col("doc_title")))
    if chunked:
        parts = chunk.chunks(files)
        report = chunk.chunk_report(parts)
        titles = docs.select("doc_id", F.col("doc_title").alias("title"))
        articles = parts.filter("seq is not null").select("doc_id", "seq", F.col("body").alias("text"), "n_chars").join(titles, "doc_id")
        none = F.lit(None).cast("string")
        articles = articles.withColumns({
            "section": F.lit("본칙"), "chapter": none, "art_no": none.cast("int"), "art_sub": none.cast("int"),
        })
    else:
        articles = segment.articles(files)
        report = segment.coverage(files, articles)
    return docs.drop("text").join(report, "doc_id"), articles


def places(articles: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, before): how many articles stand before each document's in the order of keys.

    Documents' counts are written in ranges of keys; the few ranges are summed in one window, documents within their range.
    """
    counts = articles.groupBy(key).agg(F.count("*").alias("n")).repartitionByRange(key)
    counts.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(folder)
    ranged = articles.sparkSession.read.parquet(folder)
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.sum("n").alias("size"))
    starts = starts.select("part", F.coalesce(F.sum("size").over(earlier(Window.orderBy("part"))), F.lit(0)).alias("start"))
    within = F.coalesce(F.sum("n").over(earlier(Window.partitionBy("part").orderBy(key))), F.lit(0))
    return ranged.withColumn("within", within).join(starts, "part").select(key, (F.col("start") + F.col("within")).alias("before"))


ARTICLE_INDEX, DOCUMENT_INDEX = "article_titles", "document_titles"
#: the columns that each index looks into
ARTICLE_TEXTS, DOCUMENT_TEXTS = ["title"], ["doc_title", "alias"]


def _named(docs: DataFrame) -> DataFrame:
    """Documents with an alias column."""
    return docs if "alias" in docs.columns else docs.withColumn("alias", F.lit(None).cast("string"))


def _numbered(articles: DataFrame, folder: str, after: int = 0) -> DataFrame:
    """Articles with ids in the order of (doc_id, seq), their text as ``body``, and the corpus they are stored by."""
    rows = articles.join(places(articles, folder), "doc_id").withColumn("id", F.col("before") + F.col("seq") + after).drop("before")
    return rows.withColumnRenamed("text", "body").withColumn("corpus_part", F.substring_index("doc_id", ":", 1))


def database(spark: SparkSession, root: str) -> Store:
    """The snapshot tables that ``store`` and ``refresh`` write."""
    return Store(spark, f"{root.rstrip('/')}/store")


def tables(db: Store) -> dict[str, DataFrame]:
    """The stored tables of the latest version, without the indexes."""
    state = db.state()
    names = ("documents", "articles", "institutions", "article_hash", "embed_queue")
    return {name: db.rows(state.tables[name]).drop("corpus_part") for name in names}


def store(docs: DataFrame, articles: DataFrame, root: str) -> dict[str, DataFrame]:
    """Check the gate (an action), then write and return documents, articles, institutions, hashes and queue.

    Article ids follow the order of (doc_id, seq), so building again gives the same ones. All tables and the trigram indexes
    over titles become visible at once, as one version of the snapshot tables in ``database``.
    """
    load.require(load.gate(docs, articles))
    db = database(docs.sparkSession, root)
    base, docs = db.state(), _named(docs)
    made = {"documents": db.write(docs, "corpus"), "articles": db.write(_numbered(articles, f"{root}/article_places"), "corpus_part")}
    docs, rows = (db.rows(made[n]) for n in ("documents", "articles"))
    made["article_hash"] = db.write(load.hashes(rows))
    made["embed_queue"] = db.write(load.queue(db.rows(made["article_hash"])))
    made["institutions"] = db.write(load.institutions(docs))
    made |= title_index.built(db, ARTICLE_INDEX, rows, ARTICLE_TEXTS)
    made |= title_index.built(db, DOCUMENT_INDEX, docs, DOCUMENT_TEXTS, "doc_id")
    db.commit(base, made)
    return tables(db)


def refresh(docs: DataFrame, articles: DataFrame, root: str) -> dict[str, DataFrame]:
    """Delta load: the given documents and their articles replace what is stored of them; indexes get a generation more.

    Articles get ids after the stored ones. Only the corpora of the delta are rewritten, besides the narrow tables of hashes.
    """
    load.require(load.gate(docs, articles))
    db = database(docs.sparkSession, root)
    base = db.state()
    was = base.tables
    last = db.rows(was["articles"]).agg(F.max("id")).first()[0] or 0
    new = db.write(_numbered(articles, f"{root}/article_places", last))
    delta, docs = db.rows(new), db.rows(db.write(_named(docs).select(*was["documents"].struct.names)))
    ids = docs.select("doc_id")
    gone = db.rows(was["articles"]).join(ids.distinct(), "doc_id", "left_semi").select("id")
    made = {
        "documents": db.replaced(was["documents"], docs, "doc_id"), "articles": db.replaced(was["articles"], delta, "doc_id", ids),
        "article_hash": db.replaced(was["article_hash"], load.hashes(delta), "id", gone),
    }
    made["embed_queue"] = db.write(load.queue(db.rows(made["article_hash"])))
    made["institutions"] = db.write(load.institutions(db.rows(made["documents"])))
    made |= title_index.updated(db, base, ARTICLE_INDEX, delta, gone, ARTICLE_TEXTS)
    made |= title_index.updated(db, base, DOCUMENT_INDEX, docs, ids, DOCUMENT_TEXTS, "doc_id")
    db.commit(base, made)
    return tables(db)


def index_scores(db: Store, keyword: str) -> IndexScores:
    """What the stored indexes say of a keyword, cut to the 40 characters that a search looks for."""
    state, word = db.state(), keyword[:40]
    return IndexScores(*(title_index.search(db, name, word, state=state) for name in (ARTICLE_INDEX, DOCUMENT_INDEX)))
