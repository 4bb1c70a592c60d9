"""Queries of the retrieval operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.similarity import cosine, trigram_similarity
from corpusloom.operators import ranking, search
from corpusloom.plans import views
from corpusloom.plans.registry import Registry

REGISTRY = Registry()
KEYWORD = "the thing of that onat"
RESULT = ["id", "doc_id", "inst_name", "ministry", "doc_title", "corpus", "rel_path", "art_ref", "title", "score"]
_COLUMNS = ", ".join(RESULT)
_ORDER = "score DESC, CASE corpus WHEN 'legal' THEN 0 WHEN 'ca' THEN 1 ELSE 2 END, inst_name NULLS LAST, id"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views.articles(spark, sf_dir), views.documents(spark, sf_dir), views.institutions(spark, sf_dir)
    return search.joined(*tables)


def _hits_sql(where: str = "TRUE", keyword: str = KEYWORD) -> str:
    title = views.similarity_sql("title", f"'{keyword}'")
    doc = views.similarity_sql("doc_title", f"'{keyword}'")
    return f"""{views.SQL}, hits AS (
  SELECT *, round(s, 3) AS score FROM (SELECT *, {title} AS s FROM a_rows WHERE {where}) WHERE s >= 0.3
  UNION ALL
  SELECT * EXCLUDE (n) FROM (
    SELECT *, round(s, 3) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY art_no NULLS LAST, id) AS n
    FROM (SELECT *, {doc} AS s FROM a_rows WHERE {where}) WHERE s >= 0.3) WHERE n = 1
)"""


@REGISTRY(f"WITH {_hits_sql()} SELECT {_COLUMNS} FROM hits ORDER BY {_ORDER} LIMIT 20")
def kw_title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.keyword_search(_rows(spark, sf_dir), search.cli_spec(keyword=KEYWORD, limit=20), views.documents(spark, sf_dir)).select(RESULT)


_FILTER = (
    "corpus = 'legal' AND doc_type ILIKE '%e%' AND inst_name ILIKE '%src1%' AND ministry ILIKE '%e%' "
    "AND list_has_any(usecases, ['audit', 'recruit'])"
)


@REGISTRY(f"WITH {_hits_sql(_FILTER)} SELECT {_COLUMNS} FROM hits ORDER BY {_ORDER} LIMIT 20")
def kw_title_search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = search.cli_spec(keyword=KEYWORD, corpus="legal", type="e", inst="src1", ministry="e",
                           usecases=("audit", "recruit"), limit=20)
    return search.keyword_search(_rows(spark, sf_dir), spec, views.documents(spark, sf_dir)).select(RESULT)


@REGISTRY(f"""WITH {views.SQL}, hits AS (
  SELECT *, round({views.similarity_sql("title", "'anre'")}, 3) AS score FROM a_rows
  WHERE corpus = 'disclosure' AND (title ILIKE '%anre%' OR body ILIKE '%anre%'))
SELECT {_COLUMNS} FROM hits ORDER BY {_ORDER} LIMIT 30""")
def kw_body_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = search.cli_spec(keyword="anre", corpus="disclosure", body=True, limit=30)
    return search.keyword_search(_rows(spark, sf_dir), spec, views.documents(spark, sf_dir)).select(RESULT)


@REGISTRY(f"""WITH {views.SQL} SELECT {_COLUMNS} FROM (
  SELECT *, round({views.similarity_sql("doc_title", f"'{KEYWORD}'")}, 3) AS score,
    row_number() OVER (PARTITION BY doc_id ORDER BY art_no NULLS LAST, id) AS n FROM a_rows)
WHERE n = 1 AND score >= 0.2""")
def kw_doc_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.first_by(_rows(spark, sf_dir), ["doc_id"], [F.col("art_no").asc_nulls_last(), F.col("id")])
    score = F.round(trigram_similarity(F.col("doc_title"), KEYWORD), 3)
    return rows.withColumn("score", score).filter("score >= 0.2").select(RESULT)


@REGISTRY(f"""WITH {_hits_sql()}, capped AS (
  SELECT *, row_number() OVER (PARTITION BY corpus ORDER BY score DESC, inst_name NULLS LAST, id) AS k FROM hits
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY score, corpus ORDER BY inst_name NULLS LAST, id) AS turn FROM capped
  WHERE k <= 27
) SELECT {_COLUMNS}, turn::INT AS turn FROM turns ORDER BY score DESC, turn,
  CASE corpus WHEN 'legal' THEN 0 WHEN 'ca' THEN 1 WHEN 'bylaws' THEN 2 ELSE 3 END, inst_name NULLS LAST, id LIMIT 20""")
def per_corpus_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.keyword_search(_rows(spark, sf_dir), search.http_spec(keyword=KEYWORD, limit=20), views.documents(spark, sf_dir)).select(*RESULT, "turn")


@REGISTRY(f"""WITH {_hits_sql()}, top AS (SELECT * FROM hits ORDER BY {_ORDER} LIMIT 60)
SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (
  PARTITION BY coalesce(nullif(inst_name, ''), nullif(doc_title, ''), '') ORDER BY {_ORDER}) AS n FROM top)
WHERE n = 1 ORDER BY {_ORDER} LIMIT 15""")
def dedup_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.keyword_search(_rows(spark, sf_dir), search.cli_spec(keyword=KEYWORD, group=True), views.documents(spark, sf_dir)).select(RESULT)


@REGISTRY(f"""WITH {views.SQL} SELECT {_COLUMNS} FROM (SELECT *, 1.0::DOUBLE AS score FROM a_rows
WHERE art_no = 7 AND art_sub = 2) ORDER BY {_ORDER} LIMIT 100""")
def exact_article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.keyword_search(_rows(spark, sf_dir), search.cli_spec(keyword="제 7조의 2", limit=100), views.documents(spark, sf_dir)).select(RESULT)


@REGISTRY(f"""WITH {views.SQL} SELECT doc_id, doc_title, doc_type, corpus, seq, art_ref, title, substr(body, 1, 200) AS body,
n_chars FROM a_rows WHERE doc_id = 11 AND seq <= 20""")
def doc_with_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.get_document(views.documents(spark, sf_dir), views.articles(spark, sf_dir), 11)


@REGISTRY(f"WITH {views.SQL} SELECT id, doc_id, seq, title, body FROM a_articles WHERE doc_id = 3 AND art_no = 2")
def article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.get_article(views.articles(spark, sf_dir), 3, 2).select("id", "doc_id", "seq", "title", "body")


@REGISTRY(f"""SELECT p_partkey, p_name, round({views.similarity_sql("p_name", "'small blue ring'")}, 3) AS score FROM part
ORDER BY score DESC, p_partkey LIMIT 50""")
def trigram_similarity_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.round(trigram_similarity(F.col("p_name"), "small blue ring"), 3)
    rows = views.read(spark, sf_dir, "part").select("p_partkey", "p_name", score.alias("score"))
    return rows.orderBy(F.desc("score"), "p_partkey").limit(50)


@REGISTRY(f"""SELECT p_partkey, p_name FROM part WHERE len(list_intersect({views.trigram_sql("p_name")},
{views.trigram_sql("'small blue ring'")})) >= ceil(len({views.trigram_sql("'small blue ring'")}) * 0.3)""")
def posting_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return search.posting_prefilter(rows, search.title_postings(rows, "p_partkey", "p_name"), "p_partkey", "small blue ring")


@REGISTRY(f"""SELECT * FROM (SELECT p_partkey, round({views.similarity_sql("p_name", "'small blue ring'")}, 6) AS similarity
FROM part) WHERE similarity >= 0.3""")
def posting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities from trigram postings, without the texts."""
    rows = views.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    found = search.posting_scores(search.title_postings(rows, "p_partkey", "p_name"), "p_partkey", "small blue ring")
    return found.withColumn("similarity", F.round("similarity", 6))


def _vector(spark: SparkSession, sf_dir: str, number: int) -> list[float]:
    row = views.read(spark, sf_dir, "embeddings").filter(F.col("vec_id") == number).select("embedding").first()
    return list(row[0])


_KNN = f"""q AS (SELECT vec_id AS q_id, embedding AS qe FROM embeddings WHERE vec_id IN (7, 8)), scored AS (
  SELECT q_id, vec_id, label, {views.cosine_sql("embedding", "qe")} AS c FROM embeddings CROSS JOIN q)"""


def _scored(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    vector = F.array(*map(F.lit, _vector(spark, sf_dir, number)))
    rows = views.read(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", cosine(F.col("embedding"), vector).alias("c"))


def _top(rows: DataFrame, k: int) -> DataFrame:
    return rows.orderBy(F.desc("c"), "vec_id").limit(k).select("vec_id", "label", F.round("c", 3).alias("score"))


@REGISTRY(f"WITH {_KNN} SELECT vec_id, label, round(c, 3) AS score FROM scored WHERE q_id = 7 ORDER BY c DESC, vec_id LIMIT 15")
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(_scored(spark, sf_dir, 7), 15)


@REGISTRY(f"""WITH {_KNN} SELECT vec_id, label, round(c, 3) AS score FROM scored WHERE q_id = 7 AND label % 2 = 1
ORDER BY c DESC, vec_id LIMIT 15""")
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(_scored(spark, sf_dir, 7).filter("label % 2 = 1"), 15)


@REGISTRY(f"WITH {_KNN} SELECT vec_id, label, round(c, 3) AS score FROM scored WHERE q_id = 7 AND c >= 0.28")
def knn_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir, 7).filter(F.col("c") >= search.SCORE_FLOOR)
    return rows.select("vec_id", "label", F.round("c", 3).alias("score"))


@REGISTRY(f"""WITH {_KNN}, arms AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY c DESC, vec_id) AS n FROM scored)
SELECT vec_id AS id, max(round(c, 3)) AS score FROM arms WHERE n <= 30 GROUP BY vec_id HAVING max(round(c, 3)) >= 0.28
ORDER BY score DESC, id LIMIT 25""")
def knn_two_query_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    arms = [_arm(_top(_scored(spark, sf_dir, n), 30).withColumnRenamed("vec_id", "id")) for n in (7, 8)]
    return ranking.best_of_variants(arms, search.SCORE_FLOOR, 25).select("id", "score")


def _arm(rows: DataFrame) -> DataFrame:
    name = F.col("id").cast("string")
    return rows.select("id", "score", name.alias("rel_path"), name.alias("doc_title"), F.lit("").alias("art_ref"),
                       name.alias("art_title"))


def _semantic_tables(spark: SparkSession, sf_dir: str):
    articles = views.articles(spark, sf_dir)
    links = articles.select("id", (F.col("id") % 499).cast("string").alias("text_hash"))
    vectors = views.read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("text_hash"), "embedding")
    return links, vectors


_NEAR = f"""near AS (SELECT r.*, {views.cosine_sql("e.embedding", "qe")} AS c, h FROM (
  SELECT *, (id % 499) AS h FROM a_rows) r JOIN embeddings e ON e.vec_id = r.h CROSS JOIN q WHERE q_id = 7)"""
_Q = "q AS (SELECT vec_id AS q_id, embedding AS qe FROM embeddings WHERE vec_id IN (7, 8))"
_NEAR_COLUMNS = "id, doc_id, inst_name, art_ref, score"


@REGISTRY(f"""WITH {views.SQL}, {_Q}, {_NEAR} SELECT {_NEAR_COLUMNS} FROM (SELECT *, round(c, 3) AS score FROM near
WHERE id IN (SELECT min(id) FROM near GROUP BY h)) ORDER BY c DESC, id LIMIT 15""")
def semantic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, vectors = _semantic_tables(spark, sf_dir)
    queue = links.groupBy("text_hash").agg(F.min("id").alias("id"))
    found = search.nearest(_rows(spark, sf_dir), vectors, links, _vector(spark, sf_dir, 7), search.tool_spec(limit=15), queue)
    return found.select(_NEAR_COLUMNS.split(", "))


@REGISTRY(f"""WITH {views.SQL}, {_Q}, {_NEAR} SELECT {_NEAR_COLUMNS} FROM (SELECT *, round(c, 3) AS score FROM near
WHERE corpus = 'ca' AND inst_name ILIKE '%src5%') ORDER BY c DESC, id LIMIT 15""")
def semantic_search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, vectors = _semantic_tables(spark, sf_dir)
    spec = search.tool_spec(corpus="ca", inst="src5", limit=15)
    found = search.nearest(_rows(spark, sf_dir), vectors, links, _vector(spark, sf_dir, 7), spec)
    return found.select(_NEAR_COLUMNS.split(", "))


@REGISTRY(f"""WITH {views.SQL} SELECT id FROM a_rows WHERE corpus = 'ca' AND inst_name ILIKE '%src5%'""")
def knn_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.candidates(_rows(spark, sf_dir), search.tool_spec(corpus="ca", inst="src5"), 1_000_000)


_PART_ARM = f"""kw AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY score DESC, p_partkey) AS r FROM (
  SELECT *, round({views.similarity_sql("p_name", "'small blue ring'")}, 3) AS score FROM part))"""


@REGISTRY(f"""WITH {_PART_ARM}, sem AS (SELECT p_partkey AS id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS r
FROM part), votes AS (SELECT id, 1.0 / (60 + r) AS v FROM kw WHERE r <= 40 UNION ALL
SELECT id, 1.0 / (60 + r) FROM sem WHERE r <= 40)
SELECT id, round(sum(v)::DOUBLE, 4) AS rrf FROM votes GROUP BY id ORDER BY sum(v) DESC, id LIMIT 20""")
def rrf_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = views.read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    by_name = parts.withColumn("score", F.round(trigram_similarity(F.col("p_name"), "small blue ring"), 3))
    by_price = parts.withColumn("score", F.col("p_retailprice"))
    order = [F.desc("score"), F.col("id")]
    arms = [_arm(a.orderBy(*order).limit(40)) for a in (by_name, by_price)]
    return ranking.reciprocal_rank_fusion(arms, [order, order], 20).select("id", "rrf")


@REGISTRY("""WITH r AS (SELECT p_partkey AS id, p_brand AS corpus, (p_size // 10)::DOUBLE AS score FROM part), t AS (
SELECT *, row_number() OVER (PARTITION BY score, corpus ORDER BY id) AS turn FROM r)
SELECT id, corpus, score, turn::INT AS turn FROM t ORDER BY score DESC, turn,
CASE corpus WHEN 'Brand#11' THEN 0 WHEN 'Brand#12' THEN 1 ELSE 9 END, id LIMIT 200""")
def round_robin_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("corpus"), F.floor(F.col("p_size") / 10).cast("double").alias("score")
    )
    turn = F.row_number().over(ranking.Window.partitionBy("score", "corpus").orderBy("id"))
    place = ranking.corpus_rank(F.col("corpus"), {"Brand#11": 0, "Brand#12": 1})
    return rows.withColumn("turn", turn).orderBy(F.desc("score"), "turn", place, "id").limit(200)


@REGISTRY("""SELECT id, text, no::INT AS number, sub::INT AS sub FROM (SELECT p_partkey AS id, '제 ' || p_size || ' 조' ||
CASE WHEN p_size % 2 = 0 THEN '의 3' ELSE '' END AS text, p_size AS no, CASE WHEN p_size % 2 = 0 THEN 3 END AS sub FROM part)""")
def article_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.functions.text import article_reference as reference

    size = F.col("p_size")
    text = F.concat(F.lit("제 "), size, F.lit(" 조"), F.when(size % 2 == 0, "의 3").otherwise(""))
    rows = views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.alias("text"))
    return rows.withColumn("r", reference(F.col("text"))).select("id", "text", "r.number", "r.sub")
