"""Queries of loads, sync and work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import planning
from corpusloom.operators import catalog, classify, load, queueing, ranking, sync
from corpusloom.plans import views
from corpusloom.plans.registry import Registry

REGISTRY = Registry()


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    articles = views.articles(spark, sf_dir).withColumnRenamed("body", "text")
    counts = articles.groupBy("doc_id").agg(F.count("*").alias("n_articles"))
    docs = views.documents(spark, sf_dir).join(counts, "doc_id", "left").fillna(0, ["n_articles"])
    return docs, articles


_GATE = """count(*)::BIGINT AS articles, (count(*) - count(DISTINCT (doc_id, seq)))::BIGINT AS repeated,
count(*) FILTER (contains(coalesce(text, '') || coalesce(title, ''), chr(0)))::BIGINT AS nul,
count(*) FILTER (regexp_matches(coalesce(text, '') || coalesce(title, ''), '[\\x01-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]'))::BIGINT
AS control, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM g_docs))::BIGINT AS orphans FROM g_articles"""


def _gate_sql(docs: str, articles: str) -> str:
    return f"""WITH {views.SQL}, g_docs AS ({docs}), g_articles AS ({articles}), d AS (
  SELECT count(*)::BIGINT AS docs, (count(*) - count(DISTINCT doc_id))::BIGINT AS repeated_docs, sum(n)::BIGINT AS expected
  FROM g_docs), a AS (SELECT {_GATE})
SELECT 0::BIGINT AS bad_docs, 0::BIGINT AS bad_articles, *, (repeated_docs = 0 AND repeated = 0 AND nul = 0 AND orphans = 0
  AND articles IN (expected, expected + repeated)) AS passed FROM d CROSS JOIN a"""


_DOCS = "SELECT doc_id, len(l)::BIGINT AS n FROM a_lines"
_ARTICLES = "SELECT doc_id, seq, title, body AS text FROM a_articles"


@REGISTRY(_gate_sql(_DOCS, _ARTICLES))
def staging_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.gate(*_staged(spark, sf_dir))


@REGISTRY(_gate_sql(
    _DOCS + " WHERE doc_id % 50 <> 0",
    _ARTICLES + " UNION ALL SELECT doc_id, seq, title, text || chr(1) FROM (" + _ARTICLES + ") WHERE doc_id % 9 = 1 AND seq = 1",
))
def staging_gate_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, articles = _staged(spark, sf_dir)
    again = articles.filter("doc_id % 9 = 1 and seq = 1").withColumn("text", F.concat("text", F.lit("\x01")))
    return load.gate(docs.filter("doc_id % 50 <> 0"), articles.unionByName(again))


_HASH = """hashed AS (SELECT id, doc_id, title, md5(CASE WHEN coalesce(title, '') = '' THEN '' ELSE title || chr(10) END ||
substr(body, 1, 4000)) AS text_hash FROM a_articles)"""


@REGISTRY(f"WITH {views.SQL}, {_HASH} SELECT id, text_hash FROM hashed")
def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.hashes(views.articles(spark, sf_dir))


@REGISTRY(f"WITH {views.SQL}, {_HASH} SELECT text_hash, min(id) AS id FROM hashed GROUP BY text_hash")
def embed_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.queue(load.hashes(views.articles(spark, sf_dir)))


@REGISTRY(f"""WITH {views.SQL}, {_HASH}, q AS (SELECT text_hash, min(id) AS id FROM hashed GROUP BY text_hash)
SELECT text_hash, id FROM q WHERE text_hash NOT IN (SELECT text_hash FROM hashed WHERE doc_id % 5 = 0) ORDER BY id LIMIT 500""")
def embed_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.articles(spark, sf_dir)
    done = load.hashes(articles.filter("doc_id % 5 = 0"))
    return load.pending(load.queue(load.hashes(articles)), done, 500)


@REGISTRY(f"WITH {views.SQL}, {_HASH} SELECT id, text_hash FROM hashed WHERE doc_id % 3 <> 0")
def dangling_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.articles(spark, sf_dir)
    return load.without_dangling(load.hashes(articles), articles.filter("doc_id % 3 <> 0"))


_COPY = "SELECT rel_path AS doc_id, inst_code, 'old' AS state FROM a_documents"


def _keyed(spark: SparkSession, sf_dir: str, state: str) -> DataFrame:
    rows = views.documents(spark, sf_dir)
    return rows.select(F.col("rel_path").alias("doc_id"), "inst_code", F.lit(state).alias("state"))


@REGISTRY(f"""WITH {views.SQL} {_COPY} WHERE corpus <> 'ca'
UNION ALL SELECT rel_path, inst_code, 'new' FROM a_documents WHERE corpus = 'ca' AND a_documents.doc_id % 8 = 1""")
def append_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.split_part("doc_id", F.lit(":"), F.lit(2)).cast("long")
    new = _keyed(spark, sf_dir, "new").filter(F.col("doc_id").startswith("ca:") & (number % 8 == 1))
    return load.replace_corpus(_keyed(spark, sf_dir, "old"), new, "ca")


@REGISTRY(f"""WITH {views.SQL} {_COPY} WHERE NOT (corpus = 'ca' AND a_documents.doc_id % 12 = 1)
UNION ALL SELECT rel_path, inst_code, 'new' FROM a_documents WHERE corpus = 'ca' AND a_documents.doc_id % 12 = 1""")
def delta_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.split_part("doc_id", F.lit(":"), F.lit(2)).cast("long")
    new = _keyed(spark, sf_dir, "new").filter(F.col("doc_id").startswith("ca:") & (number % 12 == 1))
    return load.replace_documents(_keyed(spark, sf_dir, "old"), new, new, "ca")


@REGISTRY("""SELECT source AS inst_code, any_value('name ' || lang) AS inst_name, any_value(lang) AS ministry FROM documents d
WHERE doc_id = (SELECT min(doc_id) FROM documents e WHERE e.source = d.source) GROUP BY source""")
def institutions_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "documents")
    named = rows.select("doc_id", F.col("source").alias("inst_code"), F.concat(F.lit("name "), "lang").alias("inst_name"),
                        F.col("lang").alias("ministry"))
    return load.institutions(named)


@REGISTRY("""SELECT o_custkey AS k, o_orderkey AS v FROM orders WHERE o_orderkey % 3 = 0 UNION ALL
SELECT o_custkey, min(o_orderkey) FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)
GROUP BY o_custkey""")
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    return load.insert_missing(rows.filter("v % 3 = 0"), rows, ["k"])


@REGISTRY("""SELECT p.p_partkey AS id, CASE WHEN p.p_partkey % 4 = 0 THEN 'changed' ELSE p_brand END AS p_brand FROM part p""")
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand")
    return load.update_from(rows, rows.filter("id % 4 = 0").withColumn("p_brand", F.lit("changed")), "id", "p_brand")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "orders")
    number = F.when(F.col("o_orderkey") % 40 == 0, "").otherwise(F.col("o_orderkey").cast("string"))
    name = F.when(F.col("o_custkey") % 11 == 0, "nobody").otherwise(F.concat(F.lit("c"), F.col("o_custkey")))
    return rows.select(number.alias("disclosure_no"), F.col("o_orderpriority").alias("report_no"), name.alias("inst_name"))


_FEED = """feed AS (SELECT CASE WHEN o_orderkey % 40 = 0 THEN '' ELSE o_orderkey::VARCHAR END AS disclosure_no,
o_orderpriority AS report_no, CASE WHEN o_custkey % 11 = 0 THEN 'nobody' ELSE 'c' || o_custkey END AS inst_name FROM orders)"""


@REGISTRY(f"""WITH {_FEED} SELECT disclosure_no, report_no, f.inst_name, c_custkey::VARCHAR AS inst_code,
CASE WHEN disclosure_no::BIGINT % 3 = 0 THEN 'stored' WHEN report_no NOT IN ('1-URGENT', '2-HIGH') THEN 'out_of_scope'
WHEN c_custkey IS NULL THEN 'unmatched' ELSE 'missing' END AS route
FROM feed f LEFT JOIN customer c ON f.inst_name = 'c' || c.c_custkey WHERE disclosure_no <> ''""")
def feed_diff_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    stored = views.read(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").cast("string").alias("disclosure_no"))
    scoped = feed.select("report_no").filter(F.col("report_no").isin("1-URGENT", "2-HIGH"))
    named = views.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("inst_code"), F.concat(F.lit("c"), "c_custkey").alias("inst_name"))
    return sync.route_feed(feed, stored, scoped, named)


@REGISTRY("""SELECT c.c_custkey AS inst_code, p.report_no FROM customer c CROSS JOIN
(SELECT DISTINCT o_orderpriority AS report_no FROM orders) p
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = p.report_no)""")
def pair_cross_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.read(spark, sf_dir, "orders")
    done = orders.select(F.col("o_custkey").alias("inst_code"), F.col("o_orderpriority").alias("report_no"))
    names = views.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("inst_code"))
    return sync.open_pairs(names, done.select("report_no"), done)


@REGISTRY("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_linenumber % 2 = 0 AND l_orderkey % 3 = 0)""")
def missing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return sync.missing(rows, rows.filter("l_linenumber % 2 = 0 and l_orderkey % 3 = 0"), ["l_orderkey", "l_linenumber"])


_TARGETS = """m AS (SELECT o_custkey::VARCHAR AS inst_code, o_orderpriority AS report_no, o_orderkey::VARCHAR AS disclosure_no
FROM orders), t AS (SELECT inst_code, report_no, CASE WHEN disclosure_no::BIGINT % 7 = 0 THEN NULL ELSE disclosure_no END AS
disclosure_no, NULL::VARCHAR AS reason FROM m WHERE disclosure_no::BIGINT % 5 = 0)"""


def _targets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = views.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("inst_code"), F.col("o_orderpriority").alias("report_no"),
        F.col("o_orderkey").cast("string").alias("disclosure_no"))
    number = F.col("disclosure_no").try_cast("long")
    some = rows.filter(number % 5 == 0)
    return rows, some.withColumn("disclosure_no", F.when(number % 7 != 0, F.col("disclosure_no")))


@REGISTRY(f"""WITH {_TARGETS} SELECT * FROM t UNION ALL
SELECT DISTINCT inst_code, report_no, disclosure_no, 'missing_file' FROM m WHERE disclosure_no::BIGINT % 4 = 0
AND (inst_code, report_no, disclosure_no) NOT IN (SELECT inst_code, report_no, coalesce(disclosure_no, '') FROM t)""")
def retry_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, some = _targets(spark, sf_dir)
    return sync.retry_targets(some, rows.filter(F.col("disclosure_no").try_cast("long") % 4 == 0))


@REGISTRY(f"""WITH {_TARGETS} SELECT * FROM m WHERE (inst_code, report_no) IN
(SELECT inst_code, report_no FROM t WHERE disclosure_no IS NULL) OR (inst_code, report_no, disclosure_no) IN
(SELECT inst_code, report_no, disclosure_no FROM t WHERE disclosure_no IS NOT NULL)""")
def retry_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.by_targets(*_targets(spark, sf_dir))


_CHECKPOINT = """ck AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN 'other'
ELSE o_orderdate::DATE::VARCHAR END AS d FROM orders WHERE o_orderkey % 2 = 0),
live AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE o_orderdate::DATE::VARCHAR END AS d FROM orders)"""


def _checkpoint(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = views.read(spark, sf_dir, "orders")
    day, key = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")
    live = rows.select(key.alias("k"), F.when(key % 12 == 0, "").otherwise(day).alias("d"))
    date = F.when(key % 10 == 0, "").when(key % 4 == 0, "other").otherwise(day)
    return live, rows.filter(key % 2 == 0).select(key.alias("k"), date.alias("d"))


@REGISTRY(f"""WITH {_CHECKPOINT} SELECT live.* FROM live LEFT JOIN ck USING (k)
WHERE ck.d IS NULL OR NOT (live.d = ck.d OR live.d = '' OR ck.d = '')""")
def checkpoint_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.not_in_checkpoint(*_checkpoint(spark, sf_dir), "k", "d")


@REGISTRY(f"WITH {_CHECKPOINT} SELECT live.* FROM live LEFT JOIN ck USING (k) WHERE ck.d IS NULL OR live.d <> ck.d")
def checkpoint_skip_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.not_in_checkpoint(*_checkpoint(spark, sf_dir), "k", "d", strict=True)


@REGISTRY(f"""WITH {_CHECKPOINT} SELECT k, coalesce(nullif(live.d, ''), nullif(ck.d, '')) AS d FROM ck FULL JOIN live USING (k)""")
def checkpoint_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, old = _checkpoint(spark, sf_dir)
    return sync.union_checkpoints(old, live, "k", "d")


@REGISTRY("""SELECT o_orderkey::VARCHAR AS number FROM orders WHERE o_orderkey % 3 <> 0""")
def recency_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    rows = views.read(spark, sf_dir, "orders").select(key.alias("number"), F.concat(F.lit("a:b:"), key).alias("id"))
    stored = rows.filter(F.col("number").cast("long") % 3 == 0).select(sync.stored_number(F.col("id")).alias("number"))
    return sync.missing(rows.select("number"), stored, ["number"])


@REGISTRY("""WITH s AS (SELECT p_partkey AS id, p_name || ' ' || p_partkey AS title, p_partkey AS old_seq,
CASE WHEN p_partkey % 6 = 0 THEN '' ELSE '2020' || lpad((p_partkey % 12 + 1)::VARCHAR, 2, '0') END AS old_date FROM part)
SELECT id, title, old_seq::VARCHAR AS old_seq, (old_seq + id % 3)::VARCHAR AS new_seq, old_date, '202006' AS new_date FROM s
WHERE id % 3 <> 0 AND (old_date = '' OR '202006' > old_date)""")
def revision_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = views.read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    title = F.concat_ws(" ", "p_name", key.cast("string"))
    date = F.when(key % 6 == 0, "").otherwise(F.concat(F.lit("2020"), F.lpad((key % 12 + 1).cast("string"), 2, "0")))
    url = F.concat(F.lit("https://laws.example.org/view?lsiSeq="), key)
    sources = part.select(key.alias("id"), title.alias("title"), url.alias("source_url"), date.alias("effective_date"))
    new = F.concat_ws("  ", "p_name", key.cast("string"))
    listed = part.select(new.alias("title"), (key + key % 3).cast("string").alias("seq"), F.lit("202006").alias("effective_date"),
                         F.lit(True).alias("current"))
    old = part.select(title.alias("title"), F.lit("0").alias("seq"), F.lit("190001").alias("effective_date"), F.lit(False).alias("current"))
    return sync.revisions(sources, listed.unionByName(old))


@REGISTRY("""SELECT CASE WHEN o_orderkey % 9 = 0 THEN '::' ELSE 'r' END || o_orderkey AS id,
CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS state FROM orders WHERE o_orderkey % 9 <> 0""")
def index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = views.read(spark, sf_dir, "orders").select(F.concat(F.when(key % 9 == 0, "::").otherwise("r"), key).alias("id"), key.alias("k"))
    old = rows.select("id", F.lit("old").alias("state"))
    return sync.merge_index(old, rows.filter("k % 2 = 0").select("id", F.lit("new").alias("state")))


@REGISTRY("""WITH st AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'ocr' END
AS status FROM orders WHERE o_orderkey % 2 = 0), w AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0)
SELECT coalesce(st.id, w.id) AS id, CASE WHEN w.id IS NOT NULL THEN 'success' ELSE status END AS status
FROM st FULL JOIN w ON st.id = w.id""")
def merge_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(key % 3 == 0, "success").when(key % 3 == 1, "failed").otherwise("ocr")
    rows = views.read(spark, sf_dir, "orders")
    main = rows.filter(key % 2 == 0).select(key.alias("id"), status.alias("status"))
    return sync.merge_status(main, rows.filter(key % 5 == 0).select(key.alias("id"), F.lit("success").alias("status")))


_QUEUE = """items AS (SELECT doc_id AS id, n_chars * 500 AS size, 1 + n_chars // 3000 AS pages, md5(text) AS hash FROM documents)"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "documents")
    pages = (1 + F.floor(F.col("n_chars") / 3000)).cast("long")
    return rows.select(F.col("doc_id").alias("id"), (F.col("n_chars") * 500).alias("size"), pages.alias("pages"),
                       F.md5(F.col("text").cast("binary")).alias("hash"))


@REGISTRY(f"""WITH {_QUEUE}, f AS (SELECT hash, min(id) AS first FROM items WHERE id % 10 <> 3 GROUP BY hash)
SELECT id, size, pages, hash, CASE WHEN id % 10 = 3 THEN 'DEDUP' WHEN hash IN (SELECT hash FROM items WHERE id % 17 = 0)
OR id <> first THEN 'CDEDUP' ELSE 'CANONICAL' END AS class, CASE WHEN id % 10 = 3 THEN id ELSE first END AS canonical,
greatest(size / 1048576.0::DOUBLE * 60, pages * 20.0::DOUBLE) AS score FROM items LEFT JOIN f USING (hash)""")
def content_dedup_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    return queueing.classify(items, items.filter("id % 10 = 3"), items.filter("id % 17 = 0"))


@REGISTRY(f"""WITH {_QUEUE} SELECT id, hash, reused_from, 'body ' || reused_from AS body FROM items JOIN
(SELECT hash, min(id) AS reused_from FROM items WHERE id % 2 = 0 GROUP BY hash) USING (hash) WHERE id % 2 = 1""")
def hash_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    done = items.filter("id % 2 = 0").withColumn("body", F.concat(F.lit("body "), "id"))
    return queueing.reuse_by_hash(items.filter("id % 2 = 1"), done)


@REGISTRY(f"""WITH {_QUEUE} SELECT id, greatest(size / 1048576.0::DOUBLE * 60, pages * 20.0::DOUBLE) AS cost,
greatest(1800000, least(greatest(300000 + ceil(size / 1048576.0::DOUBLE * 60000), pages * 20000), 5400000))::BIGINT AS timeout_ms,
least(3600, greatest(180, 180 + ceil(size / 1048576.0::DOUBLE * 42)))::BIGINT AS quick_s,
size / 1048576.0::DOUBLE / pages AS density, ('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT % 5 AS shard FROM items""")
def queue_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, pages = F.col("size"), F.col("pages")
    return _items(spark, sf_dir).select(
        "id", planning.conversion_cost(size, pages).alias("cost"), planning.conversion_timeout(size, pages).alias("timeout_ms"),
        planning.quick_timeout(size).alias("quick_s"), planning.density(size, pages).alias("density"),
        planning.shard(F.col("id").cast("string"), 5).alias("shard"),
    )


@REGISTRY(f"""WITH {_QUEUE}, b AS (SELECT *, size / 1048576.0::DOUBLE AS mb, id % 13 = 0 AS q FROM items) SELECT id,
pages <= 100 AND mb <= 0.9 AS small, mb <= 0.9 AS light, NOT q AND (mb <= 0.9 OR (pages >= 3 AND mb / pages <= 0.5)) AS safe,
NOT (NOT q AND (mb <= 0.9 OR (pages >= 3 AND mb / pages <= 0.5))) AS risky, pages BETWEEN 2 AND 3 AS mid FROM b""")
def band_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, pages, quarantined = F.col("size"), F.col("pages"), F.col("id") % 13 == 0
    bands = {n: queueing.band(n, size, pages, quarantined).alias(n) for n in ("small", "light", "safe", "risky")}
    return _items(spark, sf_dir).select("id", *bands.values(), queueing.band("", size, pages, low=2, high=3).alias("mid"))


@REGISTRY(f"""WITH {_QUEUE}, s AS (SELECT id, bool_or(good) AS good, bool_or(NOT good) AS bad FROM (
SELECT id, id % 3 = 0 AS good FROM items WHERE id % 4 <> 0 UNION ALL SELECT id, TRUE FROM items WHERE id % 5 = 0) GROUP BY id)
SELECT count(*)::BIGINT AS queued, count(*) FILTER (good)::BIGINT AS succeeded, count(*) FILTER (bad AND NOT good)::BIGINT
AS failed, count(*) FILTER (good IS NULL)::BIGINT AS open, count(*) FILTER (good IS NULL) = 0 AS complete
FROM items LEFT JOIN s USING (id)""")
def completion_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    one = items.filter("id % 4 <> 0").select("id", F.when(F.col("id") % 3 == 0, "success").otherwise("failed").alias("status"))
    two = items.filter("id % 5 = 0").select("id", F.lit("success").alias("status"))
    return queueing.completion(items, one.unionByName(two))


@REGISTRY(f"""WITH {_QUEUE}, o AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS i, count(*) OVER () AS n FROM items)
SELECT min(size) FILTER (i = floor(n * 0.1)) AS p10, min(size) FILTER (i = floor(n * 0.5)) AS p50,
min(size) FILTER (i = floor(n * 0.9)) AS p90 FROM o""")
def size_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queueing.size_percentiles(_items(spark, sf_dir), "size")


@REGISTRY("""SELECT event_id, hits, hits > 5 AS blocked FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id
ORDER BY epoch_us(ts) RANGE BETWEEN 43199999999 PRECEDING AND CURRENT ROW) AS hits FROM events)""")
def rate_limit_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.read(spark, sf_dir, "events")
    return queueing.hits_in_window(events, "user_id", "ts", 12 * 3600, 5).select("event_id", "hits", "blocked")


@REGISTRY("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) THEN ''
ELSE '_v' || lpad((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber))::VARCHAR, 2, '0') END AS version_suffix
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return sync.newest_version(rows, ["l_orderkey"], "l_linenumber")


@REGISTRY("""SELECT p_brand, p_name, p_size, CASE WHEN n = 1 THEN p_name ELSE p_name || '_alt' || n END AS stored_as FROM (
SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_size) AS n FROM (SELECT DISTINCT p_brand, p_name, p_size
FROM part))""")
def alternate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.alternate_names(views.read(spark, sf_dir, "part"), "p_brand", "p_name", "p_size")


@REGISTRY(f"""WITH {views.SQL} SELECT corpus, usecase, count(*) AS n FROM (SELECT corpus, unnest(usecases) AS usecase
FROM a_documents) GROUP BY corpus, usecase""")
def usecase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.label_counts(views.documents(spark, sf_dir), ["corpus"])


def _code_rules(spark: SparkSession) -> DataFrame:
    rows = [("Brand#11", "audit"), ("Brand#11", "labor"), ("Brand", "finance"), ("Brand#45", "recruit")]
    return spark.createDataFrame(rows, "code string, usecase string")


@REGISTRY("""SELECT p_partkey AS id, CASE p_brand WHEN 'Brand#11' THEN ['audit', 'labor'] WHEN 'Brand#45' THEN ['recruit']
ELSE ['finance'] END AS usecases FROM part""")
def usecase_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"))
    return classify.by_code(rows, _code_rules(spark))


_WORDS = [("audit", ["red", "ring"]), ("labor", ["small"]), ("finance", ["bolt", "gear"])]


@REGISTRY("""SELECT p_partkey AS id, list_filter([CASE WHEN contains(p_name, 'red') OR contains(p_name, 'ring') THEN 'audit' END,
CASE WHEN contains(p_name, 'small') THEN 'labor' END, CASE WHEN contains(p_name, 'bolt') OR contains(p_name, 'gear')
THEN 'finance' END], lambda x: x IS NOT NULL) AS usecases FROM part""")
def usecase_by_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"))
    return classify.by_keyword(rows, _WORDS)


def _three_letters() -> list[tuple[str, list[str]]]:
    """Fifteen groups of three-letter words by rule: a word's number in base 26, modulo 1009, is its group's."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c for a in letters for b in letters for c in letters]
    return [(f"g{g}", words[g::1009]) for g in range(15)]


@REGISTRY("""WITH codes AS (SELECT doc_id, list_transform(list_filter(list_transform(range(1, length(t) - 1), lambda i: substr(t, i::INT, 3)),
lambda x: regexp_matches(x, '^[a-z]{3}$')), lambda x: ((ascii(x) - 97) * 676 + (ascii(x[2:]) - 97) * 26 + ascii(x[3:]) - 97) % 1009) AS c
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
SELECT doc_id AS id, list_transform(list_filter(range(15), lambda g: list_contains(c, g)), lambda g: 'g' || g) AS groups FROM codes""")
def groups_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All groups of over 250 words that whole texts hold, by one automaton."""
    rows = views.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("title"))
    return classify.by_words(rows, _three_letters())


@REGISTRY("""WITH i AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN ['_shared'] WHEN p_size > 25 THEN ['audit']
END AS u, p_brand AS c FROM part), r(role, kind, value) AS (VALUES ('auditor', 'usecase', 'audit'), ('buyer', 'code', 'Brand#11'),
('buyer', 'group', 'g1')) SELECT DISTINCT id, role FROM i CROSS JOIN r WHERE list_contains(u, '_shared')
OR (kind = 'usecase' AND list_contains(u, value)) OR (kind = 'code' AND c = value) OR (kind = 'group' AND id % 7 = 0)""")
def role_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    labels = F.when(key % 10 == 0, F.array(F.lit("_shared"))).when(F.col("p_size") > 25, F.array(F.lit("audit")))
    rows = views.read(spark, sf_dir, "part").select(key.alias("id"), labels.alias("usecases"), F.col("p_brand").alias("code"),
                                                    F.when(key % 7 == 0, F.array(F.lit("g1"))).alias("groups"))
    rules = spark.createDataFrame([("auditor", "usecase", "audit"), ("buyer", "code", "Brand#11"), ("buyer", "group", "g1")],
                                  "role string, kind string, value string")
    return classify.roles(rows, rules)


@REGISTRY("""SELECT p_brand AS code, count(*) AS n FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand', 'Brand#45')
GROUP BY p_brand ORDER BY n DESC, code LIMIT 15""")
def unmapped_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select(F.col("p_brand").alias("code"))
    return classify.unmapped(rows, _code_rules(spark))


@REGISTRY("""SELECT n_nationkey AS code, CASE WHEN n_nationkey % 2 = 0 THEN 'removed' ELSE 'added' END AS change FROM nation
WHERE n_nationkey % 3 <> 0""")
def catalog_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"))
    return catalog.catalog_diff(rows.filter("code % 2 = 0 or code % 3 = 0"), rows.filter("code % 2 = 1 or code % 3 = 0"))


@REGISTRY("""SELECT CASE WHEN p_size <= 10 THEN 'susi' WHEN p_size <= 20 THEN 'board' ELSE 'regular' END AS kind, count(*) AS n
FROM part GROUP BY kind""")
def kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    rows = views.read(spark, sf_dir, "part").select(F.concat(size, F.lit(", x")).alias("report_form_root_no"))
    kinds = {"susi": [str(i) for i in range(11)], "board": [str(i) for i in range(11, 21)]}
    return catalog.kind_counts(catalog.catalog_items(rows, kinds))


@REGISTRY("""SELECT l_returnflag AS file, count(DISTINCT (l_linestatus, l_orderkey)) AS n_rows, count(DISTINCT l_suppkey)
AS n_institutions, count(DISTINCT l_linestatus) AS n_sheets, list_sort(list(DISTINCT l_linenumber)) AS columns
FROM lineitem GROUP BY l_returnflag""")
def statistics_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = views.read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("file"), F.col("l_linestatus").alias("sheet"), F.col("l_orderkey").alias("row"),
        F.col("l_linenumber").alias("column"), F.col("l_suppkey").alias("institution"),
    )
    return catalog.statistics_index(cells)


@REGISTRY("""SELECT o_orderkey, o_orderpriority FROM (SELECT *, CASE WHEN o_orderkey % 6 = 0 THEN 'n/a' ELSE
year(o_orderdate)::VARCHAR END AS y FROM orders) WHERE coalesce(try_cast(y AS INT) >= 1996, TRUE)""")
def year_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "orders")
    year = F.when(F.col("o_orderkey") % 6 == 0, "n/a").otherwise(F.year("o_orderdate").cast("string"))
    return catalog.year_from(rows.withColumn("y", year), "y", 1996, True).select("o_orderkey", "o_orderpriority")


@REGISTRY("""SELECT c_custkey, c_nationkey, o_orderkey FROM (SELECT c_custkey, c_nationkey, o_orderkey, row_number() OVER (
PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM customer JOIN orders ON o_custkey = c_custkey) WHERE n = 1""")
def first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "orders").join(views.read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    first = ranking.first_by(rows, ["c_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("c_custkey", "c_nationkey", "o_orderkey")
