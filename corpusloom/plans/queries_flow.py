"""Queries of sources, selections, reports and small column rules, over columns made from the given tables."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import rules
from corpusloom.functions import planning
from corpusloom.functions import text as fn
from corpusloom.operators import catalog, classify, extract, load, queueing, search, selection, sync
from corpusloom.plans import build, views
from corpusloom.plans.registry import Registry
from corpusloom.sources import readers, writers

REGISTRY = Registry()


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.read(spark, sf_dir, "part")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.read(spark, sf_dir, "orders")


def _text(column: str):
    return F.col(column).cast("string")


@REGISTRY("SELECT p_partkey AS id, p_name AS text FROM part WHERE contains(p_name, 'red')")
def content_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    return selection.holding(rows, "red")


_PARSERS = """p AS (SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'paddleOCR' WHEN 1 THEN 'ocr-fast' WHEN 2 THEN 'text' END
AS parser FROM part)"""


@REGISTRY(f"""WITH {_PARSERS} SELECT id, parser, 'ocr' AS asked FROM p WHERE parser ILIKE '%ocr%' UNION ALL
SELECT id, parser, 'text' FROM p WHERE parser = 'text' UNION ALL SELECT id, parser, 'all' FROM p""")
def parser_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 4
    parser = F.when(n == 0, "paddleOCR").when(n == 1, "ocr-fast").when(n == 2, "text")
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), parser.alias("parser"))
    arms = [selection.by_parser(rows, asked).withColumn("asked", F.lit(asked)) for asked in ("ocr", "text", "all")]
    return arms[0].unionByName(arms[1]).unionByName(arms[2])


@REGISTRY("""WITH f AS (SELECT p_partkey AS id, p_name AS file_name, CASE p_size % 3 WHEN 0 THEN ['audit', 'labor'] WHEN 1 THEN
['finance'] END AS usecases FROM part) SELECT id, 'agreements' AS scope FROM f WHERE contains(file_name, 'blue') OR
contains(file_name, 'ring') UNION ALL SELECT id, 'expanded' FROM f WHERE list_contains(usecases, 'audit')
UNION ALL SELECT id, 'labelled' FROM f WHERE usecases IS NOT NULL UNION ALL SELECT id, 'listed' FROM f""")
def scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 3
    labels = F.when(n == 0, F.array(F.lit("audit"), F.lit("labor"))).when(n == 1, F.array(F.lit("finance")))
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("file_name"), labels.alias("usecases"))
    found = {
        "agreements": selection.by_scope(rows, "agreements", words=("blue", "ring")),
        "expanded": selection.by_scope(rows, "expanded", usecases=("audit",)), "labelled": selection.by_scope(rows, "expanded"),
        "listed": selection.by_scope(rows, "agreements", listed=True), "none": selection.by_scope(rows, "other"),
    }
    out = None
    for name, arm in found.items():
        arm = arm.select("id", F.lit(name).alias("scope"))
        out = arm if out is None else out.unionByName(arm)
    return out


@REGISTRY("""SELECT p_partkey, p_name AS title FROM part WHERE regexp_matches(p_name, '^(small|large)')
AND NOT regexp_matches(p_name, 'ring$')""")
def pattern_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part(spark, sf_dir).select("p_partkey", F.col("p_name").alias("title"))
    return selection.by_patterns(rows, "^(small|large)", "ring$")


@REGISTRY("""SELECT p_partkey, p_name || CASE p_size % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.x.hwp' ELSE '.png' END AS file_name
FROM part WHERE p_size % 3 < 2 AND p_partkey % 2 = 0""")
def convertible_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size") % 3
    name = F.concat("p_name", F.when(n == 0, ".PDF").when(n == 1, ".x.hwp").otherwise(".png"))
    got = F.when(F.col("p_partkey") % 2 == 0, True).when(F.col("p_partkey") % 3 == 0, False)
    rows = _part(spark, sf_dir).select("p_partkey", name.alias("file_name"), got.alias("downloaded"))
    return selection.convertible(rows, ("pdf", "hwp")).select("p_partkey", "file_name")


@REGISTRY(f"""WITH {views.SQL} SELECT doc_id, CASE corpus WHEN 'legal' THEN '법령' WHEN 'ca' THEN '단협' WHEN 'disclosure' THEN '공시'
ELSE '내규' END AS corpus_label, CASE usecases[1] WHEN 'audit' THEN '02_감사대응징계' WHEN 'labor' THEN '04_노사관계' ELSE '-' END
AS usecase_label FROM a_documents""")
def listing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get("usecases", F.lit(0))
    return views.documents(spark, sf_dir).select(
        "doc_id", selection.labelled(F.col("corpus"), selection.CORPUS_LABELS, selection.OTHER_CORPUS).alias("corpus_label"),
        selection.labelled(first, selection.USECASE_LABELS, "-").alias("usecase_label"),
    )


@REGISTRY("""SELECT o_orderkey AS id, coalesce(c_name, '') AS inst_name, coalesce(c_mktsegment, '') AS ministry FROM orders
LEFT JOIN (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS c_mktsegment FROM customer
WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey""")
def metadata_or_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = views.read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("inst_name"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("ministry"),
    )
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), "o_custkey")
    return selection.with_metadata(rows, known, "o_custkey", ("inst_name", "ministry")).drop("o_custkey")


@REGISTRY(f"""WITH {views.SQL}, names AS (SELECT doc_title, min('alias ' || doc_title) AS new FROM a_documents WHERE doc_id % 3 = 0
AND doc_title IS NOT NULL GROUP BY doc_title) SELECT doc_id, new AS alias FROM a_documents LEFT JOIN names USING (doc_title)""")
def alias_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = views.documents(spark, sf_dir)
    title = F.col("doc_title")
    names = docs.filter((F.col("doc_id") % 3 == 0) & title.isNotNull()).select(
        title.alias("title"), F.concat(F.lit("alias "), title).alias("alias")
    )
    return selection.alias_by_title(docs, names).select("doc_id", "alias")


@REGISTRY(f"""WITH {views.SQL} SELECT (SELECT count(*) FROM a_documents)::BIGINT AS documents, (SELECT string_agg(corpus || '=' || n, ','
ORDER BY corpus) FROM (SELECT corpus, count(*) AS n FROM a_rows GROUP BY corpus)) AS articles, (SELECT count(DISTINCT md5(CASE WHEN
title = '' THEN '' ELSE title || chr(10) END || substr(body, 1, 4000))) FROM a_articles)::BIGINT AS queued,
(SELECT count(*) FROM embeddings)::BIGINT AS embedded""")
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.articles(spark, sf_dir)
    queue = load.queue(load.hashes(articles))
    found = selection.corpus_totals(views.documents(spark, sf_dir), articles, queue, views.read(spark, sf_dir, "embeddings"))
    listed = F.transform(F.map_entries("articles"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("articles", F.array_join(F.array_sort(listed), ","))


@REGISTRY("SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def distinct_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.distinct_values(_part(spark, sf_dir), "p_type")


@REGISTRY("""SELECT l_returnflag AS level, count(*)::BIGINT AS n FROM lineitem GROUP BY 1 UNION ALL
SELECT 'total', count(*)::BIGINT FROM lineitem""")
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.level_counts(views.read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("level")))


@REGISTRY("""SELECT count(*)::BIGINT AS files, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS success,
count(*) FILTER (o_orderstatus = 'O')::BIGINT AS failed, count(*) FILTER (o_orderstatus = 'P')::BIGINT AS ocr_needed,
count(*) FILTER (o_custkey % 7 = 0)::BIGINT AS hash_reused FROM orders""")
def status_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"F": "success", "O": "failed", "P": "ocr_needed"}
    status = selection.labelled(F.col("o_orderstatus"), names, "other")
    parser = F.when(F.col("o_custkey") % 7 == 0, "hash_reuse")
    return selection.status_totals(_orders(spark, sf_dir).select(status.alias("status"), parser.alias("parser")))


@REGISTRY("""SELECT p_type AS bid_type, count(DISTINCT p_brand)::BIGINT AS institutions FROM part GROUP BY p_type
ORDER BY institutions DESC, bid_type""")
def kinds_by_institution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _part(spark, sf_dir).select(F.col("p_brand").alias("inst_code"), F.col("p_type").alias("bid_type"))
    return selection.kinds_by_institution(rows)


@REGISTRY("SELECT count(*)::BIGINT AS count FROM events WHERE event_type = 'view'")
def visit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.visits(views.read(spark, sf_dir, "events").filter("event_type = 'view'"))


@REGISTRY("""SELECT p_partkey, row_number() OVER (ORDER BY coalesce(CASE WHEN p_size % 4 > 0 THEN p_brand END, ''), p_type, p_size::VARCHAR,
p_name, p_partkey::VARCHAR)::BIGINT AS place FROM part ORDER BY place LIMIT 500""")
def index_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.when(F.col("p_size") % 4 > 0, F.col("p_brand"))
    rows = selection.index_order(_part(spark, sf_dir).withColumn("brand", brand), ("brand", "p_type", "p_size", "p_name", "p_partkey"))
    first = rows.select("p_partkey").limit(500).agg(F.collect_list("p_partkey").alias("keys"))  # a page of the listing
    return first.select(F.posexplode("keys").alias("place", "p_partkey")).select("p_partkey", (F.col("place") + 1).cast("long").alias("place"))


@REGISTRY("""SELECT event_id, (event_id % 4 = 0) OR (event_id % 3 = 0) OR (event_id % 5 > 0) AS useful FROM events""")
def meaningful_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    json = F.when(n % 4 == 0, F.col("props")).when(n % 4 == 1, "[]").when(n % 4 == 2, " {} ")
    text = F.when(n % 3 == 0, "text").when(n % 3 == 1, "  ")
    files = F.when(n % 5 > 0, F.array(F.lit("a.pdf"))).otherwise(F.array().cast("array<string>"))
    return views.read(spark, sf_dir, "events").select("event_id", selection.meaningful_output(json, text, files).alias("useful"))


@REGISTRY("""SELECT o_orderkey AS id, o_orderkey % 4 = 0 AS quarantined, o_orderkey % 6 = 0 AS inflight,
NOT (o_orderkey % 4 = 0 OR o_orderkey % 6 = 0) AS ready FROM orders""")
def workable_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"))
    twice = rows.filter("id % 4 = 0")
    return selection.workable(rows, twice.unionByName(twice), rows.filter("id % 6 = 0"))


@REGISTRY(f"""WITH {views.SQL} SELECT (CASE corpus WHEN 'legal' THEN '법령' WHEN 'ca' THEN '단협' WHEN 'disclosure' THEN '공시' ELSE '내규' END
|| ' | ' || coalesce(nullif(inst_name, ''), nullif(doc_title, ''), '') || ' | ' || coalesce(doc_title, '') || chr(10) || art_ref || ' '
|| coalesce(nullif(title, ''), '(제목없음)') || '  (유사도: 0.500  부처: ' || coalesce(nullif(ministry, ''), '-') || ')' || chr(10) ||
CASE WHEN length(body) > 300 THEN substr(body, 1, 300) || '…' ELSE body END) AS line FROM a_rows WHERE inst_name IS NOT NULL""")
def rendered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.joined(views.articles(spark, sf_dir), views.documents(spark, sf_dir), views.institutions(spark, sf_dir))
    return search.rendered(rows.filter("inst_name is not null").withColumn("score", F.lit(0.5)))


_SOURCES = """s AS (SELECT p_partkey AS id, p_name AS title, 'http://h/l?lsiSeq=' || p_partkey || '#top' AS source_url, p_type AS category,
'done' AS status, '2020-01-01' AS effective_date FROM part)"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("http://h/l?lsiSeq="), "p_partkey", F.lit("#top"))
    return _part(spark, sf_dir).select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), url.alias("source_url"), F.col("p_type").alias("category"),
        F.lit("done").alias("status"), F.lit("2020-01-01").alias("effective_date"),
    )


@REGISTRY(f"""WITH {_SOURCES} SELECT id, CASE WHEN id % 3 = 0 THEN id::VARCHAR END AS previous_seq, CASE WHEN id % 3 = 0 THEN
'http://h/l?lsiSeq=9' || id || '#top' ELSE source_url END AS source_url, CASE WHEN id % 3 = 0 THEN 'planned' ELSE status END AS status,
CASE WHEN id % 3 = 0 THEN '2024-05-01' ELSE effective_date END AS effective_date FROM s""")
def apply_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New numbers in URLs with a fragment, which must stay."""
    rows = _sources(spark, sf_dir)
    found = rows.filter("id % 3 = 0").select("id", F.concat(F.lit("9"), "id").alias("new_seq"), F.lit("2024-05-01").alias("new_date"))
    return sync.apply_revisions(rows, found).select("id", "previous_seq", "source_url", "status", "effective_date")


@REGISTRY(f"""WITH {_SOURCES}, o AS (SELECT * FROM s WHERE id % 2 = 0), w AS (SELECT id + 1000000 AS id, title, CASE WHEN id % 5 = 0 THEN
source_url ELSE 'http://h/new' || id END AS source_url, category, status, effective_date FROM s) SELECT id, source_url FROM o UNION ALL
SELECT id, source_url FROM w WHERE regexp_extract(source_url, 'lsiSeq=(\\d+)', 1) NOT IN (SELECT regexp_extract(source_url,
'lsiSeq=(\\d+)', 1) FROM o) AND (title, category) NOT IN (SELECT (title, category) FROM o)""")
def add_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sources(spark, sf_dir)
    url = F.when(F.col("id") % 5 == 0, F.col("source_url")).otherwise(F.concat(F.lit("http://h/new"), "id"))
    new = rows.withColumn("source_url", url).withColumn("id", F.col("id") + 1_000_000)
    return sync.add_sources(rows.filter("id % 2 = 0"), new).select("id", "source_url")


@REGISTRY("""SELECT o_orderkey, o_custkey, 'a' AS kind FROM orders WHERE o_custkey % 3 = 0 UNION ALL
SELECT o_orderkey, o_custkey, 'b' FROM orders WHERE o_custkey % 3 <> 0""")
def prefer_first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    first = rows.filter("o_custkey % 3 = 0").withColumn("kind", F.lit("a"))
    return sync.prefer_first_source([first, rows.withColumn("kind", F.lit("b"))], ["o_custkey"])


@REGISTRY("""SELECT id, file_path FROM (SELECT 'i' || p_partkey AS id, p_name || p_partkey AS file_path FROM part WHERE p_partkey % 2 = 0)
UNION ALL SELECT 'z' || p_partkey, p_name || p_partkey FROM part WHERE p_partkey % 2 = 1""")
def add_archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat("p_name", "p_partkey")
    index = _part(spark, sf_dir).filter("p_partkey % 2 = 0").select(F.concat(F.lit("i"), "p_partkey").alias("id"), path.alias("file_path"))
    members = _part(spark, sf_dir).select(F.concat(F.lit("z"), "p_partkey").alias("id"), path.alias("file_path"))
    return sync.add_archive_members(index, members)


@REGISTRY("""SELECT o_orderkey::VARCHAR AS id, 'old' AS form, NULL::BOOLEAN AS seeded FROM orders WHERE o_orderkey % 2 = 0 UNION ALL
SELECT o_orderkey::VARCHAR, 'new', TRUE FROM orders WHERE o_orderkey % 2 = 1""")
def seed_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _orders(spark, sf_dir).select(_text("o_orderkey").alias("id"), "o_orderkey")
    old = ids.filter("o_orderkey % 2 = 0").select("id", F.lit("old").alias("form"))
    new = ids.select("id", F.lit("new").alias("form"))
    blank = spark.createDataFrame([("0", "x"), ("", "x"), (None, "x")], "id string, form string")
    return sync.seed_checkpoint(old, new.unionByName(new).unionByName(blank), "id")


@REGISTRY("""SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 <> 0""")
def without_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh list holds every fifth item; one that has run out holds every third."""
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"))
    now = F.lit("2024-03-01 12:00:00").cast("timestamp")
    lists = rows.filter("id % 5 = 0").withColumn("updated_at", F.lit("2024-03-01 01:00:00").cast("timestamp")).unionByName(
        rows.filter("id % 3 = 0").withColumn("updated_at", F.lit("2024-02-29 23:00:00").cast("timestamp")))
    return queueing.without_pending(rows, lists, now)


@REGISTRY("""SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 < 2 THEN NULL WHEN o_orderstatus = 'F' THEN 'failed'
ELSE 'success' END AS status FROM orders""")
def reset_retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 3
    error = F.when(n == 0, "read timeout (30 s)").when(n == 1, "worker exited").otherwise("empty result")
    status = F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success")
    rows = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), status.alias("status"), error.alias("error"))
    return queueing.reset_retryable(rows, ("timeout", "exited")).drop("error")


@REGISTRY("""SELECT p_partkey, (c >= 20 AND p >= 1 AND c / p >= CASE WHEN p = 1 THEN 70 ELSE 100 END) AS enough
FROM (SELECT p_partkey, p_partkey % 900 AS c, p_size % 9 AS p FROM part)""")
def text_is_enough(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars, pages = F.col("p_partkey") % 900, F.col("p_size") % 9
    return _part(spark, sf_dir).select("p_partkey", F.coalesce(planning.text_is_enough(chars, pages), F.lit(False)).alias("enough"))


@REGISTRY("""SELECT p_partkey, (CASE WHEN p_partkey % 4000 >= 1800 AND p_size % 7 < p_size % 5 AND 50 * p_size % 450 < 400 THEN
least(50 * p_size % 450 + 100, 400) ELSE 50 * p_size % 450 END)::INT AS split FROM part""")
def rebalanced_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    split = planning.rebalanced_split(50 * size % 450, size % 5, size % 7, F.col("p_partkey") % 4000)
    return _part(spark, sf_dir).select("p_partkey", split.cast("int").alias("split"))


@REGISTRY("""SELECT o_orderkey::VARCHAR AS inst_code, trim(o_orderpriority) AS report_no, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR ELSE ''
END AS disclosure_no, '' AS submission_no, CASE WHEN o_orderkey % 3 = 0 THEN '1999' WHEN o_orderkey % 3 = 1 THEN '2031' ELSE '2015' END AS year,
o_orderstatus AS quarter, '' AS period_label, CASE WHEN o_orderkey % 3 = 1 THEN '2031 plan' ELSE 'plan' END AS title FROM orders""")
def normalise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    rows = _orders(spark, sf_dir).select(
        _text("o_orderkey").alias("apbaId"), F.lit("").alias("reportFormNo"), F.concat(F.lit(" "), "o_orderpriority").alias("report_form_root_no"),
        F.when(n % 2 == 0, _text("o_custkey")).alias("disclosureNo"), F.when(n % 3 == 0, "1999").alias("critYyyy"),
        F.col("o_orderstatus").alias("critQuar"), F.when(n % 3 == 1, "2031 plan").otherwise("plan").alias("title"), F.lit("2015.03.01").alias("idate"),
    )
    return catalog.normalise_rows(rows)


@REGISTRY("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'item ' || o_orderkey % 4 END AS item_name FROM orders""")
def resolve_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes as they are, as the first of a list, and unknown ones."""
    n = F.col("o_orderkey") % 4
    code = F.when(n == 0, "c0").when(n == 1, " c1 , x").when(n == 2, "x,c1")
    items = spark.createDataFrame([("c0", "item 0"), ("c1", "item 1")], "code string, item_name string")
    rows = catalog.resolve_items(_orders(spark, sf_dir).select("o_orderkey", code.alias("report_no")), items)
    return rows.select("o_orderkey", F.col("item.item_name").alias("item_name"))


@REGISTRY("""WITH e AS (SELECT unnest([p_partkey, p_partkey + 1])::VARCHAR AS code, p_name || ' ' || p_partkey AS item_name,
split_part(p_type, ' ', 1) AS kind FROM part) SELECT code, max(item_name) AS item_name, max_by(kind, item_name) AS minor_category,
bool_or(kind IN ('STANDARD', 'PROMO')) AS is_scoped FROM e GROUP BY code""")
def scope_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items of two codes each, one of them shared with the next part."""
    key = F.col("p_partkey")
    items = _part(spark, sf_dir).select(
        F.concat(key, F.lit(" , "), key + 1, F.lit(",")).alias("report_form_root_no"), F.concat("p_name", F.lit(" "), key).alias("item_name"),
        F.split_part("p_type", F.lit(" "), F.lit(1)).alias("minor_category"),
    )
    return catalog.scope(items, categories=("STANDARD", "PROMO"))


@REGISTRY("""SELECT c_custkey::VARCHAR AS inst_code FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey % 3 = 1
ORDER BY inst_code LIMIT 20""")
def pick_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("inst_code"), F.col("c_mktsegment").alias("ministry"), _text("c_nationkey").alias("n"),
        (F.col("c_nationkey") % 3).cast("string").alias("type"),
    )
    return catalog.pick_institutions(rows, ministry="BUILDING", kind="1", first=20).select("inst_code")


@REGISTRY("""SELECT o_orderkey FROM orders WHERE o_orderkey % 7 > 1 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-06-01'""")
def converted_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 7
    at = F.when(n == 0, "not a time").when(n > 1, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = _orders(spark, sf_dir).select("o_orderkey", at.alias("converted_at"))
    return catalog.converted_between(rows, "converted_at", "1995-01-01", "1996-06-01").select("o_orderkey")


@REGISTRY("""SELECT '| r_regionkey | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || '\\|x y |',
chr(10) ORDER BY r_regionkey) AS markdown FROM region""")
def markdown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "region").select("r_regionkey", F.concat("r_name", F.lit("|x\ny")).alias("name"))
    return catalog.markdown_table(rows, ["r_regionkey", "name"], ["r_regionkey"])


@REGISTRY("""SELECT p_partkey, p_type AS category, substr(p_name, 1, 6) || CASE WHEN length(p_name) > 6 THEN '…' ELSE '' END AS short FROM part""")
def previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select("p_partkey", F.col("p_type").alias("category"), fn.preview(F.col("p_name"), 6).alias("short"))


@REGISTRY("""SELECT p_partkey, replace(p_name, ' ', '') AS key, CASE WHEN p_size % 3 = 0 THEN 'label' WHEN contains(p_name, 'red') THEN 'warm'
WHEN contains(p_name, 'blue') THEN 'cold' ELSE 'other' END AS family, p_size % 2 = 0 AS sentence, p_size % 4 = 0 AND length(p_name) >= 2
AND length(p_name) <= 60 AS fits, CASE WHEN p_size % 2 = 0 THEN '규정' ELSE '기타' END AS kind FROM part""")
def label_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label keys, families, sentences, rewrites and kinds of documents."""
    name, size = F.col("p_name"), F.col("p_size")
    headed = F.when(size % 3 == 0, F.concat(F.lit("[label] "), name)).otherwise(name)
    text = F.when(size % 2 == 0, "ten letters or more").otherwise("short")
    rewrite = F.when(size % 4 == 0, name).when(size % 4 == 1, F.concat(name, F.lit("?"))).when(size % 4 == 2, "q")
    title = F.when(size % 2 == 0, "인사 규정 전문").otherwise("unnamed")
    return _part(spark, sf_dir).select(
        "p_partkey", fn.label_key(F.concat(F.lit("("), name, F.lit(" :)"))).alias("key"),
        fn.first_family(headed, {"warm": ["red"], "cold": ["blue"]}, "other").alias("family"), fn.is_sentence(text).alias("sentence"),
        fn.rewrite_fits(rewrite, F.lit("a query")).alias("fits"), fn.document_type(title).alias("kind"),
    )


@REGISTRY("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'a_b' || ';' || 'c' END AS tags, p_name || ' <!-- page: ' || (p_size + 10) || ' -->x<!-- page: 11 -->'
AS pages, 'id=' || p_partkey || ' title=' || p_name AS front, p_name || 'z![b](https://h/i.png)' AS images,
'https://h/d?no=' || p_partkey || '&kind=a%2Fb' AS url, 'l' || p_size || '=f.pdf' AS link FROM part""")
def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags, page markers, front matter, images, URLs and links of texts made from names."""
    name, size, key = F.col("p_name"), F.col("p_size"), F.col("p_partkey")
    tags = fn.tags(F.when(size % 2 == 0, "a_b, c,X,").otherwise("A,9"))
    pages = F.concat(name, F.lit(" <!-- page: "), size, F.lit(" -->x<!-- page: 1 -->"))
    meta = fn.front_matter(F.concat(F.lit("---\nid: "), key, F.lit("\ntitle: '"), name, F.lit("'\n---\nbody")))
    links = fn.markdown_links(F.concat(F.lit("![no](x.png) [l"), size, F.lit("](f.pdf)")))
    return _part(spark, sf_dir).select(
        "p_partkey", F.array_join(tags, ";").alias("tags"), fn.shifted_pages(pages, 10).alias("pages"),
        F.concat(F.lit("id="), meta["id"], F.lit(" title="), meta["title"]).alias("front"),
        fn.without_dangling_images(F.concat(name, F.lit("![a](x.png)z![b](https://h/i.png)"))).alias("images"),
        fn.download_url("https://h/d", no=key.cast("string"), kind=F.lit("a/b")).alias("url"),
        F.array_join(F.transform(links, lambda x: F.concat(x["label"], F.lit("="), x["target"])), ",").alias("link"),
    )


@REGISTRY("""SELECT p_partkey AS doc_id, unnest([1, 3, 5])::INT AS line, unnest([2, 1, 0])::INT AS level, unnest([p_name, 'top', 'entry']) AS title FROM part""")
def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("## "), "p_name", F.lit("\nplain\n# top \n####### no\n* [entry](#toc-1)"))
    return extract.headings(_part(spark, sf_dir).select(F.col("p_partkey").alias("doc_id"), text.alias("text")))


@REGISTRY("""SELECT l_orderkey AS doc_id, list_sort(list_distinct(flatten(list([l_returnflag, l_linestatus])))) AS keywords FROM lineitem GROUP BY l_orderkey""")
def field_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("label"), F.array("l_linestatus").alias("aliases")
    )
    return extract.keywords(rows)


@REGISTRY("""SELECT p_partkey AS id, CASE p_size % 3 WHEN 2 THEN 'labor' WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN 'audit' ELSE '_shared' END
ELSE CASE WHEN p_size % 2 = 0 THEN 'audit' END END AS usecases FROM part""")
def with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    corpus = F.when(n % 3 == 0, "legal").when(n % 3 == 1, "bylaws").otherwise("ca")
    labels = F.when(n % 2 == 0, F.array(F.lit("audit"))).otherwise(F.array().cast("array<string>"))
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), corpus.alias("corpus"), labels.alias("usecases"))
    return classify.with_fallback(rows).select("id", F.array_join("usecases", ",").alias("usecases"))


@REGISTRY(f"""WITH {views.SQL} SELECT text_hash, id FROM (SELECT md5(CASE WHEN title = '' THEN '' ELSE title || chr(10) END || substr(body, 1, 4000))
AS text_hash, min(id) AS id, min_by(title, id) AS title FROM a_articles GROUP BY 1) WHERE regexp_matches(title, 'the|an') ORDER BY id LIMIT 200""")
def pending_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.articles(spark, sf_dir)
    none = spark.createDataFrame([], "text_hash string")
    return load.pending(load.queue(load.hashes(articles)), none, 200, articles.select("id", "title"), "the|an")


@REGISTRY(f"""WITH {views.SQL} SELECT 'load' AS script, 'append' AS mode, 'legal' AS corpus, (SELECT count(*) FROM a_documents)::BIGINT AS n_docs,
(SELECT count(*) FROM a_articles)::BIGINT AS n_articles, TRUE AS finished""")
def load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime

    counts = [view(spark, sf_dir).count() for view in (views.documents, views.articles)]
    rows = load.load_run(spark, "load", "append", "legal", *counts, datetime(2024, 1, 1))
    return rows.select("script", "mode", "corpus", "n_docs", "n_articles", F.col("finished_at").isNotNull().alias("finished"))


@REGISTRY(f"""WITH {views.SQL} SELECT doc_id, (sum(n) OVER (ORDER BY doc_id) - n)::BIGINT AS before FROM (SELECT doc_id, count(*) AS n FROM a_articles
GROUP BY doc_id)""")
def article_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's articles start in the order of the corpus."""
    return build.places(views.articles(spark, sf_dir).select("doc_id"), f"{_folder(spark)}/places")


_made: list[tuple[SparkSession, str]] = []


def _folder(spark: SparkSession) -> str:
    """A new folder for what a query writes and reads again, below ``spark.checkpoint.dir`` where it is set; removed when the
    driver ends."""
    import tempfile
    import uuid

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    path = f"{root.rstrip('/')}/corpusloom/query-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may have ended already
            continue


@REGISTRY("SELECT p_partkey, p_name, p_size FROM part")
def json_lines_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    rows = _part(spark, sf_dir).select("p_partkey", "p_name", "p_size")
    writers.write_json_lines(rows, f"{folder}/lines")
    return readers.json_lines(spark, f"{folder}/lines", rows.schema)


@REGISTRY("SELECT p_partkey, p_brand FROM part")
def tables_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in partitions; half of them are written again and the others stay."""
    folder = _folder(spark)
    rows = _part(spark, sf_dir).select("p_partkey", "p_brand")
    load.write_tables({"t": rows}, folder, {"t": "p_brand"})
    load.write_tables({"t": rows.filter(F.col("p_brand") < "Brand#3")}, folder, {"t": "p_brand"})
    return spark.read.parquet(f"{folder}/t").select("p_partkey", "p_brand")


@REGISTRY(f"""WITH {views.SQL} SELECT doc_id, unnest(usecases) AS usecase FROM a_documents""")
def views_by_usecase(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    writers.write_views(views.documents(spark, sf_dir).select("doc_id", "usecases"), f"{folder}/views")
    return spark.read.parquet(f"{folder}/views").select("doc_id", "usecase")


@REGISTRY("""SELECT r_regionkey::VARCHAR AS code, r_name AS item_name FROM region""")
def catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON array of items, as a catalog file holds it."""
    folder = _folder(spark)
    rows = views.read(spark, sf_dir, "region").select(_text("r_regionkey").alias("report_form_root_no"), F.col("r_name").alias("item_name"))
    array = rows.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    array.coalesce(1).write.text(f"{folder}/catalog")
    return readers.catalog(spark, f"{folder}/catalog").select(F.col("report_form_root_no").alias("code"), "item_name")


@REGISTRY("""SELECT p_partkey, '[' || p_type || ']' || p_brand || '_C1/' || 'r1_' || replace(p_name, ' ', ' ') || '/' || p_size AS folder FROM part""")
def report_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = fn.institution_folder(F.col("p_type"), F.col("p_brand"), F.lit("C1"))
    return _part(spark, sf_dir).select("p_partkey", F.concat_ws("/", top, fn.report_folder(F.lit("r1"), F.col("p_name"), _text("p_size"))).alias("folder"))


@REGISTRY("""SELECT p_partkey::VARCHAR AS file, 'row ' || n AS name, v AS value FROM (SELECT p_partkey, unnest([1, 2]) AS n, unnest([p_size::VARCHAR, p_brand]) AS v FROM part)""")
def sheet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two data rows below a header in the second row of a sheet for each part."""
    cells = F.array(*(
        F.struct(F.lit(r).alias("row"), F.lit(c).alias("column"), v.alias("value"))
        for r, c, v in ((0, 0, F.lit("title")), (1, 0, F.lit("inst")), (1, 1, F.lit("value")), (2, 0, F.lit("row 1")), (2, 1, _text("p_size")),
                        (3, 0, F.lit("row 2")), (3, 1, F.col("p_brand")), (4, 1, F.lit("no institution")))
    ))
    rows = _part(spark, sf_dir).select(_text("p_partkey").alias("file"), F.lit("s").alias("sheet"), F.explode(cells).alias("x"))
    found = readers.sheet_records(rows.select("file", "sheet", "x.row", "x.column", "x.value"), "inst")
    return found.groupBy("file", "sheet", "row").agg(
        F.max(F.when(F.col("name") == "inst", F.col("value"))).alias("inst"), F.max(F.when(F.col("name") == "value", F.col("value"))).alias("value")
    ).select("file", F.col("inst").alias("name"), "value")


_LABELS = ("노조 명", "조합원 수", "임직원 수", "일반 정규직", "여성 현원", "기본급", "1인당 평균보수액", "지원 대상", "비 고", "name")
_FOUND = ("노동조합:union_name", "노동조합:members_count", "인력관리:employee_total", "인력관리:regular_employees", "인력관리:gender_breakdown",
          "보수관리:base_salary", None, "복리후생:support_target", "복리후생:remarks", None)
_CELLS = ("해당 없음", "1,234", "전일제", "12:30", "2024년 3월", "about", "3.5%", "합계", "2024 / 3", "12명")


def _listed(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


@REGISTRY(f"""SELECT p_partkey, ({_listed(_FOUND)})[p_size % 10 + 1] AS field, p_size % 10 <> 5 AS is_value FROM part""")
def field_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that the shipped rules find for labels, and cells that count as values."""
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("p_size") % 10)
    return _part(spark, sf_dir).select(
        "p_partkey", extract.field_key(pick(_LABELS)).alias("field"), fn.looks_like_value(pick(_CELLS)).alias("is_value")
    )


@REGISTRY("""SELECT p_partkey AS id, CASE p_size % 5 WHEN 0 THEN 'audit' WHEN 1 THEN 'governance,finance' WHEN 2 THEN 'recruit' WHEN 3 THEN 'labor'
ELSE '' END AS usecases FROM part""")
def keyword_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("청렴 규정", "이사회 예산 규정", "채용 세칙", "단체협약", "기타")))
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.get(names, F.col("p_size") % 5).alias("title"))
    return classify.by_keyword(rows).select("id", F.array_join("usecases", ",").alias("usecases"))


@REGISTRY("""SELECT p_partkey AS id, unnest(CASE p_size % 4 WHEN 0 THEN ['union'] WHEN 1 THEN ['pay', 'jobseeker', 'transfer']
WHEN 2 THEN ['welfare', 'hr'] ELSE ['union', 'hr', 'pay', 'welfare', 'account', 'contract', 'audit', 'planning', 'assembly', 'safety', 'security',
'board', 'jobseeker', 'watchdog', 'transfer'] END) AS role FROM part""")
def role_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles by use case, by code, by group, and of what all share."""
    n = F.col("p_size") % 4
    none = F.array().cast("array<string>")
    rows = _part(spark, sf_dir).select(
        F.col("p_partkey").alias("id"), F.when(n == 0, F.array(F.lit("labor"))).when(n == 3, F.array(F.lit("_shared"))).otherwise(none).alias("usecases"),
        F.when(n == 1, "20601").otherwise("x").alias("code"), F.when(n == 2, F.array(F.lit("travel"), F.lit("edu"))).otherwise(none).alias("groups"),
    )
    return classify.roles(rows, spark.createDataFrame(rules.role_rows(), "role string, kind string, value string"))


@REGISTRY("SELECT n_nationkey::INT AS idx, n_name AS name, greatest(1, ceil((n_nationkey - 1) / 5.0))::INT AS page FROM nation")
def paged_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations as a service that gives seven on each page, two of them again on the next: the first by page stays."""
    rows = [(r[0], r[1]) for r in views.read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int"), "n_name").orderBy("n_nationkey").collect()]

    def fetch(page: int):
        return ((key, name, page) for key, name in rows[5 * page - 5 : 5 * page + 2])

    return readers.paged_source(spark, fetch, "idx int, name string, page int", -(-len(rows) // 5), ["idx"])


@REGISTRY("""SELECT p_partkey, p_partkey || '=' || p_name || ',' || (p_partkey + 1) || '=more' AS files, 'plan:' || (p_partkey + 1) || '=more' AS sections,
p_size || '=' || p_brand AS options, '/a/b:' || p_name || ':c' AS calls FROM part""")
def html_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File links, links below headings, choices and script calls of pages made from parts."""
    key, name = F.col("p_partkey"), F.col("p_name")
    html = F.concat(
        F.lit("<table><tr><th>notes</th><td><a href='x?fileNo="), key, F.lit("'> "), name, F.lit(" </a><a href='x?fileNo="), key,
        F.lit("'>again</a></td><th class='t'> plan </th><td><a href='x?fileNo="), key + 1, F.lit("'>more</a></td></table><option value=\""),
        F.col("p_size"), F.lit("\">"), F.col("p_brand"), F.lit("</option><option value=\"\">none</option><a onclick=\"down('/a/b', '"), name,
        F.lit("','c')\">")
    )
    joined = lambda pairs, a, b: F.array_join(F.transform(pairs, lambda x: F.concat(x[a], F.lit("="), x[b])), ",")
    sections = F.transform(fn.section_files(html, ("plan",)), lambda x: F.concat(x["label"], F.lit(":"), joined(x["files"], "file_no", "name")))
    calls = F.transform(fn.call_arguments(html, "down"), lambda x: F.concat_ws(":", x["a"], x["b"], x["c"]))
    return _part(spark, sf_dir).select(
        "p_partkey", joined(fn.file_links(html), "file_no", "name").alias("files"), F.array_join(sections, ";").alias("sections"),
        joined(fn.option_values(html), "value", "label").alias("options"), F.array_join(calls, ";").alias("calls"),
    )
