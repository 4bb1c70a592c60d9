"""The engine's tables as views over the given ones, in Spark and, for the oracle, in SQL.

Lines of a document that aren't blank are its articles; positions are made within the row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schema import MAIN_SECTION


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lines(text):
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\r?\n", -1), lambda x: F.trim(x) != "")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(_lines(F.col("text"))).alias("pos", "body"))
    seq = F.col("pos") + 1
    return rows.select(
        (F.col("doc_id") * 1_000_000 + seq).alias("id"), "doc_id", seq.alias("seq"), F.lit(MAIN_SECTION).alias("section"),
        F.lit(None).cast("string").alias("chapter"), seq.alias("art_no"), F.when(seq % 7 == 0, 2).alias("art_sub"),
        F.substring("body", 1, 40).alias("title"), "body", F.length("body").alias("n_chars"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 4
    corpus = F.when(kind == 0, "legal").when(kind == 1, "ca").when(kind == 2, "bylaws").otherwise("disclosure")
    tags = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("audit"))).when(
        F.col("doc_id") % 3 == 1, F.array(F.lit("labor"), F.lit("finance"))
    )
    first = F.get(_lines(F.col("text")), F.lit(0))
    return rows.select(
        "doc_id", corpus.alias("corpus"), F.concat_ws(":", corpus, F.col("doc_id").cast("string")).alias("rel_path"),
        F.col("source").alias("inst_code"), F.substring(first, 1, 40).alias("doc_title"),
        F.lit(None).cast("string").alias("alias"), F.col("lang").alias("doc_type"), tags.alias("usecases"),
    )


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").filter("source is not null").groupBy(F.col("source").alias("inst_code"))
    return rows.agg(F.concat(F.lit("inst "), F.first("source")).alias("inst_name"), F.min("lang").alias("ministry"))


#: SQL of the same views, to stand after WITH
SQL = f"""
a_lines AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\\r?\\n'), lambda x: trim(x) <> '') AS l, source, lang
  FROM documents
), a_articles AS (
  SELECT doc_id * 1000000 + seq AS id, doc_id, seq::INT AS seq, '{MAIN_SECTION}' AS section, NULL::VARCHAR AS chapter,
    seq::INT AS art_no, CASE WHEN seq % 7 = 0 THEN 2 END AS art_sub, substr(body, 1, 40) AS title, body,
    length(body)::INT AS n_chars
  FROM (SELECT doc_id, unnest(l) AS body, unnest(range(1, len(l) + 1)) AS seq FROM a_lines)
), a_documents AS (
  SELECT doc_id, corpus, corpus || ':' || doc_id AS rel_path, source AS inst_code, substr(l[1], 1, 40) AS doc_title,
    NULL::VARCHAR AS alias, lang AS doc_type,
    CASE doc_id % 3 WHEN 0 THEN ['audit'] WHEN 1 THEN ['labor', 'finance'] END AS usecases
  FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'legal' WHEN 1 THEN 'ca' WHEN 2 THEN 'bylaws' ELSE 'disclosure' END AS corpus
    FROM a_lines)
), a_institutions AS (
  SELECT source AS inst_code, 'inst ' || source AS inst_name, min(lang) AS ministry FROM documents
  WHERE source IS NOT NULL GROUP BY source
), a_rows AS (
  SELECT a.*, d.* EXCLUDE (doc_id), i.inst_name, i.ministry, '제' || a.art_no || '조' ||
    CASE WHEN a.art_sub IS NULL THEN '' ELSE '의' || a.art_sub END AS art_ref
  FROM a_articles a JOIN a_documents d USING (doc_id) LEFT JOIN a_institutions i USING (inst_code)
)"""


def trigram_sql(text: str) -> str:
    """SQL of the distinct trigrams of a text."""
    return (
        f"list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), "
        "lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), "
        "lambda i: substr('  ' || w || ' ', i::INT, 3)))))"
    )


def similarity_sql(a: str, b: str) -> str:
    """SQL of the trigram similarity of two texts."""
    x, y = trigram_sql(a), trigram_sql(b)
    return f"(len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y}))))"


def cosine_sql(a: str, b: str) -> str:
    """SQL of the cosine similarity of two vectors, summed in doubles from left to right."""
    def dot(x: str, y: str) -> str:
        return f"list_sum(list_transform(list_zip({x}, {y}), lambda p: p[1]::DOUBLE * p[2]::DOUBLE))"

    return f"({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"
