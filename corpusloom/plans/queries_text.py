"""Queries of segmentation, cleaning, audits and extraction.

The given documents have no article numbers, so where a query needs some its input lines get them by position, alike in
Spark and SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as fn
from corpusloom.operators import audit, catalog, chunk, clean, extract, queueing, segment
from corpusloom.plans import views
from corpusloom.plans.registry import Registry
from corpusloom.schema import ADDENDUM, MAIN_SECTION

REGISTRY = Registry()


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.read(spark, sf_dir, "documents").select("doc_id", "text")


_LINES = """lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM (
  SELECT doc_id, string_split_regex(text, '\\r?\\n') AS l FROM documents))"""


@REGISTRY(f"WITH {_LINES} SELECT doc_id, pos::INT AS pos, line FROM lines WHERE trim(line) <> ''")
def line_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.lines(_docs(spark, sf_dir), keep_blank=False)


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their 3rd, 6th, ... lines made articles, the 8th a chapter, the 20th an addendum, the 4th a citation; round
    brackets become square ones, as a title's end is a round one."""
    lines = F.split("text", "\r?\n", -1)

    def mark(line, i):
        n = i + 1
        article = F.concat(F.lit("제"), (n / 3).cast("int"), F.lit("조("), F.substring(line, 1, 8), F.lit(") "), line)
        return (
            F.when(n == 20, F.concat(F.lit("## 부칙 <"), line, F.lit(">")))
            .when(n == 8, F.concat(F.lit("제2장 "), line))
            .when(n == 4, F.concat(F.lit("제1조 및 "), line))
            .when(n % 3 == 0, article).otherwise(line)
        )

    text = F.array_join(F.transform(lines, mark), "\n")
    return _docs(spark, sf_dir).withColumn("text", F.translate("text", "()", "[]")).withColumn("text", text)


_NUMBERED = """l0 AS (SELECT doc_id, string_split_regex(translate(text, '()', '[]'), '\\r?\\n') AS l FROM documents), raw AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS n FROM l0
), lines AS (
  SELECT doc_id, n, line AS own, CASE WHEN n = 20 THEN '## 부칙 <' || line || '>' WHEN n = 8 THEN '제2장 ' || line
    WHEN n = 4 THEN '제1조 및 ' || line WHEN n % 3 = 0 THEN '제' || n // 3 || '조(' || substr(line, 1, 8) || ') ' || line
    ELSE line END AS line,
    CASE WHEN n = 20 THEN 'addendum' WHEN n = 8 THEN 'chapter' WHEN n % 3 = 0 AND line <> '' THEN 'article' END AS kind FROM raw
), marked AS (
  SELECT *, sum(CASE WHEN kind IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS part FROM lines
), parts AS (
  SELECT doc_id, part, min_by(kind, n) AS kind, min(n) AS first, trim(string_agg(CASE kind WHEN 'addendum' THEN NULL
    WHEN 'article' THEN nullif(trim(own), '') ELSE line END, chr(10) ORDER BY n), ' ' || chr(10) || chr(9)) AS body,
    min_by(own, n) AS head FROM marked WHERE part > 0 GROUP BY doc_id, part
)"""


def _articles_sql() -> str:
    """Articles of the numbered documents; addendum and chapter lines hold what was their line."""
    return f"""WITH {_NUMBERED}, bodies AS (
  SELECT doc_id, part, kind, first, head, CASE WHEN kind = 'addendum' THEN trim('## ' || '부칙 <' || regexp_replace(head, '\\*{{1,2}}', '', 'g') || '>' ||
    coalesce(chr(10) || body, ''), chr(10) || ' ') ELSE coalesce(body, '') END AS text FROM parts WHERE kind <> 'chapter'
) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part)::INT AS seq,
  CASE WHEN first >= 20 THEN '{ADDENDUM}' ELSE '{MAIN_SECTION}' END AS section,
  CASE WHEN first BETWEEN 9 AND 19 THEN chapter ELSE '' END AS chapter,
  CASE WHEN kind = 'article' THEN (first // 3)::INT END AS art_no, NULL::INT AS art_sub,
  CASE WHEN kind = 'article' THEN trim(regexp_replace(substr(head, 1, 8), '\\*{{1,2}}', '', 'g')) ELSE '{ADDENDUM}' END AS title, text,
  length(text)::INT AS n_chars
FROM bodies LEFT JOIN (SELECT doc_id, '제2장' || CASE WHEN trim(own) = '' THEN '' ELSE ' ' ||
  trim(regexp_replace(own, '\\*{{1,2}}', '', 'g')) END AS chapter FROM lines
  WHERE n = 8) USING (doc_id) WHERE text <> ''"""


@REGISTRY(_articles_sql())
def article_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.articles(numbered(spark, sf_dir))


_COVERAGE = """per AS (SELECT doc_id, sum(length(trim(line)))::INT AS content_chars,
  sum(CASE WHEN pos % 2 = 0 THEN length(line) ELSE 0 END)::BIGINT AS covered_chars,
  count(*) FILTER (pos % 2 = 0 AND line <> '') AS n_articles FROM lines GROUP BY doc_id), cov AS (
  SELECT *, CASE WHEN content_chars > 0 THEN round(covered_chars / content_chars, 3) ELSE 0.0 END AS coverage,
  CASE WHEN n_articles = 0 THEN 'no_articles' WHEN (CASE WHEN content_chars > 0 THEN round(covered_chars / content_chars, 3)
  ELSE 0.0 END) < 0.5 THEN 'low_coverage' ELSE 'ok' END AS parse_status FROM per)"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    found = segment.lines(docs).filter("pos % 2 = 0 and line <> ''").select("doc_id", F.length("line").alias("n_chars"))
    return segment.coverage(docs, found)


@REGISTRY(f"WITH {_LINES}, {_COVERAGE} SELECT doc_id, content_chars, n_articles, covered_chars, coverage, parse_status FROM cov")
def segment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)


@REGISTRY(f"""WITH {_LINES}, {_COVERAGE} SELECT count(*)::BIGINT AS docs, count(*) FILTER (n_articles > 0)::BIGINT AS with_articles,
count(*) FILTER (n_articles = 0)::BIGINT AS without_articles, count(*) FILTER (parse_status = 'low_coverage')::BIGINT AS
low_coverage, sum(n_articles)::BIGINT AS articles, round(avg(coverage) FILTER (n_articles > 0), 6) AS avg_coverage,
(SELECT list(doc_id ORDER BY doc_id) FROM (SELECT doc_id FROM cov WHERE n_articles = 0 ORDER BY doc_id LIMIT 20)) AS samples
FROM cov""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.coverage_report(_coverage(spark, sf_dir))


@REGISTRY(f"""WITH art AS ({_articles_sql()}), {_NUMBERED}, per AS (SELECT doc_id, sum(length(trim(line)))::INT AS content_chars FROM lines
GROUP BY doc_id), own AS (SELECT doc_id, count(*) AS n, sum(n_chars)::BIGINT AS covered FROM art GROUP BY doc_id)
SELECT doc_id, content_chars, coalesce(n, 0)::BIGINT AS n_articles, coalesce(covered, 0)::BIGINT AS covered_chars,
CASE WHEN content_chars > 0 THEN round(coalesce(covered, 0) / content_chars, 3) ELSE 0.0 END AS coverage,
CASE WHEN n IS NULL THEN 'no_articles' WHEN content_chars = 0 OR round(covered / content_chars, 3) < 0.5 THEN 'low_coverage' ELSE 'ok' END
AS parse_status FROM per LEFT JOIN own USING (doc_id)""")
def article_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of documents by the articles that segmentation finds in them."""
    docs = numbered(spark, sf_dir)
    return segment.coverage(docs, segment.articles(docs))


@REGISTRY("""SELECT count(*)::BIGINT AS docs, sum(o_orderkey % 5)::BIGINT AS chunks, count(*) FILTER (o_orderkey % 5 = 0)::BIGINT AS empty_docs,
count(*) FILTER (o_orderkey % 5 = 4)::BIGINT AS truncated_docs, round(sum(o_orderkey % 5) / count(*), 2) AS avg_chunks_per_doc FROM orders""")
def chunk_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey") % 5
    status = F.when(n == 0, "empty").when(n == 4, "truncated").otherwise("chunked")
    rows = views.read(spark, sf_dir, "orders").select(n.alias("n_articles"), status.alias("parse_status"))
    return chunk.corpus_report(rows)


@REGISTRY()
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunks(_docs(spark, sf_dir))


@REGISTRY()
def chunk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk_report(chunk.chunks(_docs(spark, sf_dir)))


def _joined_sql() -> str:
    """Five passes; in each, of every run of boundaries that may join, the first, third, ... do."""
    starts = "|".join(clean.STARTS).replace(r"[^\S\n]", r"\s").replace("'", "''")
    steps = ["j0 AS (SELECT doc_id, pos AS n, line FROM lines)"]
    for i in range(5):
        steps.append(f"""b{i} AS (SELECT *, next IS NOT NULL AND regexp_matches(line, '[^\\s{clean.ENDS}]\\s*$') AND trim(next) <> ''
  AND NOT regexp_matches(next, '^\\s*(?:{starts})') AS may FROM (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY n) AS next FROM j{i})),
r{i} AS (SELECT *, may AND (n - coalesce(max(CASE WHEN NOT may THEN n END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED
  PRECEDING AND 1 PRECEDING), 0)) % 2 = 1 AS takes FROM b{i}),
t{i} AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY doc_id ORDER BY n), FALSE) AS taken FROM r{i}),
j{i + 1} AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS n, CASE WHEN takes THEN rtrim(line) || ' ' || ltrim(next)
  ELSE line END AS line FROM t{i} WHERE NOT taken)""")
    return f"""WITH lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM (SELECT doc_id,
string_split(text, chr(10)) AS l FROM documents)), {", ".join(steps)} SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS text FROM j5 GROUP BY doc_id"""


@REGISTRY(_joined_sql())
def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.join_broken_lines(_docs(spark, sf_dir))


@REGISTRY("""SELECT doc_id, FALSE AS changed, md5(CASE WHEN contains(text, chr(13) || chr(10)) THEN replace(replace('제1조(a)' || chr(10) ||
'① x' || chr(10) || text, chr(13) || chr(10), chr(10)), chr(10), chr(13) || chr(10)) ELSE '제1조(a)' || chr(10) || '① x' || chr(10) || text END)
AS digest FROM documents""")
def restructure_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents, and whether cleaning them again changes them: it must not."""
    docs = views.read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("제1조(a) ① x\n"), "text").alias("text"))
    return clean.cleaned_again(docs, clean.restructure, {"digest": lambda x: F.md5(x.cast("binary"))})


@REGISTRY(f"""WITH {_LINES}, c AS (SELECT doc_id, pos, CASE WHEN regexp_matches(line, '^\\s*\\|.*\\|\\s*$')
THEN replace(line, '|', '  ') ELSE line END AS s FROM lines WHERE NOT regexp_matches(line, '^\\s*#{{0,6}}\\s*!\\[')
AND NOT regexp_matches(line, '^\\s*\\|?[\\s:|]*-{{2,}}[\\s:|-]*\\|?\\s*$'))
SELECT doc_id, pos::INT AS pos, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(s,
'\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '\\*\\*?', '', 'g'), '^\\s*#{{1,6}}\\s*', ''), '(?i)<br\\s*/?>', ' ', 'g'),
'</?[a-zA-Z][^>]*>', '', 'g'), '\\s+$', '') AS line FROM c""")
def line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_lines(_docs(spark, sf_dir))


@REGISTRY(f"""WITH {_LINES}, n AS (SELECT *, lag(line, 1, '') OVER w AS p, lead(line, 1, '') OVER w AS q FROM lines
WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) SELECT doc_id, pos::INT AS pos, CASE WHEN line LIKE '<!--%' OR
regexp_matches(line, '^\\s*\\|') THEN line ELSE regexp_replace(line, '([^ ]) {{2,}}([^ ])', '\\1 \\2', 'g') END AS line FROM n
WHERE NOT (regexp_matches(trim(line), '^[가-힣A-Za-z0-9]$') AND trim(p) = '' AND trim(q) = '')""")
def line_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalise_lines(segment.lines(_docs(spark, sf_dir)))


_HEADINGS = f"""{_LINES}, hl AS (SELECT doc_id, pos, max(pos) OVER (PARTITION BY doc_id) AS last, CASE WHEN pos % 5 = 1 THEN '### 제' || pos || '조(a)'
WHEN pos % 5 = 3 THEN '제' || pos || '조' ELSE 'see 제' || pos || '조(b) ' || line END AS line FROM lines)"""


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines: every fifth a heading, two after it an article line, the others name one and go on."""
    rows, n = segment.lines(_docs(spark, sf_dir)), F.col("pos")
    line = (
        F.when(n % 5 == 1, F.concat(F.lit("### 제"), n, F.lit("조(a)")))
        .when(n % 5 == 3, F.concat(F.lit("제"), n, F.lit("조")))
        .otherwise(F.concat(F.lit("see 제"), n, F.lit("조(b) "), "line"))
    )
    return rows.withColumn("line", line)


_GAPS = f"""{_HEADINGS}, gaps AS (SELECT CASE WHEN pos % 5 = 3 THEN 'A' ELSE 'B' END AS grade, FALSE AS excluded, doc_id,
pos::INT AS line, pos::INT AS missing, '### 제' || (pos - (pos - 1) % 5) || '조(a)' AS previous,
'### 제' || (pos - (pos - 1) % 5 + 5) || '조(a)' AS next, trim(line, ' ' || chr(9)) AS text FROM hl WHERE pos % 5 <> 1
AND pos - (pos - 1) % 5 + 5 <= last)"""


@REGISTRY(f"WITH {_GAPS} SELECT * FROM gaps")
def heading_gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.heading_gaps(_headings(spark, sf_dir))


@REGISTRY(f"""WITH {_GAPS} SELECT count(*)::BIGINT AS candidates, count(*) FILTER (grade = 'A')::BIGINT AS grade_a,
count(*) FILTER (grade = 'B')::BIGINT AS grade_b, 0::BIGINT AS grade_a_excluded, count(*) FILTER (grade = 'A')::BIGINT AS
eligible, count(DISTINCT doc_id)::BIGINT AS files FROM gaps""")
def heading_gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_summary(audit.heading_gaps(_headings(spark, sf_dir)))


#: document names by id, and article lines bare, titled, and titled with text behind; each fifth line is a heading
_REPAIRS = f"""{_LINES}, rl AS (SELECT doc_id, pos, max(pos) OVER (PARTITION BY doc_id) AS last, doc_id % 4 IN (0, 3) AS of_kind,
CASE WHEN pos % 5 = 1 THEN '## 제' || pos || '조(a)' WHEN pos % 5 = 3 AND pos % 3 = 0 THEN '제' || pos || '조'
WHEN pos % 5 = 3 AND pos % 3 = 1 THEN '제 ' || pos || ' 조 (b) ' WHEN pos % 5 = 3 THEN '제' || pos || '조(c) ' || line ELSE line END AS line FROM lines)"""


def _repairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(lines, candidates) of documents that are agreements, comparisons, regulations and agreements by turns."""
    n, kinds = F.col("pos"), F.array(*map(F.lit, ("단체협약 2024", "임금협약 개정 (안)", "단체협약 운영규정", "2023 보충협약")))
    line = (
        F.when(n % 5 == 1, F.concat(F.lit("## 제"), n, F.lit("조(a)")))
        .when((n % 5 == 3) & (n % 3 == 0), F.concat(F.lit("제"), n, F.lit("조")))
        .when((n % 5 == 3) & (n % 3 == 1), F.concat(F.lit("제 "), n, F.lit(" 조 (b) ")))
        .when(n % 5 == 3, F.concat(F.lit("제"), n, F.lit("조(c) "), "line"))
        .otherwise(F.col("line"))
    )
    named = F.get(kinds, (F.col("doc_id") % 4).cast("int"))
    rows = segment.lines(_docs(spark, sf_dir)).withColumns({"line": line, "name": named})
    names = _docs(spark, sf_dir).select("doc_id", named.alias("name"))
    return rows.drop("name"), audit.heading_candidates(audit.heading_gaps(rows, name="name"), names)


@REGISTRY(f"""WITH {_REPAIRS} SELECT doc_id, pos::INT AS pos, CASE WHEN of_kind AND pos % 5 = 3 AND pos % 3 > 0 AND pos + 3 <= last
AND trim(substr(line, strpos(line, ')') + 1), ' ' || chr(9)) = '' THEN '### ' || trim(line) ELSE line END AS line FROM rl""")
def heading_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.repair_headings(*_repairs(spark, sf_dir)).select("doc_id", "pos", "line")


@REGISTRY(f"""WITH {_REPAIRS} SELECT doc_id, pos::INT AS line, pos::INT AS missing, CASE WHEN trim(substr(line, strpos(line, ')') + 1),
' ' || chr(9)) = '' THEN 'repair' ELSE 'title_body_split_candidate' END AS action FROM rl WHERE of_kind AND pos % 5 = 3 AND pos % 3 > 0 AND pos + 3 <= last""")
def heading_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repairs(spark, sf_dir)[1].select("doc_id", "line", "missing", "action")


@REGISTRY("""SELECT l_orderkey, prev_number, next_number FROM (SELECT l_orderkey, lag(l_linenumber) OVER w AS prev_number,
l_linenumber AS next_number FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)) WHERE next_number - prev_number BETWEEN 2 AND 100""")
def number_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("number")).distinct()
    gaps = audit.number_gaps(rows.withColumn("pos", F.col("number")), "l_orderkey")
    return gaps.select("l_orderkey", "prev_number", "next_number")


_MARKED = ("제1조 (a) ① ", "② two ③ ", "④ ", "1. 가나 2. 다라 ", "3. 마바 ")


def _markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' lines (digits made signs) after a cycle of an article with paragraphs and items."""
    rows, own = segment.lines(_docs(spark, sf_dir)), F.translate("line", "0123456789", "##########")
    head = F.get(F.array(*map(F.lit, _MARKED)), (F.col("pos") - 1) % 5)
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.concat(head, own).alias("line"))


_MARKERS = f"""{_LINES}, ml AS (SELECT doc_id, pos, max(pos) OVER (PARTITION BY doc_id) AS last, (pos - 1) % 5 + 1 AS k,
translate(line, '0123456789', '##########') AS own FROM lines), m(k, level, "offset", marker, reason) AS (VALUES
(1, 'paragraph', 8, '①', 'first'), (2, 'paragraph', 6, '③', 'middle'), (4, 'item', 6, '2.', 'middle'))"""


@REGISTRY(f"""WITH {_MARKERS} SELECT doc_id, pos::BIGINT AS pos, level, "offset", marker, reason FROM ml JOIN m USING (k) WHERE pos < last""")
def neighbour_marker_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _markers(spark, sf_dir)
    return audit.marker_gaps(audit.markers(rows), rows)


@REGISTRY(f"""WITH {_MARKERS}, h(k, whole, broken) AS (VALUES (1, '{_MARKED[0]}', '제1조 (a)' || chr(10) || '① '), (2, '{_MARKED[1]}',
'② two' || chr(10) || '③ '), (3, '{_MARKED[2]}', '④ '), (4, '{_MARKED[3]}', '1. 가나' || chr(10) || '2. 다라 '), (5, '{_MARKED[4]}', '3. 마바 '))
SELECT doc_id, pos::BIGINT AS pos, CASE WHEN pos < last THEN broken ELSE whole END || own AS line FROM ml JOIN h USING (k)""")
def marker_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _markers(spark, sf_dir)
    return audit.repair_markers(rows, audit.marker_gaps(audit.markers(rows), rows)).select("doc_id", "pos", "line")


_TEXT = """trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
regexp_replace({}, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'),
'&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&apos;', ''''), '&quot;', '"'), '\\s+', ' ', 'g'))"""


@REGISTRY(f"SELECT page_id, {_TEXT.format('html')} AS text FROM pages")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.read(spark, sf_dir, "pages").select("page_id", fn.html_to_text(F.col("html")).alias("text"))


@REGISTRY(f"""SELECT page_id, pos::INT AS pos, href, {_TEXT.format("body")} AS label FROM (SELECT page_id,
unnest(range(len(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>')))) AS pos,
unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2)) AS body FROM pages)""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "pages").select("page_id", F.posexplode(fn.links(F.col("html"))).alias("pos", "x"))
    return rows.select("page_id", "pos", "x.href", "x.label")


@REGISTRY(f"""WITH {_LINES}, t AS (SELECT doc_id, pos, trim(regexp_replace(line, '\\[([^\\]]+)\\]\\(([^)]+)\\)', '\\1', 'g')) AS s
FROM lines) SELECT doc_id, trim(regexp_extract(s, p, 1)) AS label, trim(regexp_extract(s, p, 2)) AS value,
'markdown_line' AS source_type, 'line:' || pos AS source_ref, pos::INT AS line FROM (SELECT *,
CASE WHEN regexp_matches(s, '^(.+?)\\s*[:：]\\s*(.+)$') THEN '^(.+?)\\s*[:：]\\s*(.+)$'
WHEN regexp_matches(s, '^(.+?)\\s*-\\s*(.+)$') AND length(regexp_extract(s, '^(.+?)\\s*-\\s*(.+)$', 1)) <= 40
THEN '^(.+?)\\s*-\\s*(.+)$' END AS p FROM t WHERE s <> '' AND NOT contains(s, '|')) WHERE p IS NOT NULL""")
def md_lines_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.line_pairs(_docs(spark, sf_dir))


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    text = F.concat_ws("\n", F.lit("| name | size | price |"), F.lit("|---|---|---|"),
                       F.concat(F.lit("| "), "p_name", F.lit(" | "), "p_size", F.lit(" | 1,000 |")), F.lit("after"),
                       F.concat(F.lit("| key | "), key, F.lit(" |")))
    return views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), text.alias("text"))


@REGISTRY("""SELECT p_partkey AS doc_id, label, value, 'markdown_table' AS source_type, 'table:1:row:3:col:' || n AS source_ref,
3 AS line, label AS column_label FROM (SELECT p_partkey, unnest(['name', 'size', 'price']) AS label,
unnest([p_name, p_size::VARCHAR, '1,000']) AS value, unnest([1, 2, 3]) AS n FROM part)""")
def table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.table_records(_tables(spark, sf_dir))


_RULES = [("part:name", "^name"), ("part:size", "siz"), ("part:any", ".*")]


@REGISTRY("""SELECT p_partkey AS doc_id, field, label, value, [label] AS aliases, 1::BIGINT AS n_sources FROM (
SELECT p_partkey, unnest(['part:name', 'part:size', 'part:any']) AS field, unnest(['name', 'size', 'price']) AS label,
unnest([p_name, p_size::VARCHAR, '1,000']) AS value FROM part)""")
def field_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.roll_up(extract.table_records(_tables(spark, sf_dir)), _RULES)


@REGISTRY("""SELECT event_id, substr(t.fullkey, 3) AS path, t.atom::VARCHAR AS value FROM events e, json_tree(e.props) t
WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'NULL')""")
def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.json_leaves(views.read(spark, sf_dir, "events"), "event_id", "props")


@REGISTRY("""SELECT p_partkey AS id, 'ministry' || p_size AS ministry, p_name AS inst_name, 'C' || p_partkey AS inst_code,
'20240131' AS doc_date, p_type AS doc_title FROM part""")
def path_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("[ministry"), "p_size", F.lit("]"), "p_name", F.lit("_C"), "p_partkey", F.lit("/x/"), "p_type",
                    F.lit("_20240131.md"))
    rows = views.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), path.alias("rel_path"))
    return catalog.path_metadata(rows).drop("rel_path")


@REGISTRY("""SELECT o_orderkey, strftime(d, '%Y.%m.%d') AS dotted, strftime(d, '%Y-%m-%d') AS iso,
year(d)::VARCHAR AS year, o_orderpriority || '_x' AS segment, md5(o_orderkey || '-' || o_custkey) AS record
FROM (SELECT *, o_orderdate + INTERVAL 10 YEAR AS d FROM orders)""")
def scalar_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.functions.planning import record_id

    digits = F.date_format(F.add_months("o_orderdate", 120), "yyyyMMdd")
    return views.read(spark, sf_dir, "orders").select(
        "o_orderkey", fn.dotted_date(digits).alias("dotted"), fn.date_in_name(F.concat(F.lit("a_"), digits)).alias("iso"),
        fn.year_of(digits, F.lit("")).alias("year"), fn.safe_segment(F.concat("o_orderpriority", F.lit(":x "))).alias("segment"),
        record_id(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("record"),
    )


@REGISTRY("""SELECT p_partkey, upper(p_brand) AS ext, p_size >= 25 AS is_large FROM part
ORDER BY CASE p_brand WHEN 'Brand#12' THEN 0 WHEN 'Brand#11' THEN 1 ELSE 2 END, p_partkey LIMIT 100""")
def by_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.read(spark, sf_dir, "part").select("p_partkey", F.upper("p_brand").alias("ext"), F.col("p_size").alias("size"))
    return queueing.by_extension(rows, ["BRAND#12", "BRAND#11"], 25, "p_partkey").drop("size").limit(100)
