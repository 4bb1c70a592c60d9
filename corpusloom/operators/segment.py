"""Documents to lines and articles, by windows over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import group_or_null, strip
from corpusloom.schema import ADDENDUM, MAIN_SECTION

#: fixed patterns: lines that open an article, a chapter or an addendum, after a heading or emphasis mark
MARK = r"^(?:#{1,6}\s*)?(?:\*{1,2}\s*)?"
ARTICLE = MARK + r"제\s*(\d{1,4})\s*조(?:\s*의\s*(\d{1,3}))?(?:\s*\(([^)\n]{1,80})\))?(.*)\z"
CHAPTER = MARK + r"제\s*(\d{1,3})\s*(장|절|편|관)\s*(.*)\z"
ADDENDUM_LINE = MARK + r"부\s?칙\s*(?:\z|[<(（【\[]|제\d|\d)"
#: fixed values: what follows the number where a line only cites an article
CITATION = (
    r"^\s*(?:제\d|및|또는|내지|부터|까지|에\s|의\s|와\s|과\s|은\s|는\s|을\s|를\s|이\s|가\s|에서|으로|로\s)"
)


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_blank: bool = True) -> DataFrame:
    """(key, pos, line): a row for each line, positions from 1."""
    rows = docs.select(key, F.posexplode(F.split(text, "\r?\n", -1)).alias("pos", "line"))
    rows = rows.withColumn("pos", F.col("pos") + 1)
    return rows if keep_blank else rows.filter(strip(F.col("line")) != "")


def plain(text: Column) -> Column:
    """Without emphasis marks and outer white space."""
    return strip(F.regexp_replace(text, r"\*{1,2}", ""))


def articles(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, seq, section, chapter, art_no, art_sub, title, text, n_chars) of every article with a body.

    A line is a boundary if it opens an addendum, a chapter or an article; an untitled article line that goes on as a
    citation is none. What follows a boundary belongs to it up to the next one; chapter lines own nothing. The section
    stays the addendum once one has started, and an addendum clears the chapter.
    """
    rows = lines(docs, key, text)
    line = F.col("line")
    title = plain(F.coalesce(group_or_null(line, ARTICLE, 3), F.lit("")))
    tail = F.regexp_extract(line, ARTICLE, 4)
    is_addendum = F.regexp_like(line, F.lit(ADDENDUM_LINE))
    is_chapter = ~is_addendum & F.regexp_like(line, F.lit(CHAPTER))
    numbered = ~is_addendum & ~is_chapter & F.regexp_like(line, F.lit(ARTICLE))
    is_article = numbered & ~((title == "") & F.regexp_like(tail, F.lit(CITATION)))
    kind = F.when(is_addendum, "addendum").when(is_chapter, "chapter").when(is_article, "article")
    rest = F.when(title == "", plain(tail)).otherwise(strip(tail))
    short = (title == "") & (rest != "") & (F.length(rest) <= 30) & ~F.regexp_like(rest, F.lit(r"[.다]\z"))
    body = (
        F.when(kind == "addendum", F.regexp_replace(plain(line), r"^부\s?칙\s*", ""))
        .when(kind == "article", F.when(short | (rest == ""), F.lit(None)).otherwise(rest))
        .when(kind.isNull(), line)
    )
    heading = F.regexp_extract(line, CHAPTER, 3)
    chapter = F.concat(
        F.lit("제"), F.regexp_extract(line, CHAPTER, 1), F.regexp_extract(line, CHAPTER, 2),
        F.when(heading == "", "").otherwise(F.concat(F.lit(" "), plain(heading))),
    )
    marked = rows.select(
        key, "pos", body.alias("body"), kind.alias("kind"),
        F.when(kind == "article", group_or_null(line, ARTICLE, 1).try_cast("int")).alias("no"),
        F.when(kind == "article", group_or_null(line, ARTICLE, 2).try_cast("int")).alias("sub"),
        F.when(kind == "addendum", ADDENDUM).when(kind == "article", F.when(short, rest).otherwise(title)).alias("title"),
        F.when(kind == "chapter", chapter).when(kind == "addendum", "").alias("chapter"),
    )
    order = Window.partitionBy(key).orderBy("pos")
    marked = marked.select(
        "*",
        F.sum(F.col("kind").isNotNull().cast("int")).over(order).alias("part"),
        F.coalesce(F.last("chapter", ignorenulls=True).over(order), F.lit("")).alias("in_chapter"),
        F.max(F.when(F.col("kind") == "addendum", 1)).over(order).alias("late"),
    )
    grouped = marked.filter("part > 0").groupBy(key, "part").agg(
        F.min_by("kind", "pos").alias("kind"), F.min_by("no", "pos").alias("art_no"), F.min_by("sub", "pos").alias("art_sub"),
        F.min_by("title", "pos").alias("title"), F.min_by("in_chapter", "pos").alias("chapter"),
        F.min_by("late", "pos").alias("late"),
        F.array_sort(F.collect_list(F.when(F.col("body").isNotNull(), F.struct("pos", "body")))).alias("parts"),
    )
    joined = F.array_join(F.transform("parts", lambda x: x["body"]), "\n")
    whole = strip(F.regexp_replace(joined, "[  \u0085]", "\n"))
    kept = grouped.filter("kind <> 'chapter'").withColumn("text", whole).filter("text <> ''")
    return kept.select(
        key, F.row_number().over(Window.partitionBy(key).orderBy("part")).alias("seq"),
        F.when(F.col("late") == 1, ADDENDUM).otherwise(MAIN_SECTION).alias("section"),
        "chapter", "art_no", "art_sub", "title", "text", F.length("text").alias("n_chars"),
    )


def coverage(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", low: float = 0.5) -> DataFrame:
    """(key, n_articles, content_chars, covered_chars, coverage, parse_status); coverage isn't clamped."""
    per_line = F.transform(F.split(text, "\r?\n", -1), lambda x: F.length(strip(x)))
    content = docs.select(key, F.aggregate(per_line, F.lit(0), lambda a, x: a + x).alias("content_chars"))
    sums = found.groupBy(key).agg(F.count("*").alias("n_articles"), F.sum("n_chars").alias("covered_chars"))
    rows = content.join(sums, key, "left").fillna(0, ["n_articles", "covered_chars"])
    ratio = F.when(F.col("content_chars") > 0, F.round(F.col("covered_chars") / F.col("content_chars"), 3)).otherwise(0.0)
    status = F.when(F.col("n_articles") == 0, "no_articles").when(F.col("coverage") < low, "low_coverage").otherwise("ok")
    return rows.withColumn("coverage", ratio).withColumn("parse_status", status)


def coverage_report(rows: DataFrame, key: str = "doc_id", samples: int = 20) -> DataFrame:
    """One row: documents, with and without articles, low ones, articles, mean coverage of parsed ones, samples."""
    parsed = F.col("n_articles") > 0
    low = F.col("parse_status") == "low_coverage"
    count = lambda c: F.sum(c.cast("long"))
    return rows.agg(
        F.count("*").alias("docs"), count(parsed).alias("with_articles"), count(~parsed).alias("without_articles"),
        count(low).alias("low_coverage"), F.sum("n_articles").alias("articles"),
        F.round(F.avg(F.when(parsed, F.col("coverage"))), 6).alias("avg_coverage"),
    ).join(
        rows.filter(~parsed).select(key).orderBy(key).limit(samples).agg(F.sort_array(F.collect_list(key)).alias("samples")),
        how="cross",
    )
