"""Which files and rows a run works on, and what it reports about them at the end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: names of corpora and of use cases in listings
CORPUS_LABELS = {"legal": "법령", "ca": "단협", "disclosure": "공시"}
OTHER_CORPUS = "내규"
USECASE_LABELS = {
    "recruit": "01_채용정보", "audit": "02_감사대응징계", "governance": "03_거버넌스국민감시", "labor": "04_노사관계",
    "finance": "05_재무보수경영", "_shared": "00_공유법령참조",
}
#: what a converted file tells about its source; blank where the source is unknown
METADATA = ("inst_name", "ministry", "inst_code", "scd", "item_name", "minor_category", "year", "source_url")


def holding(rows: DataFrame, needle: str, text: str = "text") -> DataFrame:
    """Rows whose text holds a string as it is."""
    return rows.filter(F.col(text).contains(needle))


def by_parser(rows: DataFrame, parser: str, column: str = "parser") -> DataFrame:
    """Rows by their parser: ``all``, any whose name holds ``ocr`` in either case, or an exact name."""
    if parser == "all":
        return rows
    name = F.coalesce(F.col(column), F.lit(""))
    return rows.filter(F.lower(name).contains("ocr") if parser == "ocr" else name == parser)


def by_scope(rows: DataFrame, scope: str, words: Sequence[str] = (), usecases: Sequence[str] = (), listed: bool = False,
             name: str = "file_name", labels: str = "usecases") -> DataFrame:
    """Rows in a scope: everything for ``all`` and for listed files, names with a word for ``agreements``, labelled rows (with
    one of the use cases, if some are given) for ``expanded``; none for another scope."""
    if listed or scope == "all":
        return rows
    if scope == "agreements":
        hit = F.lit(False)
        for word in words:
            hit = hit | F.col(name).contains(word)
        return rows.filter(hit)
    if scope != "expanded":
        return rows.filter(F.lit(False))
    rows = rows.filter(F.size(F.coalesce(labels, F.array().cast("array<string>"))) > 0)
    return rows.filter(F.arrays_overlap(labels, F.array(*map(F.lit, usecases)))) if usecases else rows


def by_patterns(rows: DataFrame, include: str | None = None, exclude: str | None = None, column: str = "title") -> DataFrame:
    """Rows that match one pattern and don't match another; a pattern that isn't given doesn't count."""
    text = F.coalesce(F.col(column), F.lit(""))
    rows = rows.filter(F.regexp_like(text, F.lit(include))) if include else rows
    return rows.filter(~F.regexp_like(text, F.lit(exclude))) if exclude else rows


def extension(name: Column) -> Column:
    """What follows the last dot of a name, in lower case; the whole name without one."""
    return F.lower(F.element_at(F.split(name, r"\."), -1))


def convertible(rows: DataFrame, extensions: Sequence[str], name: str = "file_name", downloaded: str = "downloaded") -> DataFrame:
    """Downloaded files of the given extensions."""
    return rows.filter(F.coalesce(F.col(downloaded), F.lit(False)) & extension(F.col(name)).isin(*extensions))


def labelled(value: Column, labels: Mapping[str, str], default: str) -> Column:
    """A listing's name for a value."""
    out = F.lit(default)
    for key, label in labels.items():
        out = F.when(value == key, label).otherwise(out)
    return out


def with_metadata(rows: DataFrame, known: DataFrame, key: str = "id", columns: Sequence[str] = METADATA) -> DataFrame:
    """Rows with what is known of their key; blanks where nothing is, or where a field is null."""
    found = rows.join(known.select(key, *(F.col(c).cast("string") for c in columns)), key, "left")
    return found.fillna("", list(columns))


def alias_by_title(documents: DataFrame, names: DataFrame) -> DataFrame:
    """``alias`` from (title, alias) by the document's title, where there is one; else it stays. Of several the first in order."""
    new = names.groupBy(F.col("title").alias("doc_title")).agg(F.min("alias").alias("_alias"))
    found = documents.join(new, "doc_title", "left")
    return found.withColumn("alias", F.coalesce("_alias", "alias")).drop("_alias")


def corpus_totals(documents: DataFrame, articles: DataFrame, queue: DataFrame, embeddings: DataFrame) -> DataFrame:
    """One row: documents, articles of each corpus, queued texts and embedded ones."""
    named = articles.join(documents.select("doc_id", "corpus"), "doc_id")
    each = named.groupBy("corpus").agg(F.count("*").alias("n"))
    by_corpus = each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("corpus", "n")))).alias("articles"))
    counts = [documents.agg(F.count("*").alias("documents")), queue.agg(F.count("*").alias("queued"))]
    out = by_corpus
    for one in [*counts, embeddings.agg(F.count("*").alias("embedded"))]:
        out = out.crossJoin(one)  # a row each
    return out.select("documents", "articles", "queued", "embedded")


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).filter(F.col(column).isNotNull()).distinct()


def level_counts(rows: DataFrame, level: str = "level") -> DataFrame:
    """(level, n), and a row ``total`` for all."""
    return rows.groupBy(F.coalesce(F.col(level), F.lit("")).alias(level)).agg(F.count("*").alias("n")).unionByName(
        rows.agg(F.lit("total").alias(level), F.count("*").alias("n"))
    )


def status_totals(rows: DataFrame) -> DataFrame:
    """One row: all files, those that succeeded, failed or wait for recognition, and those whose text was reused."""
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0)).cast("long")
    status = F.col("status")
    return rows.agg(
        F.count("*").alias("files"), count(status == "success").alias("success"), count(status == "failed").alias("failed"),
        count(status == "ocr_needed").alias("ocr_needed"), count(F.col("parser") == "hash_reuse").alias("hash_reused"),
    )


def kinds_by_institution(rules: DataFrame, institution: str = "inst_code", kind: str = "bid_type") -> DataFrame:
    """(kind, institutions): how many institutions have a rule of each kind, the most common kind first."""
    each = rules.select(institution, kind).distinct()
    return each.groupBy(kind).agg(F.count("*").alias("institutions")).orderBy(F.desc("institutions"), kind)


def visits(events: DataFrame) -> DataFrame:
    """One row: how many visits there were; the events are the counter, so nothing is updated in place."""
    return events.agg(F.count("*").alias("count"))


def index_order(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a file index in order of its columns; a missing field sorts as a blank one."""
    return rows.orderBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def meaningful_output(json: Column, markdown: Column, files: Column) -> Column:
    """Whether a crawl gave anything: JSON that isn't null or empty, text that isn't blank, or a file."""
    has_json = ~F.coalesce(F.trim(json), F.lit("null")).isin("", "null", "[]", "{}")
    return has_json | (F.trim(F.coalesce(markdown, F.lit(""))) != "") | (F.coalesce(F.size(files), F.lit(0)) > 0)


def workable(rows: DataFrame, quarantined: DataFrame, inflight: DataFrame, key: str = "id") -> DataFrame:
    """Adds ``quarantined`` and ``inflight`` from lists of keys; ``ready`` rows are in neither."""
    for name, listed in (("quarantined", quarantined), ("inflight", inflight)):
        flag = listed.select(key).distinct().withColumn(name, F.lit(True))
        rows = rows.join(flag, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return rows.withColumn("ready", ~F.col("quarantined") & ~F.col("inflight"))
