"""Article search: exact reference, keyword, semantic and hybrid, with three presets of limits.

``articles``, ``documents`` and ``institutions`` follow ``corpusloom.schema``. Optional filters are added only where set,
so the scan gets just those that apply. Scores are doubles rounded to three places. A text without a title has no
similarity and counts as 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.similarity import THRESHOLD, cosine, keyword_trigrams, trigram_similarity, trigrams
from corpusloom.functions.text import ARTICLE_REFERENCE, article_label
from corpusloom.operators.ranking import (
    best_of_variants,
    corpus_fan_out,
    corpus_rank,
    first_by,
    one_by_institution,
    reciprocal_rank_fusion,
)
from corpusloom.operators.selection import CORPUS_LABELS, OTHER_CORPUS, labelled
from corpusloom.schema import MAIN_SECTION

SCORE_FLOOR = 0.28
RESULT = ("inst_name", "ministry", "doc_title", "doc_type", "corpus", "rel_path", "art_ref", "art_title", "body", "n_chars")
#: sort place of corpora in one ranked list, others after these
LIST_ORDER = {"legal": 0, "ca": 1}


@dataclass(frozen=True)
class SearchSpec:
    """One search. ``None`` leaves a filter out; ``escape`` takes % and _ of a keyword literally."""

    keyword: str = ""
    corpus: str = "all"
    type: str | None = None
    inst: str | None = None
    ministry: str | None = None
    usecases: tuple[str, ...] | None = None
    section: str = MAIN_SECTION
    body: bool = False
    group: bool = False
    limit: int = 15
    escape: bool = False
    #: preset: most rows, fan-out over corpora, floor of semantic scores
    most: int = 300
    fan_out: bool = True
    floor: float | None = SCORE_FLOOR

    def clamped(self) -> SearchSpec:
        return replace(self, limit=min(self.most, max(1, self.limit)))

    @property
    def filtered(self) -> bool:
        return self.corpus != "all" or any((self.type, self.inst, self.ministry, self.usecases))


def cli_spec(**values) -> SearchSpec:
    """Command line preset: at most 100 rows, one list over all corpora, no floor."""
    return SearchSpec(**{"most": 100, "fan_out": False, "floor": None} | values).clamped()


def http_spec(**values) -> SearchSpec:
    """Service preset: at most 300 rows, fan-out with round-robin, floor 0.28, keyword of 100 characters."""
    values["keyword"] = values.get("keyword", "")[:100]
    return SearchSpec(**values).clamped()


def tool_spec(**values) -> SearchSpec:
    """Tool preset: at most 50 rows, 10 by default, one list, no floor."""
    return SearchSpec(**{"most": 50, "limit": 10, "fan_out": False, "floor": None} | values).clamped()


def _contains(column: Column, value: str, escape: bool) -> Column:
    return F.lower(column).contains(value.lower()) if escape else column.ilike(f"%{value}%")


def joined(articles: DataFrame, documents: DataFrame, institutions: DataFrame) -> DataFrame:
    """Articles with their document and institution."""
    documents = documents.withColumnRenamed("n_articles", "_n") if "n_articles" in documents.columns else documents
    rows = articles.join(documents.drop("_n"), "doc_id").join(institutions, "inst_code", "left")
    label = article_label(F.col("art_no"), F.col("art_sub"))
    return rows.withColumn("art_ref", label).withColumn("art_title", F.col("title"))


def apply_filters(rows: DataFrame, spec: SearchSpec) -> DataFrame:
    rows = rows.filter(F.col("section") == spec.section)
    if spec.corpus != "all":
        rows = rows.filter(F.col("corpus") == spec.corpus)
    for column, value in (("doc_type", spec.type), ("inst_name", spec.inst), ("ministry", spec.ministry)):
        if value:
            rows = rows.filter(_contains(F.col(column), value, spec.escape))
    if spec.usecases:
        rows = rows.filter(F.arrays_overlap("usecases", F.array(*map(F.lit, spec.usecases))))
    return rows


def list_order() -> list[Column]:
    return [F.desc("score"), corpus_rank(F.col("corpus"), LIST_ORDER), F.col("inst_name").asc_nulls_last(), F.col("id")]


def exact_article(rows: DataFrame, spec: SearchSpec) -> DataFrame | None:
    """Articles by the number that the keyword names; None if it names none."""
    named = re.search(ARTICLE_REFERENCE, spec.keyword)
    if not named:
        return None
    found = apply_filters(rows, spec).filter(F.col("art_no") == int(named[1]))
    if named[2]:
        found = found.filter(F.col("art_sub") == int(named[2]))
    return found.withColumn("score", F.lit(1.0)).orderBy(*list_order()[1:]).limit(spec.limit)


@dataclass(frozen=True)
class IndexScores:
    """(id, similarity) of the articles and of the documents whose titles reach the threshold, from a stored index."""

    articles: DataFrame
    documents: DataFrame


def named_articles(articles: DataFrame, indexed: IndexScores) -> DataFrame:
    """The articles that a keyword search can show: those with a score, and all of documents with one. To be met with their
    documents, so that the others aren't; ``indexed`` should be stored, it is read for each kind."""
    own = indexed.articles.select("id", F.lit(True).alias("_own"))
    of_document = indexed.documents.select(F.col("id").alias("doc_id"), F.lit(True).alias("_of_document"))
    return articles.join(own, "id", "left").join(of_document, "doc_id", "left").filter("_own OR _of_document").select(articles.columns)


def keyword_hits(
    rows: DataFrame, spec: SearchSpec, documents: DataFrame | None = None, indexed: IndexScores | None = None
) -> DataFrame:
    """Scored rows: article hits, and but for the disclosure corpus each matching document's first article.

    ``documents``: the table of documents, one row each; without it names are taken from the rows of their articles.
    ``indexed``: scores of the keyword from a stored index, in place of cutting every title into trigrams; a search in
    bodies reads the bodies all the same.

    The branches aren't deduplicated: an article that hits both ways is there twice.
    """
    word = spec.keyword[:40]
    rows = apply_filters(rows, spec)
    score = F.round(F.coalesce(trigram_similarity(F.col("title"), word), F.lit(0.0)), 3)
    if spec.body:
        keyword = spec.keyword[:40]
        hit = _contains(F.col("title"), keyword, spec.escape) | _contains(F.col("body"), keyword, spec.escape)
        articles = rows.filter(F.coalesce(hit, F.lit(False))).withColumn("score", score)
    else:
        if indexed is not None:
            articles = rows.join(indexed.articles.withColumnRenamed("similarity", "_raw"), "id")
        else:
            articles = rows.withColumn("_raw", trigram_similarity(F.col("title"), word)).filter(F.col("_raw") >= THRESHOLD)
        articles = articles.withColumn("score", F.round("_raw", 3)).drop("_raw").select(*rows.columns, "score")
    if spec.corpus == "disclosure":
        return articles
    # documents are scored by themselves, and only those that match meet their articles
    firsts = _first_articles(rows, _matching(rows, word, documents, indexed))
    return articles.unionByName(firsts)


def _matching(rows: DataFrame, word: str, documents: DataFrame | None, indexed: IndexScores | None) -> DataFrame:
    """(doc_id, _raw) of the documents whose title or alias reaches the threshold."""
    if indexed is not None:
        return indexed.documents.select(F.col("id").alias("doc_id"), F.col("similarity").alias("_raw"))
    names = rows.select("doc_id", "doc_title", "alias") if documents is None else documents.select("doc_id", "doc_title", "alias")
    by_title = F.coalesce(trigram_similarity(F.col("doc_title"), word), F.lit(0.0))
    by_alias = F.coalesce(trigram_similarity(F.col("alias"), word), F.lit(0.0))
    raw = F.greatest(by_title, by_alias)
    matched = names.select("doc_id", raw.alias("_raw")).filter(F.col("_raw") >= THRESHOLD)
    return matched.distinct() if documents is None else matched


def _first_articles(rows: DataFrame, matched: DataFrame) -> DataFrame:
    """The first article of each matching document, with the document's score."""
    firsts = first_by(rows.join(matched, "doc_id"), ["doc_id"], [F.col("art_no").asc_nulls_last(), F.col("id")])
    return firsts.withColumn("score", F.round("_raw", 3)).drop("_raw").select(*rows.columns, "score")


def keyword_search(
    rows: DataFrame, spec: SearchSpec, documents: DataFrame | None = None, indexed: IndexScores | None = None
) -> DataFrame:
    """Keyword search with routing: article numbers are looked up, other keywords are matched by trigrams."""
    exact = exact_article(rows, spec)
    if exact is not None:
        return exact
    fetch = min(300, spec.limit * 4) if spec.group else spec.limit
    hits = keyword_hits(rows, spec, documents, indexed)
    if spec.corpus == "all" and spec.fan_out:
        found = corpus_fan_out(hits, [F.col("inst_name").asc_nulls_last(), F.col("id")], fetch)
    else:
        found = hits.orderBy(*list_order()).limit(fetch)
    return one_by_institution(found, list_order()).orderBy(*list_order()).limit(spec.limit) if spec.group else found


def title_postings(rows: DataFrame, key: str, text_col: str) -> DataFrame:
    """(gram, key, n): the trigrams of each row's text and how many it has. Store it sorted by ``gram``: a search then
    reads the few row groups of its keyword's trigrams and no text at all."""
    grams = trigrams(F.col(text_col))
    listed = rows.filter(F.col(text_col).isNotNull()).select(key, grams.alias("grams"))
    return listed.select(F.explode("grams").alias("gram"), key, F.size("grams").alias("n"))


def posting_counts(postings: DataFrame, key: str, keyword: str) -> DataFrame:
    """(key, shared, n) of the rows that share a trigram with the keyword."""
    found = postings.filter(F.col("gram").isin(keyword_trigrams(keyword)))
    return found.groupBy(key).agg(F.count("*").alias("shared"), F.first("n").alias("n"))


def posting_scores(postings: DataFrame, key: str, keyword: str, threshold: float = THRESHOLD) -> DataFrame:
    """(key, similarity) of the rows that reach the threshold, from stored postings alone."""
    found = posting_counts(postings, key, keyword)
    similarity = F.col("shared") / (F.col("n") + len(keyword_trigrams(keyword)) - F.col("shared"))
    return found.select(key, similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


def posting_prefilter(rows: DataFrame, postings: DataFrame, key: str, keyword: str, threshold: float = THRESHOLD) -> DataFrame:
    """Rows that share enough trigrams with a keyword to reach the threshold, by stored postings.

    The similarity can't reach t unless at least t of the keyword's trigrams are shared.
    """
    least = math.ceil(len(keyword_trigrams(keyword)) * threshold)
    return rows.join(posting_counts(postings, key, keyword).filter(F.col("shared") >= least).select(key), key, "left_semi")


def nearest(rows: DataFrame, embeddings: DataFrame, hashes: DataFrame, query: list[float], spec: SearchSpec,
            queue: DataFrame | None = None) -> DataFrame:
    """Exact cosine neighbours. Without filters one article stands for each text (``queue``); with filters all copies
    of a text are candidates, as the representative may fail the filter. Filtering comes before scoring."""
    vector = F.array(*(F.lit(float(x)) for x in query))
    rows = apply_filters(rows, spec)
    links = hashes if spec.filtered or queue is None else queue
    scored = rows.join(links.select("id", "text_hash"), "id").join(embeddings.select("text_hash", "embedding"), "text_hash")
    scored = scored.withColumn("_cosine", cosine(F.col("embedding"), vector))
    return scored.orderBy(F.desc("_cosine"), "id").limit(spec.limit).withColumn("score", F.round("_cosine", 3)).drop("_cosine")


def candidates(rows: DataFrame, spec: SearchSpec, most: int = 20_000) -> DataFrame:
    """Ids that pass the filters, one more than ``most`` at the most, for a first stage that narrows the second."""
    return apply_filters(rows, spec).select("id").limit(most + 1)


def narrowed(rows: DataFrame, spec: SearchSpec, most: int = 20_000) -> DataFrame:
    """First stage of a filtered search: rows of the ids that pass, where there are few; else the rows as they are.

    The ids are counted before they are broadcast; where none passes, nothing is left to score.
    """
    ids = candidates(rows, spec, most)
    found = ids.count()
    if not found:
        return rows.limit(0)
    return rows.join(F.broadcast(ids), "id", "left_semi") if found <= most else rows


def semantic_search(arms: list[DataFrame], spec: SearchSpec) -> DataFrame:
    """Best score of each article over the original and rewritten query's neighbours, floored."""
    found = best_of_variants(arms, spec.floor, spec.limit * (4 if spec.group else 1))
    if spec.group:
        found = one_by_institution(found, [F.desc("score"), F.col("id")]).orderBy(F.desc("score"), "id").limit(spec.limit)
    return found


def hybrid_search(keyword_arm: DataFrame, semantic_arm: DataFrame | None, spec: SearchSpec) -> DataFrame:
    """Rank fusion of both arms; keyword results alone where there is no semantic arm."""
    depth = min(100, max(20, spec.limit * 2))
    arms = [keyword_arm] + ([semantic_arm] if semantic_arm is not None else [])
    orders = [list_order(), [F.desc("score"), F.col("id")]][: len(arms)]
    fused = reciprocal_rank_fusion(arms, orders, depth if spec.group else spec.limit)
    if spec.group:
        fused = one_by_institution(fused, [F.desc("rrf"), F.col("id")]).orderBy(F.desc("rrf"), "id").limit(spec.limit)
    return fused


def rewritten(keyword: str, rewrite: Callable[[str], str | None] = lambda _: None) -> list[str]:
    """Query variants: a usable rewrite of a sentence first, then the query. The rewriter is pluggable."""
    if len(keyword) < 10 or not re.search(r"\s", keyword):
        return [keyword]
    other = rewrite(keyword)
    usable = other and 2 <= len(other) <= 60 and other != keyword and not re.search(r"[.?!]$", other)
    return [other, keyword] if usable else [keyword]


def get_document(documents: DataFrame, articles: DataFrame, doc_id: str, first: int = 20, whole: bool = False) -> DataFrame:
    """A document's header with its first articles, bodies cut unless ``whole``."""
    own = articles.filter(F.col("doc_id") == doc_id).orderBy("seq").limit(first)
    body = F.col("body") if whole else F.substring("body", 1, 200)
    label = article_label(F.col("art_no"), F.col("art_sub"))
    own = own.select("doc_id", "seq", label.alias("art_ref"), "title", body.alias("body"), "n_chars")
    header = documents.filter(F.col("doc_id") == doc_id).select("doc_id", "doc_title", "doc_type", "corpus")
    return header.join(own, "doc_id", "left").orderBy("seq")


def get_article(articles: DataFrame, doc_id: str, number: int, sub: int | None = None) -> DataFrame:
    """Articles of a document by number, and sub-number if given."""
    found = articles.filter((F.col("doc_id") == doc_id) & (F.col("art_no") == number))
    return (found if sub is None else found.filter(F.col("art_sub") == sub)).orderBy("seq")


def rendered(rows: DataFrame, whole: bool = False) -> DataFrame:
    """(line): a result on three lines, its body on one and cut to 300 characters (2000 if ``whole``)."""
    corpus = labelled(F.col("corpus"), CORPUS_LABELS, OTHER_CORPUS)
    source = F.coalesce(F.nullif("inst_name", F.lit("")), F.nullif("doc_title", F.lit("")), corpus)
    blank = lambda c, other: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(other))
    line = F.regexp_replace(F.coalesce("body", F.lit("")), r"\n+", " ")
    most = 2000 if whole else 300
    body = F.when(F.length(line) > most, F.concat(F.substring(line, 1, most), F.lit("…"))).otherwise(line)
    head = F.concat_ws(" | ", corpus, source, F.coalesce("doc_title", F.lit("")))
    middle = F.concat(blank("art_ref", "-"), F.lit(" "), blank("art_title", "(제목없음)"), F.lit("  (유사도: "),
                      F.format_string("%.3f", "score"), F.lit("  부처: "), blank("ministry", "-"), F.lit(")"))
    return rows.select(F.concat_ws("\n", head, middle, body).alias("line"))
