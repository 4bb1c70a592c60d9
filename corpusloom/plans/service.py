"""One search over a set of tables: routing between exact, keyword, semantic and hybrid, as the front ends do it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from corpusloom.operators import search
from corpusloom.operators.snapshots import Store
from corpusloom.plans import build
from corpusloom.operators.search import SearchSpec


@dataclass(frozen=True)
class Tables:
    """The stored tables; hashes, queue and embeddings are only needed for semantic search."""

    articles: DataFrame
    documents: DataFrame
    institutions: DataFrame
    hashes: DataFrame | None = None
    queue: DataFrame | None = None
    embeddings: DataFrame | None = None
    #: snapshot tables with the title indexes that ``build.store`` makes; without them every title is scored
    store: Store | None = None


def run(tables: Tables, spec: SearchSpec, mode: str = "keyword", vector: Callable[[str], list[float]] | None = None,
        rewrite: Callable[[str], str | None] = lambda _: None) -> DataFrame:
    """Rows of a search. A keyword that names an article is looked up in every mode.

    ``vector`` turns a query text into a vector and ``rewrite`` may shorten a sentence; both are plugged in. Hybrid search
    without a vector function is keyword search. Nothing is swallowed: an arm that fails fails the search.
    """
    rows = search.joined(tables.articles, tables.documents, tables.institutions)
    exact = search.exact_article(rows, spec)
    indexed = build.index_scores(tables.store, spec.keyword) if tables.store is not None and exact is None and not spec.body else None
    if exact is not None or mode == "keyword" or (mode == "hybrid" and vector is None):
        return exact if exact is not None else search.keyword_search(rows, spec, tables.documents, indexed)
    if vector is None:
        raise ValueError("semantic search needs a function from texts to vectors")
    depth = min(100, max(20, spec.limit * 2)) if mode == "hybrid" else spec.limit * (4 if spec.group else 1)
    deep = SearchSpec(**{**spec.__dict__, "limit": depth, "group": False})
    near = search.narrowed(rows, spec) if spec.filtered else rows
    arms = [
        search.nearest(near, tables.embeddings, tables.hashes, vector(text), deep, tables.queue)
        for text in search.rewritten(spec.keyword, rewrite)
    ]
    if mode == "semantic":
        return search.semantic_search(arms, spec)
    return search.hybrid_search(search.keyword_search(rows, deep, tables.documents, indexed), search.semantic_search(arms, deep), spec)
