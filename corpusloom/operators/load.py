"""Gate, content hashes, embedding queue and loads.

Tables are DataFrames; a load returns the new state of each table, and ``write_tables`` puts it in place. Replacing by
key is an anti-join and a union, so untouched rows aren't rewritten in memory and nothing is mutated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.planning import content_hash
from corpusloom.functions.text import has_control, has_nul
from corpusloom.operators.ranking import first_by


def gate(docs: DataFrame, articles: DataFrame, bad_docs: int = 0, bad_articles: int = 0, strict: bool = False) -> DataFrame:
    """One row of counts and ``passed``.

    Counts: bad lines, documents, repeated document ids (an unreadable line counts as one, too), articles, expected
    articles, repeated (doc_id, seq), texts with NUL, texts with other control characters, articles without document.
    The counts must agree: articles with what documents state, or with that and the repeats; ``strict`` allows only the
    former. Control characters other than NUL don't fail the gate.
    """
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    known = docs.agg(
        (F.count("*") + bad_docs).alias("docs"), F.countDistinct("doc_id").alias("distinct_docs"),
        F.coalesce(F.sum("n_articles"), F.lit(0)).cast("long").alias("expected"),
    )
    text = F.concat(F.coalesce("text", F.lit("")), F.coalesce("title", F.lit("")))
    marked = articles.join(docs.select("doc_id", F.lit(1).alias("_known")).distinct(), "doc_id", "left")
    keys = marked.groupBy("doc_id", "seq").agg(
        F.count("*").alias("n"), count(has_nul(text)).alias("nul"),
        count(has_control(text) & ~has_nul(text)).alias("control"), count(F.col("_known").isNull()).alias("orphan"),
    )
    seen = keys.agg(
        (count(F.col("n")) + bad_articles).alias("articles"), count(F.col("n") - 1).alias("repeated"),
        count(F.col("nul")).alias("nul"), count(F.col("control")).alias("control"), count(F.col("orphan")).alias("orphans"),
    )
    row = known.crossJoin(seen).select(
        F.lit(bad_docs).cast("long").alias("bad_docs"), F.lit(bad_articles).cast("long").alias("bad_articles"),
        "docs", (F.col("docs") - F.col("distinct_docs")).alias("repeated_docs"), "articles", "expected", "repeated", "nul",
        "control", "orphans",
    )
    agrees = F.col("articles") == F.col("expected")
    agrees = agrees if strict else agrees | (F.col("articles") == F.col("expected") + F.col("repeated"))
    clean = F.lit(True)
    for name in ("bad_docs", "bad_articles", "repeated_docs", "repeated", "nul", "orphans"):
        clean = clean & (F.col(name) == 0)
    return row.withColumn("passed", clean & agrees)


def require(gate_row: DataFrame) -> None:
    """Raise unless the gate passed (an action on one row)."""
    row = gate_row.first()
    if not row["passed"]:
        raise ValueError(f"the staging gate failed: {row.asDict()}")


def hashes(articles: DataFrame, length: int = 4000) -> DataFrame:
    """(id, text_hash) of what is embedded of each article."""
    return articles.select("id", content_hash(F.col("title"), F.col("body"), length).alias("text_hash"))


def queue(article_hashes: DataFrame) -> DataFrame:
    """(text_hash, id): the article with the smallest id stands for each text."""
    return article_hashes.groupBy("text_hash").agg(F.min("id").alias("id"))


def pending(queued: DataFrame, embeddings: DataFrame, limit: int | None = None, titles: DataFrame | None = None,
            pattern: str | None = None) -> DataFrame:
    """Queue entries without an embedding, in order of their id; a pattern keeps those whose title matches."""
    rows = queued.join(embeddings.select("text_hash"), "text_hash", "left_anti")
    if pattern is not None and titles is not None:
        rows = rows.join(titles.filter(F.regexp_like("title", F.lit(pattern))).select("id"), "id", "left_semi")
    return rows.select("text_hash", "id").orderBy("id").limit(limit) if limit else rows.select("text_hash", "id")


def embed(rows: DataFrame, model: Callable[[list[str]], list[list[float]]], name: str, text: str = "text") -> DataFrame:
    """(text_hash, embedding, model): calls a pluggable model with the texts of each Arrow batch."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            vectors = pa.array(model(batch.column(1).to_pylist()), pa.list_(pa.float32()))
            names = pa.array([name] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors, names], ["text_hash", "embedding", "model"])

    return rows.select("text_hash", text).mapInArrow(run, "text_hash string, embedding array<float>, model string")


def without_dangling(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Hash or queue rows whose article still exists."""
    return rows.join(articles.select("id"), "id", "left_semi")


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert unless the key exists; of new rows with one key the first by all columns stays."""
    fresh = new.join(old.select(*keys), keys, "left_anti")
    return old.unionByName(first_by(fresh, keys, [F.col(c) for c in fresh.columns if c not in keys] or [F.lit(1)]))


def replace_keys(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose key isn't in ``new``, and all of ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def replace_corpus(old: DataFrame, new: DataFrame, corpus: str, key: str = "doc_id") -> DataFrame:
    """Append mode: the corpus' documents (``corpus:`` prefix of the key) are replaced as a whole."""
    return old.filter(~F.col(key).startswith(f"{corpus}:")).unionByName(new)


def replace_documents(old: DataFrame, delta: DataFrame, docs: DataFrame, corpus: str) -> DataFrame:
    """Delta mode: rows of just the delta's documents are replaced; a document of another corpus is an error."""
    ids = docs.select("doc_id").distinct()
    wrong = F.raise_error(F.concat(F.lit("not in the corpus: "), F.col("doc_id"))).cast("string")
    checked = ids.select(F.when(F.col("doc_id").startswith(f"{corpus}:"), F.col("doc_id")).otherwise(wrong).alias("doc_id"))
    return old.join(checked, "doc_id", "left_anti").unionByName(delta)


def delta_effect(old: DataFrame, docs: DataFrame) -> DataFrame:
    """Dry run: how many documents and rows a delta would replace."""
    hit = old.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    return hit.agg(F.countDistinct("doc_id").alias("documents"), F.count("*").alias("rows"))


def institutions(staged_documents: DataFrame, order: str = "doc_id") -> DataFrame:
    """(inst_code, inst_name, ministry): the first document that names an institution describes it."""
    named = staged_documents.filter(F.coalesce("inst_code", F.lit("")) != "")
    return first_by(named, ["inst_code"], [F.col(order)]).select("inst_code", "inst_name", "ministry")


def update_from(old: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """``old`` with a column set from changes by key; rows without a change stay."""
    new = changes.select(key, F.col(column).alias("_new"), F.lit(True).alias("_set"))
    set_ = F.when(F.col("_set"), F.col("_new")).otherwise(F.col(column))
    return old.join(new, key, "left").withColumn(column, set_).drop("_new", "_set")


def write_tables(tables: dict[str, DataFrame], root: str, partition: dict[str, str] | None = None) -> None:
    """Write each table as plain Parquet; a partition column makes it a dynamic overwrite of just the partitions written.

    Other tables are written aside, the old one is moved aside and the new one put in its place. No step deletes the only
    copy: a writer that is killed between the two moves leaves the old table as ``_name.old``, and the next call of
    ``write_tables`` or ``recover`` puts it back. Where readers must never miss a table, use ``snapshots.Store``.
    """
    for name, rows in tables.items():
        column = (partition or {}).get(name)
        if column:
            writer = rows.write.mode("overwrite").partitionBy(column).option("partitionOverwriteMode", "dynamic")
            writer.parquet(f"{root}/{name}")
            continue
        aside = f"{root}/_{name}-{uuid.uuid4().hex}"
        rows.write.parquet(aside)
        jvm, conf = rows.sparkSession._jvm, rows.sparkSession._jsparkSession.sessionState().newHadoopConf()
        old, new = jvm.org.apache.hadoop.fs.Path(f"{root}/{name}"), jvm.org.apache.hadoop.fs.Path(aside)
        system, before = new.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(f"{root}/_{name}.old")
        recover(rows.sparkSession, root, name)
        if system.exists(old) and not system.rename(old, before):
            raise OSError(f"can't rename {old}")
        if not system.rename(new, old):
            recover(rows.sparkSession, root, name)
            raise OSError(f"can't rename {aside}")
        system.delete(before, True)


def recover(spark, root: str, name: str) -> None:
    """Put a table's old folder back if a writer was killed before the new one was there; drop it if the new one is."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    old, before = path(f"{root}/{name}"), path(f"{root}/_{name}.old")
    system = old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if system.exists(before):
        if system.exists(old):
            system.delete(before, True)
        elif not system.rename(before, old):
            raise OSError(f"can't rename {before}")


def load_run(spark, script: str, mode: str, corpus: str, n_docs: int, n_articles: int, started_at) -> DataFrame:
    """One audit row of a load."""
    from corpusloom.schema import LOAD_RUNS

    row = (f"{script}:{started_at.isoformat()}", script, mode, corpus, started_at, None, n_docs, n_articles)
    return spark.createDataFrame([row], LOAD_RUNS).withColumn("finished_at", F.current_timestamp())
