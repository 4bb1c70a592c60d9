"""Catalogs, scopes, paths and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import filled, group_or_null, report_year


def catalog_items(items: DataFrame, kinds: dict[str, Sequence[str]], default: str = "regular") -> DataFrame:
    """Items with ``code`` (the first of their comma list) and ``kind`` by sets of codes."""
    code = F.trim(F.get(F.split("report_form_root_no", ","), F.lit(0)))
    kind = F.lit(default)
    for name, codes in kinds.items():
        kind = F.when(code.isin(*codes), name).otherwise(kind)
    return items.withColumn("code", code).withColumn("kind", kind)


def scope(items: DataFrame, everything: bool = False, codes: Sequence[str] = (), categories: Sequence[str] = ()) -> DataFrame:
    """(code, item_name, minor_category, is_scoped) for each code of each item.

    All items, else listed codes, else listed categories; of items that share a code the last by name describes it.
    """
    each = items.withColumn("code", F.explode(F.filter(
        F.transform(F.split("report_form_root_no", ","), lambda c: F.trim(c)), lambda c: c != "")))
    if everything:
        scoped = F.lit(True)
    elif codes:
        scoped = F.col("code").isin(*codes)
    else:
        scoped = F.col("minor_category").isin(*categories) if categories else F.lit(False)
    each = each.withColumn("is_scoped", scoped)
    return each.groupBy("code").agg(
        F.max_by("item_name", "item_name").alias("item_name"), F.max_by("minor_category", "item_name").alias("minor_category"),
        F.bool_or("is_scoped").alias("is_scoped"),
    )


def resolve_items(rows: DataFrame, scoped: DataFrame, code: str = "report_no") -> DataFrame:
    """Rows with the item of their code, else of the first code of their comma list."""
    exact = scoped.select(F.col("code").alias("_a"), F.struct("*").alias("_exact"))
    first = scoped.select(F.col("code").alias("_b"), F.struct("*").alias("_first"))
    rows = rows.withColumn("_a", F.trim(code)).withColumn("_b", F.trim(F.get(F.split(code, ","), F.lit(0))))
    rows = rows.join(exact, "_a", "left").join(first, "_b", "left")
    return rows.withColumn("item", F.coalesce("_exact", "_first")).drop("_a", "_b", "_exact", "_first")


def pick_institutions(rows: DataFrame, ministry: str | None = None, codes: Sequence[str] = (), kind: str | None = None,
                      first: int | None = None) -> DataFrame:
    """Institutions by ministry, codes and type; the first so many by code."""
    rows = rows if ministry is None else rows.filter(F.col("ministry") == ministry)
    rows = rows if not codes else rows.filter(F.col("inst_code").isin(*codes))
    rows = rows if kind is None else rows.filter(F.col("type") == kind)
    return rows if first is None else rows.orderBy("inst_code").limit(first)


def normalise_rows(rows: DataFrame) -> DataFrame:
    """Service rows with one set of names; columns that the input lacks count as null."""
    def col(*names: str):
        return filled(*(F.col(n).cast("string") for n in names if n in rows.columns), F.lit(None).cast("string"), default="")

    title, date = col("title", "disclosure_title"), col("openDate", "idate", "stDate")
    return rows.select(
        col("apbaId", "apba_id").alias("inst_code"), F.trim(col("reportFormNo", "report_form_root_no")).alias("report_no"),
        F.trim(col("disclosureNo", "disclosure_no")).alias("disclosure_no"),
        F.trim(col("submissionNo", "submission_no")).alias("submission_no"),
        report_year(col("year", "critYyyy"), title, date).alias("year"), F.trim(col("quarter", "critQuar")).alias("quarter"),
        F.trim(col("period_label", "quartNa")).alias("period_label"), title.alias("title"),
    )


def path_metadata(rows: DataFrame, path: str = "rel_path") -> DataFrame:
    """Adds ministry, inst_name, inst_code, doc_date and doc_title from ``[ministry]name_code/.../title_date.md``."""
    top = F.get(F.split(path, "/"), F.lit(0))
    base = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.md\z", "")
    folder = r"^\[([^\]]+)\](.+)_(C\d+)\z"
    return rows.withColumns({
        "ministry": group_or_null(top, folder, 1), "inst_name": group_or_null(top, folder, 2),
        "inst_code": group_or_null(top, folder, 3),
        "doc_date": F.coalesce(group_or_null(base, r"_(\d{8})\z"), group_or_null(base, r"(\d{4})년")),
        "doc_title": F.regexp_replace(base, r"_\d{8}\z", ""),
    })


def statistics_index(cells: DataFrame, file: str = "file") -> DataFrame:
    """For each file: rows, distinct institutions, sheets and columns of long cells (file, sheet, row, column, institution)."""
    return cells.groupBy(file).agg(
        F.countDistinct("sheet", "row").alias("n_rows"), F.countDistinct("institution").alias("n_institutions"),
        F.countDistinct("sheet").alias("n_sheets"), F.sort_array(F.collect_set("column")).alias("columns"),
    )


def kind_counts(items: DataFrame, kind: str = "kind") -> DataFrame:
    return items.groupBy(kind).agg(F.count("*").alias("n"))


def catalog_diff(old: DataFrame, new: DataFrame, key: str = "code") -> DataFrame:
    """(key, change): added and removed keys."""
    added = new.select(key).join(old.select(key), key, "left_anti").withColumn("change", F.lit("added"))
    removed = old.select(key).join(new.select(key), key, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def year_from(rows: DataFrame, year: str, cutoff: int, keep_unknown: bool) -> DataFrame:
    """Rows from a year on; rows without a readable year stay or go."""
    value = F.col(year).try_cast("int")
    return rows.filter(F.coalesce(value >= cutoff, F.lit(keep_unknown)))


def converted_between(rows: DataFrame, column: str, after: str | None, before: str) -> DataFrame:
    """Rows converted from ``after`` on and before ``before``; unreadable and missing times go."""
    at = F.try_to_timestamp(F.col(column))
    rows = rows.filter(at < F.lit(before).cast("timestamp"))
    return rows if after is None else rows.filter(at >= F.lit(after).cast("timestamp"))


def markdown_table(rows: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row, ``markdown``: a table of all rows. Bars are escaped and line breaks become blanks. For report-sized input."""
    def cell(name: str):
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), r"\r?\n", " ")

    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))
    head = [f"| {' | '.join(columns)} |", f"| {' | '.join('---' for _ in columns)} |"]
    body = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))), lambda x: x["_line"])
    return rows.agg(F.concat_ws("\n", F.array(*map(F.lit, head)), body).alias("markdown"))
