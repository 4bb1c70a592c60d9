"""Law and administrative-rule JSON to Markdown, annexes and metadata.

The service gives one object where there is one of a thing and an array where there are several; ``many`` makes both an
array of JSON texts, level by level, so no schema has to fit both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import dotted_date, filled, strip


def at(json: Column, *path: str) -> Column:
    return F.get_json_object(json, "$" + "".join(f"['{name}']" for name in path))


def many(json: Column) -> Column:
    """array<string> of JSON texts: an array's elements, or the one value; empty for null."""
    none = F.array().cast("array<string>")
    return F.when(json.isNull() | (json == ""), none).when(
        json.startswith("["), F.coalesce(F.from_json(json, "array<string>"), none)
    ).otherwise(F.array(json))


def said(json: Column, name: str) -> Column:
    return strip(F.coalesce(at(json, name), F.lit("")))


def some(parts: Column, by: str) -> Column:
    """The filled parts, joined."""
    return F.array_join(F.filter(parts, lambda x: x != ""), by)


def _below(json: Column, children: str, render) -> Column:
    return F.transform(many(at(json, children)), render)


def _unit(unit: Column) -> Column:
    """A unit without a title is a heading; one with paragraphs lists them with their items and sub-items."""
    text = said(unit, "조문내용")
    sub_item = lambda s: said(s, "목내용")
    item = lambda i: some(F.concat(F.array(said(i, "호내용")), _below(i, "목", sub_item)), "\n")
    paragraph = lambda p: some(F.concat(F.array(said(p, "항내용")), _below(p, "호", item)), "\n")
    body = some(F.concat(F.array(text), _below(unit, "항", paragraph)), "\n")
    return F.when(said(unit, "조문제목") != "", body).when(text != "", F.concat(F.lit("## "), text)).otherwise("")


def _addenda(root: Column) -> Column:
    texts = some(_below(at(root, "부칙"), "부칙단위", lambda u: said(u, "부칙내용")), "\n\n")
    return F.when(texts == "", "").otherwise(F.concat(F.lit("## 부칙\n\n"), texts))


def _line(label: str, value: Column) -> Column:
    return F.when(value == "", "").otherwise(F.concat(F.lit(f"**{label}**: "), value))


def _object_or_text(json: Column, name: str, inner: str) -> Column:
    value = F.coalesce(at(json, name), F.lit(""))
    return F.when(value.startswith("{"), F.coalesce(at(value, inner), F.lit(""))).otherwise(value)


def law_markdown(json: Column) -> Column:
    root = at(json, "법령")
    info = at(root, "기본정보")
    number = said(info, "공포번호")
    promulgated = F.concat(
        dotted_date(said(info, "공포일자")), F.when(number == "", "").otherwise(F.concat(F.lit("  (제"), number, F.lit("호)")))
    )
    head = some(F.array(
        _line("시행일자", dotted_date(said(info, "시행일자"))), _line("공포일자", promulgated),
        _line("소관부처", _object_or_text(info, "소관부처", "소관부처명")),
    ), "\n")
    units = some(_below(at(root, "조문"), "조문단위", _unit), "\n\n")
    return some(F.array(head, units, _addenda(root)), "\n\n")


def rule_markdown(json: Column) -> Column:
    root = at(json, "AdmRulService")
    info = at(root, "행정규칙기본정보")
    head = some(F.array(
        _line("시행일자", dotted_date(said(info, "시행일자"))), _line("소관부처", said(info, "소관부처명")),
        _line("종류", said(info, "행정규칙종류")),
    ), "\n")
    heading = lambda t: F.regexp_like(t, F.lit(r"^제\d+(장|절)"))
    texts = F.transform(many(at(root, "조문내용")), lambda t: strip(t))
    body = some(F.transform(texts, lambda t: F.when(heading(t), F.concat(F.lit("## "), t)).otherwise(t)), "\n\n")
    return some(F.array(head, body, _addenda(root)), "\n\n")


def annex_text(content: Column) -> Column:
    """Lines of a nested array of texts: trailing blanks off, blank lines at either end off."""
    flat = F.flatten(F.transform(many(content), lambda x: F.flatten(F.transform(many(x), lambda y: many(y)))))
    lines = F.flatten(F.transform(flat, lambda t: F.split(t, "\n", -1)))
    text = F.array_join(F.transform(lines, lambda t: F.regexp_replace(t, r"\s+\z", "")), "\n")
    return F.regexp_replace(text, r"\A\n+|\n+\z", "")


def annexes(rows: DataFrame, key: str, json: str) -> DataFrame:
    """(key, number, title, text) of every annex of a law or rule."""
    root = F.coalesce(at(F.col(json), "법령"), at(F.col(json), "AdmRulService"))
    units = rows.select(key, F.explode(many(at(root, "별표", "별표단위"))).alias("u"))
    number = filled(F.regexp_replace(said(F.col("u"), "별표번호"), "^0+", ""), default="?")
    return units.select(
        key, number.alias("number"), said(F.col("u"), "별표제목").alias("title"), annex_text(at(F.col("u"), "별표내용")).alias("text")
    )


def metadata(json: Column) -> Column:
    """struct<ministry, departments>: the ministry, and up to three different contact departments."""
    root = F.coalesce(at(json, "법령"), at(json, "행정규칙"), json)
    info = F.coalesce(at(root, "기본정보"), root)
    first = F.get(many(at(info, "소관부처")), F.lit(0))
    names = F.transform(many(at(info, "연락부서", "부서단위")), lambda u: strip(F.split_part(said(u, "부서명"), F.lit(" - "), F.lit(1))))
    names = F.slice(F.array_distinct(F.filter(names, lambda n: n != "")), 1, 3)
    return F.struct(F.coalesce(at(first, "content"), F.lit("")).alias("ministry"), names.alias("departments"))
