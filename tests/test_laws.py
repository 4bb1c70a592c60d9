"""Invented law JSON, with one object or several where the service gives either."""

import json

from pyspark.sql import functions as F

from corpusloom.operators import laws

LAW = {"법령": {
    "기본정보": {"시행일자": "20240101", "공포일자": "20231201", "공포번호": "77", "소관부처": {"소관부처명": "부처", "content": "부처"},
              "연락부서": {"부서단위": [{"부서명": "가과 - 담당"}, {"부서명": "가과"}, {"부서명": "나과"}]}},
    "조문": {"조문단위": [
        {"조문내용": "제1장 총칙"}, {"조문내용": "제1조(목적) 본문", "조문제목": "목적"},
        {"조문내용": "제2조(정의)", "조문제목": "정의", "항": {"항내용": "① 항", "호": [{"호내용": "1. 호", "목": {"목내용": "가. 목"}}]}},
    ]},
    "부칙": {"부칙단위": {"부칙내용": " 시행한다. "}},
    "별표": {"별표단위": {"별표번호": "0003", "별표제목": "표", "별표내용": [["", "a  ", "b\nc"], [""]]}},
}}


def show(spark, column, value):
    frame = spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "j string")
    return frame.select(column.alias("x")).first()["x"]


def test_law(spark):
    assert show(spark, laws.law_markdown(F.col("j")), LAW) == "\n\n".join([
        "**시행일자**: 2024.01.01\n**공포일자**: 2023.12.01  (제77호)\n**소관부처**: 부처", "## 제1장 총칙", "제1조(목적) 본문",
        "제2조(정의)\n① 항\n1. 호\n가. 목", "## 부칙\n\n시행한다.",
    ])
    one = {"법령": {"조문": {"조문단위": {"조문내용": "제1조", "조문제목": "x"}}}}
    assert show(spark, laws.law_markdown(F.col("j")), one) == "제1조"


def test_rule(spark):
    rule = {"AdmRulService": {"행정규칙기본정보": {"행정규칙종류": "고시"}, "조문내용": ["제1장 총칙", " ", "제1조 내용"]}}
    assert show(spark, laws.rule_markdown(F.col("j")), rule) == "**종류**: 고시\n\n## 제1장 총칙\n\n제1조 내용"


def test_annexes_and_metadata(spark):
    frame = spark.createDataFrame([(1, json.dumps(LAW, ensure_ascii=False)), (2, "{}"), (3, None)], "id long, j string")
    assert [tuple(r) for r in laws.annexes(frame, "id", "j").collect()] == [(1, "3", "표", "a\nb\nc")]
    found = {r.id: r.m for r in frame.select("id", laws.metadata(F.col("j")).alias("m")).collect()}
    assert (found[1].ministry, found[1].departments) == ("부처", ["가과", "나과"]) and found[2].ministry == ""
