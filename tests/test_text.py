"""Invented rows for segmentation, cleaning, audits and chunks."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import planning
from corpusloom.functions import text as fn
from corpusloom.functions.similarity import cosine, trigram_similarity
from corpusloom.operators import audit, chunk, clean, extract, segment


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return frame.select(column.alias("x")).first()["x"]


def articles(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [r.asDict() for r in segment.articles(docs).orderBy("seq").collect()]


def test_articles(spark):
    text = "\n".join([
        "front", "제1장 총칙", "ignored", "제1조(목적) 이 규정은", "둘째 줄", "제3조 및 제4조에 따라", "제2조의3 (정의) 뜻", "제4조 짧은 제목",
        "본문", "제5조(빈 조)", "### 제6조 (굵은 제목) **x**", "제2장", "제7조(장 뒤) 내용", "부 칙 <2020.1.1>", "시행", "제1조(시행일) 바로",
    ])
    found = articles(spark, text.replace("둘째 줄", "둘째 줄"))
    assert [(a["seq"], a["art_no"], a["art_sub"], a["title"]) for a in found] == [
        (1, 1, None, "목적"), (2, 2, 3, "정의"), (3, 4, None, "짧은 제목"), (4, 6, None, "굵은 제목"), (5, 7, None, "장 뒤"),
        (6, None, None, "부칙"), (7, 1, None, "시행일"),
    ]
    assert found[0]["text"] == "이 규정은\n둘째\n줄\n제3조 및 제4조에 따라"
    assert [a["chapter"] for a in found] == ["제1장 총칙"] * 4 + ["제2장", "", ""]
    assert [a["section"] for a in found] == ["본칙"] * 5 + ["부칙"] * 2
    assert all(a["n_chars"] == len(a["text"]) for a in found)


def test_articles_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "no article\r\nhere")], "doc_id long, text string")
    assert segment.articles(docs).count() == 0
    report = {r.doc_id: r for r in segment.coverage(docs, segment.articles(docs)).collect()}
    assert report[3].parse_status == "no_articles" and report[3].content_chars == 14


def test_lines_keep_crlf_apart(spark):
    docs = spark.createDataFrame([(1, "a\r\n\r\nb\n")], "doc_id long, text string")
    assert [(r.pos, r.line) for r in segment.lines(docs).orderBy("pos").collect()] == [(1, "a"), (2, ""), (3, "b"), (4, "")]


def test_scalars(spark):
    assert one(spark, fn.squash(F.col("t")), t="　a  \t b﻿") == "a b"
    assert one(spark, fn.safe_segment(F.col("t")), t=' a/b:c*"<x>|? ') == "a_b_c___x___"
    assert one(spark, fn.first_bytes(F.col("t"), 7), t="가나다") == "가나"
    assert one(spark, fn.title_key(F.col("t")), t="가ㆍ나 • 다") == "가·나·다"
    assert one(spark, fn.document_type(F.col("t")), t="인사규정 시행세칙") == "규정"
    assert one(spark, fn.tags(F.col("t")), t="a, B ,c_d") == ["a", "c_d"]
    assert one(spark, fn.tags(F.col("t")), t="A,B") is None
    assert one(spark, fn.year_of(F.col("t"), F.lit("2019 년")), t="x") == "2019"
    assert one(spark, fn.front_matter(F.col("t")), t="---\ntitle: 'a b'\nid: 3\n---\nbody") == {"title": "a b", "id": "3"}
    assert one(spark, fn.without_front_matter(F.col("t")), t="---\nid: 3\n---\nbody") == "body"
    assert one(spark, fn.shifted_pages(F.col("t"), 10), t="a<!-- page: 1 -->b<!-- page: 2 -->") == (
        "a<!-- page: 11 -->b<!-- page: 12 -->"
    )
    assert one(spark, fn.without_dangling_images(F.col("t")), t="![a](x.png)![b](https://h/i.png)") == "![b](https://h/i.png)"
    assert one(spark, fn.filled(F.col("t"), F.lit("z")), t="") == "z"
    assert one(spark, fn.rewrite_fits(F.col("t"), F.lit("query")), t="It is so.") is False
    assert one(spark, fn.looks_like_value(F.col("t")), t="1,234.5%") is True
    assert one(spark, fn.has_control(F.col("t")), t="a\tb") is False


def test_similarity(spark):
    assert one(spark, trigram_similarity(F.col("a"), F.col("b")), a="word", b="word") == 1.0
    assert one(spark, trigram_similarity(F.col("a"), F.col("b")), a="word", b="two words") == pytest.approx(4 / 11)
    assert one(spark, trigram_similarity(F.col("a"), F.lit(None).cast("string")), a="word") is None
    frame = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert frame.select(cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(2**-0.5)


def test_planning(spark):
    frame = spark.createDataFrame([(1048576, 0), (1048576, 34), (0, 600)], "size long, pages int")
    size, pages = F.col("size"), F.col("pages")
    rows = frame.select(planning.conversion_cost(size, pages), planning.conversion_timeout(size, pages)).collect()
    assert [tuple(r) for r in rows] == [(60.0, 1_800_000), (680.0, 1_800_000), (12000.0, 5_400_000)]
    shards = spark.range(829).select(planning.shard(F.col("id").cast("string"), 3).alias("s")).groupBy("s").count().collect()
    assert sum(r["count"] for r in shards) == 829 and all(abs(r["count"] - 829 / 3) < 0.2 * 829 / 3 for r in shards)


def changed(spark, change, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r[0] for r in rows.orderBy("id").select(change(F.col("text"))).collect()]


def test_join_lines(spark):
    texts = ["이 문장은\n이어진다.\n새 문장", "a\n1. item\n\nb", "a\nb\nc\nd\ne", "끝 \n  처음", "a", "", None]
    wanted = ["이 문장은 이어진다.\n새 문장", "a\n1. item\n\nb", "a b c d e", "끝 처음", "a", "", None]
    assert changed(spark, clean.join_lines, texts) == wanted
    assert changed(spark, lambda t: clean.join_lines(t, 1), ["a\nb\nc\nd\ne"]) == ["a b\nc d\ne"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(
    ["제1조(a) ① x ② y", "1. 가나 2. 다라", "```", "# 제3조", "<!-- 1. 가 -->", "", "plain", "| 1. 가 2. 나 |", "제2조(b)"]
), max_size=8), min_size=40, max_size=40))
def test_restructure_is_stable(spark, found):
    done = changed(spark, clean.restructure, ["\n".join(lines) for lines in found])
    assert changed(spark, clean.restructure, done) == done


def test_restructure(spark):
    code = "```\n제1조(a) ① x\n```\n| 제2조 ① |"
    texts = [
        code, "앞\n제1조(a) ① x", "제1조(a) ① x ② y", "1. 가나 2. 다라 3) 마바", "# 제3조\n제1조(a) ① x", "```\n제9조 ① x",
        "a\r\n제1조(b) ① c", "제1조(a)\n\n제2조(b)\n제3조(c)", "```\nx\n```\n제1조(a)", "<!-- 1. 가 2. 나 -->", None,
    ]
    assert changed(spark, clean.restructure, texts) == [
        code, "앞\n\n제1조(a)\n① x", "제1조(a)\n① x ② y", "1. 가나\n2. 다라\n3) 마바", "# 제3조\n\n제1조(a) ① x",
        "```\n제9조 ① x", "a\r\n\r\n제1조(b)\r\n① c", "제1조(a)\n\n제2조(b)\n\n제3조(c)", "```\nx\n```\n\n제1조(a)",
        "<!-- 1. 가 2. 나 -->", None,
    ]


def test_chunks():
    assert chunk.cut(["short"]) == ([], 5, False)
    words = " ".join(["word"] * 400)
    found, content, short = chunk.cut([words, "", words])
    assert content == 2 * len(words) and not short and all(len(c) <= 1000 + chunk.OVERLAP for c in found)
    table = ["| name | value |", "|---|---|", *[f"| key{i} | {'x' * 30} |" for i in range(60)]]
    rows = chunk.cut(table)[0]
    assert len(rows) > 1 and all(r.startswith("name value") for r in rows)
    assert sum(r.count("key") for r in rows) == 60
    capped, _, short = chunk.cut([("y" * 990 + "\n\n") for _ in range(1)] + sum(([f"{'z' * 2490}{i}", ""] for i in range(200)), []))
    assert len(capped) == chunk.MOST_CHUNKS and short


def test_html_table_is_cut_at_rows():
    html = ["<table>", "<tr><th>a</th></tr><tr><td>" + "b<br>" * 30 + "</td></tr>", "</table>", "text after " * 10]
    found = chunk.cut(html)[0]
    assert found[0].split("\n")[0] == "a" and found[1].startswith("text after")


HEADED = ["## 제1조(a)", "제2조", "제3조(b)", "제4조(c) 본문이 붙은 줄", "  제5조 (d) ", "## 제9조(e)"]


def test_headings_are_repaired_in_agreements_alone(spark):
    """Titles alone become headings, bare numbers don't, and lines whose text goes on are reported."""
    names = {"a": "단체협약 2024", "b": "단체협약 신구 대비표", "c": "단체협약 운영규정", "d": "보고서", "e": "노사협약 개정 (안)"}
    rows = [(d, k + 1, line, n) for d, n in names.items() for k, line in enumerate(HEADED)]
    rows = spark.createDataFrame(rows, "doc_id string, pos int, line string, name string")
    gaps = audit.heading_gaps(rows, name="name")
    found = audit.heading_candidates(gaps, rows.select("doc_id", "name").distinct())
    got = sorted((r.doc_id, r.missing, r.action) for r in found.collect())
    assert got == [("a", 3, audit.REPAIR), ("a", 4, audit.SPLIT), ("a", 5, audit.REPAIR)]
    fixed = {(r.doc_id, r.pos): r.line for r in audit.repair_headings(rows, found).collect()}
    assert fixed == {(r.doc_id, r.pos): r.line for r in rows.collect()} | {("a", 3): "### 제3조(b)", ("a", 5): "### 제5조 (d)"}


def test_heading_repair_stops_at_changed_lines(spark):
    rows = spark.createDataFrame([("d", k + 1, line) for k, line in enumerate(HEADED)], "doc_id string, pos int, line string")
    found = audit.heading_candidates(audit.heading_gaps(rows), spark.createDataFrame([("d", "현장협약")], "doc_id string, name string"))
    changed = rows.withColumn("line", F.when(F.col("pos") == 3, "other").otherwise(F.col("line")))
    with pytest.raises(Exception, match="changed since the audit"):
        audit.repair_headings(changed, found).collect()
    with pytest.raises(Exception, match="two candidates"):
        audit.repair_headings(rows, found.unionAll(found)).collect()


def test_table_shapes(spark):
    text = "\n".join(["| a | b | c |", "|---|:-:|---|", "| 1 | 2 | 3 |", "| only | two |", "| p | q | x | 5 | 6 |", "| k | v | k2 | v2 |"])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = [(r.label, r.value) for r in extract.table_records(docs).orderBy("line", "source_ref").collect()]
    assert ("a", "1") in found and ("only", "two") in found and ("k", "v") in found and ("k2", "v2") in found
    assert ("p / q / x", "5 | 6") in found and ("p / q / x", "5") in found


def test_chunks_are_given_on_before_a_batch_ends():
    import pyarrow as pa

    from corpusloom.operators import chunk

    texts = pa.array(["some words of a text " * 20 * (k % 4) for k in range(50)] + [None])
    keys = pa.array(range(51))
    parts, (whole,) = list(chunk.cut_batch(keys, texts, "id", 2000)), list(chunk.cut_batch(keys, texts, "id"))
    assert len(parts) > 10 and pa.Table.from_batches(parts).combine_chunks().to_pylist() == whole.to_pylist()
    assert set(whole.column(0).to_pylist()) == set(range(51))


def test_cleaning_again_takes_no_shuffle(spark, sf_dir):
    from corpusloom.operators import clean
    from corpusloom.plans.queries_text import restructure_again

    plan = restructure_again(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    rows = spark.createDataFrame([(1, "a"), (1, "b\r\n"), (2, None), (None, "aa")], "doc_id long, text string")
    found = clean.cleaned_again(rows, lambda t: F.regexp_replace(t, "^a", ""), {"text": lambda x: x})
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, [(1, False, ""), (1, False, "b\r\n"), (2, False, None), (None, True, "a")]))
