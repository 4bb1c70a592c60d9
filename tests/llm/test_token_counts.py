"""Prefix counts against the tokenizer, on every prefix."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import token_counts
from tests.llm import cases

ALPHABET = "aaabcdeist'rvlmd <|>ENéÉİ́ñ中文かK12½ßΣς.,- \n\x1c한 "


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoded(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def odd_texts(n=400):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    texts += ["a<|endoftext|>b", "<|startoftext|>", "<|ENDOFTEXT|> x", "don't we've I'LL ''re", "été", "İİ İstanbul", "aaaaaaaaaaa" * 9]
    return texts


def test_every_prefix_of_a_word(path, tokenizer):
    table = token_counts.PrefixCounter(path)
    for word in {w for t in odd_texts() for w in cases.words(t)} | {"antidisestablishmentarianism", "x" * 70, "中文" * 30}:
        wanted = [encoded(tokenizer, word[: k + 1]) for k in range(len(word))]
        assert table.counts(word.encode()).tolist() == wanted and table.count(word.encode()) == wanted[-1], word


def test_counts_are_the_librarys(spark, path, tokenizer):
    rows = cases.corpus() + [(1000 + i, t) + (None,) * 7 for i, t in enumerate(odd_texts())]
    got = token_counts.token_counts(cases.frame(spark, rows).repartition(3), path, limit=60).collect()
    wanted = [(r[0], len((r[1] or "").encode()), encoded(tokenizer, r[1])) for r in rows]
    assert sorted(map(repr, (tuple(r[:3]) for r in got))) == sorted(map(repr, wanted))
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        assert r.over_limit == (r.n_tokens > 60)
        if r.doc_id is not None and r.over_limit and len(text[r.doc_id]) < 5000:
            fits = [k for k in range(len(text[r.doc_id]) + 1) if encoded(tokenizer, text[r.doc_id][:k]) <= 60]
            assert r.cut_chars == fits[-1]


def test_stored_prefixes_answer_without_encoding(spark, path, tokenizer):
    rows = [(i, t) for i, t in enumerate(odd_texts(60) + [None, "", "  \n ", " lead and trail "])]
    table = token_counts.prefix_table(spark.createDataFrame(rows, "doc_id long, text string"), path).persist()
    for r in table.collect():
        text = rows[r.doc_id][1] or ""
        assert r.prefix_tokens == [encoded(tokenizer, text[: k + 1]) for k in range(len(text))]
        assert r.n_tokens == encoded(tokenizer, text)
    for r in token_counts.cut(table, 5).collect():
        text = rows[r.doc_id][1] or ""
        longest = max(k for k in range(len(text) + 1) if encoded(tokenizer, text[:k]) <= 5)
        assert (r.text, r.n_tokens, len(r.prefix_tokens)) == (text[:longest], encoded(tokenizer, text[:longest]), longest)
    at = table.select("doc_id", *(token_counts.tokens_of(F.col("prefix_tokens"), k).alias(f"t{k}") for k in (0, 3, 1000)))
    for r in at.collect():
        text = rows[r.doc_id][1] or ""
        assert [r.t0, r.t3, r.t1000] == [encoded(tokenizer, text[:k]) for k in (0, 3, 1000)]


def test_texts_longer_than_a_slice(spark, path, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS_KEPT", 50)
    text = " ".join(f"w{k}x" for k in range(150_000))
    assert len(text) > token_counts.SLICE
    got = token_counts.token_counts(spark.createDataFrame([(1, text), (2, "w1x")], "doc_id long, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {1: encoded(tokenizer, text), 2: encoded(tokenizer, "w1x")}
    cut = next(r.cut_chars for r in got if r.doc_id == 1)
    assert encoded(tokenizer, text[:cut]) <= 2048 < encoded(tokenizer, text[: cut + 1])


def test_empty_table_and_clashing_columns(spark, path):
    none = cases.frame(spark, [])
    assert token_counts.token_counts(none, path).count() == token_counts.prefix_table(none, path).count() == 0
    clash = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_tokens int, n_bytes string")
    assert token_counts.token_counts(clash, path).collect()[0][:3] == (1, 3, 2)


def test_other_tokenizers_are_refused(tmp_path, path):
    public = pytest.importorskip("public_tokenizers")
    with pytest.raises(ValueError, match="white space"):
        token_counts.PrefixCounter(public.path("byte_bpe_50k.json"))
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"]["dropout"] = 0.5
    (tmp_path / "x.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="plain byte-pair"):
        token_counts.PrefixCounter(str(tmp_path / "x.json"))
