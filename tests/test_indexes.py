"""Stored indexes: trigrams against scoring all texts, vector cells against exact neighbours; word groups and open pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.similarity import THRESHOLD, cosine, trigram_similarity
from corpusloom.operators import classify, search, sync, title_index, vector_index
from corpusloom.operators.snapshots import Store

WORDS = ["annual", "leave", "annul", "pay", "rule", "rules", "연차", "연차휴가", "휴가", "인사규정", "x", "Leave-Pay"]
KEYWORDS = ["annual leave", "연차휴가", "x", "rules", "", "no such thing"]


def titles(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4))), rng.choice([None, "pay rule", "연차"])) for i in range(n)]
    return [*rows, (n, None, None), (n + 1, "annual leave", None), (n + 2, "annual leave", "annual leave")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, alias string")


def scored(rows, keyword):
    """What scoring every text gives."""
    each = [F.coalesce(trigram_similarity(F.col(c), keyword), F.lit(0.0)) for c in ("title", "alias")]
    found = rows.select("id", F.greatest(*each).alias("s")).filter(F.col("s") >= THRESHOLD)
    return sorted((r.id, round(r.s, 9)) for r in found.collect())


def searched(store, keyword):
    return sorted((r.id, round(r.similarity, 9)) for r in title_index.search(store, "titles", keyword).collect())


def test_the_index_answers_like_scoring_all_titles(spark, tmp_path):
    store, rows = Store(spark, str(tmp_path)), frame(spark, titles(200))
    store.commit(store.state(), title_index.built(store, "titles", rows, ["title", "alias"]))
    for keyword in KEYWORDS:
        assert searched(store, keyword) == scored(rows, keyword)
    assert searched(store, "annual leave")


def test_deltas_and_merges_keep_the_index_right(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(title_index, "MOST_GENERATIONS", 3)
    store, rng = Store(spark, str(tmp_path)), random.Random(4)
    now = {r[0]: r for r in titles(60)}
    store.commit(store.state(), title_index.built(store, "titles", frame(spark, list(now.values())), ["title", "alias"]))
    sizes = []
    for step in range(4):
        gone = rng.sample(sorted(now), 10)
        delta = [(i, *r[1:]) for i, r in zip([*gone[:6], 1000 + step], titles(7, 50 + step))]  # six replaced, four gone, one new
        for i in gone:
            del now[i]
        now |= {r[0]: r for r in delta}
        state = store.state()
        ids = spark.createDataFrame([(i,) for i in gone], "id long")
        store.commit(state, title_index.updated(store, state, "titles", frame(spark, delta), ids, ["title", "alias"]))
        sizes.append(len(store.state().tables["titles_postings"].parts))
        for keyword in KEYWORDS[:3]:
            assert searched(store, keyword) == scored(frame(spark, list(now.values())), keyword)
    assert sizes == [2, 3, 1, 2]


def test_a_search_reads_its_trigrams_alone(spark, tmp_path):
    store, rows = Store(spark, str(tmp_path)), frame(spark, titles(50))
    store.commit(store.state(), title_index.built(store, "titles", rows, ["title", "alias"]))
    plan = title_index.search(store, "titles", "annual leave")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PushedFilters: [" in scan and "In(gram" in scan and "title" not in scan.split("ReadSchema")[1]


def test_trigrams_are_made_once_a_build(spark, tmp_path, monkeypatch):
    plans, write = [], Store.write
    monkeypatch.setattr(Store, "write", lambda self, rows, *rest: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or write(self, rows, *rest))
    store = Store(spark, str(tmp_path))
    store.commit(store.state(), title_index.built(store, "titles", frame(spark, titles(50)), ["title", "alias"]))
    # what is put into ranges is read twice, once to find them
    ranged = [p for p in plans if "RepartitionByExpression" in p]
    assert len(ranged) == 1 and "regexp" not in ranged[0] and any("regexp" in p for p in plans)
    assert len(list((tmp_path / "data").iterdir())) == 1
    assert searched(store, "annual leave") == scored(frame(spark, titles(50)), "annual leave")


def test_named_articles_are_all_that_a_search_shows(spark):
    articles = spark.createDataFrame([(d * 10 + k, d, k, "t") for d in range(5) for k in range(3)] + [(None, None, 0, "t")], "id long, doc_id long, art_no int, title string")
    found = search.IndexScores(*(spark.createDataFrame([(i, 0.5) for i in ids], "id long, similarity double") for ids in ([11, 30], [1, 4])))
    got = search.named_articles(articles, found)
    assert got.columns == articles.columns
    assert sorted(r.id for r in got.collect()) == [10, 11, 12, 30, 40, 41, 42]


def test_many_words_equal_one_expression_a_word(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("가나다ab") for _ in range(rng.randint(1, 4))) for _ in range(240)]
    groups = [(f"g{k}", words[k::15] + ["shared"][: k % 2]) for k in range(15)]
    texts = ["".join(rng.choice("가나다ab c\0") for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, "", "shared"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    wanted = {r.id: r.usecases for r in classify.by_keyword(rows.fillna(""), groups).collect()}
    assert {r.id: r.groups for r in classify.by_words(rows.repartition(3), groups).collect()} == wanted
    assert {tuple(r.groups) for r in classify.by_words(rows, []).collect()} == {()} and classify.by_words(rows.limit(0), groups).count() == 0
    with pytest.raises(ValueError, match="NUL"):
        classify.by_words(rows, [("g", [""])])


def test_open_pairs_are_what_is_not_done(spark):
    inst = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "inst_code string")
    codes = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "report_no string")
    done = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), ("b", "9"), ("z", "1"), ("c", None)], "inst_code string, report_no string")
    assert sorted(map(tuple, sync.open_pairs(inst, codes, done).collect())) == [("a", "2"), ("c", "1"), ("c", "2")]
    assert sync.open_pairs(inst, codes.limit(0), done).count() == sync.open_pairs(inst.limit(0), codes, done).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(24)] for _ in range(30)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)]) for i in range(3000)]
    rows += [(5000, None), (5001, [0.0] * 24)]
    return spark.createDataFrame(rows, "id long, embedding array<float>").persist()


@pytest.fixture(scope="module")
def vector_store(spark, vectors, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("v")))
    store.commit(store.state(), vector_index.built(store, "v", vectors, "id"))
    return store


def neighbours(vectors, query, limit):
    vector = F.array(*map(F.lit, query))
    found = vectors.select("id", cosine(F.col("embedding"), vector).alias("c")).filter("c is not null")
    return [r.id for r in found.orderBy(F.desc("c"), "id").limit(limit).collect()]


def test_recall_of_probed_cells(vectors, vector_store):
    queries = [r.embedding for r in vectors.filter("id % 300 = 7").orderBy("id").collect()]
    hits = 0
    for query in queries:
        exact = neighbours(vectors, query, 10)
        hits += len(set(exact) & {r.id for r in vector_index.search(vector_store, "v", query, 10, "id").collect()})
        assert [r.id for r in vector_index.search(vector_store, "v", query, 10, "id", exact=True).collect()] == exact
    assert hits >= 0.9 * 10 * len(queries)


def test_probes_are_tuned_to_a_recall(spark, sf_dir, vectors, vector_store):
    state = vector_index.tuned(vector_store, "v", vectors.filter("id % 100 = 1"), "id", target=0.97)
    ranks = vector_index.cell_ranks(vector_store, state, "v", vectors.filter("id % 100 = 2"), "id", 10).collect()
    assert len(ranks) == 300 and sum(r["rank"] <= state.marks["v:probes"] for r in ranks) >= 270
    assert vector_index.probes_for(spark.createDataFrame([(1, 1)] * 8 + [(1, 3), (1, 9)], "asked int, rank int"), 0.9) == 3
    from corpusloom.plans.queries_store import cells_recall

    found = cells_recall(spark, sf_dir).collect()
    assert sum(r.found for r in found) >= 0.9 * sum(r.asked for r in found) > 0


def test_every_vector_stands_in_one_cell_and_probes_read_few(spark, vectors, vector_store):
    state = vector_store.state()
    assert sorted(r.id for r in vector_store.read("v_cells").select("id").collect()) == list(range(3000))
    assert len(state.tables["v_cells"].parts) > 20
    few = vector_index.search(vector_store, "v", [1.0] * 24, 5, "id", probes=2)
    assert 0 < len(few.inputFiles()) < len(vector_store.read("v_cells").inputFiles()) / 2


def test_filters_make_it_go_on(spark, vectors, vector_store):
    query = vectors.filter("id = 5").first().embedding
    allowed = vectors.filter("id % 500 = 3").select("id")
    found = vector_index.search(vector_store, "v", query, 6, "id", probes=1, allowed=allowed)
    assert [r.id for r in found.collect()] == neighbours(vectors.join(allowed, "id"), query, 6)
    assert vector_index.search(vector_store, "v", query, 6, "id", allowed=allowed.limit(0)).count() == 0


def test_no_vectors_are_an_error(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no vectors"):
        vector_index.built(store, "v", spark.createDataFrame([(1, None)], "id long, embedding array<float>"), "id")


def test_ranks_of_blocks_are_those_of_all_pairs(spark, tmp_path, monkeypatch):
    from pyspark.sql import Window

    monkeypatch.setattr(vector_index, "ASKED_A_BLOCK", 7)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(150, 8)).astype(np.float32).tolist()
    rows = [(i, base[i % 150] if i < 400 else base[3]) for i in range(600)]  # copies of all, very many of one
    vectors = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    odd = [(900, [0.0] * 8), (901, [None] + [1.0] * 7), (902, [float("nan")] * 8), (903, [1.0] * 3), (904, None)]
    queries = vectors.filter("id % 30 = 3").unionByName(spark.createDataFrame(odd, vectors.schema))
    store = Store(spark, str(tmp_path))
    state = store.commit(store.state(), vector_index.built(store, "v", vectors, "id", cells=12))
    asked = queries.select(F.col("id").alias("asked"), F.col("embedding").alias("_query")).filter("_query is not null")
    cells, centres = store.read("v_cells"), store.read("v_centres")
    order = lambda c, tie: Window.partitionBy("asked").orderBy(F.desc(c), tie)
    places = centres.crossJoin(asked).withColumn("c", cosine(F.col("centre"), F.col("_query")))
    places = places.select("asked", "cell", F.row_number().over(order("c", "cell")).alias("rank"))
    top = cells.crossJoin(asked).withColumn("c", cosine(F.col("embedding"), F.col("_query")))
    top = top.withColumn("place", F.row_number().over(order("c", "id"))).filter("place <= 10")
    wanted = sorted(tuple(r) for r in top.join(places, ["asked", "cell"]).select("asked", "rank").collect())
    assert sorted(tuple(r) for r in vector_index.cell_ranks(store, state, "v", queries, "id", 10).collect()) == wanted
    few = vector_index.near_rows(cells, asked, "id", 10, "embedding").groupBy("asked").count().collect()
    assert len(few) == 24 and max(r["count"] for r in few) < 300
