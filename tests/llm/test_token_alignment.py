"""Alignment of two tokenizers against a plain version over the libraries' own tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import token_alignment
from corpusloom.llm.token_counts import byte_symbols
from tests.llm import cases

ALPHABET = "aaabcdeist'rv  <|>ENéÉİ́中文K12½▁.,-\n\t\x1c\x85 　\x7f#한"


@pytest.fixture(scope="module")
def paths():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens_of(paths):
    """A function from a text to [(id, bytes)] under either tokenizer, each encoding the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b, symbol = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1]), byte_symbols()
    a.encode_special_tokens = True

    def run(text):
        if not text:
            return [], []
        found_a = [(i, bytes(symbol[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        found_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            found_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = all(b"".join(x for _, x in found) == whole for found in (found_a, found_b))
        return (found_a, found_b) if same else ([], [])

    return run


def plain(texts, tokens_of):
    """The report's columns, by comparing the byte ranges of tokens."""
    spans, docs, rows = [], [], []
    for text in texts:
        sides = []
        for side in tokens_of(text):
            at, out = 0, []
            for i, content in side:
                out.append((i, at, at + len(content)))
                at += len(content)
            sides.append(out)
        spans.append(sides)
    for a, b in spans:
        links, j = [], 0
        for i, lo, hi in a:
            while j and b[j][1] > lo:
                j -= 1
            while j < len(b) and b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        docs.append(links)
    count = Counter(pair for links in docs for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for (a, b), links in zip(spans, docs):
        shared = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = ["|".join(",".join(str(i) for i, _, hi in side if lo < hi <= end) for side in (a, b)) for lo, end in zip([0, *shared], shared)]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(count[x] == best[x[0]] for x in links)
        rows.append((len(a), len(b), len(groups), len(links), n_best, sum(count[x] for x in links), digest))
    return rows


def report(spark, rows, paths):
    got = token_alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string, row int, pairs string").repartition(3), *paths)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(repr, map(tuple, got.collect())))


def corpus():
    rng = random.Random(11)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [r[1] for r in cases.corpus(n=12) if len(r[1] or "") < 3000]
    texts += [None, "", " ", "  ", "\n", "<|endoftext|> <s> <0x0A> </s> <unk>", "a ▁ b", "word  gap   end ", "same text", "same text", "x" * 300]
    return [(i if i % 17 else None, t, 1, "p") for i, t in enumerate(texts)]


def test_report_equals_the_plain_version(spark, paths, tokens_of):
    rows = corpus()
    wanted = sorted(map(repr, ((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], tokens_of)))))
    assert report(spark, rows, paths) == wanted


def test_rare_pairs_go_by_a_join(spark, paths, tokens_of, monkeypatch):
    monkeypatch.setattr(token_alignment, "FREQUENT", 20)
    rows = corpus()[-60:]
    wanted = sorted(map(repr, ((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], tokens_of)))))
    assert report(spark, rows, paths) == wanted


def test_frequent_pairs_are_bounded(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2, 3] * 10 + [5] * 4 + [900])], "pair long, n long")
    for most in (0, 1, 4, 5, 24, 25, 30, 75, 1000):
        least = token_alignment.frequent_from(counts, most)
        assert counts.filter(f"n >= {least}").count() <= most and counts.filter(f"n >= {least // 2}").count() > (most if least > 1 else -1)
    assert token_alignment.frequent_from(counts.limit(0), 5) == 1


def test_units_are_encoded_as_in_whole_texts(paths, tokens_of, monkeypatch):
    import pyarrow as pa

    from corpusloom.llm.kernels import text_slices

    table = token_alignment.Pair(*paths)
    assert table.by_units
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 16))) for _ in range(3000)]
    for by_units, some in ((True, texts), (False, texts[:300])):
        table.by_units = by_units
        table.clear()
        for lo, hi, raw, offsets in text_slices(pa.array(some)):
            found = table.encode(*token_alignment.spaced(raw, offsets))
            for k in range(lo, hi):
                for side, (ids, ends, bounds) in zip(tokens_of(some[k]), found):
                    a, b = bounds[k - lo], bounds[k - lo + 1]
                    assert ids[a:b].tolist() == [i for i, _ in side], repr(some[k])
                    assert ends[a:b].tolist() == [sum(len(x) for _, x in side[: j + 1]) for j in range(len(side))]


def test_groups_and_links_are_given(spark, paths):
    docs = spark.createDataFrame([(1, "unbelievable tokens"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in token_alignment.aligned(token_alignment.tokenised(docs, *paths)).collect()}
    assert [i for g in rows[1].groups for i in g.a] == rows[1].a_ids and [i for g in rows[1].groups for i in g.b] == rows[1].b_ids
    assert {x.a for x in rows[1].links} == set(rows[1].a_ids) and len(rows[1].links) == len(rows[1].a_ids) + len(rows[1].b_ids) - len(rows[1].groups)
    assert (rows[2].groups, rows[2].links) == ([], [])


def test_a_long_text_and_an_empty_table(spark, paths, tokens_of):
    rng = random.Random(3)
    text = " ".join(rng.choice(["alpha", "betagamma", "delta,", "épsilon", "zz9"]) for _ in range(60_000))
    got = token_alignment.alignment_report(spark.createDataFrame([(1, text)], "doc_id long, text string"), *paths).collect()[0]
    a, b = tokens_of(text)
    assert (got.n_a, got.n_b) == (len(a), len(b)) and got.n_links == got.n_a + got.n_b - got.n_groups == got.count_sum
    assert token_alignment.alignment_report(spark.createDataFrame([], "doc_id long, text string"), *paths).count() == 0


def test_array_functions_meet_a_unit_once_a_task(spark, paths, tokens_of):
    texts = ["alpha betagamma delta, " * 40 + f"zz{i % 3}" for i in range(200)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    rows = token_alignment.unit_rows(docs, *paths, "id")
    assert rows.filter("unit is null").count() == 202 and rows.filter("unit is not null").count() == 3 + 3
    got = sorted(map(tuple, token_alignment.alignment_report(docs.withColumnRenamed("id", "doc_id"), *paths).collect()))
    assert got == [(i, *w) for i, w in enumerate(plain(texts, tokens_of))]


def test_texts_are_put_together_across_emptied_tables(paths, tokens_of):
    import pyarrow as pa

    kind = pa.schema([("id", pa.int64()), ("units", pa.list_(pa.int32())), ("n_a", pa.int64()), ("n_b", pa.int64()), ("unit", pa.int32()),
                      ("groups_text", pa.string()), ("n_groups", pa.int32()), ("pairs", pa.list_(pa.int64()))])
    unit = lambda k, text, pairs: {"unit": k, "groups_text": text, "n_groups": text.count("|"), "pairs": pairs}
    batch = lambda rows: pa.RecordBatch.from_pylist(rows, schema=kind)
    met = token_alignment.MetUnits()
    met.add(batch([unit(0, "1|2", [7]), unit(1, "3|4;5|6", [8, 7])]))
    told = [x.to_pylist() for x in met.report(batch([{"id": 5, "units": [1, 0, 1], "n_a": 5, "n_b": 5}, {"id": 6, "units": [], "n_a": 0, "n_b": 0}]), 10)]
    assert told == [[5, 6], [5, 0], [5, 0], [5, 0], [5, 0], [hashlib.sha256(b"3|4;5|6;1|2;3|4;5|6").hexdigest(), ""], [[7, 8], []], [[3, 2], []]]
    met.add(batch([unit(2, "9|9", [1]), unit(0, "8|8", [3]), unit(1, "6|6", [4])]))
    told = [x.to_pylist() for x in met.report(batch([{"id": 5, "units": [0, 1], "n_a": 2, "n_b": 2}]), 10)]
    assert told[5:] == [[hashlib.sha256(b"8|8;6|6").hexdigest()], [[3, 4]], [[1, 1]]]
    with pytest.raises(RuntimeError):
        met.add(batch([unit(5, "1|1", [1])]))
    with pytest.raises(RuntimeError):
        met.report(batch([{"id": 5, "units": [2], "n_a": 1, "n_b": 1}]), 10)


def test_a_small_table_gives_the_same_report(spark, paths, tokens_of, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE", 400)
    monkeypatch.setattr(token_alignment, "UNITS_AT_ONCE", 7)
    rows = corpus()[-80:]
    wanted = sorted(map(repr, ((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], tokens_of)))))
    assert report(spark, rows, paths) == wanted


def test_array_functions_meet_a_shape_once_a_task(spark, paths, tokens_of, monkeypatch):
    met, whole = [], token_alignment.aligned
    monkeypatch.setattr(token_alignment, "aligned", lambda tokens: met.append(tokens) or whole(tokens))
    rng = random.Random(9)
    words = ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 9))) + rng.choice(["", ".", "##"]) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(80)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = sorted(map(tuple, token_alignment.alignment_report(docs, *paths).collect()))
    assert got == [(i, *w) for i, w in enumerate(plain(texts, tokens_of))]
    used = {w for t in texts for w in (t or "").split()}
    shapes = {tuple(tuple(len(x) for _, x in side) for side in tokens_of(w)) for w in used}
    assert met[0].filter("a_sizes is not null").count() == len(shapes) < len(used)


def test_a_task_whose_tables_are_emptied_gives_the_same_report(spark, paths, tokens_of, monkeypatch):
    def small(path_a, path_b):
        found = token_alignment.Pair(path_a, path_b)
        found.units_kept = 40
        return found

    monkeypatch.setattr(token_alignment, "pair", small)
    monkeypatch.setattr(token_alignment, "SLICE", 400)
    rows = corpus()[-80:]
    wanted = sorted(map(repr, ((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], tokens_of)))))
    assert report(spark, rows, paths) == wanted


def test_units_get_their_ids_into_their_shapes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_alignment, "UNITS_SPELT", 2)
    number = pa.list_(pa.int32())
    kind = pa.schema([("unit", pa.int32()), ("unit_shapes", number), ("unit_a", number), ("unit_b", number), ("shape", pa.int32()),
                      ("groups", pa.list_(pa.struct([("a", number), ("b", number)]))), ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))])
    batch = lambda *rows: pa.RecordBatch.from_pylist(list(rows), schema=kind)
    shape = lambda k, groups, links: {"shape": k, "groups": [{"a": a, "b": b} for a, b in groups], "links": [{"a": a, "b": b} for a, b in links]}
    units = lambda k, shapes, a, b: {"unit": k, "unit_shapes": shapes, "unit_a": a, "unit_b": b}
    told = lambda: [tuple(r.values()) for x in met.spelt() for r in x.to_pylist()]
    one, two = shape(0, [([0], [0])], [(0, 0)]), shape(1, [([0], [0, 1]), ([1], [2])], [(0, 0), (0, 1), (1, 2)])
    met = token_alignment.MetShapes(10, 100)
    met.add(batch(one, two, units(0, [1, 0, 1], [11, 12, 3, 5, 6], [4, 5, 6, 7, 8, 9, 1])))
    wanted = [(0, b"11|4,5;12|6", 2, [114, 115, 126]), (1, b"3|7", 1, [37]), (2, b"5|8,9;6|1", 2, [58, 59, 61])]
    assert told() == wanted and told() == []
    met.add(batch(units(3, [0], [99], [9])))
    assert told() == [(3, b"99|9", 1, [999])]
    # shapes from 0 again
    met.add(batch(shape(0, [([0, 1], [0])], [(0, 0), (1, 0)]), units(0, [0], [7, 8], [9])))
    assert told() == [(0, b"7,8|9", 1, [79, 89])]
    for wrong in (shape(5, [([0], [0])], [(0, 0)]), units(1, [1], [1], [1]), units(1, [0], [1], [1])):
        with pytest.raises(RuntimeError):
            met.add(batch(wrong))
            told()
