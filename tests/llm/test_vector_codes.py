"""Vector codes against a plain version in Python's integers."""

import hashlib
import math
import random
import struct
from collections import defaultdict

import pytest

from corpusloom.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, key int"


def plain(rows, dims, parts=8, entries=16, rounds=6, scale=4096):
    """{(id, integers): (code, error)}, label errors and the digest, one part at a time."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) == dims]
    whole = [[math.floor(scale * x) for x in r[1]] for r in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    width, books = dims // parts, []
    best = [[0] * parts for _ in kept]
    error = [0] * len(kept)
    for p in range(parts):
        own = [w[p * width : (p + 1) * width] for w in whole]
        book = [own[i] for i in first]
        for round_ in range(rounds + 1):
            members = defaultdict(list)
            for i, x in enumerate(own):
                gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
                best[i][p] = gaps.index(min(gaps))
                members[best[i][p]].append(x)
                if round_ == rounds:
                    error[i] += min(gaps)
            if round_ < rounds:
                book = [[sum(c) // len(members[k]) for c in zip(*members[k])] if members[k] else e for k, e in enumerate(book)]
        books.append(book)
    labels = defaultdict(int)
    for r, e in zip(kept, error):
        labels[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    codes = ["".join(f"{k:02x}" for k in c) for c in best]
    return sorted(((r[0], c, e, labels[r[2]]) for r, c, e in zip(kept, codes, error)), key=repr), digest


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def vectors(n, dims=16, seed=3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(30)]
    rows = []
    for i in range(n):
        x = [single(c + rng.gauss(0, 0.1)) for c in rng.choice(centres)]
        rows.append((1000 - 3 * i, x, rng.choice([1, 1, 1, 2, None]), "k", 7))
    return rows


def awkward(dims=16):
    rows = vectors(300, dims)
    rows += [rows[4], rows[4], (rows[7][0], rows[8][1], 5, None, None), (None, rows[9][1], None, None, None)]
    rows += [(-5, None, 1, None, None), (-6, [0.0] * (dims - 1) + [None], 1, None, None), (-7, [float("nan")] * dims, 1, None, None)]
    rows += [(-8, [float("inf")] * dims, None, None, None), (-9, [-float("inf")] + [0.0] * (dims - 1), 2, None, None)]
    rows += [(2000 + k, [0.5] * dims, 3, None, None) for k in range(200)]  # a hot group of equal vectors
    return rows


def found(coded):
    return sorted(((r.id, r.code, r.error, r.label_error) for r in coded.collect()), key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_codes_equal_the_plain_version(spark, partitions):
    rows = awkward()
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(partitions))
    assert (found(coded), books.digest) == plain(rows, 16)


def test_other_sizes_and_few_rows(spark):
    for rows, options in ((vectors(40, 8), {"parts": 4, "entries": 5, "rounds": 3}), (vectors(3, 16), {}), (vectors(1, 8), {})):
        coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), **options)
        assert (found(coded), books.digest) == plain(rows, len(rows[0][1]), **options)


def test_ties_go_to_the_first_entry_and_unused_entries_stay(spark):
    rows = [(i, [single(float(v))] * 8, 1, None, None) for i, v in enumerate([0, 0, 1, 1, 2, 1, 0, 5])]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=4)
    assert (found(coded), books.digest) == plain(rows, 8, entries=4)
    assert books.entries[0, 1].tolist() == [0] and "01" not in {r.code[:2] for r in coded.collect()}


def test_very_large_components(spark):
    rows = vectors(30, 8) + [(5000 + k, [single(x)] * 8, 9, None, None) for k, x in enumerate((3e5, -3e30, 1e7 + 0.5, 3e38))]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    wanted, digest = plain(rows, 8)
    limit = 1 << 63
    got, sums = found(coded), {r[0]: r[3] for r in wanted}
    assert books.digest == digest
    assert [g[:3] for g in got] == [(i, c, e if e < limit else None) for i, c, e, _ in wanted]
    assert all(g[3] in (sums[g[0]], None) or g[0] >= 5000 for g in got)


def test_other_lengths_have_no_code(spark):
    rows = [*vectors(20, 16), (7000, [1.0] * 8, 1, None, None), (7001, [], 1, None, None)]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    wanted, digest = plain(rows, 16)
    assert books.digest == digest
    assert [r[:3] for r in found(coded) if r[0] < 7000] == [r[:3] for r in wanted]
    assert [r[:3] for r in found(coded) if r[0] >= 7000] == [(7000, None, None), (7001, None, None)]
    coded, _ = vector_codes.compress(spark.createDataFrame(vectors(5, 12), SCHEMA))
    assert {r.code for r in coded.collect()} == {None}


def test_empty_table(spark):
    coded, books = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert coded.count() == 0 and books.digest == hashlib.sha256(b"").hexdigest()


def test_many_labels_meet_without_a_broadcast(spark, monkeypatch):
    from corpusloom.llm import shared

    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    monkeypatch.setattr(shared, "HOT_LEAST", 20)
    rows = awkward()
    coded, _ = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert found(coded) == plain(rows, 16)[0]


def test_codes_decode_to_their_entries(spark):
    rows = vectors(50, 16)
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts=4)
    for r in vector_codes.decode(coded, books).collect():
        at = [int(r.code[2 * p : 2 * p + 2], 16) for p in range(4)]
        assert r.vector == [x / 4096 for p, k in enumerate(at) for x in books.entries[p, k].tolist()]


def test_wrong_columns_are_refused(spark):
    rows = spark.createDataFrame([("a", [1.0] * 8, 1)], "vec_id string, embedding array<float>, label int")
    with pytest.raises(ValueError, match="vec_id"):
        vector_codes.compress(rows)
    with pytest.raises(ValueError, match="256"):
        vector_codes.compress(rows, entries=300)


def test_query_equals_its_sql(spark, sf_dir, duck):
    from corpusloom.llm import queries
    from tests.compare import assert_same

    assert_same(queries.op13_vector_codes(spark, sf_dir), duck, queries.ORACLE_SQL["op13_vector_codes"])
