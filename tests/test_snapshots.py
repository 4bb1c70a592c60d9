"""Snapshot tables, and deltas with null and odd partition values."""

import pytest
from pyspark.sql import types as T

from corpusloom.operators.snapshots import Conflict, Store
from corpusloom.streaming import deltas

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "body", "corpus")])
OLD = [("a", "1", "x:y"), ("b", "1", None), ("c", "1", "p=q/é"), ("d", "1", "plain"), (None, "1", None), ("e", "1", "")]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def got(rows):
    return sorted(map(repr, map(tuple, rows.collect())))


def want(rows):
    return sorted(map(repr, rows))


def test_versions_stay_readable(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.versions() == [] and store.state().tables == {}
    store.overwrite({"t": frame(spark, OLD), "u": frame(spark, OLD[:2])}, {"t": "corpus"})
    store.overwrite({"t": frame(spark, OLD[:1])}, {"t": "corpus"})
    assert got(store.read("t")) == want(OLD[:1]) and got(store.read("t", 1)) == want(OLD)
    assert got(store.read("u")) == want(OLD[:2]) and store.versions() == [1, 2]
    assert got(store.read("t", 1, [None, "x:y"])) == want([r for r in OLD if r[2] in (None, "x:y")])
    store.retain(1)
    assert store.versions() == [2] and got(store.read("u")) == want(OLD[:2])
    assert len(list((tmp_path / "s" / "data").iterdir())) == 2


def test_a_replacement_touches_its_partitions_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    base = store.overwrite({"t": frame(spark, OLD)}, {"t": "corpus"})
    delta = [("a", "2", None), ("c", "2", "plain"), (None, "2", "x:y"), ("f", "2", "new value")]
    table = store.replaced(base.tables["t"], frame(spark, delta), "doc_id")
    store.commit(base, {"t": table})
    assert got(store.read("t")) == want([OLD[1], OLD[3], OLD[5], *delta])
    same = {p.folder for p in base.tables["t"].parts} & {p.folder for p in table.parts}
    assert {p.value for p in table.parts if p.folder in same} == {""}  # neither read nor written
    removed = store.replaced(table, frame(spark, []), "doc_id", frame(spark, OLD[3:4]))
    assert got(store.rows(removed)) == want([OLD[1], OLD[5], *delta])


def test_a_killed_writer_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.overwrite({"t": frame(spark, OLD), "u": frame(spark, OLD)})
    real, written = Store.write, []

    def dies(self, rows, partition=None):
        if written:
            raise KeyboardInterrupt
        written.append(real(self, rows, partition))
        return written[0]

    monkeypatch.setattr(Store, "write", dies)
    with pytest.raises(KeyboardInterrupt):
        store.overwrite({"t": frame(spark, []), "u": frame(spark, [])})
    assert got(store.read("t")) == got(store.read("u")) == want(OLD) and store.versions() == [1]
    # killed between writing the manifest aside and renaming it
    (tmp_path / "s" / "manifests" / ".half").write_text("{")
    assert Store(spark, str(tmp_path / "s")).state().version == 1
    monkeypatch.setattr(Store, "write", real)
    store.overwrite({"t": frame(spark, OLD[:1])})
    store.retain(1)
    assert got(store.read("t")) == want(OLD[:1]) and len(list((tmp_path / "s" / "data").iterdir())) == 2


def test_of_two_writers_one_starts_again(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    base = store.overwrite({"t": frame(spark, OLD[:1])})
    store.commit(base, {"t": store.appended(base.tables["t"], frame(spark, OLD[1:2]))})
    with pytest.raises(Conflict):
        store.commit(base, {"t": store.write(frame(spark, []))})
    tries = []

    def change(state):
        if not tries:  # another writer comes first
            store.commit(state, {"t": store.appended(state.tables["t"], frame(spark, OLD[2:3]))})
        tries.append(state.version)
        return {"t": store.appended(state.tables["t"], frame(spark, OLD[3:4]))}, {}

    store.again(change)
    assert tries == [2, 3] and got(store.read("t")) == want(OLD[:4])


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_streamed_deltas_are_applied_once(spark, tmp_path):
    store, source = Store(spark, str(tmp_path / "s")), str(tmp_path / "in")
    start = lambda: run(deltas.stream_into(store, "t", source, SCHEMA, str(tmp_path / "c")))
    frame(spark, OLD).coalesce(1).write.parquet(source)
    start()
    frame(spark, [("c", "2", "x:y"), ("b", "2", None)]).coalesce(1).write.mode("append").parquet(source)
    start()
    wanted = want([*OLD[:1], *OLD[3:], ("c", "2", "x:y"), ("b", "2", None)])
    assert got(store.read("t")) == wanted
    last = store.versions()[-1]
    # the stream's own record of its last batch is lost: it runs again and finds its number
    for name in (tmp_path / "c" / "commits").iterdir():
        if name.name.strip(".").split(".")[0] == "1":
            name.unlink()
    start()
    assert store.versions()[-1] == last and got(store.read("t")) == wanted


def test_plain_deltas_keep_null_and_escaped_partitions(spark, tmp_path):
    table, source = str(tmp_path / "t"), str(tmp_path / "in")

    def add(rows):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        run(deltas.apply_deltas(spark, source, SCHEMA, table, str(tmp_path / "c")))
        return sorted(repr((r.doc_id, r.body, r.corpus)) for r in spark.read.schema(SCHEMA).parquet(table).collect())

    rows = [r for r in OLD if r[2] != ""]  # Hive folders can't tell an empty value from null
    assert add(rows) == want(rows)
    assert add([("b", "2", None)]) == want([rows[0], *rows[2:], ("b", "2", None)])  # (None, null) stays
    moved = [("c", "3", "plain"), (None, "3", "x:y")]  # c leaves an escaped folder empty, the null key leaves null
    assert add(moved) == want([rows[0], ("b", "2", None), rows[3], *moved])
