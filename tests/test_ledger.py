"""The ledger of progress: cut off and run again, merged, and written by two."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import ledger
from corpusloom.operators.snapshots import Store


def states(store, name="work"):
    return sorted((r.key, r.state) for r in ledger.current(store, name).collect())


def test_work_that_is_cut_off_goes_on_to_the_same_state(spark, tmp_path):
    items = spark.createDataFrame([(f"k{i:02d}",) for i in range(23)] + [(None,)], "key string")
    seen = []

    def step(portion, cut=None):
        keys = [r.key for r in portion.collect()]
        if cut is not None and len(seen) == cut:
            raise RuntimeError("killed")
        seen.append(keys)
        return portion.select("key", F.when(F.col("key").endswith("7"), "failed").otherwise("done").alias("state"))

    whole = Store(spark, str(tmp_path / "a"))
    assert ledger.work_off(whole, "work", items, "key", step, 10) == 3
    seen.clear()
    other = Store(spark, str(tmp_path / "b"))
    with pytest.raises(RuntimeError, match="killed"):
        ledger.work_off(other, "work", items, "key", lambda p: step(p, 1), 10)
    assert len(states(other)) == 10
    assert ledger.work_off(other, "work", items, "key", step, 10) == 2
    # the second run takes up the failed one of the first ten again, and no item that is done
    assert seen[1][0] == "k07" and states(other) == states(whole) and len(states(whole)) == 23
    assert sorted(set(sum(seen, []))) == [f"k{i:02d}" for i in range(23)]


def test_the_last_state_counts_also_when_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_GENERATIONS", 2)
    store = Store(spark, str(tmp_path))
    assert states(store) == []
    wanted, parts = {}, []
    for generation in range(5):
        rows = [(f"k{i}", f"s{generation}") for i in range(generation, 4)]
        ledger.record(store, "work", spark.createDataFrame(rows, "key string, state string"))
        wanted |= dict(rows)
        parts.append(len(store.state().tables["work"].parts))
        assert states(store) == sorted(wanted.items())
    assert parts == [1, 2, 1, 2, 1]
