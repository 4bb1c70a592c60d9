"""A ledger of progress: states of items, appended in generations to a snapshot table; the last state of an item counts.

A generation is visible as a whole or not at all, so work that is cut off has recorded its finished portions and nothing
else; run again, it takes up what has no final state. Every ``MOST_GENERATIONS`` portions the ledger is merged to one row an item.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.snapshots import State, Store, Table

MOST_GENERATIONS = 16
FINAL = ("done",)


def latest(rows: DataFrame) -> DataFrame:
    """One row an item: that of the last generation; of two in one generation that with the greater state."""
    value = [F.struct("generation", "state").alias("v")]
    found = rows.select("key", *value).groupBy("key").agg(F.max("v").alias("v"))
    return found.select("key", "v.state", "v.generation")


def current(store: Store, name: str) -> DataFrame:
    """(key, state) of every item that has a state."""
    table = store.state().tables.get(name)
    return latest(store.rows(table)).select("key", "state") if table else store.spark.createDataFrame([], "key string, state string")


def record(store: Store, name: str, states: DataFrame) -> State:
    """Append a generation of (key, state); merged with the earlier ones if there are many."""
    portion = states.select(F.col("key").cast("string").alias("key"), "state")

    def change(base: State) -> tuple[dict[str, Table], dict[str, object]]:
        generation = base.marks.get(f"{name}:generation", -1) + 1
        rows, table = portion.withColumn("generation", F.lit(generation)), base.tables.get(name)
        table = store.appended(table, rows)
        if len(table.parts) > MOST_GENERATIONS:
            table = store.write(latest(store.rows(table)).select("key", "state", "generation"))
        return {name: table}, {f"{name}:generation": generation}

    return store.again(change)


def open_items(store: Store, name: str, items: DataFrame, key: str, final: Collection[str] = FINAL) -> DataFrame:
    """The items without a final state."""
    finished = current(store, name).filter(F.col("state").isin(list(final))).select(F.col("key").alias("_key"))
    return items.join(finished, F.col(key).cast("string") == F.col("_key"), "left_anti")


def work_off(store: Store, name: str, items: DataFrame, key: str, step: Callable[[DataFrame], DataFrame], every: int) -> int:
    """Give ``step`` the open items in portions of ``every``, in the order of their keys, and record what it returns as (key, state).

    Returns the number of portions. Items that a step leaves open are tried once in a run; so the work ends.
    """
    portions, after = 0, None
    while True:
        left = open_items(store, name, items.filter(F.col(key).isNotNull()), key)
        left = left if after is None else left.filter(F.col(key) > F.lit(after))
        portion = left.orderBy(key).limit(every)
        after = portion.agg(F.max(key)).first()[0]
        if after is None:
            return portions
        record(store, name, step(portion))
        portions += 1
