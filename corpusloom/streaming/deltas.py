"""Deltas that arrive as files, and feeds that repeat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.snapshots import Store

#: Spark's folder name for null
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _stored(spark: SparkSession, table: str, partition: str) -> dict[object, str]:
    """The folders of a table written by ``partitionBy``, by the value their rows have; folder names aren't read as values."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        return {}
    prefix = f"{partition}="
    folders = [f.getPath() for f in system.listStatus(path) if f.isDirectory() and f.getPath().getName().startswith(prefix)]
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = (unescape(f.getName()[len(prefix) :]) for f in folders)
    return {None if v == NULL_FOLDER else v: f.toString() for v, f in zip(values, folders, strict=True)}


def apply_deltas(spark: SparkSession, source: str, schema: T.StructType, table: str, checkpoint: str,
                 key: str = "doc_id", partition: str = "corpus") -> StreamingQuery:
    """Apply Parquet deltas to a table partitioned by a string column: rows of a delta's keys are replaced, also where a key
    stood in another partition before.

    Only the partitions that a batch touches are rewritten, by dynamic overwrite; a batch that is run again after a
    failure replaces the same rows by the same ones. Null keys and null partitions are values like others. Ends when all
    files are applied. ``stream_into`` does the same to a snapshot table, where readers never meet a batch half applied.
    """
    columns = [f.name for f in schema.fields]

    def replace(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        touched = {r[0] for r in batch.select(partition).distinct().collect()}
        if touched:
            new = batch.select(*columns)
            there = _stored(session, table, partition)
            emptied: set = set()
            if there:
                old = session.read.schema(schema).parquet(table)
                keys = batch.select(F.col(key).alias("_key")).distinct()
                same = F.col(key).eqNullSafe(F.col("_key"))
                moved = {r[0] for r in old.join(keys, same, "left_semi").select(partition).distinct().collect()}
                emptied = moved - touched
                named = touched | moved
                mine = F.col(partition).isin([v for v in named if v is not None])
                mine = F.coalesce(mine, F.lit(False)) | (F.col(partition).isNull() if None in named else F.lit(False))
                new = old.filter(mine).join(keys, same, "left_anti").select(*columns).unionByName(new)
            # what is read and overwritten is the same folder, so the new rows are written aside first
            aside = f"{checkpoint}/aside"
            new.write.mode("overwrite").parquet(aside)
            done = session.read.schema(schema).parquet(aside)
            rows = done.write.mode("overwrite").partitionBy(partition)
            rows.option("partitionOverwriteMode", "dynamic").parquet(table)
            kept = {r[0] for r in done.select(partition).distinct().collect()}
            for value in emptied - kept:  # a dynamic overwrite doesn't touch partitions that a batch emptied
                gone = session._jvm.org.apache.hadoop.fs.Path(there[value])
                gone.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(gone, True)
        batch.unpersist()

    stream = spark.readStream.schema(schema).parquet(source)
    writer = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_into(store: Store, name: str, source: str, schema: T.StructType, checkpoint: str, key: str = "doc_id",
                partition: str | None = "corpus") -> StreamingQuery:
    """Apply Parquet deltas to a snapshot table: a version a batch, with the batch's number in its manifest.

    A batch that is run again after a failure finds its number there and does nothing, so each is applied once.
    """
    mark = f"batch:{checkpoint}"

    def replace(batch: DataFrame, number: int) -> None:
        batch = batch.persist()

        def change(state):
            table = state.tables.get(name)
            if table is None:
                return {name: store.write(batch, partition)}, {mark: number}
            return {name: store.replaced(table, batch, key)}, {mark: number}

        if store.state().marks.get(mark, -1) < number:
            store.again(change)
        batch.unpersist()

    stream = store.spark.readStream.schema(schema).parquet(source)
    writer = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def first_seen(feed: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """A feed's rows once for each key within a watermark; works on streams and tables alike."""
    return feed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys) if feed.isStreaming else feed.dropDuplicates(keys)


def counts_by_window(events: DataFrame, ts: str, width: str, by: list[str], delay: str = "10 minutes") -> DataFrame:
    """Counts by event-time window, an extension over the batch operators: late rows count up to the watermark."""
    rows = events.withWatermark(ts, delay) if events.isStreaming else events
    counted = rows.groupBy(F.window(ts, width), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), *by, "n")
