"""Work folders, staged tables and bounded samples that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_made: list[tuple[SparkSession, str]] = []
_local_roots: dict[str, str] = {}


def _qualified(spark: SparkSession, root: str) -> str:
    """A path with its scheme: Hadoop's default file system is that of a path without one."""
    if "://" not in root:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        root = system.makeQualified(path).toString()
    scheme, slash, rest = root.partition(":/")
    return root if not slash or rest.startswith("/") else f"{scheme}:///{rest}"


def work_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only for a local master."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_roots.setdefault(spark.sparkContext.applicationId, "")
        if not root:
            root = _local_roots[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    return _qualified(spark, root)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, removed when the driver ends, or earlier by ``dropped_at_end``."""
    path = f"{work_root(spark).rstrip('/')}/corpusloom/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a work folder by Hadoop's file system, whichever store it is in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def dropped_at_end(spark: SparkSession, but: tuple[str, ...]) -> Iterator[None]:
    """Remove the folders made inside, but for those with the given names: what the caller's result still reads."""
    first = len(_made)
    yield
    inside = _made[first:]
    kept = [m for m in inside if m[1].rpartition("/")[2].rpartition("-")[0] in but]
    for session, path in inside:
        if (session, path) not in kept:
            drop_dir(session, path)
    _made[first:] = kept


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            drop_dir(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended already; others may not
            continue


ARROW_ROWS = 2000


def modest_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have ``ARROW_ROWS`` rows at most: texts are long, and both ends hold a batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """``name`` with as many underscores before it as it takes not to be a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % folds


def in_fold(id_column: Column, folds: int, fold: int) -> Column:
    """Whether an id falls into a fold; a null id falls into none."""
    return F.coalesce(id_fold(id_column, folds) == fold, F.lit(False))


def bounded_sample(keys: DataFrame, id_column: str, class_column: str, per_class: int) -> DataFrame:
    """Rows of ``keys`` (narrow: no texts), about ``per_class`` of each class, chosen by a hash of the id.

    The bound holds in expectation for any input size. A class with fewer rows is kept whole.
    """
    scale = 1 << 30
    totals = keys.groupBy(class_column).agg(F.count("*").alias("_rows"))
    share = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("_rows"))
    mine = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("sample")), F.lit(scale))
    return keys.join(F.broadcast(totals), class_column).filter(mine < share * scale).drop("_rows")


SALTS = 64


def salt(column: Column, salts: int = SALTS) -> Column:
    """A small number fixed by the column's value, to deal a hot group out."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


HOT_LEAST, HOT_SHARE = 1000, 10_000


def hot_keys(rows: DataFrame, keys: list[str]) -> list[tuple]:
    """Keys with more than a ``HOT_SHARE``-th of all rows (and ``HOT_LEAST``): there are at most ``HOT_SHARE`` of them.

    ``rows`` should be a staged table: it is counted, and its keys are counted with partial sums.
    """
    least = max(HOT_LEAST, rows.count() // HOT_SHARE)
    if rows.limit(least + 1).count() <= least:
        return []
    return [tuple(r) for r in rows.groupBy(*keys).count().filter(F.col("count") > least).drop("count").collect()]


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], by: Column, hot: list[tuple], how: str = "inner") -> DataFrame:
    """Join on ``keys``. Rows of a hot key are dealt over ``SALTS`` by a hash of ``by``, with a copy of what the table has for
    the key at each, so that no task gets all rows of one key."""
    if not hot:
        return rows.join(table, keys, how)
    spark = rows.sparkSession
    names = [f"_hot{i}" for i in range(len(keys))]
    listed = spark.createDataFrame(hot, T.StructType([T.StructField(n, rows.schema[k].dataType) for n, k in zip(names, keys, strict=True)]))
    listed = F.broadcast(listed.withColumn("_is_hot", F.lit(True)))
    met = [F.col(k) == F.col(n) for k, n in zip(keys, names, strict=True)]
    left = rows.join(listed, met, "left").withColumn("_salt", F.when(F.col("_is_hot"), salt(by)).otherwise(0))
    copies = F.when(F.col("_is_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(listed, met, "left").withColumn("_salt", F.explode(copies)).drop(*names, "_is_hot")
    return left.drop(*names, "_is_hot").join(right, [*keys, "_salt"], how).drop("_salt")


def shared_groups(rows: DataFrame, keys: list[str], salt_col: str, value: Column, name: str) -> DataFrame:
    """(keys, salt, name) for groups of two rows or more; ``name`` aggregates ``value`` by max.

    Rows meet by key and salt first, then at most ``SALTS`` partial rows by key, so no task gets a whole hot group;
    joined by key and salt, the result deals a hot group's rows over the salts too.
    """
    part = rows.groupBy(*keys, salt_col).agg(F.max(value).alias("_part"), F.count("*").alias("_rows"))
    whole = part.groupBy(*keys).agg(
        F.max("_part").alias(name), F.sum("_rows").alias("_all"), F.collect_list(salt_col).alias("_salts")
    )
    return whole.filter("_all > 1").select(*keys, F.explode("_salts").alias(salt_col), name)
