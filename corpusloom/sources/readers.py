"""Readers: catalogs, JSON lines, Markdown trees, manifests, archives, sheets and paged services."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.operators.ranking import first_by
from corpusloom.schema import CATALOG


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of catalog items."""
    return spark.read.option("multiLine", True).schema(CATALOG).json(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines of a declared schema; blank lines are skipped and missing fields are null."""
    return spark.read.schema(schema).json(path)


def json_lines_with_errors(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines): lines that are no JSON objects, with their text."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select("value", F.from_json("value", whole, {"columnNameOfCorruptRecord": "_bad"}).alias("row"))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull()
    return parsed.filter(~bad).select("row.*").drop("_bad"), parsed.filter(bad).select("value")


def markdown_tree(spark: SparkSession, root: str, pattern: str = "*.md", under: Sequence[str] = (), since: str | None = None,
                  skip: Sequence[str] = ()) -> DataFrame:
    """(path, modified, text) of the files below a folder; ``since`` keeps those modified later than a time.

    Files are read whole and in UTF-8; a file of no bytes gives no row. Filters on time come before contents are read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = reader.load(root)
    if since is not None:
        files = files.filter(F.col("modificationTime") > F.lit(since).cast("timestamp"))
    files = files.select("path", F.col("modificationTime").alias("modified"), F.col("content").cast("string").alias("text"))
    if under:
        hit = F.lit(False)
        for part in under:
            hit = hit | F.col("path").contains(part)
        files = files.filter(hit)
    for name in skip:
        files = files.filter(~F.col("path").endswith(f"/{name}"))
    return files


def manifest_files(files: DataFrame, manifest: DataFrame, root: str) -> DataFrame:
    """The files that a manifest (path) lists. A repeated path, one outside the root or one without file is an error."""
    listed = manifest.groupBy("path").agg(F.count("*").alias("_n"))
    joined = listed.join(files.withColumn("_there", F.lit(True)), "path", "left")
    error = (
        F.when(F.col("_n") > 1, F.concat(F.lit("listed twice: "), F.col("path")))
        .when(~F.col("path").startswith(root.rstrip("/") + "/"), F.concat(F.lit("outside the root: "), F.col("path")))
        .when(F.col("_there").isNull(), F.concat(F.lit("no such file: "), F.col("path")))
    )
    checked = F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(F.col("path"))
    return joined.withColumn("path", checked).drop("_n", "_there")


def archive_members(files: DataFrame) -> DataFrame:
    """(path, member, size, content) of the ZIP files in a binary-file DataFrame. Names without the UTF-8 flag are read as
    cp949, else kept. A task holds one archive."""
    import io
    import zipfile

    def name_of(info: zipfile.ZipInfo) -> str:
        if info.flag_bits & 0x800:
            return info.filename
        raw = info.filename.encode("cp437", "replace")
        for encoding in ("cp949", "utf-8"):
            try:
                return raw.decode(encoding)
            except UnicodeDecodeError:
                continue
        return info.filename

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            row = [[path], [name_of(info)], [info.file_size], [archive.read(info)]]
                            yield pa.RecordBatch.from_arrays(list(map(pa.array, row)), ["path", "member", "size", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, size long, content binary")


def sheet_records(cells: DataFrame, marker: str, head_rows: int = 5) -> DataFrame:
    """Long cells (file, sheet, row, column, value) below the first of five rows that holds the marker, with the header's
    name for each column; rows without a value under the marker are dropped.

    Cells are put together to rows, and rows meet their sheet's header in one shuffled join: there may be as many sheets as
    rows, so headers are not broadcast, whatever the planner takes their size for.
    """
    kept = [c for c in cells.columns if c not in ("file", "sheet", "row")]
    rows = cells.groupBy("file", "sheet", "row").agg(F.collect_list(F.struct(*kept)).alias("_cells"))
    headers = rows.filter((F.col("row") <= head_rows) & F.exists("_cells", lambda c: c["value"].eqNullSafe(F.lit(marker))))
    names = F.array_sort(F.transform("_cells", lambda c: F.struct(c["column"].alias("column"), c["value"].alias("name"))))
    heads = headers.groupBy("file", "sheet").agg(F.min("row").alias("_head"), F.min_by(names, "row").alias("_names"))
    # names of columns without a gap are found by their place, others by a look at each
    first = F.get("_names", F.lit(0))["column"]
    gapless = F.forall(F.transform("_names", lambda n, i: F.coalesce(n["column"] == first + i, F.lit(False))), lambda x: x)
    body = rows.join(heads.withColumn("_gapless", gapless).hint("merge"), ["file", "sheet"]).filter(F.col("row") > F.col("_head"))

    def named(c):
        by_place = F.get("_names", (c["column"] - first).cast("int"))
        own = F.when(F.col("_gapless"), F.when(c["column"] >= first, F.filter(F.array(by_place), lambda n: n.isNotNull())))
        own = F.when(F.col("_gapless"), own).otherwise(F.filter("_names", lambda n: n["column"] == c["column"]))
        return F.transform(own, lambda n: F.struct(*(c[k].alias(k) for k in kept), n["name"].alias("name")))

    found = F.flatten(F.filter(F.transform("_cells", named), lambda x: x.isNotNull()))
    body = body.select("file", "sheet", "row", found.alias("_found"))
    keyed = F.exists("_found", lambda x: (x["name"] == marker) & (F.coalesce(x["value"], F.lit("")) != ""))
    order = ["column", *(c for c in kept if c != "column"), "name"]
    return body.filter(keyed).select("file", "sheet", "row", F.explode("_found").alias("x")).select("file", "sheet", "row", *(f"x.{c}" for c in order))


class _Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class PagedSource(DataSource):
    """Rows of a paged service. Options: ``pages``; the fetch function and schema are set by ``paged_source``."""

    fetch: Callable[[int], Iterator[tuple]]
    table: str

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.table

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PagedReader(int(self.options.get("pages", 1)), type(self).fetch)


class _PagedReader(DataSourceReader):
    def __init__(self, pages: int, fetch: Callable[[int], Iterator[tuple]]):
        self.pages, self.fetch = pages, fetch

    def partitions(self) -> list[InputPartition]:
        return [_Page(i) for i in range(1, self.pages + 1)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        for place, row in enumerate(self.fetch(partition.number)):
            yield partition.number, place, *row


def paged_source(spark: SparkSession, fetch: Callable[[int], Iterator[tuple]], schema: str, pages: int,
                 keys: Sequence[str] = ()) -> DataFrame:
    """A page a task, through a pluggable ``fetch(page)``; of rows with equal keys the first by page and place stays."""
    kind = type("Pages", (PagedSource,), {"fetch": staticmethod(fetch), "table": f"_page int, _place int, {schema}"})
    spark.dataSource.register(kind)
    rows = spark.read.format("paged").option("pages", pages).load()
    return (first_by(rows, list(keys), [F.col("_page"), F.col("_place")]) if keys else rows).drop("_page", "_place")
