"""Writers: JSON lines, quoted CSV, Markdown documents and views by label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOM = "﻿"


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def csv_lines(rows: DataFrame) -> DataFrame:
    """(line): all fields quoted, quotes doubled, for readers that expect just that."""
    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))

    return rows.select(F.concat_ws(",", *map(cell, rows.columns)).alias("line"))


def write_csv(rows: DataFrame, path: str, bom: bool = True) -> None:
    """Quoted CSV; each part file starts with the header line, after a byte order mark if ``bom``."""
    import pyarrow as pa

    header = (BOM if bom else "") + ",".join('"' + n.replace('"', '""') + '"' for n in rows.columns)

    def headed(batches):
        for number, batch in enumerate(batches):
            if not number:
                yield pa.RecordBatch.from_arrays([pa.array([header])], ["line"])
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["line"])

    csv_lines(rows).mapInArrow(headed, "line string").write.mode("overwrite").text(path)


def markdown_document(title: Column, body: Column, **fields: Column) -> Column:
    """A document with YAML front matter; null fields are left out and quotes doubled."""
    quoted = [
        F.when(v.isNotNull(), F.concat(F.lit(f"{k}: '"), F.replace(v.cast("string"), F.lit("'"), F.lit("''")), F.lit("'")))
        for k, v in {"title": title, **fields}.items()
    ]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *quoted), F.lit("\n---\n\n"), F.coalesce(body, F.lit("")), F.lit("\n"))


def write_views(rows: DataFrame, path: str, labels: str = "usecases") -> None:
    """A folder for each label with the rows that have it."""
    rows.withColumn("usecase", F.explode(labels)).drop(labels).write.mode("overwrite").partitionBy("usecase").parquet(path)
