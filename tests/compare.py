"""Order-free comparison of a Spark result with a DuckDB one."""

import math

import numpy as np


def plain(value):
    if isinstance(value, np.ndarray):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if value is None or type(value).__name__ in ("NAType", "NaTType") or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bool, np.bool_)):
        return int(value)
    if isinstance(value, (int, float, np.number)):
        number = round(float(value), 6)
        return int(number) if number == int(number) else number
    return str(value)


def rows(frame):
    names = sorted(frame.columns)
    return sorted(repr([plain(v) for v in row]) for row in frame[names].itertuples(index=False, name=None))


def assert_same(spark_result, connection, sql):
    mine, theirs = spark_result.toPandas(), connection.execute(sql).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
