from __future__ import annotations

import random

from pyspark.sql import Row
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KEY = StructType([StructField("i", IntegerType())])
VALUE = StructType(
    [StructField("i", IntegerType()), StructField("s", StringType()), StructField("d", DoubleType(), False)]
)
CHANGES = StructType([StructField("key", KEY), StructField("value", VALUE), StructField("offset", LongType())])
VALUE_DDL = "i int, s string, d double"

LOG_ROWS = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]

# A delete of a key that never was, one that is taken back, one for good; empty and quoted text; keys of LOG_ROWS and others.
CHANGE_ROWS = [
    ((5,), (5, "late", 4.5)),
    ((1,), (1, "new", 0.5)),
    ((2,), None),
    ((3,), (3, "new", 3.5)),
    ((1,), (1, "moved", 1.5)),
    ((3,), None),
    ((8,), (8, 'é, "q"', -2.0)),
    ((3,), (3, "again", 3.25)),
    ((5,), None),
    ((2,), (2, "", 2.5)),
    ((1,), (1, "kept", 1.75)),
]


def last_of(rows):
    """Values that are left after these changes, by replaying them."""
    state = {}
    for key, value in rows:
        state.pop(key, None)
        if value is not None:
            state[key] = value
    return sorted(state.values(), key=repr)


LAST_ROWS = last_of(CHANGE_ROWS)
LIVE_ROWS = [value for _, value in CHANGE_ROWS if value]


def log_data(spark):
    return spark.createDataFrame(LOG_ROWS, VALUE)


def change_data(spark, rows=CHANGE_ROWS, shuffle=True):
    data = [(k, v, o) for o, (k, v) in enumerate(rows)]
    if shuffle:
        random.Random(3).shuffle(data)
    return spark.createDataFrame(data, CHANGES)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df)


def as_tuple(value):
    return tuple(value) if isinstance(value, Row) else value
