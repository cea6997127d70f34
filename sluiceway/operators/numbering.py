"""Dense numbers within groups, without bringing a group together."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.structs import root

# Width of the row counter inside monotonically_increasing_id.
ROW_BITS = 33

Stage = Callable[[DataFrame, str], DataFrame]


def numbered(df: DataFrame, group: str, stage: Stage, order_by: Sequence[str] = (), number: str = "number", starts: DataFrame | None = None) -> DataFrame:
    """`df` with a column that numbers the rows of each `group` from 0 without a gap, along `order_by` or the input's order.

    Tasks number their own rows, and each adds the number of rows that earlier tasks hold; only these counts, one per task
    and group, are summed in order. So a group that holds most of the rows is spread over tasks like any other. `stage`
    writes a DataFrame and reads it back, so that a task run again finds its rows in the same places. `starts (group,
    start)` has first numbers other than 0.
    """
    position, task, row = "_position", "_task", "_row"
    columns = [root(c) for c in df.columns]
    if order_by:
        # The position splits runs of equal order values over several tasks. The range shuffle reads its
        # input twice, for the ranges and for the rows.
        rows = stage(df, "numbering-input").withColumn(position, F.monotonically_increasing_id())
        by = [*[root(c) for c in order_by], F.col(position)]
        rows = rows.repartitionByRange(*by).sortWithinPartitions(root(group), *by)
    else:
        rows = df.withColumn(position, F.monotonically_increasing_id()).sortWithinPartitions(root(group), position)
    rows = rows.select(*columns, F.monotonically_increasing_id().alias(row))
    rows = stage(rows.withColumn(task, F.shiftright(row, ROW_BITS)), "numbering-rows")
    counts = rows.groupBy(root(group), task).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"))
    earlier = Window.partitionBy(root(group)).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if starts is not None:
        counts = counts.join(starts.select(root(group), F.col("start").alias("_more")), group, "left")
        counts = counts.withColumn("_start", F.col("_start") + F.coalesce("_more", F.lit(0)))
    # A table of known size: Spark broadcasts it below the threshold, else sorts and merges.
    counts = stage(counts.select(root(group), task, "_first", "_start"), "numbering-starts")
    joined = rows.join(counts, [group, task])
    return joined.select(*columns, (F.col("_start") + F.col(row) - F.col("_first")).alias(number))
