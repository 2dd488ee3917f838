"""Shared small helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrill.session import stage


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """``doc_id``, ``text`` and the named columns; a null text is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back, so that lost executors cost a file scan."""
    return stage(df, name)


def grouped_batches(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from batches whose rows are sorted by ``keys``.

    The last group of a batch may go on in the next one, so it is held back.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        ends = tuple(c[-1].as_py() for c in columns)
        cut = batch.num_rows
        while cut and tuple(c[cut - 1].as_py() for c in columns) == ends:
            cut -= 1
        if cut or (held and tuple(c[0].as_py() for c in columns) != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
        last = ends
    if held:
        yield pa.Table.from_batches(held)


def running_before(df: DataFrame, block: str, value: str, out: str) -> DataFrame:
    """One row per ``block`` (a long from 0): the sum of ``value`` in all blocks before it.

    Sums go up two levels, 4,096 blocks to a group, so that no task holds more than a group or
    the list of groups.
    """
    from pyspark.sql import Window

    sums = df.groupBy(block).agg(F.sum(value).alias("__s")).withColumn("__g", F.expr(f"`{block}` div 4096"))
    groups = sums.groupBy("__g").agg(F.sum("__s").alias("__gs")).withColumn("__gg", F.expr("__g div 4096"))
    tops = groups.groupBy("__gg").agg(F.sum("__gs").alias("__ts"))

    def before(name: str, order: str, *keys: str) -> Column:
        # the top level has a row for each 2^24 blocks
        window = Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    tops = tops.select("__gg", before("__ts", "__gg").alias("__tb"))
    groups = groups.withColumn("__gb", before("__gs", "__g", "__gg")).join(tops, "__gg").select("__g", (F.col("__gb") + F.col("__tb")).alias("__gb"))
    return sums.withColumn("__b", before("__s", block, "__g")).join(groups, "__g").select(block, (F.col("__b") + F.col("__gb")).alias(out))
