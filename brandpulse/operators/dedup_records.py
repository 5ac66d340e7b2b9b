"""One row for each collected record.

A collector that keeps one output for each term stores a record once under every term it names; a job that
reads all outputs then counts it several times. Records that carry an id are told apart by it; records without one
cannot be told from repeats and all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import json_field

# FIXED VALUE: the field that names a record.
ID_FIELD = "id"


def record_id(value_col: str = "value", id_field: str = ID_FIELD) -> Column:
    """The record's id as text (a number is written out); NULL for a malformed record or one without."""
    return json_field(value_col, id_field)


def dedup_records(records: DataFrame, value_col: str = "value", id_field: str = ID_FIELD) -> DataFrame:
    """``(value)``: one record for each id (the least line of those that share it), every record without an id.

    The least is taken inside every task first, so an id that a third of all lines carry is one row a task.
    """
    alone = F.when(F.col("_id").isNull(), F.monotonically_increasing_id())
    keyed = records.select(F.col(value_col).alias("_value"), record_id(value_col, id_field).alias("_id"))
    return (keyed.withColumn("_alone", alone).groupBy("_id", "_alone").agg(F.min("_value").alias(value_col))
            .select(value_col))


def dedup_record_stream(records: DataFrame, time_col: str, delay: str = "1 hour", value_col: str = "value",
                        id_field: str = ID_FIELD) -> DataFrame:
    """The same on a stream: the first record of an id within ``delay`` of event time stays.

    State is bounded by the records of one ``delay``; a copy that comes later than that passes again.
    """
    keyed = records.withColumn("_id", F.coalesce(record_id(value_col, id_field), F.concat(F.lit("\0"), F.uuid())))
    return keyed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["_id"]).drop("_id")
