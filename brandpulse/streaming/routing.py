"""Streams with outputs beside the records themselves.

* ``deadletter_stream``: every line is parsed once, to its text or the reason why it has none, and each batch is
  one write with two parts, records and dead letters: a line is in exactly one of them. ``replay_dead`` parses
  dead letters again after a repair.
* ``route_table_stream``: X1 with a term *table* that may change while the stream runs and be of any size. Every
  batch reads the newest table and meets it by the equi-join of the batch job.

Both write ``batch=<id>`` folders that a replayed batch replaces as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brandpulse.functions.text import array_input, clean_tokens, emit_row_if, parsed_record, record_text, stream_file_name
from brandpulse.operators.mentions import DEFAULT_BROADCAST_BYTES, fits_broadcast, match_terms_table, term_table
from brandpulse.session import shuffles_freed
from brandpulse.sinks.keyed import KeyedTable, Store
from brandpulse.sources.readers import stream_json_lines
from brandpulse.streaming.ingest import _trigger

RECORDS, DEAD = "records", "dead"
_ROWS = "value string, text string, reason string"


def outcomes(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``(value, text, reason, outcome)``, one row for each line: its text, or the reason why it has none."""
    parsed = lines.select(emit_row_if({"value": F.col(value_col), "p": parsed_record(value_col)}, lambda r: F.lit(True)))
    return parsed.select("value", "p.text", "p.reason", F.when(F.col("p.reason").isNull(), RECORDS).otherwise(DEAD).alias("outcome"))


def _write(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").partitionBy("outcome").parquet(folder)


def deadletter_stream(spark: SparkSession, src: str, out: str, checkpoint: str, available_now: bool = True,
                      processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Records and dead letters of JSON-lines files landing in ``src``; both parts of a batch commit together."""
    raw = stream_json_lines(spark, src, max_files_per_trigger)

    def each(batch: DataFrame, batch_id: int) -> None:
        _write(outcomes(batch), f"{out.rstrip('/')}/batch={batch_id}")

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return _trigger(writer, available_now, processing_time).start()


def _replays(spark: SparkSession, out: str) -> tuple[Store, list[str], set[str]]:
    """Committed replay folders and the folders whose dead letters they have taken up."""
    store = Store(spark, out)
    done = sorted((int(n) for n in store.names(f"{out}/_replays") if n.isdigit()))
    taken = {name for n in done for name in json.loads(store.read(f"{out}/_replays/{n}"))}
    return store, [f"replay={n}" for n in done], taken


def _part(spark: SparkSession, out: str, folders: list[str], part: str) -> DataFrame:
    store = Store(spark, out)
    paths = [f"{out}/{f}/outcome={part}" for f in folders if store.exists(f"{out}/{f}/outcome={part}")]
    return spark.read.schema(_ROWS).parquet(*paths) if paths else spark.createDataFrame([], _ROWS)


def read_records(spark: SparkSession, out: str) -> DataFrame:
    """``(value, text)`` of all records, replayed ones included."""
    out = out.rstrip("/")
    store, replays, _ = _replays(spark, out)
    folders = [f"batch={b}" for b in store.batches(out)] + replays
    return _part(spark, out, folders, RECORDS).select("value", "text")


def read_dead(spark: SparkSession, out: str) -> DataFrame:
    """``(value, reason)`` of the dead letters that no replay has taken up."""
    out = out.rstrip("/")
    store, replays, taken = _replays(spark, out)
    folders = [f for f in [*(f"batch={b}" for b in store.batches(out)), *replays] if f not in taken]
    return _part(spark, out, folders, DEAD).select("value", "reason")


def replay_dead(spark: SparkSession, out: str, repair: Callable[[Column], Column]) -> int:
    """Parse the standing dead letters again after ``repair``; what now has a text becomes a record, the rest stays dead.

    The replay counts once its marker is there; of two at a time one succeeds (``CommitConflict``).
    """
    out = out.rstrip("/")
    store, replays, taken = _replays(spark, out)
    folders = [f for f in [*(f"batch={b}" for b in store.batches(out)), *replays] if f not in taken]
    number = len(replays)
    dead = _part(spark, out, folders, DEAD)
    _write(outcomes(dead.select(repair(F.col("value")).alias("value"))), f"{out}/replay={number}")
    store.create(f"{out}/_replays/{number}", json.dumps(folders))
    return number


# ---------------------------------------------------------------------------
# A term table that changes

def term_store(spark: SparkSession, root: str) -> KeyedTable:
    """A versioned term table: ``(term, active)``, the newest row of a term counts."""
    return KeyedTable(spark, root, ["term"], "term string, active boolean", "latest", buckets=4)


def put_terms(spark: SparkSession, root: str, terms: DataFrame, active: bool = True) -> None:
    """Start (or stop) tracking the terms in the first column of ``terms``."""
    rows = terms.select(F.col(terms.columns[0]).alias("term")).where("term IS NOT NULL").distinct()
    term_store(spark, root).upsert(rows.withColumn("active", F.lit(active)))


def tracked_terms(spark: SparkSession, root: str) -> DataFrame:
    return term_store(spark, root).read().where("active").select("term")


def routed_by_table(raw: DataFrame, terms: DataFrame, value_col: str = "value") -> DataFrame:
    """X1 for a term table of any size: ``(value, term, stream)``, a record once under every term it names.

    A table under the checked size meets each record's different tokens where the record is read: no record is shuffled.
    """
    rows = raw.select(F.col(value_col).alias("value"), clean_tokens(record_text(value_col), ascii_input=True).alias("_tok"))
    table = term_table(terms, terms.columns[0])
    if fits_broadcast(table, DEFAULT_BROADCAST_BYTES):
        # The generator stands between, so that the tokens are made once.
        named = rows.select("value", F.explode(F.array(array_input("_tok"))).alias("_tok")).select(
            "value", F.explode(F.array_distinct(F.transform("_tok", lambda t: F.lower(t)))).alias("_term"))
        hits = named.join(F.broadcast(table), "_term").select("value", F.col("_term").alias("term"))
    else:
        hits = match_terms_table(rows, "_tok", terms, term_col=terms.columns[0])
        hits = hits.select("value", F.explode(F.array_distinct("hits")).alias("term"))
    return hits.withColumn("stream", stream_file_name("term"))


def route_table_stream(spark: SparkSession, src: str, out: str, checkpoint: str, terms_root: str, available_now: bool = True,
                       processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """X1 + K5 with the terms of ``term_store(terms_root)``, read anew for every batch.

    A term added between two batches takes effect from the next one on. The table is broadcast only under a
    checked size. Output: text files, packed by gzip (a record stands under every term it names), under
    ``batch=<id>/stream=<name>``.
    """
    raw = stream_json_lines(spark, src, max_files_per_trigger)

    def each(batch: DataFrame, batch_id: int) -> None:
        routed = routed_by_table(batch, tracked_terms(spark, terms_root)).select("value", "stream").hint("rebalance", "stream")
        with shuffles_freed(spark):
            (routed.write.mode("overwrite").partitionBy("stream").option("compression", "gzip")
             .text(f"{out.rstrip('/')}/batch={batch_id}"))

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return _trigger(writer, available_now, processing_time).start()
