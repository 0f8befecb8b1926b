"""Streams: late-tolerant counts, sessions, deduplication, and the changes of current versions.

Sources are file streams; ``trigger(availableNow=True)`` reads what is there and stops.
Event times are zoned timestamps, as watermarks need.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: The state store that arbitrary state with timers needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_LEAST = -(2**63)
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_PACKED = "key string, epoch long, seq long, row string, observations long"
_CHANGES = "key string, kind string, epoch long, seq long, row string, observations long, history array<long>"


def file_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_trigger: int = 10, time: str = "ts") -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number for each batch, with a zoned event time."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return rows.withColumn(time, F.col(time).cast("timestamp"))


def window_counts(stream: DataFrame, key: str, window: str, slide: str | None = None, grace: str = "7 days", time: str = "ts") -> DataFrame:
    """Rows and sums of ``value`` by window and key, tumbling or sliding; a window is out once the watermark, ``grace`` behind, has passed its end."""
    span = F.window(time, window, slide) if slide else F.window(time, window)
    return stream.withWatermark(time, grace).groupBy(span, key).agg(F.count("*").alias("n"), F.round(F.sum(F.round("value", 2)), 2).alias("total")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "total")


def month_counts(stream: DataFrame, key: str, grace: str = "7 days", time: str = "ts") -> DataFrame:
    """Counts by day with a watermark; calendar months are sums of days, taken when they are read."""
    return stream.withWatermark(time, grace).groupBy(F.window(time, "1 day"), key).agg(F.count("*").alias("n")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), key, "n")


def sessions(stream: DataFrame, key: str, gap: str = "30 minutes", grace: str = "7 days", time: str = "ts") -> DataFrame:
    """Rows of each key without a pause of ``gap``; a session is out once the watermark has passed its end."""
    return stream.withWatermark(time, grace).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def deduplicated(stream: DataFrame, keys: list[str], grace: str = "7 days", time: str = "ts") -> DataFrame:
    """The first row of equal keys within the grace; state older than that is dropped."""
    return stream.withWatermark(time, grace).dropDuplicatesWithinWatermark(keys)


class _Current(StatefulProcessor):
    """Holds the current version of a key, how often it was observed, and when those before it were seen."""

    def __init__(self, late: bool, idle_ms: int | None, most: int) -> None:
        self.late, self.idle_ms, self.most = late, idle_ms, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.current = handle.getValueState("current", "epoch long, seq long, row string, observations long")
        self.history = handle.getListState("history", "epoch long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        before = self.current.get() if self.current.exists() else None
        best, seen = before[:3] if before else None, before[3] if before else 0
        for pdf in rows:  # batch by batch, so that no key's rows are held
            seen += int(pdf["observations"].sum())
            if before and self.late and (old := pdf["epoch"] < before[0]).any():
                yield self._out(key, "late", pdf[old], seen, [])
            top = pdf.sort_values(["epoch", "seq", "row"]).iloc[-1]
            mine = int(top["epoch"]), int(top["seq"]), top["row"]
            best = mine if best is None or mine > best else best
        if best is None:
            return
        self.current.update((*best, seen))
        if before and before[:3] == best:
            return
        past = [e for (e,) in self.history.get()]
        if before:
            past = [before[0], *past][: self.most]
            self.history.put([(e,) for e in past])
        if self.idle_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(best[0] * 1000 + self.idle_ms)
        yield self._out(key, "current", pd.DataFrame([best], columns=["epoch", "seq", "row"]), seen, past)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        if self.current.exists():
            *row, seen = self.current.get()
            past = [e for (e,) in self.history.get()]
            self.current.clear()
            self.history.clear()
            yield self._out(key, "expired", pd.DataFrame([row], columns=["epoch", "seq", "row"]), seen, past)

    @staticmethod
    def _out(key: tuple, kind: str, rows: pd.DataFrame, seen: int, past: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"key": key[0], "kind": kind, "epoch": rows["epoch"], "seq": rows["seq"], "row": rows["row"], "observations": seen, "history": [past] * len(rows)})

    def close(self) -> None:
        pass


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The last row of each key in an Arrow batch, with the number of its rows there."""
    for pdf in batches:
        last = pdf.sort_values(["epoch", "seq", "row"]).drop_duplicates("key", keep="last").drop(columns="observations")
        yield last.merge(pdf.groupby("key", as_index=False)["observations"].sum(), on="key")[["key", "epoch", "seq", "row", "observations"]]


def version_changes(stream: DataFrame, key: str, order: tuple[str, str], *, late: bool = False, idle_ms: int | None = None, time: str | None = None, grace: str = "7 days", most: int = 20) -> DataFrame:
    """What each batch changes: ``kind, observations, history`` and the columns of ``stream``.

    ``current``: the new current row of a key, the last by ``order`` (seconds, then arrival;
    null comes first), of equal ones by its content; at most one a key and batch, none if
    nothing changes.  ``observations`` counts all rows of the key so far, ``history`` has
    the seconds of the rows that it replaced, the newest ``most``, newest first.
    ``late``, if asked for: a row older than the key's current one of the batch before.
    ``expired``, with ``idle_ms`` and the event time ``time``: the watermark (``grace``
    behind) has passed the current row's seconds by so much, and its state is dropped; rows
    behind the watermark are no input then, nor are rows without a time.  A null key has no version.

    Unless late rows or timers need them all, the rows of a key are reduced before they are
    shuffled, so a key with many rows sends one for each Arrow batch.
    """
    epoch, seq = (F.coalesce(F.col(c).cast("long"), F.lit(_LEAST)) for c in order)
    if clash := {"kind", "observations", "history"} & {c.lower() for c in stream.columns}:
        raise ValueError(f"columns clash: {sorted(clash)}")
    rows = stream.where(F.col(key).isNotNull())
    if idle_ms is not None:
        if time is None:
            raise ValueError("idle_ms needs the event time's column")
        rows = rows.where(F.col(time).isNotNull() & F.col(order[0]).isNotNull()).withWatermark(time, grace)
    packed = [F.col(key).cast("string").alias("key"), epoch.alias("epoch"), seq.alias("seq"), F.to_json(F.struct(*(F.col(c) for c in stream.columns)), _JSON).alias("row"), F.lit(1).cast("long").alias("observations")]
    rows = rows.select(*packed, *([F.col(time).alias("_time")] if idle_ms is not None else []))
    if not late and idle_ms is None:
        rows = rows.mapInPandas(_combined, _PACKED)
    out = rows.groupBy("key").transformWithStateInPandas(_Current(late, idle_ms, most), _CHANGES, "append", "none" if idle_ms is None else "eventTime")
    schema = ", ".join(f"`{n}` {t}" for n, t in stream.dtypes)
    return out.select("kind", "observations", "history", F.from_json("row", schema, _JSON).alias("_row")).select("kind", "observations", "history", "_row.*")


def current_rows(changes: DataFrame, key: str, order: tuple[str, str]) -> DataFrame:
    """The current row of each key by a log of ``version_changes``, in one aggregation; a key that expired last has none.

    What changes later is later in ``order`` or, at the same place, has more observations;
    a key that comes back after it expired counts from one again, but lies behind.
    """
    rows = changes.where("kind != 'late'")
    at = F.struct(*(F.coalesce(F.col(c).cast("long"), F.lit(_LEAST)) for c in order), "observations", (F.col("kind") == "expired").alias("_gone"))
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*(F.col(c) for c in rows.columns)), at).alias("_row"))
    return last.select("_row.*").where("kind = 'current'")


def write_complete(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Keeps ``table`` (a folder of versions, the highest number the newest) at all groups of an aggregate, open windows included.

    In complete mode no state is dropped and no row is late.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/v{number}")

    return stream.writeStream.foreachBatch(put).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """The newest version below ``table``, by the names of its files; older ones are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(table)
    last = files.select(F.max(F.regexp_extract("path", r"/v(\d+)/[^/]*$", 1).cast("long"))).first()[0]
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{table}/v{last}")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Appends to Parquet what a stream yields until its source is read, and gives the table.

    The file sink's log makes each batch count once, whatever runs again.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)  # a query takes its settings when it starts
    try:
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
