"""Structured Streaming ingestion of validated events.

``messages`` -> dedup by message id within the receive-time watermark -> strict
validation -> ``foreachBatch`` writing accepted rows (partition ``dt_ingestao``,
the processing date) and, in ``quarantine`` mode, rejected rows with their
reason.  In ``fail`` mode a batch with a bad message raises before anything of
it is written.

Each micro-batch writes to its own ``(run, batch_id)`` partition with dynamic
overwrite, so a batch replayed after a failure replaces its own output and
nothing else; ``run`` is a name kept in the checkpoint folder, so a stream that
starts over with a new checkpoint does not overwrite the batches of the last.

Ids already ingested are kept in ``ids`` (by date, run and batch, written last).
The stream's own state knows the ids of this run inside the watermark; a
micro-batch is anti-joined with the rest: ids of other runs, and of this run
from before the watermark, of the last ``lookback_days``.  In a run that goes on
from its checkpoint these partitions are few or none, so the join costs little.

Counts of every batch go to ``counts``: received (before the dedup, by a named
observation that a ``StreamingQueryListener`` reports), first copies, already
ingested ids, accepted and rejected rows.  They survive a restart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from goalpost.sources import files
from goalpost.streaming.events import validate

#: Working column: when the micro-batch was received.
RECEIVED = "__received"

COUNTS = "batch_id long, lidos long, repetidos long, gravados long, quarentena long, run string"


class RejectedEvent(ValueError):
    """A batch held an invalid event and the stream runs in ``fail`` mode."""


@dataclass
class IngestMetrics:
    batches: list[dict] = field(default_factory=list)

    def totals(self) -> dict[str, int]:
        keys = ("lidos", "gravados", "quarentena")
        return {k: sum(int(b.get(k, 0)) for b in self.batches) for k in keys}


def prepare(messages: DataFrame, required: Sequence[str], event_time: str | None = None,
            watermark: str = "24 hours") -> DataFrame:
    """Dedup redelivered messages (same id) inside the watermark, then validate.

    By default the watermark runs on the *receive* time (the micro-batch
    timestamp), which only moves forward: no message is ever late, so none is
    dropped, and a redelivery within ``watermark`` of the first copy is
    collapsed -- the reference's idempotency is per ingestion date, i.e. on
    processing time too.  An event-time column can be passed instead; then the
    dedup window follows event time, and out-of-order sources risk having old
    rows treated as late by the stateful operator.

    A message without an id gets a fresh one (as the reference falls back to
    the clock): it is kept, never merged with other id-less messages, and --
    as in the reference -- not idempotent.
    """
    messages = messages.withColumn("message_id", F.coalesce(F.col("message_id"), F.expr("uuid()")))
    # the micro-batch's own timestamp: a replayed batch gets the same one
    messages = messages.withColumn(RECEIVED, F.current_timestamp())
    messages = messages.observe("received", F.count(F.lit(1)).alias("recebidos"))
    event_time = event_time or RECEIVED
    deduped = (messages.withWatermark(event_time, watermark)
                       .dropDuplicatesWithinWatermark(["message_id"]))
    return validate(deduped, required)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The run's name, kept in its checkpoint folder: the same after a restart, another for a new checkpoint."""
    note = f"{checkpoint.rstrip('/')}/goalpost-run"
    files.write_note(spark, note, uuid.uuid4().hex[:12])
    return files.read_note(spark, note)


def _known_ids(spark: SparkSession, out: str, run: str, lookback_days: int, state_days: int) -> DataFrame | None:
    """Ids that the stream's state does not hold: of other runs, or of this run from before its state; None if there are
    none.  A batch that is replayed does not meet its own ids: they are of its run and inside its state."""
    if not _dates(spark, f"{out}/ids"):
        return None
    ids = spark.read.schema("message_id string, dt_ingestao date, run string, batch_id long").parquet(f"{out}/ids")
    today = F.current_date()
    return ids.where((F.col("dt_ingestao") >= F.date_sub(today, lookback_days))
                     & ((F.col("run") != run) | (F.col("dt_ingestao") < F.date_sub(today, state_days)))
                     ).select("message_id")


def _write(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                  .partitionBy("dt_ingestao", "run", "batch_id"))
    writer.text(path) if fmt == "json" else writer.parquet(path)


def batch_writer(out: str, mode: str, metrics: IngestMetrics, run: str = "0", lookback_days: int = 7,
                 state_days: int = 1, fmt: str = "parquet"):
    """The ``foreachBatch`` function: leave out known ids, count (one aggregate), write both sides, then the ids."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = (batch.withColumn("dt_ingestao", F.to_date(RECEIVED)).withColumn("run", F.lit(run))
                      .withColumn("batch_id", F.lit(batch_id)))
        known = _known_ids(spark, out, run, lookback_days, state_days)
        batch = (batch.withColumn("__known", F.lit(False)) if known is None else
                 batch.join(known.distinct().withColumn("__known", F.lit(True)), "message_id", "left")
                      .withColumn("__known", F.coalesce("__known", F.lit(False))))
        batch.persist()
        try:
            fresh = ~F.col("__known")
            c = batch.agg(F.count(F.lit(1)).alias("lidos"), F.count_if(~fresh).alias("repetidos"),
                          F.count_if(F.col("valido") & fresh).alias("gravados"),
                          F.count_if(~F.col("valido") & fresh).alias("quarentena")).first()
            if mode == "fail" and c["quarentena"]:
                raise RejectedEvent(f"batch {batch_id}: {c['quarentena']} invalid event(s)")
            place = ["dt_ingestao", "run", "batch_id"]
            accepted = batch.where(fresh & F.col("valido"))
            if fmt == "json":
                # one object a line; blanks between its parts, line ends among them, carry nothing
                _write(accepted.select(F.regexp_replace("body", r"[\r\n]+", " ").alias("value"), *place),
                       f"{out}/accepted", "json")
            else:
                _write(accepted.select("message_id", "body", *place), f"{out}/accepted")
            if mode == "quarantine" and c["quarentena"]:
                _write(batch.where(fresh & ~F.col("valido")).select("message_id", "body", "motivo", *place),
                       f"{out}/quarantine")
            # last: ids count as ingested only when their rows are written
            _write(batch.where(fresh).select("message_id", *place), f"{out}/ids")
            counted = {"batch_id": batch_id, **c.asDict()}
            (spark.createDataFrame([(batch_id, c["lidos"], c["repetidos"], c["gravados"], c["quarentena"], run)], COUNTS)
                  .withColumn("id", F.col("batch_id")).coalesce(1).write.mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic").partitionBy("run", "id").parquet(f"{out}/counts"))
            metrics.batches.append(counted)
        finally:
            batch.unpersist()
    return write


class ReceivedListener(StreamingQueryListener):
    """Writes what each batch of one query received, before the dedup, as a small note that a replay writes again."""

    def __init__(self, spark: SparkSession, out: str, run: str):
        self.spark, self.out, self.run, self.query = spark, out, run, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = p.observedMetrics.get("received")
        if row is not None and (self.query is None or str(p.id) == self.query):
            note = json.dumps({"run": self.run, "batch_id": p.batchId, "recebidos": int(row["recebidos"] or 0)})
            files.write_note(self.spark, f"{self.out}/received/{self.run}-{p.batchId}.json", note + "\n")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """T6, one row a batch of every run: run, batch_id, recebidos, duplicados, gravados, quarentena.

    ``duplicados`` are redelivered copies: those the state dropped and those whose id was ingested before.  A batch whose
    progress was lost with its driver has null for both ``recebidos`` and ``duplicados``."""
    counts = spark.read.schema(COUNTS).parquet(f"{out}/counts")
    seen = spark.read.schema("run string, batch_id long, recebidos long").json(f"{out}/received")
    return (counts.join(seen, ["run", "batch_id"], "left")
                  .select("run", "batch_id", "recebidos",
                          (F.col("recebidos") - F.col("lidos") + F.col("repetidos")).alias("duplicados"),
                          "gravados", "quarentena"))


def run_ingest(messages: DataFrame, out: str, checkpoint: str, required: Sequence[str],
               mode: str = "quarantine", event_time: str | None = None, watermark: str = "24 hours",
               timeout_s: float | None = None, lookback_days: int = 7, fmt: str = "parquet") -> IngestMetrics:
    """Process everything available now (``availableNow``) and stop; restartable from ``checkpoint``.

    ``fmt`` is the accepted rows' format: ``parquet`` (id and raw body) or ``json`` (one object a line)."""
    if mode not in ("fail", "quarantine"):
        raise ValueError("mode must be 'fail' or 'quarantine'")
    if fmt not in ("parquet", "json"):
        raise ValueError("fmt must be 'parquet' or 'json'")
    spark, metrics = messages.sparkSession, IngestMetrics()
    run = run_name(spark, checkpoint)
    start = "unix_timestamp(timestamp'2000-01-01 00:00:00'"
    state_days = int(spark.sql(f"SELECT greatest(1, ceil(({start} + INTERVAL '{watermark}') - {start})) / 86400))")
                     .first()[0])
    listener = ReceivedListener(spark, out, run)
    spark.streams.addListener(listener)
    try:
        q = (prepare(messages, required, event_time, watermark)
             .writeStream.foreachBatch(batch_writer(out, mode, metrics, run, lookback_days, state_days, fmt))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        listener.query = str(q.id)
        try:
            ended = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() is None
        finally:
            if q.isActive:
                q.stop()
    finally:
        _drain(spark)
        spark.streams.removeListener(listener)
    if not ended:
        raise TimeoutError(f"stream not done after {timeout_s} s; it goes on from its checkpoint")
    if q.exception() is not None:
        raise q.exception()
    return metrics


def _drain(spark: SparkSession) -> None:
    """Wait until the listener bus has delivered what was posted, so that the last batch's progress is written."""
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    except Exception:       # the bus is stopping: nothing more will come
        pass


def compact(spark: SparkSession, out: str, before: str, files_per_day: int | None = None) -> list[str]:
    """Join the small batch folders of every ingestion date before ``before`` (ISO date) into ``files_per_day`` files; if
    that is not given, into one for each ``advisoryPartitionSizeInBytes`` of rows, so that no task holds a whole date.

    A date's rows are written to ``days``, then its name is noted in ``_closed`` (one new small file), then its batch
    folders go: readers (``read_accepted``) take a noted date from ``days`` and any other from its batch folders, so they
    see a date once at every moment, also if this is cut short and run again.  Returns the dates closed now."""
    fmt = _format(spark, out)
    closed = _closed(spark, out)
    done = []
    for d in [x for x in _dates(spark, f"{out}/accepted") if x < before]:
        if d not in closed:
            rows = _scan(spark, f"{out}/accepted", fmt).where(F.col("dt_ingestao") == F.lit(d).cast("date"))
            rows = rows.select(*[c for c in ("message_id", "body", "value") if c in rows.columns], "dt_ingestao")
            rows = rows.repartition(files_per_day) if files_per_day else rows.hint("rebalance")
            w = (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("dt_ingestao"))
            w.text(f"{out}/days") if fmt == "json" else w.parquet(f"{out}/days")
            files.write_note(spark, f"{out}/_closed/{d}", d + "\n")
            done.append(d)
        files.remove(spark, f"{out}/accepted/dt_ingestao={d}")
    return done


def _dates(spark: SparkSession, path: str) -> list[str]:
    """Ingestion dates that have a folder in ``path``."""
    return [n.split("=", 1)[1] for n, folder in files.children(spark, path) if folder and n.startswith("dt_ingestao=")]


def _closed(spark: SparkSession, out: str) -> list[str]:
    return [n for n, folder in files.children(spark, f"{out}/_closed") if not folder and not n.startswith(".")]


def _format(spark: SparkSession, out: str) -> str:
    for part in ("accepted", "days"):
        for name in files.data_files(spark, f"{out}/{part}"):
            return "parquet" if name.endswith(".parquet") else "json"
    return "parquet"


def _scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "json":
        return spark.read.text(path).withColumn("dt_ingestao", F.col("dt_ingestao").cast("date"))
    return spark.read.schema("message_id string, body string, dt_ingestao date, run string, batch_id long").parquet(path)


def read_accepted(spark: SparkSession, out: str) -> DataFrame:
    """Accepted events with their ingestion date, closed dates from their joined files: (message_id, body, dt_ingestao),
    or (body, dt_ingestao) of a JSON sink."""
    fmt, closed = _format(spark, out), _closed(spark, out)
    frames = []
    for part, keep in (("accepted", ~F.col("dt_ingestao").isin([*closed, "0001-01-01"])),
                       ("days", F.col("dt_ingestao").isin([*closed, "0001-01-01"]))):
        if _dates(spark, f"{out}/{part}"):
            rows = _scan(spark, f"{out}/{part}", fmt).where(keep)
            frames.append(rows.select(F.col("value").alias("body"), "dt_ingestao") if fmt == "json"
                          else rows.select("message_id", "body", "dt_ingestao"))
    if not frames:
        raise FileNotFoundError(f"no accepted events under {out}")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
