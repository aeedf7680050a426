"""The hourly job over a folder of landed payloads, as a stream.

The stream is stateless. Each micro-batch is appended to bronze as a slice of
its own and the hours it touches are aggregated again from bronze, so late and
out-of-order files give the same silver table as one batch over all of them. An
event-time watermark would silently drop such rows.

Batch numbers mean nothing without the checkpoint that counts them. A slice is named after
both, and what is known of a source is kept for each of its checkpoints, so a stream that
starts over never meets the slices of an earlier one.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans import store
from tidemark.plans.refresh import Refresh
from tidemark.shared import read_text

PAYLOAD_ROWS = "payload string, city string"
#: What a stream does whose source is known from another checkpoint: RAISE, as the files that
#: are read again would be stored again, or APPEND, for a checkpoint that reads other files.
RAISE, APPEND = "raise", "append"


class UnknownCheckpoint(Exception):
    """A source goes on with a checkpoint that it has not had before."""


def read_payload_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(PAYLOAD_ROWS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select("city", "payload")


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark gives a checkpoint before its first batch, and that a new one
    in the same folder does not have."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def process_batch(
    refresh: Refresh,
    batch: DataFrame,
    batch_id: int,
    drop_late: bool = False,
    source: str = "stream",
    checkpoint: str = "",
    new_checkpoint: str = RAISE,
) -> None:
    """One micro-batch of the stream named ``source``, as numbered by ``checkpoint`` (its
    identity). Doing it again changes nothing.

    Slices and marks belong to the source, so streams and scheduled runs on one root do not
    meet. The newest time is always kept, and ``drop_late`` may be switched on at any batch;
    a replayed batch is compared with the mark that it saw the first time. A source that is
    known from other checkpoints alone raises :class:`UnknownCheckpoint`, or goes on with its
    mark and all its slices if ``new_checkpoint`` is APPEND.
    """
    spark, layout = batch.sparkSession, refresh.layout
    with refresh.logged(spark):
        known = store.read_source(spark, layout, source)
        checkpoints = known.get("checkpoints", {})
        if checkpoints and checkpoint not in checkpoints and new_checkpoint != APPEND:
            raise UnknownCheckpoint(
                f"source {source!r} is known from checkpoint {', '.join(checkpoints)}; "
                f"go on with that, name another source, or pass new_checkpoint={APPEND!r} "
                "if the new checkpoint does not read the same files again"
            )
        own = checkpoints.get(checkpoint, {})
        if own.get("batch", -1) > batch_id:
            return  # done long ago; its slice and its mark stand
        replayed = own.get("batch") == batch_id
        before = own["before"] if replayed else known.get("mark")
        previous = own["previous"] if replayed else known.get("slice")
        name = "-".join(filter(None, (source, checkpoint, f"{batch_id:08d}")))
        store.remove_slice(spark, layout, name)
        summary = refresh.apply(
            spark, batch, name, before if drop_late else None, previous, source, drop_late
        )
        checkpoints[checkpoint] = {"batch": batch_id, "previous": previous, "before": before}
        newest = max(filter(None, (known.get("mark"), summary.new_mark)), default=None)
        facts = refresh.after_slice(spark, known, name)
        store.write_source(spark, layout, source, mark=newest, checkpoints=checkpoints, **facts)
        store.forget_pending(spark, layout, name)
        refresh.registered(spark, summary)


def start_refresh(
    refresh: Refresh,
    payloads: DataFrame,
    checkpoint: str,
    drop_late: bool = False,
    source: str = "stream",
    new_checkpoint: str = RAISE,
) -> StreamingQuery:
    """Process everything that has landed, then stop; run it on a schedule.

    ``checkpoint`` is the folder of the stream's progress. Without it, or with another one,
    the stream starts over, and its ``source`` says whether that is meant: see
    :func:`process_batch`.
    """

    def one(batch: DataFrame, batch_id: int) -> None:
        identity = checkpoint_id(batch.sparkSession, checkpoint)
        process_batch(refresh, batch, batch_id, drop_late, source, identity, new_checkpoint)

    return (
        payloads.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
