"""Listing state and exploded rows from streams of updates and pages."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.html import DEFAULT_DETAIL, DetailSelectors
from ..operators.details import code_rows, detail_fields, exploded_rows
from ..operators.state import candidates, decide, latest_updates
from ..schemas import STATE
from ..session import SETTINGS
from ..sources.state_table import commit_updates, committed_batch, drop_old_versions, latest_version, read_state


def streaming_state(updates: DataFrame) -> DataFrame:
    """The state as a streaming aggregate of updates with an orderable `seq`.

    Spark keeps the running values in its state store, keyed and partitioned by listing, so a trigger costs the changed
    listings only. There is no watermark: state never expires, and a late row loses to a later `seq`.
    """
    return latest_updates(updates)


_HELD = "last_seen_at string, updated_at string, updated_seq long, detail_fingerprint string, print_seq long"
_CHANGE = ("listing_id string, kind string, seq long, reason string, last_seen_at string, updated_at string, "
           "detail_fingerprint string")


_Change = Row(*[field.split()[0] for field in _CHANGE.split(", ")])


class _Listing(StatefulProcessor):
    """Keeps one listing: its values, and the `seq` that the last `updated_at` and fingerprint came with."""

    def __init__(self, decisions: bool):
        self._decisions = decisions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("listing", _HELD)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._held.update((initialState.last_seen_at, initialState.updated_at, None, initialState.detail_fingerprint, None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held.get()
        before = tuple(held) if held else None
        seen, updated, updated_seq, printed, print_seq = now = before or (None,) * 5
        for row in rows:
            if self._decisions and (reason := _reason(row.updated_at, before)):
                yield _Change(key[0], "candidate", row.seq, reason, row.last_seen_at, row.updated_at, row.detail_fingerprint)
            if row.last_seen_at is not None and (seen is None or row.last_seen_at > seen):
                seen = row.last_seen_at
            if row.updated_at is not None and _is_later(row.seq, updated_seq):
                updated, updated_seq = row.updated_at, row.seq
            if row.detail_fingerprint is not None and _is_later(row.seq, print_seq):
                printed, print_seq = row.detail_fingerprint, row.seq
        after = (seen, updated, updated_seq, printed, print_seq)
        if before is None or after != now:
            self._held.update(after)
        if before is None or (seen, updated, printed) != (now[0], now[1], now[3]):
            yield _Change(key[0], "state", None, None, seen, updated, printed)

    def close(self) -> None:
        pass


def _is_later(seq: int | None, held: int | None) -> bool:
    return held is None or (seq is not None and seq >= held)


def _reason(updated_at: str | None, before: tuple | None) -> str | None:
    """As `decide`, against the values before this trigger."""
    if before is None:
        return "new"
    if before[3] is None:
        return "no_fingerprint"
    return "updated_at_changed" if updated_at and updated_at != before[1] else None


def _use_column_families(spark: SparkSession) -> None:
    """Spark's default state store has no column families, which `transformWithState` needs; a session that has the default gets
    RocksDB for the streams it starts from here on. Streams with a checkpoint keep the store they began with."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(provider, SETTINGS[provider])


def state_changes(updates: DataFrame, *, initial: DataFrame | None = None, decisions: bool = False) -> DataFrame:
    """The change feed of a stream of updates: `listing_id, kind, seq, reason, last_seen_at, updated_at, detail_fingerprint`.

    Spark's state store keeps each listing's values. A trigger reads and writes those of its own listings, and gives one row of
    kind `state`, with the whole new values, for each listing that it changed; rows that tell nothing new give none. The
    order of arrival does not matter: greatest sighting, last value by `seq` (a long). With `decisions` every update that makes its
    listing a candidate also gives a row of kind `candidate` with its `seq` and reason, against the values before the trigger.
    `initial` has the rows of a state to start from; any update counts as later than these.
    """
    _use_column_families(updates.sparkSession)
    rows = updates.select("listing_id", "last_seen_at", "updated_at", "detail_fingerprint", F.col("seq").cast("long").alias("seq"))
    start = initial.select(STATE.names).groupBy("listing_id") if initial is not None else None
    return rows.groupBy("listing_id").transformWithState(_Listing(decisions), _CHANGE, "Update", "None", initialState=start)


def changes_writer(updates: DataFrame, state_root: str, *, name: str | None = None, keep: int = 10) -> DataStreamWriter:
    """A writer that merges the changes of each trigger into the state table: a commit holds the changed listings only, and
    rewrites their buckets. A trigger that is repeated after its commit is left out (see `incremental_writer`)."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = _writer_name(spark, name)
        if committed_batch(spark, state_root, writer, batch_id) is not None:
            batch.write.format("noop").mode("overwrite").save()  # the stream's own state still has to advance
            return
        commit_updates(batch.where("kind = 'state'").select(STATE.names), state_root, writer=writer, batch=batch_id)
        drop_old_versions(spark, state_root, keep)

    return state_changes(updates).writeStream.outputMode("update").foreachBatch(merge)


def _writer_name(spark, name: str | None) -> str:
    writer = name or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not writer:
        raise ValueError("the stream has no id here; give its writer a name that is its own")
    return writer


def streaming_rows(pages: DataFrame, *, selectors: DetailSelectors = DEFAULT_DETAIL) -> DataFrame:
    """Exploded rows of a stream of detail pages (`listing_id, source_url, scraped_at, html`); keeps no state."""
    stamped = pages.withColumnRenamed("scraped_at", "_scraped_at")
    return exploded_rows(code_rows(detail_fields(stamped, selectors)), scraped_at=F.col("_scraped_at"))


def incremental_writer(updates: DataFrame, state_root: str, decided_path: str, *, name: str | None = None,
                       keep: int = 10) -> DataStreamWriter:
    """A writer that for each batch of updates selects candidates against the state so far, then merges the batch.

    Candidates go to `decided_path` under `writer=W/batch_id=N`, the state becomes the next version whoever wrote the one before.
    W is `name`, or else the id that Spark gives the stream and keeps in its checkpoint. A batch of W that is already
    committed is left out, so a replay changes nothing; another stream, or a run, on the same state is another writer.
    The batch is computed once, and only the buckets of the state that hold its listings are read and written. `keep` versions
    stay, for readers; replays are told however many others have been written since.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = _writer_name(spark, name)
        if committed_batch(spark, state_root, writer, batch_id) is not None:
            return
        batch = batch.persist()
        try:
            before = latest_version(spark, state_root)
            state = read_state(spark, state_root, before, of=batch)
            chosen = candidates(decide(batch, state))
            chosen.select("listing_id", "reason", "seq").write.mode("overwrite").parquet(
                f"{decided_path}/writer={writer}/batch_id={batch_id}")
            commit_updates(latest_updates(batch), state_root, writer=writer, batch=batch_id, after=before)
        finally:
            batch.unpersist()
        drop_old_versions(spark, state_root, keep)

    return updates.writeStream.foreachBatch(merge)


def streaming_distinct(rows: DataFrame, *, at: str = "scraped_at", delay: str = "1 day",
                       keys: tuple[str, ...] = ("listing_id", "job_code")) -> DataFrame:
    """The first row of each key among those that come within `delay` of each other; `at` is a timestamp or ISO text.

    Unlike a plain distinct this forgets: a key is kept in the state store until the watermark, the greatest time seen less
    `delay`, has passed it, so the state grows with the keys of that span and not with the stream. A row that is later than
    the watermark is left out, repeated or not, and counted (`late_rows`). Rows without a time are taken as late.
    """
    time = F.col(at) if dict(rows.dtypes)[at] == "timestamp" else F.try_to_timestamp(at)
    timed = rows.withColumn("_at", time).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def late_rows(query: StreamingQuery) -> int:
    """How many rows the triggers on record of a query have left out for being late."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for progress in query.recentProgress for op in json.loads(progress.json)["stateOperators"])
