import os

from pyspark.sql import functions as F

from advertlode.operators.details import code_rows, detail_fields, exploded_rows
from advertlode.operators.state import candidates, decide, upsert
from advertlode.plans import inputs
from advertlode.schemas import STATE
from advertlode.session import work_dir
from advertlode.sources.state_table import commit_state, manifest, read_state, versions
from advertlode.streaming.state_stream import (changes_writer, incremental_writer, late_rows, state_changes, streaming_distinct,
                                                streaming_rows, streaming_state)

from .conftest import SF


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def finish(writer, checkpoint):
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_state_over_several_triggers_equals_batch(spark):
    path = work_dir(spark, "stream")
    updates = inputs.updates(spark, SF).drop("first_run", "source_url")
    result = {}
    for n, part in enumerate((updates.where("seq >= 500"), updates.where("seq < 500"))):
        # The later half lands first: order of arrival does not matter.
        part.write.parquet(f"{path}/in/drop={n}")
        stream = spark.readStream.schema(updates.schema).parquet(f"{path}/in/drop=*")
        writer = streaming_state(stream).writeStream.outputMode("update").foreachBatch(
            lambda batch, _: result.update({r.listing_id: tuple(r) for r in batch.collect()}))
        finish(writer, f"{path}/checkpoint")
    assert sorted(result.values(), key=repr) == rows(upsert(spark.createDataFrame([], STATE), updates))


def test_rows_equal_batch(spark):
    path = work_dir(spark, "stream")
    pages = inputs.advert_pages(spark, SF).selectExpr("*", "'now' AS scraped_at")
    pages.write.parquet(f"{path}/pages")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 3).parquet(f"{path}/pages")
    finish(streaming_rows(stream).writeStream.format("parquet").option("path", f"{path}/rows"), f"{path}/checkpoint")
    batch = exploded_rows(code_rows(detail_fields(pages.drop("scraped_at"))), scraped_at="now")
    assert rows(spark.read.parquet(f"{path}/rows")) == rows(batch)


def play(spark, path, source, checkpoint):
    updates = spark.read.parquet(f"{path}/{source}")
    stream = spark.readStream.schema(updates.schema).parquet(f"{path}/{source}")
    finish(incremental_writer(stream, f"{path}/state", f"{path}/decided"), f"{path}/{checkpoint}")
    return (versions(spark, f"{path}/state"), rows(read_state(spark, f"{path}/state")),
            rows(spark.read.parquet(f"{path}/decided").select("listing_id", "reason", "seq")))


def test_replayed_batch_changes_nothing(spark):
    path = work_dir(spark, "stream")
    updates = inputs.updates(spark, SF)
    updates.write.parquet(f"{path}/in")
    first = play(spark, path, "in", "checkpoint")
    assert first[0] == [0] and first[2] == rows(candidates(decide(updates, spark.createDataFrame([], STATE))).select(
        "listing_id", "reason", "seq"))
    # Without its commit mark the stream delivers batch 0 again, under the same id.
    folder = f"{path}/checkpoint/commits".removeprefix("file:")
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    assert play(spark, path, "in", "checkpoint") == first


def test_streams_and_batches_on_one_state_lose_nothing(spark):
    path = work_dir(spark, "stream")
    updates = inputs.updates(spark, SF)
    part = (F.col("last_seen_at") >= "2024-01-11").cast("int") + (F.col("last_seen_at") >= "2024-01-21").cast("int")
    for n in range(3):
        updates.where(part == n).write.parquet(f"{path}/in-{n}")
    commit_state(upsert(spark.createDataFrame([], STATE), spark.read.parquet(f"{path}/in-0")), f"{path}/state")
    play(spark, path, "in-1", "checkpoint-1")
    known, state, _ = play(spark, path, "in-2", "checkpoint-2")  # batch 0 again, of another stream
    assert known == [0, 1, 2] and state == rows(upsert(spark.createDataFrame([], STATE), updates))


UPDATE = "listing_id string, last_seen_at string, updated_at string, detail_fingerprint string, seq long"


def land(spark, path, n, *found):
    spark.createDataFrame(list(found), UPDATE).write.parquet(f"{path}/in/drop={n}")


def feed(spark, path, **options):
    """The changes of one trigger over what has landed since the last."""
    from pyspark.sql.types import _parse_datatype_string

    out = []
    stream = spark.readStream.schema(_parse_datatype_string(UPDATE)).parquet(f"{path}/in/drop=*")
    finish(state_changes(stream, **options).writeStream.outputMode("update").foreachBatch(lambda batch, _: out.extend(batch.collect())),
           f"{path}/checkpoint")
    return sorted((tuple(r) for r in out), key=repr)


def test_the_feed_has_what_changed_and_nothing_else(spark):
    path = work_dir(spark, "stream")
    land(spark, path, 0, ("A", "t1", "u1", None, 1), ("B", "t1", "", "f1", 2), ("C", "t1", None, None, 3), ("A", "t2", None, "f2", 4))
    assert feed(spark, path) == [("A", "state", None, None, "t2", "u1", "f2"), ("B", "state", None, None, "t1", "", "f1"),
                                 ("C", "state", None, None, "t1", None, None)]
    # An earlier sighting and an earlier value that come late, and a repeated row, change nothing.
    land(spark, path, 1, ("A", "t0", "u0", "f0", 0), ("B", "t1", "", "f1", 2), ("C", "t1", "u9", None, 9), ("D", None, None, None, 10))
    assert feed(spark, path) == [("C", "state", None, None, "t1", "u9", None), ("D", "state", None, None, None, None, None)]


def test_decisions_against_an_initial_state(spark):
    path = work_dir(spark, "stream")
    held = spark.createDataFrame([("A", "t0", "u1", "f"), ("B", "t0", None, None)], STATE)
    land(spark, path, 0, ("A", "t1", "u1", None, 1), ("A", "t1", "u2", None, 2), ("A", "t1", "", None, 3), ("B", "t1", "x", None, 4),
         ("C", "t1", None, None, 5), ("C", "t1", None, None, 6))
    found = [r[:4] for r in feed(spark, path, initial=held, decisions=True) if r[1] == "candidate"]
    assert found == [("A", "candidate", 2, "updated_at_changed"), ("B", "candidate", 4, "no_fingerprint"), ("C", "candidate", 5, "new"),
                     ("C", "candidate", 6, "new")]


def test_changes_over_triggers_and_replays_equal_batch(spark):
    path = work_dir(spark, "stream")
    updates = inputs.updates(spark, SF).drop("first_run", "source_url")

    def play():
        stream = spark.readStream.schema(updates.schema).parquet(f"{path}/in/drop=*")
        finish(changes_writer(stream, f"{path}/state"), f"{path}/checkpoint")
        return rows(read_state(spark, f"{path}/state")), versions(spark, f"{path}/state")

    for n, part in enumerate((updates.where("seq >= 500"), updates.where("seq < 500"))):  # the later half lands first
        part.write.parquet(f"{path}/in/drop={n}")
        found = play()
    assert found == (rows(upsert(spark.createDataFrame([], STATE), updates)), [0, 1])
    # The commit mark of the last trigger is lost, so it runs again, from the state before it.
    folder = f"{path}/checkpoint/commits".removeprefix("file:")
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/{name}")
    assert play() == found
    # A trigger of one listing rewrites one bucket.
    before = manifest(spark, f"{path}/state", 1).folders
    updates.limit(1).selectExpr("'one' AS listing_id", "last_seen_at", "updated_at", "detail_fingerprint", "seq").write.parquet(f"{path}/in/drop=2")
    play()
    after = manifest(spark, f"{path}/state", 2).folders
    assert sum(after[b] != before.get(b) for b in after) == 1


def test_distinct_rows_of_a_stream(spark):
    """Repeated rows are left out within the delay, also over triggers; rows behind the watermark are left out and counted."""
    path, schema = work_dir(spark, "stream"), "listing_id string, job_code string, scraped_at string"
    drops = [[("A", "1", "2024-01-01T00:00:00Z"), ("A", "1", "2024-01-01T09:00:00Z"), ("A", "2", "2024-01-01T01:00:00Z")],
             [("A", "1", "2024-01-01T12:00:00Z"), ("B", "1", "2024-01-10T00:00:00Z")],
             [("C", "1", "2024-01-02T00:00:00Z"), ("B", "1", "2024-01-09T12:00:00Z"), ("A", "1", "2024-01-10T01:00:00Z"), ("D", None, "2024-01-10T01:00:00Z")]]
    late = 0
    for n, found in enumerate(drops):
        spark.createDataFrame(found, schema).write.parquet(f"{path}/in/drop={n}")
        stream = spark.readStream.schema(spark.createDataFrame(found, schema).schema).parquet(f"{path}/in/drop=*")
        query = streaming_distinct(stream).writeStream.format("parquet").option("path", f"{path}/rows").option(
            "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        late += late_rows(query)
    # A repeats after its key was forgotten; C is late; B is neither.
    kept = rows(spark.read.schema(stream.schema).parquet(f"{path}/rows").select("listing_id", "job_code"))
    assert kept == [("A", "1"), ("A", "1"), ("A", "2"), ("B", "1"), ("D", None)] and late == 1


def test_changes_need_no_setting_of_the_session(spark):
    provider = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        path = work_dir(spark, "stream")
        updates = inputs.updates(spark, SF).drop("first_run", "source_url")
        updates.write.parquet(f"{path}/in")
        stream = spark.readStream.schema(updates.schema).parquet(f"{path}/in")
        finish(changes_writer(stream, f"{path}/state"), f"{path}/checkpoint")
        assert rows(read_state(spark, f"{path}/state")) == rows(upsert(spark.createDataFrame([], STATE), updates))
    finally:
        spark.conf.set(provider, given)
