import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from advertlode.operators.state import (candidate_sources, candidates, decide, fingerprint, incremental_efficiency,
                                        latest_updates, lookup_fingerprints, seen, unseen, update_fingerprints, upsert,
                                        upsert_summaries)
from advertlode.schemas import STATE
from advertlode.session import work_dir
from advertlode.sources import state_table
from advertlode.sources.state_table import (ConcurrentWrite, bucket, commit_state, commit_updates, committed_batch, drop_old_versions,
                                            manifest, read_state, versions)

UPDATE = "listing_id string, last_seen_at string, updated_at string, detail_fingerprint string, seq long"
SUMMARY = "listing_id string, source_url string, updated_at string, seq long"


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_select_by_reason(spark):
    known = state(spark, ("A", "2024-01-01", "2024-01-10", "fpA"), ("B", "2024-01-02", "2024-01-05", None),
                  ("D", "2024-01-02", None, "fpD"))
    found = spark.createDataFrame([("A", "uA", "2024-01-10", 0), ("B", "uB", "2024-01-05", 1), ("C", "uC", None, 2),
                                   ("A", "uA", "2024-01-12", 3), ("A", "uA", "", 4), ("A", "uA", None, 5),
                                   ("D", "uD", "2024-01-01", 6), ("C", "uC2", None, 7)], SUMMARY)
    chosen = candidates(decide(found, known)).select("seq", "listing_id", "reason")
    assert rows(chosen) == [(1, "B", "no_fingerprint"), (2, "C", "new"), (3, "A", "updated_at_changed"),
                            (6, "D", "updated_at_changed"), (7, "C", "new")]
    assert rows(candidates(decide(found, known, full=True)).select("reason")) == [("full",)] * 8
    sources = candidate_sources(chosen, found)
    assert {(r.seq, r.source_url) for r in sources.collect()} == {(1, "uB"), (2, "uC"), (3, "uA"), (6, "uD"), (7, "uC")}
    assert [r.seq for r in unseen(found, known).orderBy("seq").collect()] == [2, 7]
    assert seen(found, known).count() == 6


def test_changed_pages_on_request(spark):
    known = state(spark, ("A", "t", "u", "old"), ("B", "t", "u", "same"))
    found = spark.createDataFrame([("A", "uA", "u", 0), ("B", "uB", "u", 1)], SUMMARY)
    pages = spark.createDataFrame([("A", "new"), ("B", "same")], "listing_id string, detail_fingerprint string")
    assert rows(candidates(decide(found, known))) == []
    assert rows(candidates(decide(found, known, fingerprints=pages)).select("listing_id", "reason")) == [
        ("A", "fingerprint_changed")]


def test_upsert_rules(spark):
    known = state(spark, ("A", "2024-01-05", "u1", "f1"), ("B", "2024-01-05", "u1", None), ("C", "2024-01-01", None, None))
    new = spark.createDataFrame([("A", "2024-01-03", None, None, 0), ("B", "2024-01-06", "", "f2", 1),
                                 ("B", "2024-01-04", None, None, 2), ("D", "2024-01-01", "u9", None, 3),
                                 ("D", "2024-01-02", "u8", "", 4)], UPDATE)
    merged = upsert(known, new)
    assert rows(merged) == [("A", "2024-01-05", "u1", "f1"), ("B", "2024-01-06", "", "f2"), ("C", "2024-01-01", None, None),
                            ("D", "2024-01-02", "u8", "")]
    assert rows(upsert(merged, new)) == rows(merged)


def test_upsert_against_row_by_row(spark):
    rng = random.Random(3)
    # One listing has a third of all rows.
    updates = [(rng.choice(["hot", f"L{rng.randrange(40)}", f"L{rng.randrange(40)}"]), f"2024-01-{rng.randrange(1, 29):02d}",
                rng.choice([None, "", "u1", "u2"]), rng.choice([None, None, "f1", "f2"]), i) for i in range(3000)]
    kept = {}
    for key, at, updated, print_, _ in updates:
        old = kept.get(key, ("", None, None))
        kept[key] = (max(at, old[0]), old[1] if updated is None else updated, old[2] if print_ is None else print_)
    frame = spark.createDataFrame(updates, UPDATE).repartition(7)
    whole = upsert(state(spark), frame)
    assert rows(whole) == sorted(((k, *v) for k, v in kept.items()), key=repr)
    halves = upsert(upsert(state(spark), frame.where("seq < 1500")), frame.where("seq >= 1500"))
    assert rows(halves) == rows(whole)


def test_fingerprints(spark):
    known = state(spark, ("A", "t", "u", None), ("B", "t", "u", "old"))
    prints = spark.createDataFrame([("A", "f1", 1), ("A", "f2", 2), ("Z", "f3", 3)],
                                   "listing_id string, detail_fingerprint string, seq long")
    after = update_fingerprints(known, prints)
    assert rows(after) == [("A", "t", "u", "f2"), ("B", "t", "u", "old")]
    keys = spark.createDataFrame([("A",), ("Z",), ("A",)], "listing_id string")
    assert rows(lookup_fingerprints(keys, after)) == [("A", "f2"), ("A", "f2"), ("Z", None)]
    [row] = spark.createDataFrame([("blå",)], "html string").select(fingerprint(F.col("html"))).collect()
    assert row[0] == __import__("hashlib").sha1("blå".encode()).hexdigest()


def test_efficiency(spark):
    def run(*names):
        return spark.createDataFrame([(n, f"https://x/{n}", at, i) for i, (n, at) in enumerate(names)], SUMMARY)

    one, two = run(("A", "t1"), ("B", "t1")), run(("A", "t1"), ("B", "t1"), ("C", "t2"))
    read = spark.createDataFrame([("A",), ("B",)], "listing_id string")

    def measure(first, second, **options):
        return tuple(incremental_efficiency(state(spark), first, second, seen_at_run1="2024-01-01",
                                            seen_at_run2="2024-02-01", **options).first())

    assert measure(one, two, fingerprinted=read) == (2, 1, 0.5)
    assert measure(one, two) == (2, 3, -0.5)
    assert measure(one, two, full=True) == (2, 3, -0.5)
    assert measure(one.limit(0), two) == (0, 3, None)


def names(df):
    return [r.listing_id for r in df.orderBy("listing_id").collect()]


def test_versions(spark):
    root = work_dir(spark, "state")
    assert versions(spark, root) == [] and read_state(spark, root).count() == 0
    assert commit_state(state(spark, ("A", "t", None, None)), root) == 0
    later = upsert_summaries(read_state(spark, root), spark.createDataFrame([("B", "u", "x", 0)], SUMMARY), seen_at="t2")
    assert commit_state(later, root) == 1
    with pytest.raises(ConcurrentWrite):
        commit_state(state(spark, ("Z", "t", None, None)), root, after=0)  # made from a version that is not the last
    assert versions(spark, root) == [0, 1] and names(read_state(spark, root)) == ["A", "B"]
    assert read_state(spark, root, 0).count() == 1
    with pytest.raises(ValueError):
        read_state(spark, root, 2)
    assert commit_state(later, root) == 2 and read_state(spark, root).count() == 2
    assert drop_old_versions(spark, root, keep=1) == [0, 1] and versions(spark, root) == [2]
    assert names(read_state(spark, root)) == ["A", "B"]
    assert commit_state(later.limit(0), root) == 3 and read_state(spark, root).count() == 0


def files_of(root):
    folder = root.removeprefix("file:")
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/data/*/bucket=*/*.parquet")}


def test_a_commit_leaves_other_buckets_alone(spark):
    root = work_dir(spark, "state")
    whole = spark.range(4000).selectExpr("concat('L', id) AS listing_id", "'t1' AS last_seen_at", "'u1' AS updated_at",
                                         "string(NULL) AS detail_fingerprint")
    commit_state(whole, root, buckets=16)
    before, files = manifest(spark, root, 0), files_of(root)
    assert len(before.folders) == 16 == len(files)
    batch = spark.createDataFrame([("L7", "t2", None, "f", 0), ("L7", "t0", "u2", None, 1), ("new", "t2", "u", None, 2)], UPDATE)
    touched = {r[0] for r in batch.select(bucket(16).cast("string")).distinct().collect()}
    assert commit_updates(latest_updates(batch), root) == 1
    after = manifest(spark, root, 1)
    assert {b for b in after.folders if after.folders[b] != before.folders[b]} == touched and len(touched) < 3
    assert {p: at for p, at in files_of(root).items() if p in files} == files  # nothing rewritten or touched
    assert len(files_of(root)) == len(files) + len(touched) and not glob.glob(f"{root.removeprefix('file:')}/data/updates-*")
    assert rows(read_state(spark, root).where("listing_id IN ('L7', 'new')")) == [("L7", "t2", "u2", "f"), ("new", "t2", "u", None)]
    assert read_state(spark, root).count() == 4001 and read_state(spark, root, 0).where("last_seen_at = 't2'").count() == 0
    assert set(names(read_state(spark, root, of=batch))) >= {"L7", "new"} and read_state(spark, root, of=batch).count() < 1000
    assert drop_old_versions(spark, root, keep=1) == [0]
    assert len(files_of(root)) == 16 and read_state(spark, root).count() == 4001
    assert rows(read_state(spark, root)) == rows(upsert(whole, batch))


def test_buckets_against_whole_merges(spark):
    root, rng, whole = work_dir(spark, "state"), random.Random(5), state(spark)
    for n in range(4):
        batch = spark.createDataFrame([(f"L{rng.randrange(60)}", f"2024-01-{rng.randrange(1, 29):02d}", rng.choice([None, "", "u1", "u2"]),
                                        rng.choice([None, "f1", "f2"]), i) for i in range(rng.choice([0, 5, 80]))], UPDATE)
        commit_updates(latest_updates(batch), root, after=n - 1 if n else None, buckets=8)
        whole = upsert(whole, batch)
    assert rows(read_state(spark, root)) == rows(whole)


def test_one_of_two_writers_commits(spark, monkeypatch):
    root = work_dir(spark, "state")
    one, other = state(spark, ("A", "t", None, None)), state(spark, ("B", "t", None, None))
    commit_state(one, root)
    plain = state_table._commit

    def late(session, path, new):
        """The other writer comes in between this one's write and its commit."""
        monkeypatch.setattr(state_table, "_commit", plain)
        commit_updates(other, path, writer="other")
        plain(session, path, new)

    monkeypatch.setattr(state_table, "_commit", late)
    with pytest.raises(ConcurrentWrite):
        commit_updates(state(spark, ("C", "t", None, None)), root, writer="late")
    assert names(read_state(spark, root)) == ["A", "B"] and versions(spark, root) == [0, 1]
    assert committed_batch(spark, root, "late", 0) is None and committed_batch(spark, root, "other", 0) == 1


def test_a_writer_that_dies_stops_nobody(spark, monkeypatch):
    root = work_dir(spark, "state")
    commit_state(state(spark, ("A", "t", None, None)), root)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(state_table, "_commit", dies)
    with pytest.raises(KeyboardInterrupt):
        commit_updates(state(spark, ("B", "t", None, None)), root, writer="w", batch=1)
    monkeypatch.undo()
    folder = root.removeprefix("file:")
    open(f"{folder}/draft-0", "w").close()  # a manifest that was never finished
    assert versions(spark, root) == [0] and names(read_state(spark, root)) == ["A"]
    assert commit_updates(state(spark, ("B", "t", None, None)), root, writer="w", batch=1) == 1
    assert names(read_state(spark, root)) == ["A", "B"]
    left = len(os.listdir(f"{folder}/data"))
    assert drop_old_versions(spark, root, keep=2, orphans_after=3600) == [] and len(os.listdir(f"{folder}/data")) == left
    assert drop_old_versions(spark, root, keep=2, orphans_after=0) == [] and len(os.listdir(f"{folder}/data")) < left
    assert not os.path.exists(f"{folder}/draft-0") and names(read_state(spark, root)) == ["A", "B"]


def test_the_last_batch_of_a_writer_is_known_after_its_version_is_dropped(spark):
    root = work_dir(spark, "state")
    for batch in range(3):
        commit_state(state(spark, ("A", "t", None, None)), root, writer="w", batch=batch)
    for n in range(3):
        commit_state(state(spark, ("A", "t", None, None)), root)
        commit_state(state(spark, ("A", "t", None, None)), root, writer="x/y", batch=n)
        drop_old_versions(spark, root, keep=2)
    assert versions(spark, root) == [7, 8]
    assert [committed_batch(spark, root, "w", n) for n in range(4)] == [None, None, 2, None]
    assert [committed_batch(spark, root, "x/y", n) for n in (1, 2, 3)] == [None, 8, None]


def test_updates_of_a_run(spark):
    from advertlode.plans.run import RunConfig, run_updates

    root = work_dir(spark, "state")
    summaries = spark.createDataFrame([("A", "u", "x", 0), ("B", "u", "y", 1)], SUMMARY)
    fetched = spark.createDataFrame([("A", "f", 0), ("B", None, 1)], "listing_id string, detail_fingerprint string, seq long")
    for n, (advance, updated) in enumerate((("always", "y"), ("on_success", None))):
        new = run_updates(summaries, fetched, RunConfig(run_ts="t2", state_root=root, advance=advance))
        assert commit_updates(new, f"{root}/{n}") == 0
        assert rows(read_state(spark, f"{root}/{n}")) == [("A", "t2", "x", "f"), ("B", "t2", updated, None)]


def test_hot_listing_is_reduced_before_the_shuffle(spark):
    """Each task sends one row per listing, so a listing with a third of all rows is no hot spot."""
    updates = spark.range(90_000).selectExpr("IF(id % 3 = 0, 'hot', concat('L', id)) AS listing_id", "'t' AS last_seen_at",
                                             "'u' AS updated_at", "string(NULL) AS detail_fingerprint", "id AS seq")
    plan = upsert(state(spark), updates)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan and "collect_list" not in plan


def test_hot_listing_is_split_in_lookups(spark):
    """With thresholds scaled down to the data, the adaptive join splits the hot key, and the rows stay whole."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        known = spark.range(2000).selectExpr("concat('L', id) AS listing_id", "'t' AS last_seen_at", "'u' AS updated_at",
                                             "'f' AS detail_fingerprint")
        found = spark.range(0, 90_000, 1, 8).selectExpr("IF(id % 3 = 0, 'L7', concat('L', id % 4000)) AS listing_id",
                                                        "'s' AS source_url", "'v' AS updated_at", "id AS seq")
        decided = decide(found, known)
        counts = {r.reason: r["count"] for r in decided.groupBy("reason").count().collect()}
        new = sum(1 for i in range(90_000) if i % 3 and i % 4000 >= 2000)
        assert counts == {"updated_at_changed": 90_000 - new, "new": new}
        decided.collect()
        assert "skew=true" in decided._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_updates_are_staged_in_as_many_files_as_tasks(spark, monkeypatch):
    root, staged = work_dir(spark, "state"), []
    written = state_table._written
    monkeypatch.setattr(state_table, "_written", lambda *args: staged.extend(
        glob.glob(f"{root}/data/updates-*/**/*.parquet", recursive=True)) or written(*args))
    updates = spark.range(4000).repartition(5).selectExpr("concat('L', id) AS listing_id", "'t' AS last_seen_at", "string(NULL) AS updated_at",
                                                          "string(NULL) AS detail_fingerprint")
    commit_updates(updates, root)
    assert 0 < len(staged) <= 5 and read_state(spark, root).count() == 4000
