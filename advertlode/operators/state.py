"""Keyed listing state and change detection.

State rows are `listing_id, last_seen_at, updated_at, detail_fingerprint`, one per listing. Inputs carry a unique,
orderable `seq`, so "first" and "last" do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STATE


def _last(value: str) -> Column:
    """Last non-NULL value by seq."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col("seq")))


def latest_updates(updates: DataFrame, *more: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Reduce updates to one per listing: greatest `last_seen_at`, last non-NULL `updated_at` and fingerprint, and any
    further aggregates given. `by` names columns that depend on the listing alone and stay."""
    return updates.groupBy(*by, "listing_id").agg(
        F.max("last_seen_at").alias("last_seen_at"), _last("updated_at").alias("updated_at"),
        _last("detail_fingerprint").alias("detail_fingerprint"), *more)


def merge(state: DataFrame, latest: DataFrame) -> DataFrame:
    """New state from one update per listing: rows inserted, or merged so that `last_seen_at` only advances and NULL
    never overwrites a value."""
    old, new = state.alias("old"), latest.alias("new")

    def pick(name: str) -> Column:
        return F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).alias(name)

    return old.join(new, F.col("old.listing_id") == F.col("new.listing_id"), "full").select(
        pick("listing_id"), F.greatest("old.last_seen_at", "new.last_seen_at").alias("last_seen_at"),
        pick("updated_at"), pick("detail_fingerprint"))


def upsert(state: DataFrame, updates: DataFrame) -> DataFrame:
    """New state from any number of updates per listing.

    They are reduced before the shuffle and again after it, so a hot listing costs each task one row.
    """
    return merge(state, latest_updates(updates))


def summary_updates(summaries: DataFrame, seen_at: Column | str) -> DataFrame:
    """Summaries as state updates with one time of sighting; they bring no fingerprint."""
    seen = F.lit(seen_at) if isinstance(seen_at, str) else seen_at
    return summaries.select("listing_id", seen.alias("last_seen_at"), "updated_at",
                            F.lit(None).cast("string").alias("detail_fingerprint"), "seq")


def upsert_summaries(state: DataFrame, summaries: DataFrame, *, seen_at: Column | str) -> DataFrame:
    return upsert(state, summary_updates(summaries, seen_at))


def fingerprint(html: Column) -> Column:
    """SHA-1 of the page text."""
    return F.sha1(html.cast("binary"))


def lookup_fingerprints(keys: DataFrame, state: DataFrame) -> DataFrame:
    """`detail_fingerprint` for every key, NULL when the listing or its fingerprint is missing."""
    return keys.join(state.select("listing_id", "detail_fingerprint"), "listing_id", "left")


def update_fingerprints(state: DataFrame, prints: DataFrame) -> DataFrame:
    """Set the last fingerprint by `seq` for known listings; others are ignored. State rows are never added or lost."""
    new = prints.groupBy("listing_id").agg(_last("detail_fingerprint").alias("_new"))
    return state.join(new, "listing_id", "left").withColumn(
        "detail_fingerprint", F.coalesce("_new", "detail_fingerprint")).select(STATE.names)


def decide(summaries: DataFrame, state: DataFrame, *, full: bool = False,
           fingerprints: DataFrame | None = None) -> DataFrame:
    """Every summary with the `reason` to read its detail page, NULL when there is none.

    Compare with the state before the summaries are merged into it. `new`: unknown; `no_fingerprint`: never read;
    `updated_at_changed`: non-blank and different from the stored one. With `full` all are `full`, and the state is
    not read. With `fingerprints` (listing_id, detail_fingerprint of the page at hand) also `fingerprint_changed`.

    State has one row per listing, so a hot listing among the summaries is split by the adaptive skew join.
    """
    if full:
        return summaries.withColumn("reason", F.lit("full"))
    known = state.select("listing_id", F.col("updated_at").alias("_updated_at"),
                         F.col("detail_fingerprint").alias("_print"), F.lit(True).alias("_known"))
    joined = summaries.join(known, "listing_id", "left")
    updated = F.col("updated_at")
    reason = F.when(F.col("_known").isNull(), "new").when(F.col("_print").isNull(), "no_fingerprint") \
        .when((updated != "") & ~updated.eqNullSafe(F.col("_updated_at")), "updated_at_changed")
    if fingerprints is not None:
        # Several pages of one listing change it if any of them differs; NULL comparisons do not count.
        at_hand = fingerprints.groupBy("listing_id").agg(F.min("detail_fingerprint").alias("_low"),
                                                         F.max("detail_fingerprint").alias("_high"))
        joined = joined.join(at_hand, "listing_id", "left")
        reason = reason.when((F.col("_low") != F.col("_print")) | (F.col("_high") != F.col("_print")),
                             "fingerprint_changed")
    return joined.withColumn("reason", reason).select(*summaries.columns, "reason")


def candidates(decided: DataFrame) -> DataFrame:
    """The summaries whose detail page is to be read; repeated listings stay repeated."""
    return decided.where(F.col("reason").isNotNull())


def candidate_sources(chosen: DataFrame, summaries: DataFrame) -> DataFrame:
    """Candidates with the `source_url` of the first summary of their listing, NULL when there is none."""
    first = summaries.groupBy("listing_id").agg(F.min_by("source_url", "seq").alias("source_url"))
    return chosen.drop("source_url").join(first, "listing_id", "left")


def unseen(summaries: DataFrame, state: DataFrame) -> DataFrame:
    """Summaries whose listing is not in the state."""
    return summaries.join(state.select("listing_id"), "listing_id", "left_anti")


def seen(summaries: DataFrame, state: DataFrame) -> DataFrame:
    """Summaries whose listing is in the state."""
    return summaries.join(state.select("listing_id"), "listing_id", "left_semi")


def incremental_efficiency(state: DataFrame, run1: DataFrame, run2: DataFrame, *, seen_at_run1: str, seen_at_run2: str,
                           fingerprinted: DataFrame | None = None, full: bool = False) -> DataFrame:
    """Candidates of two runs with the state evolving between them, and by how much the second needs fewer.

    `fingerprinted` (listing_id) are the listings whose page was read in the first run.
    """
    after = upsert_summaries(state, run1, seen_at=seen_at_run1)
    if fingerprinted is not None:
        after = update_fingerprints(after, fingerprinted.select(
            "listing_id", F.lit("fp1").alias("detail_fingerprint"), F.lit(0).alias("seq")))
    first = candidates(decide(run1, state, full=full)).select(F.lit(1).alias("run"))
    second = candidates(decide(run2, after, full=full)).select(F.lit(2).alias("run"))
    counted = first.unionByName(second).agg(F.count_if(F.col("run") == 1).alias("run1_candidates"),
                                            F.count_if(F.col("run") == 2).alias("run2_candidates"))
    ratio = F.when(F.col("run1_candidates") > 0, 1.0 - F.col("run2_candidates") / F.col("run1_candidates"))
    return counted.withColumn("reduction_ratio", ratio)
