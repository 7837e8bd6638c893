"""Employer matching against a table of very many organisations.

`match_orgs` turns a short keyword table into expressions. Here the keywords are rows: `tag, phrase, place`, where `place` gives the
order of priority. Employers are reduced to their distinct normal forms first, so a hot one costs one row.

* A phrase occurs in a name if its rarest gram does: a phrase is filed under that of its grams of GRAM letters that fewest names
  hold, names are looked up by all theirs, and `contains` decides. It is a join, so neither side has to fit anywhere.
* The best token-set score of a name needs no comparison with most phrases: the shared tokens give two of the three ratios exactly,
  and the letters that both have bound the third from above. Phrases are compared in the order of their bounds until
  none can win. The bounds of one name against all phrases are array arithmetic inside a task; phrases are shipped in parts of
  MOST_PHRASES, and each name meets every part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.orgs import indel_score, normalize_org
from ..functions.text import bind

GRAM = 3
#: Phrases in one part, some 20 MB of counts, and parts: the keyword table passes through the driver, so it has a bound.
MOST_PHRASES, MOST_PARTS = 1 << 17, 16


def _grams(text: Column, size: Column | int) -> Column:
    """Distinct grams of a text of at least `size` letters, in no order."""
    size = F.lit(size) if isinstance(size, int) else size
    return bind(text, lambda t: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - size + 1), lambda i: F.substring(t, i, size))))


def phrases_in(names: DataFrame, phrases: DataFrame) -> DataFrame:
    """`name, phrase` of every pair of a `name` and a `phrase` that occurs in it, as plain text. Both sides distinct; blank and
    NULL phrases occur nowhere."""
    named = names.select("name").where(F.length("name") > 0).distinct()
    wanted = phrases.select("phrase").where(F.length("phrase") > 0).distinct().withColumn(
        "size", F.least(F.lit(GRAM), F.length("phrase")))
    sizes = [r.size for r in wanted.select("size").distinct().collect()]  # GRAM numbers at most
    held = [named.where(F.length("name") >= size).select("name", F.explode(_grams(F.col("name"), size)).alias("gram")) for size in sizes]
    if not held:
        return wanted.select(F.col("phrase").alias("name"), "phrase").limit(0)
    by_gram = held[0]
    for more in held[1:]:
        by_gram = by_gram.unionByName(more)
    often = by_gram.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    filed = wanted.select("phrase", F.explode(_grams(F.col("phrase"), F.col("size"))).alias("gram")).join(often, "gram", "left")
    # A phrase with a gram that no name holds occurs nowhere: its least count is then missing.
    rarest = filed.groupBy("phrase").agg(F.min_by("gram", F.coalesce("often", F.lit(0))).alias("gram"), F.count_if(F.col("often").isNull()).alias("none"))
    return by_gram.join(rarest.where("none = 0"), "gram").where(F.contains("name", F.col("phrase"))).select("name", "phrase")


class _Phrases:
    """Phrases with what their bounds need: letters, lengths, tokens."""

    def __init__(self, phrases: list[str]):
        sets = [sorted(set(p.split())) for p in phrases]
        texts = [" ".join(s) for s in sets]
        self.phrases = phrases
        self.letters = sorted(set("".join(texts)))
        self.counts = np.array([[t.count(c) for t in texts] for c in self.letters], np.int16).reshape(len(self.letters), len(texts))
        self.length = np.array([len(t) for t in texts], np.int64)
        self.tokens = np.array([len(s) for s in sets], np.int64)
        where: dict[str, list[int]] = {}
        for i, tokens in enumerate(sets):
            for token in tokens:
                where.setdefault(token, []).append(i)
        self.where = {token: np.array(places) for token, places in where.items()}

    def best(self, name: str, least: float) -> tuple[float, int] | None:
        """The greatest score of at least `least` and the first phrase that has it."""
        tokens = sorted(set(name.split()))
        if not tokens or not len(self.length):
            return None
        text = " ".join(tokens)
        shared, count = np.zeros(len(self.length)), np.zeros(len(self.length), np.int64)
        for token in tokens:
            if token in self.where:
                shared[self.where[token]] += len(token) + 1
                count[self.where[token]] += 1
        common = np.zeros(len(self.length), self.counts.dtype if len(text) < 1 << 15 else np.int64)
        for letter, of_phrases in zip(self.letters, self.counts):
            if n := text.count(letter):
                common += np.minimum(of_phrases, n, dtype=common.dtype)
        bound = 200.0 * common / (len(text) + self.length)
        shared -= count > 0  # tokens joined by spaces
        some = count > 0
        for size in (len(text), self.length):
            bound = np.where(some, np.maximum(bound, 200.0 * shared / (shared + size)), bound)
        bound[some & ((count == len(tokens)) | (count == self.tokens))] = 100.0
        bound[self.tokens == 0] = 0.0
        found = None
        # A bound that is hardly above the score may be the same number, computed another way.
        able = np.flatnonzero(bound + 1e-9 >= least)
        for i in able[np.argsort(-bound[able], kind="stable")].tolist():
            if found is not None and bound[i] + 1e-9 < found[0]:
                break
            score = indel_score(name, self.phrases[i])
            if score >= least and (found is None or score > found[0] or (score == found[0] and i < found[1])):
                found = score, i
        return found


def _scored(parts: dict[int, list[str]], least: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, _Phrases] = {}
        for batch in batches:
            rows = []
            for name, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part not in made:
                    made[part] = _Phrases(parts[part])
                if (found := made[part].best(name, least)) is not None:
                    rows.append((name, found[0], made[part].phrases[found[1]], part * most + found[1]))
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.float64(), pa.string(), pa.int64()))],
                                  ["name", "score", "phrase", "at"])
    return run


def best_phrases(names: DataFrame, phrases: DataFrame, *, threshold: float) -> DataFrame:
    """`name, phrase, score`: for each distinct `name` the phrase (`phrase, place`) with the greatest token-set score, the first by
    `place` of equal ones, if that reaches 100 * `threshold`. Scores and choice are those of comparing every phrase."""
    wanted = phrases.where(F.length("phrase") > 0).groupBy("phrase").agg(F.min("place").alias("place"))
    ordered = wanted.orderBy("place", "phrase").limit(MOST_PHRASES * MOST_PARTS + 1).toArrow()["phrase"].to_pylist()
    if len(ordered) > MOST_PHRASES * MOST_PARTS:
        raise ValueError(f"{len(ordered)} phrases, more than {MOST_PHRASES * MOST_PARTS}")
    parts = {n: ordered[i:i + MOST_PHRASES] for n, i in enumerate(range(0, len(ordered), MOST_PHRASES))}
    meets = names.select("name").where(F.length("name") > 0).distinct().select(
        "name", F.explode(F.sequence(F.lit(0), F.lit(max(len(parts) - 1, 0)))).alias("part"))
    if not parts:
        return meets.select("name", F.lit("").alias("phrase"), F.lit(0.0).alias("score")).limit(0)
    # Names are few bytes and much work, so they are dealt over as many tasks as a shuffle has, whatever their size.
    dealt = meets.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = dealt.mapInArrow(_scored(parts, 100.0 * threshold, MOST_PHRASES), "name string, score double, phrase string, at long")
    if len(parts) == 1:
        return found.select("name", "phrase", "score")
    return found.groupBy("name").agg(F.max_by(F.struct("phrase", "score"), F.struct("score", -F.col("at"))).alias("best")).select("name", "best.*")


def match_org_table(df: DataFrame, employer: str, orgs: DataFrame, *, fuzzy_threshold: float | None = None) -> DataFrame:
    """Add `org_tag, provenance, matched_org_keyword, match_confidence`: as `match_orgs` with `explain`, for `orgs` given as a table
    (`tag, phrase, place`), without prefixes and titles. A name that equals a tag comes first, then the first organisation one of whose
    phrases occurs (its longest there is the keyword), then the best score. Repeated rows, NULL and blank employers stay.
    """
    named = df.withColumn("_name", normalize_org(F.col(employer)))
    names = named.select(F.col("_name").alias("name")).where("name <> ''").distinct()
    exact = names.join(orgs.groupBy(F.col("tag").alias("name")).agg(F.min("place").alias("place")), "name").select(
        "name", F.lit(0).alias("rule"), "place", F.col("name").alias("tag"), F.col("name").alias("keyword"), F.lit(1.0).alias("score"))
    occurs = phrases_in(names, orgs).join(orgs, "phrase").select(
        "name", F.lit(1).alias("rule"), "place", "tag", F.col("phrase").alias("keyword"), F.lit(1.0).alias("score"))
    # The least rule, then place; of one organisation's phrases the longest.
    order = F.struct(-F.col("rule"), -F.col("place"), F.length("keyword"), "keyword")
    best = exact.unionByName(occurs).groupBy("name").agg(F.max_by(F.struct("rule", "tag", "keyword", "score"), order).alias("m")).select("name", "m.*")
    if fuzzy_threshold is not None:
        first = orgs.groupBy("phrase").agg(F.min_by("tag", "place").alias("tag"))
        scored = best_phrases(names.join(best, "name", "left_anti"), orgs, threshold=fuzzy_threshold).join(first, "phrase")
        best = best.unionByName(scored.select("name", F.lit(2).alias("rule"), "tag", F.col("phrase").alias("keyword"), (F.col("score") / 100.0).alias("score")))
    way = F.when(F.col("rule") == 0, "employer_exact").when(F.col("rule") == 1, "employer_synonym").when(
        F.col("rule") == 2, F.concat(F.lit("employer_fuzzy_"), F.col("org_tag"))).otherwise("none")
    told = best.select(F.col("name").alias("_name"), "rule", F.col("tag").alias("org_tag"), F.col("keyword").alias("matched_org_keyword"),
                       F.col("score").alias("match_confidence"))
    return named.join(told, "_name", "left").select(*df.columns, "org_tag", way.alias("provenance"), "matched_org_keyword", "match_confidence")
