"""Organisation names: normal form, tokens, and matching by exact, phrase, prefix and fuzzy rules.

Matching is per row: the keyword table is configuration, so its rules become native expressions and nothing is joined
or shuffled, however often one employer occurs. Only the fuzzy score of rows that no other rule matched needs Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .text import bind, fold_accents

# Letters that have no accent to fold.
_LETTERS = (("ø", "o"), ("æ", "ae"), ("å", "a"))


@dataclass(frozen=True)
class Org:
    """One organisation: its tag, the normalised phrases that name it, and a token prefix, if it has one."""

    tag: str
    phrases: tuple[str, ...] = ()
    prefix: str | None = None

    @property
    def fuzzy_phrases(self) -> tuple[str, ...]:
        return self.phrases or (self.tag,)


# The keyword table in order of priority.
DEFAULT_ORGS = (Org("pst", phrases=("pst", "politiets sikkerhetstjeneste")),
                Org("nsm", phrases=("nsm", "nasjonal sikkerhetsmyndighet")),
                Org("forsvar", prefix="forsvar"))


def punctuation_to_space(text: Column) -> Column:
    """Each run of anything but letters and digits, spaces included, to one space."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")


def normalize_org(text: Column, *, folded: Column | None = None) -> Column:
    """Accents folded, lower case, letters and digits only, single spaces; NULL becomes blank. `folded` is the text without
    accents where that is at hand."""
    lowered = F.lower(F.coalesce(folded, F.lit("")) if folded is not None else fold_accents(F.coalesce(text, F.lit(""))))
    plain = reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), _LETTERS, lowered)
    return F.trim(punctuation_to_space(plain))


def tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def contains_any(normalized: Column, phrases: Sequence[str]) -> Column:
    """Whether any phrase occurs, as plain text and not by tokens."""
    found = [F.contains(normalized, F.lit(p)) for p in phrases if p]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def has_prefix(normalized: Column, prefix: str) -> Column:
    """Whether any token starts with the prefix."""
    return F.exists(tokens(normalized), lambda t: t.startswith(prefix))


def _common_length(left: str, right: str) -> int:
    """Length of the longest common subsequence, with one bit per character of `right`."""
    where: dict[str, int] = {}
    for i, char in enumerate(right):
        where[char] = where.get(char, 0) | 1 << i
    full = (1 << len(right)) - 1
    free = full
    for char in left:
        used = free & where.get(char, 0)
        free = (free + used | free - used) & full
    return len(right) - free.bit_count()


def indel_score(left: str, right: str) -> float:
    """Similarity of two normalised texts as token sets, 0 to 100 (see `token_set_scores`)."""
    a, b = set(left.split()), set(right.split())
    if not a or not b:
        return 0.0
    shared, only_a, only_b = (" ".join(sorted(part)) for part in (a & b, a - b, b - a))
    if shared and not (only_a and only_b):
        return 100.0
    # Shared tokens and a joining space lead both texts, so only the rests are compared.
    lead, len_a, len_b = len(shared) + bool(shared), len(only_a), len(only_b)
    pairs = [(len_a + len_b - 2 * _common_length(only_a, only_b), 2 * lead + len_a + len_b)]
    if shared:
        pairs += [(1 + rest, 2 * lead - 1 + rest) for rest in (len_a, len_b)]
    return max(100.0 - 100.0 * distance / total for distance, total in pairs)


def _indel_udf(phrases: tuple[str, ...]):
    @F.arrow_udf(ArrayType(DoubleType()))
    def score(names: pa.Array) -> pa.Array:
        known: dict[str | None, list[float] | None] = {None: None}
        scores = []
        for name in names.to_pylist():
            if name not in known:
                known[name] = [indel_score(name, phrase) for phrase in phrases]
            scores.append(known[name])
        return pa.array(scores, pa.list_(pa.float64()))

    return score


def token_set_scores(name: Column, phrases: Sequence[str], *, method: str = "indel") -> Column:
    """Similarity of a normalised text and each phrase as token sets, an array of 0 to 100; 0 when either is empty.

    `jaccard` is shared by all tokens, natively. `indel` is 100 when one set holds the other, else the best normalised
    insert-delete similarity among the shared tokens alone, shared with left-only and shared with right-only tokens;
    a text is scored once per batch, however often it occurs.
    """
    if method == "indel":
        return _indel_udf(tuple(phrases))(name)
    if method != "jaccard":
        raise ValueError(f"unknown method: {method}")

    def score(a: Column, phrase: str) -> Column:
        b = F.array(*[F.lit(t) for t in sorted(set(phrase.split()))]).cast("array<string>")
        shared, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
        return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.lit(100.0) * shared / either)

    return F.when(name.isNotNull(), bind(tokens(name), lambda a: F.array(*[score(a, p) for p in phrases])))


def _found_phrase(name: Column, phrases: Sequence[str]) -> Column:
    """The longest phrase that occurs, the first of equals: the greatest of structs in that order. NULL when none does."""
    found = [F.when(F.contains(name, F.lit(p)), F.struct(F.lit(len(p)).alias("size"), F.lit(-i).alias("place"), F.lit(p).alias("phrase")))
             for i, p in enumerate(phrases) if p]
    return F.array_max(F.array(*found))["phrase"]


def _prefix_share(name: Column, prefix: str) -> Column:
    """How much of the shortest token with the prefix it is."""
    return F.lit(float(len(prefix))) / F.array_min(F.transform(F.filter(tokens(name), lambda t: t.startswith(prefix)), F.length))


def rule_match(name: Column, orgs: Sequence[Org] = DEFAULT_ORGS) -> Column:
    """An `org_match` for a normalised employer that equals a tag, contains a phrase or has a token with a prefix, in that order
    and each in the order of `orgs`; else NULL."""
    chain = F
    for org in orgs:
        chain = chain.when(name == org.tag, org_match(org.tag, "employer_exact", F.lit(org.tag), F.lit(1.0)))
    for org in orgs:
        if org.phrases:
            chain = chain.when(contains_any(name, org.phrases),
                               org_match(org.tag, "employer_synonym", _found_phrase(name, org.phrases), F.lit(1.0)))
    for org in orgs:
        if org.prefix:
            chain = chain.when(has_prefix(name, org.prefix),
                               org_match(org.tag, "employer_prefix", F.lit(org.prefix), _prefix_share(name, org.prefix)))
    return chain


def title_match(title_name: Column, orgs: Sequence[Org] = DEFAULT_ORGS) -> Column:
    """An `org_match` for a normalised title that has a token with a prefix; else NULL."""
    return F.coalesce(*[F.when(has_prefix(title_name, org.prefix), org_match(
        org.tag, f"title_prefix_{org.tag}", F.lit(org.prefix), _prefix_share(title_name, org.prefix))) for org in orgs if org.prefix])


def org_match(tag: str | None, provenance: str, keyword: Column | None = None, confidence: Column | None = None) -> Column:
    """`struct<org_tag, provenance, keyword, confidence>`; the keyword is what matched, the confidence 0 to 1."""
    return F.struct(F.lit(tag).cast("string").alias("org_tag"), F.lit(provenance).alias("provenance"),
                    (F.lit(None) if keyword is None else keyword).cast("string").alias("keyword"),
                    (F.lit(None) if confidence is None else confidence).cast("double").alias("confidence"))
