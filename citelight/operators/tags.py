"""Tags: bridge table, membership and dashboard filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parse_tags

# Filter words for terms without tags and without topic, and for "no filter".
UNTAGGED = "__UNTAGGED__"
ORPHANED = "_orphaned"
ALL = "all"
# Tag texts that stand for "no tags".
EMPTY_TAG_TEXTS = ("[]", "null", "")


def tag_bridge(terms: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per term and tag (``tag`` trimmed); terms without tags vanish."""
    tagged = terms.where(F.col("tags").isNotNull() & ~F.col("tags").isin(*EMPTY_TAG_TEXTS))
    return tagged.select(*carry, F.explode(parse_tags(F.col("tags"))).alias("tag")).withColumn(
        "tag", F.trim("tag")
    )


def has_tag(tags: Column, tag: str) -> Column:
    """Whether JSON tag text contains ``tag``; false when it holds no list."""
    return F.coalesce(F.array_contains(parse_tags(tags), tag), F.lit(False))


def with_tag(df: DataFrame, bridge: DataFrame, tag: str, key: str = "search_term_id") -> DataFrame:
    """Rows whose term carries ``tag``; a duplicate tag in the bridge multiplies nothing."""
    members = bridge.where(F.col("tag") == tag).select(key)
    return df.join(members, key, "left_semi")


def blend_tags(df: DataFrame, bridge: DataFrame, key: str = "search_term_id") -> DataFrame:
    """Left outer blend with the bridge: rows multiply by their tags, untagged rows stay."""
    return df.join(bridge.select(key, "tag"), key, "left")


def matches_tags(tags: Column, wanted: Sequence[str]) -> Column:
    """Any wanted tag present; ``__UNTAGGED__`` matches terms without tags."""
    found = parse_tags(tags)
    names = [t for t in wanted if t != UNTAGGED]
    hit = F.coalesce(F.arrays_overlap(found, F.array(*map(F.lit, names))), F.lit(False)) if names else F.lit(False)
    if UNTAGGED in wanted:
        hit = hit | (F.coalesce(F.size(found), F.lit(0)) == 0)
    return hit


def matches_topic(topic_id: Column, wanted: str) -> Column:
    """One topic; ``_orphaned`` matches terms without topic."""
    return topic_id.isNull() if wanted == ORPHANED else topic_id == wanted


def slice_rows(
    df: DataFrame,
    topic: str = ALL,
    engine: str | Sequence[str] = ALL,
    tags: str | Sequence[str] = ALL,
    competitors: str | Sequence[str] = ALL,
    prompt: str = ALL,
) -> DataFrame:
    """Dashboard slicer: each filter may be ``"all"``; filters combine with AND.

    ``competitors`` keeps own-brand rows next to the competitors named.
    """
    if topic != ALL:
        df = df.where(matches_topic(F.col("topic_id"), topic))
    if engine != ALL:
        df = df.where(F.col("engine").isin(*([engine] if isinstance(engine, str) else engine)))
    if tags != ALL:
        df = df.where(matches_tags(F.col("tags"), [tags] if isinstance(tags, str) else tags))
    if competitors != ALL:
        df = df.where(own_or_listed(competitors if not isinstance(competitors, str) else [competitors]))
    if prompt != ALL:
        df = df.where(F.col("query") == prompt)
    return df


def own_or_listed(names: Sequence[str]) -> Column:
    """Own-brand rows, or rows of the brands named."""
    return F.col("is_own_brand") | F.col("brand_name").isin(*names)
