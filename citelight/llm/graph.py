"""Connected components, and links found through shared keys without pairing whole groups.

Nodes are longs. Every step writes its result to the shared folder, so a lost
executor costs at most one step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import staged


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node in ``links`` (columns a, b).

    Large-star and small-star steps alternate until nothing changes; the number of
    rounds grows with the logarithm of the largest component. Minima are
    aggregated before the shuffle, and the joins back have one row per node on one
    side, so adaptive execution can split a hub.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = staged(links.where("a <> b").select(high, low).distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "edges")
        hooks = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(hooks, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(moved.unionByName(hooks.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (key, node, ...) whose key is held by two nodes or more, with one of them as ``pivot``.

    The pivot is the node of the smallest ``rank`` where there is such a column, else the smallest node.
    """
    ranked = "rank" in keys.columns
    first = F.min(F.struct("rank", "node"))["node"] if ranked else F.min("node")
    pivots = (
        keys.groupBy("key").agg(first.alias("pivot"), F.min("node").alias("_first"), F.max("node").alias("_last"))
        .where("_first < _last").select("key", "pivot")
    )
    return keys.drop("pivot").join(pivots, "key")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """Each node with the pivots of its keys: as many pairs as members, however large a key's group is."""
    ends = F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")
    return members.where("node <> pivot").select(*ends).distinct()


def undecided(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` with their ``component``, of keys whose nodes still lie in several components."""
    tagged = members.drop("component").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed = tagged.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    return tagged.join(mixed.where("_lo < _hi").select("key"), "key", "left_semi")


def crossing_pairs(members: DataFrame, plausible: str = "true") -> DataFrame:
    """Pairs of nodes with a common key that lie in different components, where ``plausible``.

    That condition sees the other columns of ``members`` with the suffixes _a and _b.
    """
    rest = [c for c in members.columns if c not in ("key", "node")]
    left = members.select("key", F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in rest])
    right = members.select("key", F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in rest])
    pairs = left.join(right, "key").where("a < b AND component_a <> component_b").where(plausible)
    return pairs.select("a", "b").distinct()


def link_through(
    keys: DataFrame,
    load: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame, DataFrame], DataFrame],
    refine: Callable[[DataFrame], DataFrame] | None = None,
    plausible: str = "true",
    traits: Sequence[str] = (),
) -> DataFrame:
    """Verified links (a, b) that connect the same nodes as all links between nodes with a common key.

    ``load`` gives what is compared (one row per node) for the nodes that share a key with others;
    ``verify`` takes pairs and that table and returns the pairs that link.

    1. Every node is compared with the smallest node of each of its keys.
    2. Keys whose nodes are now all connected are done: whatever else links in
       them changes no component.
    3. For the nodes of the other keys ``refine`` (given their rows of the loaded table) may
       name narrower keys that all their links share, with a ``rank`` that is lowest for the node
       likeliest to link with the others; those take steps 1 and 2 in turn.
    4. Of what is left, nodes of different components are compared pair by pair, where ``plausible``
       (see :func:`crossing_pairs`) does not rule a link out. It may use the columns ``traits`` of the
       loaded table.

    So copies of one text are never paired among themselves, and no link between
    components is lost.
    """
    members = staged(shared_keys(keys), "members")
    held = staged(load(members.select("node").distinct()), "held")
    links = staged(verify(pivot_pairs(members), held), "links")
    open_keys = staged(undecided(members, components(links)), "open")
    if refine is not None:
        narrower = refine(held.join(open_keys.select("node").distinct(), "node", "left_semi"))
        members = staged(narrower, "members")
        tagged = undecided(members, components(links))
        links = links.unionByName(staged(verify(pivot_pairs(shared_keys(tagged)), held), "links"))
        open_keys = staged(undecided(members, components(links)), "open")
    if traits:
        open_keys = open_keys.join(held.select("node", *traits), "node")
    return links.unionByName(staged(verify(crossing_pairs(open_keys, plausible), held), "links"))
