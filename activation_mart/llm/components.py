"""Pairs within buckets without all pairs, and connected components, as joins and aggregations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, settle

FEW = 32  # members of a bucket that are compared without a closer bound


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of undirected ``edges`` (a, b).

    Each round a node's neighbours and itself are pointed at the least of them,
    first the larger neighbours, then the smaller ones; components halve in
    depth, and a star is left. Every round is settled in the shared folder, so
    that lineage stays short. A node with very many neighbours is a group in a
    map-side aggregate and one side of a join that the skew join may split.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = settle(both.distinct(), "links")

    def stars() -> bool:
        """Whether each larger end has one link, to a node that is no larger end: no round changes that."""
        ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            links.select("v", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.filter("up > 1 OR up = 1 AND down = 1").isEmpty()

    while not stars():
        # Large star: every larger neighbour of u goes to the least of u and its neighbours.
        around = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = settle(
            around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct(),
            "large-star",
        )
        # Small star: u and its smaller neighbours go to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = settle(joined.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        discard(links, large)
        links = small
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _near(size: str, unique: str, similarity: float) -> str:
    """Whether a set of these weights and one of (size, own) can be similar: they share no more than this."""
    shared = f"least({size} - {unique}, size - own)"
    return f"{shared} >= {similarity} * ({size} + size - {shared}) - 1e-9"


def own_weights(elements: DataFrame) -> DataFrame:
    """(node, own) of rows (node, element, weight), none twice: the weight of the elements that no other node has.

    Counted in the tasks that list them: as a copy of their own they took more room than the input.
    """
    single = elements.groupBy("element").agg(
        F.count(F.lit(1)).alias("k"), F.min("node").alias("node"), F.min("weight").alias("weight")
    ).filter("k = 1")
    return single.groupBy("node").agg(F.sum("weight").alias("own"))


def linked_components(
    members: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    compare: Callable[[DataFrame, DataFrame], DataFrame],
    own: Callable[[DataFrame, DataFrame], DataFrame],
    similarity: float,
) -> tuple[DataFrame, DataFrame]:
    """Components of all pairs of sets that share a bucket and are similar, and the pairs found on the way.

    ``members`` has (bucket, node). ``fetch`` gives what is compared of some
    nodes, once, with their ``size``, the weight of a set; ``compare`` takes distinct pairs
    (a, b), a < b, and returns those that hold; ``own`` gives (node, own), the
    weight of what none but the node has of some nodes (see ``own_weights``).

    First every member is compared with the least node of each of its buckets.
    Where a bucket then still holds several components, what a set has that no
    other set in question has bounds its similarity to all of them. Members are
    compared with the node of least such weight of their bucket, and at last
    every member outside a bucket's largest component with all members of other
    components that the bounds allow. A pair that is never compared stands in
    one component already or cannot be similar: the components are those of
    comparing all pairs, while a group of n copies costs a few times n.
    """
    given = settle(members, "members")
    counts = given.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settle(given.join(counts, "bucket"), "shared")
    discard(given)
    payload = settle(fetch(shared.select("node").distinct()), "payload")
    members = settle(shared.join(payload.select("node", "size"), "node"), "sized")
    discard(shared)
    hubs = members.groupBy("bucket").agg(F.min_by(F.struct("node", "size"), "node").alias("hub"))
    stars = (
        members.withColumn("own", F.lit(0.0)).join(hubs, "bucket")
        .filter("node <> hub.node").filter(_near("hub.size", "0.0", similarity))
        .select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    )
    tried = settle(stars.distinct(), "stars")
    found = settle(compare(tried, payload), "star-pairs")
    roots = settle(components(found), "roots")

    def still_open(rows: DataFrame) -> DataFrame:
        """Rows of buckets that hold several components, with the largest one, ``main``."""
        placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = settle(placed, "placed")
        main = (
            placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
            .groupBy("bucket").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").select("bucket", "main")
        )
        rows = settle(placed.join(main, "bucket"), "open")
        discard(placed)
        return rows

    def further(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Compare pairs not yet tried; the components grow by what holds, from the stars they are."""
        new = pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
        new = settle(new.join(tried, ["a", "b"], "left_anti"), "more")
        links = settle(compare(new, payload), "more-pairs")
        if links.isEmpty():
            return tried.union(new), found, roots
        ends = links
        for side in ("a", "b"):
            ends = ends.join(roots.withColumnsRenamed({"node": side, "root": "of"}), side, "left").withColumn(
                side, F.coalesce("of", side)
            ).drop("of")
        merged = settle(components(ends), "merged")
        grown = roots.join(merged.toDF("root", "least"), "root", "left")
        grown = grown.select("node", F.coalesce("least", "root").alias("root"))
        return tried.union(new), found.union(links), settle(
            grown.unionByName(merged.join(roots, "node", "left_anti")), "roots"
        )

    rows = unbounded = still_open(members)
    discard(members)
    # Buckets of a few members cost little either way.
    many = rows.filter(F.col("n") > FEW).select("node").distinct()
    # The bound holds among ``many`` alone, hence in the large buckets.
    rows = rows.join(own(many, payload), "node", "left").withColumn(
        "own", F.when(F.col("n") > FEW, F.coalesce("own", F.lit(0.0))).otherwise(0.0)
    )
    rows = bounded = settle(rows.select("bucket", "node", "size", "own", "root", "main"), "bounded")
    discard(unbounded)
    hubs = rows.groupBy("bucket").agg(
        F.min_by(F.struct("node", "size", "own", "root"), F.struct(F.col("own") / F.col("size"), F.col("node"))).alias("hub")
    )
    pairs = rows.join(hubs, "bucket").filter("root <> hub.root").filter(_near("hub.size", "hub.own", similarity))
    tried, found, roots = further(pairs.select(F.col("hub.node").alias("x"), "node"))

    rows = still_open(bounded.select("bucket", "node", "size", "own"))
    discard(bounded)
    left = rows
    rows = rows.join(rows.groupBy("node").agg(F.collect_set("bucket").alias("all")), "node")
    apart = rows.filter("root <> main").select(
        "bucket", F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("size").alias("x_size"),
        F.col("own").alias("x_own"), F.col("all").alias("x_all"),
    )
    # A pair is made in the least of the buckets that it shares, once.
    pairs = (
        apart.join(rows, "bucket").filter("x_root <> root").filter(_near("x_size", "x_own", similarity))
        .filter("bucket = array_min(array_intersect(x_all, all))")
    )
    tried, found, roots = further(pairs.select("x", "node"))
    discard(left, payload)
    return roots, found
