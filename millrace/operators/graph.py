"""Graph operators on edge tables (src, dst).

Hubs are expected: a vertex may hold a third of all edges. Aggregates combine before their
shuffle, adjacency is spread over salts in proportion to the degree, and joins on a vertex
keep one side unique so that adaptive execution can split the other.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from millrace.plans.durable import checkpointed, staged
from millrace.plans.sizing import shuffle_partitions
from millrace.plans.skew import all_salts, salt_count, salt_of

EDGES_PER_SALT = 1_000_000
PLACED_BYTES = 4 << 20  # of written edges that a task counts


def canonical(edges: DataFrame) -> DataFrame:
    """Undirected edges as src < dst, without loops and repeats."""
    return (edges.where(F.col("src") != F.col("dst"))
            .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def graph_size(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    count = F.count(F.lit(1))
    return edges.agg(count.alias("edges")).withColumn("vertices", ends.distinct().agg(count).scalar())


def degree_histogram(edges: DataFrame) -> DataFrame:
    """Vertices per degree (both directions)."""
    degree = (edges.select(F.explode(F.array("src", "dst")).alias("id"))
              .groupBy("id").agg(F.count(F.lit(1)).alias("degree")))
    return degree.groupBy("degree").agg(F.count(F.lit(1)).alias("n"))


class _Adjacency:
    """Links laid out once, by (src, salt), for many rounds of rank passing.

    Only the rank table moves in a round; the links stay where they are, sorted for the join.
    """

    def __init__(self, links: DataFrame, weight: str | None = None):
        self.weight = weight
        kept = ["dst", weight] if weight else ["dst"]
        partitions = shuffle_partitions(links)
        self.sources = (links.groupBy("src").agg(F.count(F.lit(1)).alias("_out"))
                        .withColumn("_salts", salt_count(F.col("_out"), EDGES_PER_SALT))
                        .persist(StorageLevel.MEMORY_AND_DISK))
        self.links = (links.join(self.sources.select("src", "_salts"), "src")
                      .select("src", salt_of(F.col("_salts"), "dst").alias("_salt"), *kept)
                      .repartition(partitions, "src", "_salt").sortWithinPartitions("src", "_salt")
                      .persist(StorageLevel.MEMORY_AND_DISK))

    def received(self, ranks: DataFrame) -> DataFrame:
        """Sum over in-links of rank / out-degree (or rank * weight), for vertices with in-links."""
        passed = F.col("rank") if self.weight else F.col("rank") / F.col("_out")
        share = (ranks.join(self.sources, ranks["id"] == self.sources["src"])
                 .select("src", passed.alias("_share"), all_salts(F.col("_salts")).alias("_salt")))
        value = F.col("_share") * F.col(self.weight) if self.weight else F.col("_share")
        return (self.links.join(share, ["src", "_salt"])
                .groupBy(F.col("dst").alias("id")).agg(F.sum(value).alias("_in")))

    def release(self) -> None:
        self.links.unpersist()
        self.sources.unpersist()


def pagerank_links(links: DataFrame, iterations: int = 10, damping: float = 0.85, cut_every: int = 5) -> DataFrame:
    """Ranks of the pages reached by links, starting from 1.0 on every page that links.

    Pages without in-links drop out after the first round; pages without out-links receive
    rank and pass none on.
    """
    graph = _Adjacency(staged(links.select("src", "dst").distinct(), "links"))
    ranks = graph.sources.select(F.col("src").alias("id"), F.lit(1.0).alias("rank"))
    for i in range(1, iterations + 1):
        ranks = graph.received(ranks).select("id", (F.lit(1 - damping) + F.lit(damping) * F.col("_in")).alias("rank"))
        if i % cut_every == 0 and i < iterations:
            ranks = checkpointed(ranks)
    result = checkpointed(ranks)
    graph.release()
    return result


def pagerank(edges: DataFrame, iterations: int | None = 10, tolerance: float = 0.001,
             reset: float = 0.15, cut_every: int = 5, max_rounds: int = 200) -> DataFrame:
    """Ranks of every vertex: a fixed number of rounds, or until no rank moves by ``tolerance``.

    Ranks that still move after ``max_rounds`` are an error, not a result.
    """
    kept = staged(edges.select("src", "dst"), "links")
    graph = _Adjacency(kept)
    everyone = staged(vertices_of(kept), "vertices")
    ranks = everyone.withColumn("rank", F.lit(1.0))
    rounds = max_rounds if iterations is None else iterations
    for i in range(1, rounds + 1):
        new = everyone.join(graph.received(ranks), "id", "left").select(
            "id", (F.lit(reset) + F.lit(1 - reset) * F.coalesce("_in", F.lit(0.0))).alias("rank"))
        if iterations is None:
            new = staged(new, "ranks")
            moved = new.join(ranks.withColumnRenamed("rank", "_old"), "id").agg(
                F.max(F.abs(F.col("rank") - F.col("_old")))).first()[0]
            ranks = new
            if moved is None or moved < tolerance:
                break
        else:
            ranks = checkpointed(new) if i % cut_every == 0 or i == rounds else new
    else:
        if iterations is None:
            raise RuntimeError(f"ranks still move by {moved} after {max_rounds} rounds; raise max_rounds or tolerance")
    graph.release()
    return ranks


def power_iteration_clusters(similarity: DataFrame, k: int, iterations: int = 15, cut_every: int = 5, seed: int = 1) -> DataFrame:
    """(id, cluster) from the dominant direction of the row-normalised similarity graph.

    ``similarity`` holds each pair once as (src, dst, weight). Values start from the degrees, take
    the weighted mean of their neighbours in every round and are then grouped by k-means
    (Lin and Cohen, 2010). The rounds only average, so scaling by the mean waits for the end.
    """
    both = similarity.select("src", "dst", "weight").unionByName(
        similarity.where("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    both = staged(both.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "similarity")
    degree = staged(both.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("_degree")).where("_degree > 0"), "degree")
    graph = _Adjacency(both, "weight")
    values = degree.select("id", (F.col("_degree") / degree.agg(F.avg("_degree")).scalar()).alias("rank"))
    for i in range(1, iterations + 1):
        values = graph.received(values).join(degree, "id").select("id", (F.col("_in") / F.col("_degree")).alias("rank"))
        if i % cut_every == 0 or i == iterations:
            values = checkpointed(values)
    graph.release()
    scaled = values.select("id", array_to_vector(F.array(F.col("rank") / values.agg(F.avg("rank")).scalar())).alias("features"))
    model = KMeans(k=k, seed=seed, tol=0.0).fit(scaled)
    return model.transform(scaled).select("id", F.col("prediction").alias("cluster"))


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All pairs (src, dst) joined by a path. Each round extends only the newest pairs."""
    steps = staged(edges.select("src", "dst").distinct(), "edges")
    known, newest = steps, steps
    while True:
        longer = (newest.withColumnRenamed("dst", "_mid")
                  .join(steps.select(F.col("src").alias("_mid"), "dst"), "_mid").select("src", "dst").distinct())
        newest = staged(longer.join(known, ["src", "dst"], "left_anti"), "paths")
        if newest.isEmpty():
            return known
        known = known.unionByName(newest)


def levels_below(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Distance of every vertex that reaches a root along edges (each first seen at its level)."""
    found = staged(roots.select("id", F.lit(0).alias("level")), "level")
    frontier, level = found, 0
    while True:
        level += 1
        above = frontier.select(F.col("id").alias("dst"))
        nxt = edges.join(above, "dst").select(F.col("src").alias("id")).distinct()
        frontier = staged(nxt.join(found, "id", "left_anti").withColumn("level", F.lit(level)), "level")
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component), the component being its smallest vertex id.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): the number of rounds
    grows with the logarithm of the graph's size.
    """
    everyone = staged(vertices_of(edges), "vertices")
    pairs = staged(canonical(edges).select(F.col("dst").alias("u"), F.col("src").alias("v")), "pairs")
    before = None
    while True:
        # Large star: each neighbour above u is pointed at the least vertex around u.
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("_m"))
        large = staged(around.where(F.col("v") > F.col("u")).join(least, "u")
                       .select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct(), "large")
        # Small star: u and its lower neighbours are pointed at the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("_m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
        pairs = staged(moved.unionByName(least.select("u", F.col("_m").alias("v"))).distinct(), "small")
        mark = _fingerprint(pairs)
        if mark == before:
            break
        before = mark
    label = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return everyone.join(label, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def triangle_counts(edges: DataFrame) -> DataFrame:
    """(id, triangles) for the vertices of at least one triangle.

    Edges point from the vertex of lower degree to the higher, which bounds the out-degree by
    the square root of twice the edges; hubs are never expanded.
    """
    und = staged(canonical(edges), "undirected")
    degree = (und.select(F.explode(F.array("src", "dst")).alias("id"))
              .groupBy("id").agg(F.count(F.lit(1)).alias("deg")))
    d1 = degree.select(F.col("id").alias("src"), F.col("deg").alias("_ds"))
    d2 = degree.select(F.col("id").alias("dst"), F.col("deg").alias("_dd"))
    ranked = und.join(d1, "src").join(d2, "dst")
    low, high = F.struct(F.col("_ds").alias("d"), F.col("src").alias("v")), F.struct(F.col("_dd").alias("d"), F.col("dst").alias("v"))
    up = staged(ranked.select(F.least(low, high).alias("a"), F.greatest(low, high).alias("b")), "oriented")
    # The neighbours above a vertex by rank, one row a vertex. An edge takes those above both of its ends along, so a row
    # moves per edge and not per wedge.
    above = up.groupBy(F.col("a.v").alias("a")).agg(F.sort_array(F.collect_list("b")).alias("_n"))
    above = staged(above.select("a", F.col("_n.v").alias("_n")), "above")
    wedges = (above.select("a", F.posexplode("_n").alias("_i", "b"), "_n").where(F.col("_i") < F.size("_n") - 1)
              .select("a", "b", F.slice("_n", F.col("_i") + 2, F.size("_n")).alias("_later")))
    # Written lists are far smaller than in memory, so neither side may be broadcast for the size of its files.
    closing = above.select(F.col("a").alias("b"), F.col("_n").alias("_own")).hint("merge")
    closed = wedges.join(closing, "b").select("a", "b", F.array_intersect("_later", "_own").alias("_c")).where(F.size("_c") > 0)
    found = F.size("_c").cast("bigint")
    corner = lambda v, n: F.struct(v.alias("id"), n.alias("_t"))
    corners = F.concat(F.array(corner(F.col("a"), found), corner(F.col("b"), found)),
                       F.transform("_c", lambda c: corner(c, F.lit(1).cast("bigint"))))
    return closed.select(F.inline(corners)).groupBy("id").agg(F.sum("_t").alias("triangles"))


def _grid_part(partitions: int) -> Column:
    side = math.ceil(math.sqrt(partitions))
    row = F.pmod(F.xxhash64("src"), F.lit(side))
    column = F.pmod(F.xxhash64("dst"), F.lit(side))
    return F.pmod(row * side + column, F.lit(partitions)).cast("int")


def partition_edges(edges: DataFrame, strategy: str, partitions: int) -> DataFrame:
    """Place edges by one of four strategies.

    ``RandomVertexCut`` keeps equal directed pairs together, ``CanonicalRandomVertexCut`` both
    directions of a pair, ``EdgePartition1D`` all edges of a source and ``EdgePartition2D`` uses
    a square grid, which limits the parts that hold a vertex to twice the grid's side.
    """
    if strategy == "RandomVertexCut":
        return edges.repartition(partitions, "src", "dst")
    if strategy == "CanonicalRandomVertexCut":
        return edges.repartition(partitions, F.least("src", "dst"), F.greatest("src", "dst"))
    if strategy == "EdgePartition1D":
        return edges.repartition(partitions, "src")
    if strategy == "EdgePartition2D":
        return edges.repartitionById(partitions, _grid_part(partitions))
    raise ValueError(f"unknown strategy {strategy}")


def placement_report(edges: DataFrame, strategy: str, partitions: int) -> DataFrame:
    """Edges placed, and whether no more parts than the strategy promises share what it keeps together.

    The placed edges are written, as their parts may be too few and too large to count in, and counted in shares of
    bounded size.
    """
    placed = staged(partition_edges(edges, strategy, partitions).withColumn("_p", F.spark_partition_id()), "placed")
    shares = shuffle_partitions(placed, PLACED_BYTES)
    if strategy == "CanonicalRandomVertexCut":
        placed = placed.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "_p")
    keys = ["src"] if strategy.startswith("EdgePartition") else ["src", "dst"]
    counted = placed.repartition(shares, "src", "dst").groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_n"))
    parts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_parts"), F.sum("_n").alias("_n"))
    bound = math.ceil(math.sqrt(partitions)) if strategy == "EdgePartition2D" else 1
    return parts.agg(F.lit(strategy).alias("strategy"), F.sum("_n").alias("edges"),
                     (F.max("_parts") <= bound).alias("kept_together"))
