"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``tables`` small hashes (of ``rows`` minimums each) are computed per document. A table key is a
pair, one small hash of each collection, so tables * tables keys of 2 * rows minimums come from 2 * tables * rows
minimums instead of 2 * rows * tables * tables. Documents that share a key are candidates; every link is confirmed on
the full sets of shingles. With 16 tables of 3 rows a pair of similarity 0.8 meets with probability 0.99998.

Work is kept proportional to the rows, not to the pairs of a group:

* Equal sets are one node. Small hashes that no other node shares are dropped before keys are formed.
* In the first pass the sketch of every node is compared with those of its keys' smallest nodes only, and the full
  set with the most alike of these, so a node has one pair however many hubs its group has. That ties most of a
  group together. Then only nodes of a key that lie in different components are left. The nodes of the key's
  largest component are not compared with each other, and a pair is formed once, at the first small hash that it
  shares. Again the most alike pair of a node comes first, and the others only if their ends still lie apart. A sketch of 1024 bins, each with four bits of the smallest hash that fell into it, drops pairs that are
  below the limit by six standard deviations.
* Texts travel to the comparison only for pairs that remain: their nodes are sent to the texts when they are few
  (``broadcast_if_small``), otherwise both are shuffled. Joins on a key keep one side splittable.

Defined results: null or wordless text has an empty set, linked with nothing; rows that repeat an id are one
document for linking and give a row each; rows with a null id are linked with nothing, have no component and are
kept; a text with fewer words than a shingle is one shingle; an empty table gives no rows; other columns are
ignored by ``components`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.batches import blocks_of, map_rows, utf8
from millrace.operators.graph import connected_components
from millrace.plans.durable import shuffles_dropped, staged
from millrace.plans.sizing import broadcast_if_small

WIDTH, SIMILARITY = 5, 80  # words of a shingle, percent
TABLES, ROWS = 16, 3
BINS, PLANES = 1024, 5  # of the sketch: which bins are used, and four bits of what is in them
DEVIATIONS = 6.0  # a pair at the limit is lost with less than 1 in 10 million
BLOCK_SHINGLES = 1 << 19

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words, A-Z lower-cased, split at ASCII white space."""
    words = text.translate(_FOLD).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    runs = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        runs = mixed(runs * _K1 + hashes[i:i + len(runs)])
    return np.unique(runs)


def minimums(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash values, one row per (non-empty) set."""
    draw = np.random.default_rng(2024)
    flips, factors = draw.integers(0, 1 << 63, (2, count)).astype(np.uint64)
    values = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), count), dtype=np.uint64)
    for j in range(count):
        out[:, j] = np.minimum.reduceat((values ^ flips[j]) * (factors[j] << np.uint64(1) | np.uint64(1)), starts)
    return out


def small_hashes(low: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash per ``rows`` neighbouring minimums, different in every table."""
    tables = low.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64), (len(low), tables))
    for r in range(rows):
        keys = mixed(keys * _K1 + low[:, r::rows])
    return keys


def bit_sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Per set, PLANES bit planes over BINS bins of the hash range: is the bin used, and bits of its smallest hash."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    cell = owner * BINS + (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(cell, prepend=-1))  # sets are sorted, so the first of a bin is its smallest
    code = mixed(values[first])
    planes = np.zeros((PLANES, len(sets) * BINS), dtype=np.uint8)
    planes[0, cell[first]] = 1
    for k in range(1, PLANES):
        planes[k, cell[first]] = (code >> np.uint64(k)) & np.uint64(1)
    packed = np.packbits(planes.reshape(PLANES, len(sets), BINS), axis=2)
    return packed.transpose(1, 0, 2).reshape(len(sets), -1).copy().view("<i8")


def signatures(docs: DataFrame, width: int, tables: int = TABLES, rows: int = ROWS, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """(id, text_hash, n_shingles, set_id, u, v, sketch); the last four are null for empty sets."""

    def signed(texts: Iterator[tuple]) -> Iterator[tuple]:
        found = ((key, hashed, shingles(text, width)) for key, hashed, text in texts)
        for block in blocks_of(found, lambda row: len(row[2]), BLOCK_SHINGLES):
            full = [s for _, _, s in block if len(s)]
            low = minimums(full, 2 * tables * rows) if full else None
            if full:
                keys, bits = small_hashes(low, rows).view(np.int64), bit_sketch(full)
            at = 0
            for key, hashed, own in block:
                if len(own):
                    yield (key, hashed, len(own), xxhash.xxh3_128_digest(own.tobytes()), keys[at, :tables], keys[at, tables:], bits[at])
                    at += 1
                else:
                    yield key, hashed, 0, None, None, None, None

    return map_rows(docs, [F.col(id_column), F.xxhash64(utf8(text_column)), utf8(text_column)],
                    "doc_id bigint, text_hash bigint, n_shingles bigint, set_id binary, u array<bigint>, v array<bigint>, sketch array<bigint>",
                    signed, spread=True)


def bins_of(a: str, b: str) -> tuple[Column, Column]:
    """Bins in which the sketches of two nodes differ, and bins that either uses."""
    words = BINS // 64
    one, two = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    differing = reduce(Column.__add__, [F.bit_count(reduce(Column.bitwiseOR, [
        one[p * words + i].bitwiseXOR(two[p * words + i]) for p in range(PLANES)])) for i in range(words)])
    return differing, reduce(Column.__add__, [F.bit_count(one[i].bitwiseOR(two[i])) for i in range(words)])


def plausible(a: str, b: str, percent: int) -> Column:
    """Neither the sizes nor the sketches of two nodes rule out the similarity.

    The used bins of either node are a sample without replacement of the union of the two sets; of a pair at the
    limit the share (100 - percent) of them differs, give or take the sample's deviation.
    """
    limit = percent / 100
    differing, used = bins_of(a, b)
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    unseen = F.greatest(F.lit(0.0), 1 - used * (1 + limit) / (na + nb))
    margin = 1 + DEVIATIONS * F.sqrt(limit * (1 - limit) * used * unseen)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (differing <= used * (1 - limit) + margin)


def similar(texts: Callable[[DataFrame], DataFrame], pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full sets reach the similarity. ``texts`` gives the unique (node, text) of nodes.

    Pairs lie sorted by dst, so the set of a node that many pairs share is made once per run of them.
    """
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    needed = staged(texts(ends), "texts")
    left = pairs.join(needed.select(F.col("node").alias("src"), F.col("text").alias("_a")), "src")
    both = (left.join(needed.select(F.col("node").alias("dst"), F.col("text").alias("_b")), "dst")
            .sortWithinPartitions("dst"))

    def confirmed(rows: Iterator[tuple]) -> Iterator[tuple]:
        last, right = None, np.zeros(0, dtype=np.uint64)
        for src, dst, a, b in rows:
            if dst != last:
                last, right = dst, shingles(b, width)
            own = shingles(a, width)
            common = len(np.intersect1d(own, right, assume_unique=True))
            if 100 * common >= percent * (len(own) + len(right) - common):
                yield src, dst

    return map_rows(both, [F.col("src"), F.col("dst"), F.col("_a"), F.col("_b")], "src bigint, dst bigint", confirmed)


@contextmanager
def compiled_in_parts(spark: SparkSession) -> Iterator[None]:
    """Keeps generated code in methods that the virtual machine compiles: the comparison of two sketches is a long expression."""
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def links(docs: DataFrame, nodes: DataFrame, width: int, percent: int, tables: int, rows: int,
          id_column: str, text_column: str) -> DataFrame:
    """Confirmed links (src, dst) that connect whatever the similarity connects. ``nodes`` is staged."""
    # An id may come with several texts: a node's text is the one that it was made of.
    own = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc_id"), utf8(text_column).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))

    def texts(ends: DataFrame) -> DataFrame:
        wanted = staged(nodes.select("node", "doc_id", "text_hash").join(ends, "node", "left_semi"), "wanted")
        return own.join(broadcast_if_small(wanted), ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"])

    # Small hashes that at least two nodes share, and the keys made of pairs of them.
    halves = nodes.select("node", F.posexplode(F.concat("u", "v")).alias("pos", "half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("half")
    kept = halves.join(shared, "half")
    first = F.col("pos") < tables
    kept = (kept.groupBy("node").agg(F.collect_list(F.when(first, F.col("half"))).alias("us"),
                                     F.collect_list(F.when(~first, F.col("half"))).alias("vs"))
            .where((F.size("us") > 0) & (F.size("vs") > 0)))
    keys = (kept.select("node", F.explode("us").alias("_u"), "vs").select("node", "_u", F.explode("vs").alias("_v"))
            .select("node", F.xxhash64("_u", "_v").alias("key")))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    members = staged(keys.join(hubs, "key"), "members")

    light = nodes.select("node", "n_shingles", "sketch")
    stars = members.where("node <> hub").select(F.col("node").alias("src"), F.col("hub").alias("dst")).distinct()
    tied = _checked(_most_alike(_plausible_pairs(stars, light, percent)), texts, width, percent)
    if tied.isEmpty():
        label = nodes.select(F.col("node").alias("id"), F.col("node").alias("component")).limit(0)
    else:
        label = connected_components(tied)

    # What is left: keys whose nodes lie in several components.
    lying = (members.select("node", "key").join(label.withColumnRenamed("id", "node"), "node", "left")
             .select("node", "key", F.coalesce("component", "node").alias("component")))
    open_keys = (lying.groupBy("key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
                 .where("_a <> _b").select("key"))
    left = staged(lying.join(open_keys, "key"), "open")
    sizes = left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("_n", "component")).alias("largest"))
    full = nodes.select("node", "n_shingles", "sketch", "u", "v")
    rich = staged(left.join(largest, "key").join(full, "node"), "open")
    outside = rich.where("component <> largest").alias("a")
    apart = F.col("a.key") == F.col("b.key")
    # A pair is formed under the first pair of halves that it shares; told before its sketches are compared.
    shared_half = lambda c: F.coalesce(*[F.when(F.col(f"a.{c}")[i] == F.col(f"b.{c}")[i], F.col(f"a.{c}")[i]) for i in range(tables)])
    once = F.col("a.key") == F.xxhash64(shared_half("u"), shared_half("v"))
    close = once & plausible("a", "b", percent)
    pair = [F.col("a.node").alias("src"), F.col("b.node").alias("dst"), _apart()]
    to_largest = outside.join(rich.where("component = largest").alias("b"), apart & close).select(*pair)
    among = outside.join(rich.where("component <> largest").alias("b"),
                         apart & (F.col("a.component") < F.col("b.component")) & close).select(*pair)
    pairs = staged(to_largest.unionByName(among).distinct(), "pairs")
    if pairs.isEmpty():
        return tied
    likely = staged(_most_alike(pairs), "likely")
    tied = tied.unionByName(_checked(likely, texts, width, percent))
    if tied.isEmpty():
        others = pairs.join(likely, ["src", "dst"], "left_anti").select("src", "dst")
    else:
        others = _lying_apart(pairs.join(likely, ["src", "dst"], "left_anti"), connected_components(tied))
    return tied.unionByName(_checked(others, texts, width, percent))


def _apart() -> Column:
    """The share of the used bins in which the sketches of a and b differ."""
    differing, used = bins_of("a", "b")
    return (differing / used).alias("_apart")


def _plausible_pairs(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    a, b = light.alias("a"), light.alias("b")
    return (pairs.join(a, F.col("src") == F.col("a.node")).join(b, F.col("dst") == F.col("b.node"))
            .where(plausible("a", "b", percent)).select("src", "dst", _apart()))


def _most_alike(pairs: DataFrame) -> DataFrame:
    """Of the pairs of every ``src`` the one whose sketches are the most alike."""
    return pairs.groupBy("src").agg(F.min_by("dst", F.struct("_apart", "dst")).alias("dst"))


def _lying_apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components; a node without a label is one of its own."""
    of = lambda end: label.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
    both = pairs.join(of("src"), "src", "left").join(of("dst"), "dst", "left")
    return both.where(F.coalesce("_src", "src") != F.coalesce("_dst", "dst")).select("src", "dst")


def _checked(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], width: int, percent: int) -> DataFrame:
    return staged(similar(texts, staged(pairs, "pairs"), width, percent), "links")


def components(docs: DataFrame, width: int = WIDTH, percent: int = SIMILARITY, tables: int = TABLES, rows: int = ROWS,
               id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; component_id is the smallest id that links reach."""
    with shuffles_dropped(docs.sparkSession):
        return _components(docs, width, percent, tables, rows, id_column, text_column)


def _components(docs: DataFrame, width: int, percent: int, tables: int, rows: int, id_column: str, text_column: str) -> DataFrame:
    signed = staged(signatures(docs, width, tables, rows, id_column, text_column), "signatures")
    named = signed.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    # Nodes are the distinct sets, numbered once they are made; the written copy keeps the numbers.
    nodes = staged(named.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash", "n_shingles", "u", "v", "sketch")).alias("_s"))
                   .select("set_id", "_s.*", F.monotonically_increasing_id().alias("node")), "nodes")
    with compiled_in_parts(docs.sparkSession):
        found = links(docs, nodes, width, percent, tables, rows, id_column, text_column)
    # A repeated id ties the nodes of its texts together.
    sets = nodes.select("set_id", "node", "doc_id")
    repeated = (named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id"))
    owned = named.select("doc_id", "set_id").distinct().join(repeated, "doc_id").join(sets.drop("doc_id"), "set_id")
    ties = (owned.join(owned.groupBy("doc_id").agg(F.min("node").alias("dst")), "doc_id").where("node <> dst")
            .select(F.col("node").alias("src"), "dst").distinct())
    edges = staged(found.unionByName(ties), "links")
    if edges.isEmpty():
        classes = sets.select("set_id", F.col("doc_id").alias("component"))
    else:
        label = connected_components(edges).withColumnRenamed("id", "node").withColumnRenamed("component", "_class")
        joined = staged(sets.join(label, "node", "left").select("set_id", "doc_id", F.coalesce("_class", "node").alias("_class")), "classes")
        least = joined.groupBy("_class").agg(F.min("doc_id").alias("component"))
        classes = joined.join(least, "_class").select("set_id", "component")
    return (signed.join(classes, "set_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicate(docs: DataFrame, width: int = WIDTH, percent: int = SIMILARITY, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their component; of rows that repeat such an id, one stays."""
    classes = components(docs, width, percent, id_column=id_column, text_column=text_column)
    with shuffles_dropped(docs.sparkSession):
        classes = staged(classes, "classes")
        dropped = staged(classes.where(~F.col("kept")).select(F.col("doc_id").alias(id_column)).distinct(), "dropped")
        repeated = staged(classes.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
                          .where("_n > 1").select(F.col("doc_id").alias(id_column)), "repeated")
    # Ids are sent to the texts when they are few, so that texts are not shuffled.
    alone = docs.join(broadcast_if_small(dropped), id_column, "left_anti")
    if repeated.isEmpty():
        return alone
    several = broadcast_if_small(repeated)
    once = alone.join(several, id_column, "left_semi").dropDuplicates([id_column])
    return alone.join(several, id_column, "left_anti").select(docs.columns).unionByName(once.select(docs.columns))
