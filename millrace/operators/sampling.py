"""Sampling, splits and generated tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from millrace.plans.durable import staged
from millrace.plans.ordering import row_index, running_sums
from millrace.plans.sizing import broadcast_if_small

BINS = 4096  # of the hash, per stratum


def hash_split(df: DataFrame, key: Sequence[str], percent: int) -> tuple[DataFrame, DataFrame]:
    """Two parts by a hash of the key: the same rows every time, on any cluster."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(100))
    return df.where(bucket < percent), df.where(bucket >= percent)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def _chance(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the columns and the seed alone, so a task that runs again draws the same."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def take_sample(df: DataFrame, n: int, seed: int, with_replacement: bool = False,
                order: Sequence[str] = ()) -> DataFrame:
    """Exactly n rows. ``order`` names a total order of the rows; without replacement it defaults to all columns."""
    if not with_replacement:
        keys = list(order) or df.columns
        return df.withColumn("_h", F.xxhash64(F.lit(seed), *keys)).orderBy("_h", *keys).limit(n).drop("_h")
    numbered = row_index(df, order, "_i")
    total = numbered.count()
    draws = df.sparkSession.range(n).select(F.floor(_chance(seed, "id") * total).alias("_i"))
    return draws.join(numbered, "_i").drop("_i")


def sample_by_key(df: DataFrame, key: str, fractions: Mapping, seed: int) -> DataFrame:
    return df.sampleBy(key, dict(fractions), seed)


def _quotas(counts: DataFrame, key: str, fractions: float | Mapping) -> DataFrame:
    """``counts`` (key, n) with ``quota``: ceil(fraction * n), the fraction of a key that is not listed being 0."""
    if isinstance(fractions, Mapping):
        listed = F.lit(0.0)
        for value, fraction in fractions.items():
            listed = F.when(F.col(key) == F.lit(value), float(fraction)).otherwise(listed)
    else:
        listed = F.lit(float(fractions))
    return counts.withColumn("quota", F.ceil(F.col("n") * listed))


def accept_and_wait(df: DataFrame, key: str, fractions: float | Mapping, identity: Sequence[str], seed: int = 1,
                    bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """Rows that are in the exact stratified sample for certain, and those that wait for a place (``_open`` places).

    One pass counts the rows of each stratum in equal bins of their hash. The bins whose running count stays within the
    quota are accepted whole; the one bin that passes it holds the waiting rows, about one in ``bins`` of a stratum.
    """
    hashed = df.withColumn("_u", _chance(seed, *identity)).withColumn("_bin", F.floor(F.col("_u") * bins))
    counts = staged(hashed.groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_c")), "bins")
    quotas = _quotas(counts.groupBy(key).agg(F.sum("_c").alias("n")), key, fractions)
    upto = counts.withColumn("_upto", F.sum("_c").over(W.partitionBy(key).orderBy("_bin")))
    edges = (upto.join(quotas, upto[key].eqNullSafe(quotas[key])).where(F.col("_upto") >= F.col("quota"))
             .groupBy(upto[key].alias("_key")).agg(F.min(F.struct("_bin", (F.col("quota") - F.col("_upto") + F.col("_c")).alias("_open"))).alias("_e"))
             .select("_key", F.col("_e._bin").alias("_edge"), "_e._open"))
    placed = hashed.join(broadcast_if_small(staged(edges, "edges")), F.col(key).eqNullSafe(F.col("_key")))
    accepted = placed.where(F.col("_bin") < F.col("_edge")).select(*df.columns)
    return accepted, placed.where((F.col("_bin") == F.col("_edge")) & (F.col("_open") > 0)).select(*df.columns, "_u", "_open")


def sample_by_key_exact(df: DataFrame, key: str, fractions: float | Mapping, identity: Sequence[str], with_replacement: bool = False,
                        seed: int = 1) -> DataFrame:
    """Exactly ceil(fraction * n) rows of every key, or so many draws with replacement. Null is a key like any other.

    ``identity`` names a total order of the rows. Without replacement only the few waiting rows are sorted.
    """
    if not with_replacement:
        accepted, waiting = accept_and_wait(df, key, fractions, identity, seed)
        ranked = running_sums(waiting, ["_u", *identity], {"_rank": F.lit(1)}, keys=[key])
        return accepted.unionByName(ranked.where(F.col("_rank") <= F.col("_open")).select(*df.columns))
    numbered = staged(running_sums(df, list(identity), {"_at": F.lit(1)}, keys=[key]), "numbered")
    quotas = _quotas(numbered.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, fractions).where("quota > 0")
    draws = quotas.select(F.col(key).alias("_key"), "n", F.explode(F.sequence(F.lit(1), "quota")).alias("_draw"))
    draws = draws.select("_key", (F.floor(_chance(seed, "_key", "_draw") * F.col("n")) + 1).alias("_place"))
    return numbered.join(draws, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_place"))).select(*df.columns)


def positional_split(df: DataFrame, order: Sequence[str], fraction: float) -> tuple[DataFrame, DataFrame]:
    """The first ``fraction`` of the rows in ``order``, and the rest."""
    numbered = row_index(df, order, "_i")
    cut = int(numbered.count() * fraction)
    return numbered.where(F.col("_i") < cut).drop("_i"), numbered.where(F.col("_i") >= cut).drop("_i")


def normal_columns(df: DataFrame, names: Sequence[str], seed: int) -> DataFrame:
    """Independent standard normal columns added to each row."""
    return df.select("*", *[F.randn(seed + i).alias(n) for i, n in enumerate(names)])


def normal_table(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    return normal_columns(spark.range(rows), ["x"], seed)


def lognormal_edges(vertices: DataFrame, vertex: str, total: Column, mu: float = 4.0, sigma: float = 1.3,
                    seed: int = 1) -> DataFrame:
    """Edges from every vertex with log-normal out-degrees to random targets 0 .. total-1."""
    degree = F.floor(F.exp(F.lit(mu) + F.lit(sigma) * F.randn(seed))).cast("int")
    fan = vertices.select(F.col(vertex).alias("src"), total.alias("_n"), degree.alias("_d")).where("_d > 0")
    ends = fan.select("src", "_n", F.explode(F.sequence(F.lit(1), F.col("_d"))).alias("_e"))
    return ends.select("src", F.floor(F.rand(seed + 1) * F.col("_n")).alias("dst"))
