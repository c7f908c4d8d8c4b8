"""Importance resampling, top-k search and vector codes against brute force, with nulls, ties, repeats and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import resampling, topk, vector_codes
from tests.llm import brute

VECTORS = "vec_id bigint, embedding array<float>, label int, v string, _label int, slab int"


def runs(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def brute_resample(docs, target, longest, buckets, seed, percent, min_words):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in runs(t, longest)[0])
    t = Counter(bucket(f) for x in target for f in runs(x, longest)[0])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        features, n_words = runs(text, longest)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(features), n_words, weight, score))
    drawn = sorted((r for r in rows if r[2] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[1]))
    ranks = {}
    for place, r in enumerate(drawn[:percent * len(drawn) // 100], 1):
        ranks.setdefault(r, []).append(place)
    return [(*r[:2], *r[3:], ranks[r].pop() if ranks.get(r) else None) for r in rows]


@pytest.mark.parametrize("longest,buckets,percent,min_words", [(1, 50, 30, 3), (3, 97, 100, 0), (2, 10_000, 0, 1)])
def test_resampling(spark, longest, buckets, percent, min_words):
    draw = random.Random(8)
    word = lambda: draw.choice(["Alpha", "beta", "Éclair", "x1", "the", "\x00", "日本", "a_b"])
    docs = [(i, draw.choice([" ", ", ", "\n"]).join(word() for _ in range(draw.randrange(12)))) for i in range(120)]
    docs += [(3, docs[3][1]), (7, None), (8, ""), (9, "--"), (200, "the beta " * 40_000)]
    target = ["beta beta x1", None, "", "the Éclair"]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, rank string, score int").repartition(4)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    got = resampling.resample(d, t, longest, buckets, 7, percent, min_words).collect()
    expected = brute_resample(docs, target, longest, buckets, 7, percent, min_words)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=key) == sorted(expected, key=key)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id bigint, text string")
    none = docs.limit(0)
    assert resampling.resample(none, docs).count() == 0
    rows = {r.doc_id: r for r in resampling.resample(docs, none, percent=100, min_words=1).collect()}
    assert rows[1]["rank"] == 1 and rows[None]["rank"] is None and rows[None].weight == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 5, 6) for i, v, label in rows], VECTORS)


def odd_vectors(n=90, width=8, seed=3):
    """Clusters, copies, ties, and rows that take no part."""
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(5)]
    rows = [(i, [round(c + draw.uniform(-.2, .2), 2) for c in draw.choice(centres)], draw.choice([None, 0, 1])) for i in range(n)]
    rows += [(n + i, list(rows[0][1]), 2) for i in range(20)]
    rows += [(1000, None, 1), (1010, [0.1, None] + [0.0] * (width - 2), 1), (1020, [float("nan")] + [0.0] * (width - 1), 1),
             (1030, [float("inf")] + [0.0] * (width - 1), None)]
    return rows


def kept(rows, scale, width):
    whole = lambda v: [math.floor(scale * float(np.float32(x))) for x in v] + [0] * (width - len(v))
    return [(i, whole(v), label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute_top_k(rows, step, k):
    return sorted((q, place, c, score) for q, a, _ in rows if q % step == 0 for place, (score, c) in enumerate(
        sorted(((sum(x * y for x, y in zip(a, b)), c) for c, b, _ in rows if c != q), key=lambda p: (-p[0], p[1]))[:k], 1))


@pytest.mark.parametrize("k,slab,bins", [(5, 4096, 10), (3, 4, 2), (500, 7, 3)])
def test_top_k(spark, monkeypatch, k, slab, bins):
    """All queries in several slabs, with bins of one score found after several rounds; too few candidates give all."""
    monkeypatch.setattr(topk, "SLAB", slab)
    monkeypatch.setattr(topk, "BIN_BITS", bins)
    rows = odd_vectors() + [(None, [1.0] * 8, 0), (300, [0.5, 0.25], 0), (310, [], 0)]
    got = topk.top_k(vectors(spark, rows).repartition(5), F.col("vec_id") % 10 == 0, k).collect()
    expected = brute_top_k([r for r in kept(rows, 256, 8) if r[0] is not None], 10, k)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == expected


def test_top_k_of_repeated_ids_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [0.5, 0.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [-1.0, 0.0], 0)]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0, 2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(
        [(0, 1, 1, 65536), (0, 2, 1, 65536), (0, 1, 1, 32768), (0, 2, 1, 32768)])
    assert topk.top_k(vectors(spark, rows), F.lit(False)).count() == 0
    assert topk.top_k(vectors(spark, rows).limit(0), F.lit(True)).count() == 0
    assert topk.top_k(vectors(spark, rows[:1]), F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        topk.top_k(vectors(spark, [(1, [1e9], 0)]), F.lit(True))


def test_histogram_leaves_out_only_what_cannot_matter():
    draw = np.random.default_rng(1)
    ids, rows = np.arange(400), draw.integers(-50, 50, (400, 6))
    slab = topk.Slab(ids[:30], rows[:30], 6 * 2500, 5)
    full = topk.Slab(ids[:30], rows[:30], 6 * 2500, 400)
    parts = [(ids[i:i + 100], rows[i:i + 100]) for i in range(0, 400, 100)]
    few, every = list(topk.histogram(slab, iter(parts))), {(q, b): n for q, b, n in topk.histogram(full, iter(parts))}
    assert len(few) < len(every) / 3 and all(every[q, b] == n for q, b, n in few)
    assert all(sum(n for p, _, n in few if p == q) >= 5 for q in range(30))


def brute_codes(rows, n_parts, rounds, entries, width):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    points = np.array([v for _, v, _ in rows])
    parts = np.split(points, n_parts, axis=1)
    books = [p[:entries].copy() for p in parts]

    def best(p, b):
        apart = ((p[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)
        return apart.argmin(axis=1), apart.min(axis=1)

    for _ in range(rounds):
        for n, p in enumerate(parts):
            code, _ = best(p, books[n])
            for e in set(code.tolist()):
                books[n][e] = p[code == e].sum(axis=0) // (code == e).sum()
    found = [best(p, b) for p, b in zip(parts, books)]
    error = sum(d for _, d in found)
    total = Counter()
    for (_, _, label), e in zip(rows, error.tolist()):
        total[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return [(i, "".join(f"{c[k]:02x}" for c, _ in found), e, total[label], digest) for k, ((i, _, label), e) in enumerate(zip(rows, error.tolist()))]


@pytest.mark.parametrize("n,entries,rounds", [(90, 16, 4), (400, 256, 2), (3, 256, 4)])
def test_vector_codes(spark, n, entries, rounds):
    rows = odd_vectors(n) + [(None, [0.3] * 8, None), (5, [0.25] * 8, 1), (5, [0.25] * 8, 1), (2000, [0.5, 0.25], None), (2001, [], 7)]
    got = vector_codes.compress(vectors(spark, rows).repartition(4), 4, rounds, entries=entries).collect()
    expected = brute_codes(kept(rows, 1024, 8), 4, rounds, entries, 8)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_vector_codes_of_odd_tables(spark):
    rows = [(2, [0.5, 0.25, 1.0], 0), (1, [0.0, 0.0, 0.0], 0)]
    got = {r.vec_id: r.code for r in vector_codes.compress(vectors(spark, rows)).collect()}
    assert got == {1: "00000000", 2: "01010100"}
    assert vector_codes.compress(vectors(spark, rows).limit(0)).count() == 0
    assert vector_codes.compress(vectors(spark, [(1, None, 0)])).count() == 0
    assert vector_codes.compress(vectors(spark, [(1, [], 0)])).first().error == 0
    for bad in ({"entries": 257}, {"scale": 1 << 40}):
        with pytest.raises(ValueError):
            vector_codes.compress(vectors(spark, rows), **bad)


@pytest.mark.parametrize("n,width,spread", [(256, 16, 300), (70, 2, 3), (1, 4, 9), (200, 5, 2000)])
def test_boxes_find_the_nearest_entry(n, width, spread):
    """Candidates are exactly the entries in the box; the answer is that of a scan over all entries, ties included."""
    draw = np.random.default_rng(n)
    book = vector_codes.SlicedCodebook(draw.integers(-spread, spread, (n, width)))
    points = np.concatenate([draw.integers(-3 * spread, 3 * spread, (500, width)), book.entries])
    apart = ((points[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
    code, distance = book.nearest(points)
    assert (code == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    radius = draw.integers(0, 2 * spread, len(points))
    inside = np.unpackbits(book.box(points, radius).view(np.uint8), axis=1, bitorder="little")[:, :n]
    assert (inside == (np.abs(points[:, None, :] - book.entries[None]).max(axis=2) <= radius[:, None])).all()
