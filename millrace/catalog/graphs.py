"""Graph queries: part-to-supplier links and the order-to-region hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import ctes
from millrace.operators import graph
from millrace.operators.relational import union_all
from millrace.registry import query
from millrace.sources import views
from millrace.sources.tables import table


def _rounds(first: str, step: str, n: int) -> str:
    """A chain of materialised rounds r0 .. rn."""
    parts = [f"r0 AS MATERIALIZED ({first})"]
    parts += [f"r{i} AS MATERIALIZED ({step.replace('PREV', f'r{i - 1}')})" for i in range(1, n + 1)]
    return ", ".join(parts)


_E = f"{ctes.PART_LINKS}, e AS MATERIALIZED (SELECT DISTINCT src, dst FROM links), d AS MATERIALIZED (SELECT src, count(*) AS o FROM e GROUP BY src)"
_LINK_ROUNDS = _rounds("SELECT src AS id, 1.0::DOUBLE AS rank FROM d",
                       "SELECT e.dst AS id, 0.15 + 0.85 * sum(PREV.rank / d.o) AS rank FROM e JOIN PREV ON PREV.id = e.src "
                       "JOIN d ON d.src = e.src GROUP BY e.dst", 10)
_ALL_ROUNDS = _rounds("SELECT id, 1.0::DOUBLE AS rank FROM v",
                      "SELECT v.id, 0.15 + 0.85 * coalesce(s.t, 0) AS rank FROM v LEFT JOIN (SELECT e.dst AS id, sum(PREV.rank / d.o) AS t "
                      "FROM e JOIN PREV ON PREV.id = e.src JOIN d ON d.src = e.src GROUP BY e.dst) s ON s.id = v.id", 10)


@query("gra1_load_edges", f"""WITH {ctes.PART_LINKS}, c AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst
  FROM links WHERE src <> dst) SELECT count(*) AS edges, (SELECT count(*) FROM (SELECT src FROM c UNION SELECT dst FROM c)) AS vertices FROM c""")
def gra1(spark, folder):
    return graph.graph_size(graph.canonical(views.part_links(spark, folder)))


@query("gra2_pagerank_links", f"WITH {_E}, {_LINK_ROUNDS} SELECT id, round(rank, 5) AS rank FROM r10")
def gra2(spark, folder):
    return graph.pagerank_links(views.part_links(spark, folder)).select("id", F.round("rank", 5).alias("rank"))


@query("gra3_pagerank_static", f"WITH {_E}, v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e), {_ALL_ROUNDS} "
       "SELECT id, round(rank, 5) AS rank FROM r10")
def gra3(spark, folder):
    ranks = graph.pagerank(views.part_links(spark, folder).distinct(), iterations=10)
    return ranks.select("id", F.round("rank", 5).alias("rank"))


@query("gra3_pagerank_tolerance")
def gra3_tolerance(spark, folder):
    ranks = graph.pagerank(views.part_links(spark, folder).distinct(), iterations=None, tolerance=0.001)
    return ranks.agg(F.count(F.lit(1)).alias("vertices"), F.sum("rank").alias("total"))


_CLOSURE = f"""RECURSIVE {ctes.HIERARCHY}, paths AS (SELECT src, dst, 1 AS step FROM hierarchy UNION
  SELECT p.src, h.dst, p.step + 1 FROM paths p JOIN hierarchy h ON p.dst = h.src)"""


@query("gra4_transitive_closure", f"WITH {_CLOSURE} SELECT DISTINCT src, dst FROM paths")
def gra4(spark, folder):
    return graph.transitive_closure(views.hierarchy(spark, folder))


@query("join9_iterated_self_join", f"""WITH {_CLOSURE} SELECT src AS id, max(step) AS level FROM paths GROUP BY src
  UNION ALL SELECT CAST(r_regionkey AS BIGINT) * 8, 0 FROM region""")
def join9(spark, folder):
    roots = table(spark, folder, "region").select((F.col("r_regionkey").cast("bigint") * 8).alias("id"))
    return graph.levels_below(views.hierarchy(spark, folder), roots)


@query("gra5_connected_components", f"""WITH {_CLOSURE}, root AS (SELECT src AS id, dst AS root FROM paths WHERE dst % 8 = 0
  UNION SELECT dst, dst FROM paths WHERE dst % 8 = 0), low AS (SELECT root, min(id) AS component FROM root GROUP BY root)
  SELECT id, component FROM root JOIN low USING (root)""")
def gra5(spark, folder):
    return graph.connected_components(views.hierarchy(spark, folder))


@query("gra6_triangle_count", f"""WITH {ctes.PART_LINKS}, c AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b
  FROM links WHERE src <> dst), t AS (SELECT x.a AS a, x.b AS b, y.b AS c FROM c x JOIN c y ON x.b = y.a JOIN c z ON z.a = x.a AND z.b = y.b)
  SELECT id, count(*) AS triangles FROM (SELECT unnest([a, b, c]) AS id FROM t) GROUP BY id""")
def gra6(spark, folder):
    return graph.triangle_counts(views.part_links(spark, folder))


@query("gra7_degree_histogram", f"""WITH {ctes.PART_LINKS}, e AS (SELECT DISTINCT src, dst FROM links),
  d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id)
  SELECT degree, count(*) AS n FROM d GROUP BY degree""")
def gra7(spark, folder):
    return graph.degree_histogram(views.part_links(spark, folder).distinct())


@query("gra8_partition_edges", f"""WITH {ctes.PART_LINKS} SELECT s AS strategy, count(*) AS edges, true AS kept_together FROM links,
  (VALUES ('RandomVertexCut'), ('CanonicalRandomVertexCut'), ('EdgePartition1D'), ('EdgePartition2D')) t(s) GROUP BY s""")
def gra8(spark, folder):
    e = views.part_links(spark, folder)
    return union_all(*[graph.placement_report(e, s, 9) for s in (
        "RandomVertexCut", "CanonicalRandomVertexCut", "EdgePartition1D", "EdgePartition2D")])
