"""Every query with a SQL form gives the same rows as an independent database."""

import pytest

from millrace.compare import difference, normal_rows, sql_rows
from millrace.registry import registered

QUERIES = registered()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_same_rows_as_sql(spark, small, name):
    df = QUERIES[name].run(spark, small)
    assert difference(normal_rows(df.columns, df.collect()), sql_rows(small, QUERIES[name].sql)) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is None])
def test_runs_with_rows(spark, small, name):
    assert QUERIES[name].run(spark, small).count() > 0


def test_every_survey_family_is_registered():
    counts = {"src": 10, "snk": 5, "prj": 5, "flt": 6, "arr": 2, "mth": 2, "dat": 2, "join": 10, "agg": 19, "srt": 7, "set": 4,
              "prt": 2, "gra": 8, "smp": 6, "gen": 2, "dir": 3, "cls": 12, "reg": 6, "rec": 4, "clu": 6, "fpm": 3, "lin": 3,
              "sta": 3, "eva": 6, "tun": 4, "udf": 4}
    for family, n in counts.items():
        for i in range(1, n + 1):
            assert any(q.startswith(f"{family}{i}_") for q in QUERIES), f"{family}{i}"
    for family, last, absent in (("str", 9, {5}), ("stm", 23, {15}), ("fea", 33, {27})):
        for i in set(range(1, last + 1)) - absent:
            assert any(q.startswith(f"{family}{i}_") for q in QUERIES), f"{family}{i}"
