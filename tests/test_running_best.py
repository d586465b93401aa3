"""Running best hits where scores tie, and rows that are no hits: as arg_max in order has it."""

import duckdb

from segtrace.streaming.identify import running_best


def test_ties_and_missing_cells(spark):
    nan = float("nan")
    rows = [(1, 5.0, 11), (1, 5.0, 12), (1, 4.0, 10), (2, None, 20), (3, 7.0, None), (3, 6.0, 31), (4, nan, 41), (4, 9.0, 40), (4, nan, 42), (5, -1.0, 51), (5, -1.0, 52), (6, -0.0, 61), (6, 0.0, 62), (7, float("-inf"), 71)]
    got = running_best(spark.createDataFrame(rows, "q long, score double, hit long").repartition(4), "q", "score", "hit")
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute("CREATE TABLE t (q BIGINT, score DOUBLE, hit BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [list(r) for r in rows])
    want = con.execute("SELECT q, max(score), arg_max(hit, score) FROM t GROUP BY 1").fetchall()
    assert sorted((r.q, str(r.score), r.hit) for r in got.collect()) == sorted((q, str(s), h) for q, s, h in want)
