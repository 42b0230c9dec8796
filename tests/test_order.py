"""Ranks of holdings whose exact sums are equal: the rows don't depend on the layout of the table."""

import duckdb
import pytest

from holdlens.plans.oracles import ORACLES
from holdlens.plans.queries import QUERIES

# 40 users, 5 funds, 3 days; each holding is 0.1, 0.2 and 0.3 in one of six orders, so the last bit of its sum depends on the order
EVENTS = """
    SELECT row_number() OVER (ORDER BY day, n, k, u) AS event_id, TIMESTAMP '2024-01-01' + to_days(CAST(day AS INTEGER)) AS ts, u AS user_id, ['signup', 'purchase', 'view', 'click', 'error'][k] AS event_type,
      [[0.1, 0.2, 0.3], [0.1, 0.3, 0.2], [0.2, 0.1, 0.3], [0.2, 0.3, 0.1], [0.3, 0.1, 0.2], [0.3, 0.2, 0.1]][(u * 7 + day + k) % 6 + 1][n]::DOUBLE AS value, '{}' AS props
    FROM range(40) a(u), unnest([0, 14, 29]) b(day), range(1, 6) c(k), range(1, 4) d(n)"""


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """The folder of the tables and a connection to them; events lie there backwards in several files, in the connection by event_id."""
    folder, db = tmp_path_factory.mktemp("tables"), duckdb.connect()
    db.execute("SET threads = 1")
    db.execute(f"CREATE TABLE events AS SELECT * FROM ({EVENTS}) ORDER BY event_id")
    db.execute("CREATE TABLE customer AS SELECT range AS c_custkey, 'A' AS c_mktsegment, 0 AS c_nationkey, 1.0 AS c_acctbal FROM range(40)")
    db.execute("CREATE TABLE nation AS SELECT 0 AS n_nationkey, 'X' AS n_name")
    for t in ("customer", "nation"):
        db.execute(f"COPY {t} TO '{folder}/{t}.parquet'")
    (folder / "events.parquet").mkdir()
    for i in range(3):
        db.execute(f"COPY (SELECT * FROM events WHERE event_id % 3 = {i} ORDER BY event_id DESC) TO '{folder}/events.parquet/{i}.parquet'")
    return str(folder), db


@pytest.mark.parametrize("name", ["holdings_latest_wide", "leaderboard", "leaderboard_as_of", "velocity", "explainer_lines"])
def test_layout(spark, tables, name):
    folder, db = tables
    got = QUERIES[name](spark, folder)
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert want and sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
