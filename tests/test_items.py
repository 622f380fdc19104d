import os

import duckdb
import pytest
from pyspark.sql import functions as F

from strataframe import queries as q
from tests.oracle import TABLES, compare

SF = "/root/testdata/sf0.1"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def test_every_item_of_the_log_has_a_status(spark):
    log = q.read(spark, SF, "events").groupBy((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("key")).agg(F.count("*").alias("n"))
    got = q.q01_item_status(spark, SF)
    assert log.join(got.where("status <> 'new'"), (log.key == got.key) & (log.n == got.latest), "left_anti").count() == 0
    rows = got.count()
    assert rows == got.select("key").distinct().count() == 30 * 1500


def test_every_item_has_a_route(spark):
    got = {r.route: r.n for r in q.q04_route_work(spark, SF).collect()}
    assert sum(got.values()) == 30 * 1500 and got["never"] == 0


@pytest.mark.parametrize("name", ["q01_item_status", "q04_route_work"])
def test_items_equal_the_sql_over_all_users(spark, name):
    every = q.ORACLES[name].replace("range(150) t(u)", "(SELECT range FROM range(150) UNION SELECT user_id FROM events) t(u)")
    assert every != q.ORACLES[name]
    assert compare(spark, q.QUERIES[name](spark, SF), every, SF) > 0


NULLS = {"event_type": "event_id % 3 = 0", "value": "event_id % 3 = 1", "event_id": "event_id % 2 = 0"}


@pytest.mark.parametrize("column", sorted(NULLS))
@pytest.mark.parametrize("name", ["q01_item_status", "q04_route_work"])
def test_items_with_nulls_in_the_log_equal_the_sql(spark, tmp_path, name, column):
    """Users 0 to 9, whom the SQL has as it is; each time of a key has two events, of which one at most has no id."""
    for t in set(TABLES) - {"events"}:
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    rows = """SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_days(CAST(i // 20 % 30 AS INTEGER)) + to_minutes(i // 600) AS ts, i // 2 % 10 AS user_id,
      ['error', 'view', 'click', 'view'][1 + i * 7919 // 11 % 4] AS event_type, [0.0, 5, 19, 20, 50][1 + i * 104729 // 13 % 5] AS value, '' AS props FROM range(6000) t(i)"""
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN NOT {NULLS[column]} THEN {column} END AS {column}) FROM ({rows})) TO '{tmp_path}/events.parquet'")
    assert compare(spark, q.QUERIES[name](spark, str(tmp_path)), q.ORACLES[name], str(tmp_path)) > 0


def test_routes_of_users_of_long_ids_equal_the_sql_over_all_users(spark, tmp_path):
    """Their keys are beyond 2**53, so that a double does not hold them; negative ones too."""
    for t in set(TABLES) - {"events"}:
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    rows = f"SELECT * REPLACE ((user_id % 40 - 20) * 1000000000000000 + user_id AS user_id) FROM '{SF}/events.parquet'"
    duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/events.parquet'")
    every = q.ORACLES["q04_route_work"].replace("range(150) t(u)", "(SELECT range FROM range(150) UNION SELECT user_id FROM events) t(u)")
    assert every != q.ORACLES["q04_route_work"]
    assert compare(spark, q.q04_route_work(spark, str(tmp_path)), every, str(tmp_path)) == 6


def test_routes_of_the_users_of_the_sql_equal_it_as_it_is(spark, monkeypatch):
    monkeypatch.setattr(q, "_users", lambda spark, sf_dir: q._fixed_users(spark))
    assert compare(spark, q.q04_route_work(spark, SF), q.ORACLES["q04_route_work"], SF) == 6
