"""Every registered query with an oracle equals it; the inventory is covered."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from kandela.plans.catalog import ORACLES, QUERIES
from kandela.plans.compare import compare

needs_data = pytest.mark.skipif(not Path(SMOKE_DIR).exists(), reason="test tables are not here")

# Number of inventory rows per group.
INVENTORY = {"s": 11, "k": 10, "g": 4, "p": 23, "j": 4, "u": 1, "w": 15, "a": 14, "o": 7, "t": 6, "m": 14, "n": 6}


def test_inventory_is_covered():
    have = {name.split("_")[0] for name in queries()}
    assert {f"{g}{i}" for g, n in INVENTORY.items() for i in range(1, n + 1)} <= have
    assert set(oracle_sql()) <= set(queries())
    assert set(ORACLES) == set(QUERIES)


# On the smallest tables no series is long enough for these; they run on two event types of the next larger ones.
HISTORY_DIR = "/root/testdata/sf0.01"
LONG_HISTORY = {"a8_enough_history", "k9_model_sink", "k10_run_log", "m3_logistic_regression", "m3_optimum", "m4_random_forest",
                "m5_boosted_trees_a", "m6_boosted_trees_b", "m7_random_search", "m8_per_symbol_training", "m9_score",
                "m10_backtest_export"}


def views(folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def check(spark, connection, folder, name):
    """Equal to the oracle, which must have rows: two empty results would prove nothing."""
    want = connection.execute(ORACLES[name]).df()
    assert len(want)
    assert compare(QUERIES[name](spark, folder).toPandas(), want) is None


@pytest.fixture(scope="module")
def db():
    return views(SMOKE_DIR)


@pytest.fixture(scope="module")
def history(tmp_path_factory):
    folder = tmp_path_factory.mktemp("history")
    views(HISTORY_DIR).execute(
        f"COPY (SELECT * FROM events WHERE event_type IN ('view', 'click')) TO '{folder}/events.parquet' (FORMAT parquet)")
    return str(folder), views(folder)


@needs_data
@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG_HISTORY))
def test_query_equals_oracle(spark, db, name):
    check(spark, db, SMOKE_DIR, name)


@pytest.mark.skipif(not Path(HISTORY_DIR).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(LONG_HISTORY))
def test_query_equals_oracle_with_enough_history(spark, history, name):
    folder, connection = history
    check(spark, connection, folder, name)


@needs_data
def test_entry(spark):
    assert entry(spark).count() == 10
