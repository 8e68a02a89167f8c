"""Every registered query against its SQL twin, and the known numbers."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract
from compare import compare, connect
from fareloom.plans import registry

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
# The text queries that SQL cannot express are tested in their own folder.
TEXT = {name for name in QUERIES if name.startswith("op") and name[2].isdigit()} | {"pipeline"}


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(ORACLES) <= TEXT
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES.keys() - TEXT))
def test_matches_sql(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db, ORACLES[name]) == []


def test_entry(spark):
    row = contract.entry(spark).first()
    assert row["analysis"] == "QUESTION 1 - MAIN ANSWER"
    assert row["total_trips"] > 0


def test_layer_sizes(spark, sf_dir):
    assert registry.trips(spark, sf_dir).count() == 10_000
    assert registry.bronze(spark, sf_dir).count() == 7_534
    assert registry.silver(spark, sf_dir).count() == 6_665
    assert registry.gold(spark, sf_dir).count() == 1_655


def test_first_question(spark, sf_dir):
    row = QUERIES["q1_main"](spark, sf_dir).first()
    assert (row["avg_total_amount"], row["total_trips"]) == (57.57, 4026)
    assert row["total_revenue"] == pytest.approx(231_762.32)


def test_second_question(spark, sf_dir):
    rows = {r["pickup_hour"]: r for r in QUERIES["q2_main"](spark, sf_dir).collect()}
    assert len(rows) == 24
    assert (rows[0]["avg_passengers"], rows[0]["total_trips"]) == (5.10, 52)
    assert (rows[23]["avg_passengers"], rows[23]["total_trips"]) == (4.77, 52)


def test_both_monthly_means(spark, sf_dir):
    rows = QUERIES["q1_monthly"](spark, sf_dir).collect()
    means = [(r["mean_of_cells"], r["weighted_mean"], r["total_trips"]) for r in rows]
    assert means == [
        (57.47, 56.39, 816),
        (56.95, 57.41, 763),
        (56.75, 57.82, 830),
        (63.25, 62.78, 833),
        (52.86, 53.15, 784),
    ]


def test_top_hours_are_ordered(spark, sf_dir):
    rows = QUERIES["top5_hours"](spark, sf_dir).collect()
    assert [(r["pickup_hour"], r["total_trips"]) for r in rows] == [
        (19, 314),
        (4, 306),
        (13, 299),
        (6, 298),
        (15, 293),
    ]
