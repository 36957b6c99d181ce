"""A fit learns from the whole train side, however large the table."""

import pytest
from pyspark.sql import functions as F

from txrisk.functions.draws import congruential_draw
from txrisk.operators import model as classifier
from txrisk.plans import queries, train
from txrisk.sources import orders as source

ORDERS = 600


@pytest.fixture
def orders(spark, folder):
    key = F.col("id")
    spark.range(ORDERS).select(
        key.alias("o_orderkey"), (key % 97).alias("o_custkey"), (1000 + key * 7919 % 400000).cast("double").alias("o_totalprice"),
        F.timestamp_seconds(1704067200 + key * 3600).alias("o_orderdate"),
    ).write.parquet(folder + "/orders.parquet")
    return folder


@pytest.fixture
def train_side(spark):
    draw = congruential_draw(F.col("id"), *source.SPLIT_DRAW)
    return sorted(f"txn{r.id}" for r in spark.range(ORDERS).filter(draw < 0.8).collect())


@pytest.fixture
def learned(spark, monkeypatch):
    """The ids that each fit is given. Fits take one round, and every table is said to hold 12.5 million rows."""
    fits, fit = [], classifier.fit

    def one_round(rows, indexers, *_, **params):
        fits.append(sorted(r.transactionId for r in rows.select("transactionId").collect()))
        return fit(rows, indexers, 1, **params)

    monkeypatch.setattr(classifier, "fit", one_round)
    monkeypatch.setattr(type(spark.range(0)), "count", lambda rows: 12_500_000)
    monkeypatch.setattr(queries, "_FITS", {})
    return fits


def test_layout_is_checked_on_two_whole_fits(spark, orders, train_side, learned):
    row = queries.gbt_layout(spark, orders).first()
    assert learned == [train_side, train_side]
    assert (row.test_rows, row.changed) == (ORDERS - len(train_side), 0)


def test_reloaded_model_is_of_the_whole_fit(spark, orders, train_side, learned):
    rows = queries.gbt_reload_checks(spark, orders).collect()
    assert learned == [train_side]
    assert len(rows) == ORDERS - len(train_side) and all(r.same for r in rows)


def test_saved_model_scores_by_the_whole_fit(spark, orders, train_side, learned):
    rows = queries.model_save_load_score(spark, orders).collect()
    assert learned == [train_side]
    assert not {r.transactionId for r in rows} & set(train_side) and len(rows) == ORDERS - len(train_side)


def test_stream_scores_by_the_whole_fit(spark, orders, train_side, learned):
    rows = queries.stream_gbt_score(spark, orders).collect()
    assert learned == [train_side]
    assert len({r.transactionId for r in rows}) == len(rows) == ORDERS


def test_parts_of_a_fit_grow_slower_than_a_large_table():
    assert [train.part_count(n) for n in (0, 1, 800_001, 7_200_000, 10_000_000)] == [8, 8, 9, 72, 100]
    assert [train.part_count(n) for n in (40_000_000, 1_000_000_000)] == [200, 1000]
