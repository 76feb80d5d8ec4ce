"""Basket counting and exact medians against brute force, on skewed data."""

import random
import statistics
from collections import Counter
from itertools import combinations

import pytest

from shelfline.functions.quantiles import exact_medians
from shelfline.operators import baskets
from shelfline.operators.baskets import top_pairs


def _brute_force_pairs(orders, n):
    count, first = Counter(), {}
    for order in sorted(orders):
        for pair in combinations(sorted(set(orders[order])), 2):
            count[pair] += 1
            first.setdefault(pair, order)
    ranked = sorted(count, key=lambda p: (-count[p], first[p], p))[:n]
    return [(a, b, count[a, b], first[a, b]) for a, b in ranked]


def _skewed_orders(seed):
    """Small orders over a few favourites, and one order with a third of all lines."""
    rng = random.Random(seed)
    items = [f"p{i:03d}" for i in range(120)]
    orders = {f"o{k:04d}": [items[min(int(rng.expovariate(0.08)), 119)]
                            for _ in range(rng.randint(1, 5))] for k in range(300)}
    total = sum(map(len, orders.values()))
    orders["o0150"] = [rng.choice(items) for _ in range(total // 2)]
    return orders


@pytest.mark.parametrize("seed, n, frequent, largest, block", [
    (1, 20, 128, 32, 256),
    (2, 20, 5, 1, 7), (3, 300, 20, 3, 16),
    (4, 5, 2, 32, 2),           # most orders are several blocks
    (5, 20_000, 50, 32, 50),    # more pairs asked for than there are: no bound
    (6, 20, 128, 0, 10),        # every order makes its pairs
    (7, 50, 1, 40, 40),
])
def test_top_pairs(spark, seed, n, frequent, largest, block):
    orders = _skewed_orders(seed)
    lines = spark.createDataFrame(
        [(o, p) for o, ps in orders.items() for p in ps], "order_id string, product_id string")
    got = top_pairs(lines, "order_id", "product_id", n, frequent, largest, block)
    assert [tuple(r) for r in got.collect()] == _brute_force_pairs(orders, n)


@pytest.mark.parametrize("n", [5, 40])
def test_top_pairs_of_many_large_orders_with_low_counts(spark, n):
    rng = random.Random(n)
    orders = {f"o{i:02}": rng.sample([f"p{j:04}" for j in range(900)], 60) for i in range(25)}
    lines = spark.createDataFrame(
        [(o, p) for o, ps in orders.items() for p in ps], "order_id string, product_id string")
    got = top_pairs(lines, "order_id", "product_id", n, block_items=8)
    assert [tuple(r) for r in got.collect()] == _brute_force_pairs(orders, n)


def test_rare_items_and_the_largest_order_make_no_pairs(spark, monkeypatch):
    """Of an order with all items, and items in one other order only, no pair is made."""
    orders = {f"o{i:02}": ["a", "b", "c", f"x{i}"] for i in range(40)}
    orders["huge"] = [f"x{i}" for i in range(40)] + [f"y{i}" for i in range(3000)] + ["a", "b"]
    lines = spark.createDataFrame(
        [(o, p) for o, ps in orders.items() for p in ps], "order_id string, product_id string")
    made, pairs_by_block = [], baskets._pairs_by_block
    monkeypatch.setattr(baskets, "_pairs_by_block", lambda entries, *rest: made.append(
        entries) or pairs_by_block(entries, *rest))
    got = top_pairs(lines, "order_id", "product_id", 3)
    assert [tuple(r) for r in got.collect()] == _brute_force_pairs(orders, 3)
    # Bound 40: three items are left.
    assert {r.item for r in made[0].collect()} == {"a", "b", "c"}
    assert made[0].where("order = 'huge'").count() == 0


def test_no_pairs(spark):
    lines = spark.createDataFrame(
        [("a", "x"), ("a", "x"), ("b", "y"), (None, "x"), (None, "y")],
        "order_id string, product_id string")
    assert top_pairs(lines, "order_id", "product_id", 5).collect() == []


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 40 + [1.0, 9.0, 10.0],
    [0.0, 0.0, 0.0, 7.5, 7.5, 7.5],
    [random.Random(9).randint(0, 500) / 4 for _ in range(12_000)],
    [random.Random(8).random() for _ in range(30_001)],
    [1.0] * 10_000 + [random.Random(7).random() * 3 for _ in range(20_000)],
    # All but a few of the middle values in one stretch of the bracket.
    [random.Random(6).random() ** 40 for _ in range(20_000)] + [1e9] * 20_000,
    [-1e300, 1e300] * 3, [1.0] * 3 + [2.0] * 3,
])
def test_exact_medians(spark, values):
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "x double, y double") \
        .repartition(6)
    row = spark.range(1).select(exact_medians(df, ["x", "y"]).alias("m")).first().m
    assert (row.x, row.y) == (statistics.median(values), -statistics.median(values))
