"""Semantic layer: composed measures, join pruning, pre-aggregation, contracts, gate."""

import random

import pytest

from tidemark.operators.semantic import (
    Dimension, Join, Measure, MetricView, MetricViewError, count, count_if, distinct,
    mean, ratio, total,
)
from tidemark.plans.gates import metrics_gate
from tidemark.plans.metrics import METRIC_VIEWS

VIEW = MetricView(
    name="v", source="fact",
    joins=(Join("item", "item_id", "id"), Join("shop", "shop_id", "id"),
           Join("city", "city_id", "id", after="shop", bounded=True)),
    dimensions=(Dimension("Day", "day"), Dimension("Brand", "brand", "item"),
                Dimension("Shop", "name", "shop"), Dimension("City", "upper(name)", "city")),
    measures=(count("Rows"), distinct("Orders", "order_id"), total("Amount", "amount"),
              total("Cost", "cost"), mean("Mean Amount", "amount"), count_if("Big", "amount > 50"),
              Measure("Largest", "max", "amount"), ratio("Cost Share", "Cost", "Amount"),
              ratio("Rows Per Order", "Rows", "Orders")))


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    fact = [(rng.randrange(3), rng.randrange(40), 0 if rng.random() < .34 else rng.randrange(12),
             rng.randrange(9), rng.choice([None, rng.randrange(100)]), rng.randrange(30))
            for _ in range(600)]
    return {
        "fact": fact,
        "item": [(i, f"b{i % 3}") for i in range(11)],  # item 11 is unknown
        "shop": [(i, f"s{i}", i % 2) for i in range(9)],
        "city": [(0, "rom"), (1, "oslo")],
    }


@pytest.fixture(scope="module")
def tables(spark, data):
    return {
        "fact": spark.createDataFrame(
            data["fact"], "day int, order_id int, item_id int, shop_id int, amount int, cost int"),
        "item": spark.createDataFrame(data["item"], "id int, brand string"),
        "shop": spark.createDataFrame(data["shop"], "id int, name string, city_id int"),
        "city": spark.createDataFrame(data["city"], "id int, name string"),
    }


def brute(data, dims, keep=lambda d: True):
    brand, shop = dict(data["item"]), {i: (n, c) for i, n, c in data["shop"]}
    city = dict(data["city"])
    groups = {}
    for day, order, item, shop_id, amount, cost in data["fact"]:
        values = {"Day": day, "Brand": brand.get(item), "Shop": shop[shop_id][0],
                  "City": city[shop[shop_id][1]].upper()}
        if keep(values):
            groups.setdefault(tuple(values[d] for d in dims), []).append((order, amount, cost))
    out = {}
    for key, rows in groups.items():
        amounts = [a for _, a, _ in rows if a is not None]
        amount = sum(amounts) if amounts else None
        cost = sum(c for _, _, c in rows)
        orders = len({o for o, _, _ in rows})
        out[key] = (len(rows), orders, amount, cost,
                    round(amount / len(amounts), 9) if amounts else None,
                    sum(a > 50 for a in amounts), max(amounts, default=None),
                    round(cost / amount, 9) if amount else None, round(len(rows) / orders, 9))
    return out


MEASURES = ["Rows", "Orders", "Amount", "Cost", "Mean Amount", "Big", "Largest", "Cost Share",
            "Rows Per Order"]


@pytest.mark.parametrize("dims", [[], ["Day"], ["Brand"], ["City"], ["Shop", "Brand"],
                                  ["Day", "Brand", "Shop", "City"]])
def test_query_matches_brute_force(tables, data, dims):
    rows = VIEW.query(tables, dims, MEASURES).collect()
    got = {tuple(r)[:len(dims)]: tuple(round(v, 9) if isinstance(v, float) else v
                                       for v in tuple(r)[len(dims):]) for r in rows}
    assert got == brute(data, dims)


def test_filters_on_shown_and_hidden_dimensions(tables, data):
    rows = VIEW.query(tables, ["Day"], ["Rows"], {"City": "ROM", "Day": [0, 2]}).collect()
    want = brute(data, ["Day"], lambda d: d["City"] == "ROM" and d["Day"] in (0, 2))
    assert {(r[0],): r[1] for r in rows} == {k: v[0] for k, v in want.items()}


def test_order_and_limit(tables, data):
    rows = VIEW.query(tables, ["Brand"], ["Amount"], order_by=[("Amount", "desc")], limit=1).collect()
    assert rows[0][1] == max(v[2] for v in brute(data, ["Brand"]).values())


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_needed_joins_are_planned(tables):
    assert plan(VIEW.query(tables, ["Day"], ["Amount"])).count("Join") == 0
    assert plan(VIEW.query(tables, ["Brand"], ["Amount"])).count("Join") == 1
    assert plan(VIEW.query(tables, ["City"], ["Amount"])).count("Join") == 2


def test_rows_are_aggregated_before_an_unbounded_join(tables):
    text = plan(VIEW.query(tables, ["Brand"], ["Amount"]))
    assert text.index("Join") < text.rindex("Aggregate")


def test_composed_measure_is_null_on_zero_denominator(spark):
    tables = {"fact": spark.createDataFrame([(0, 1, 0, 0, 0, 5)], "day int, order_id int, "
                                            "item_id int, shop_id int, amount int, cost int")}
    assert VIEW.query(tables, [], ["Cost Share"]).first()[0] is None


def test_ratio_is_not_the_mean_of_ratios(spark):
    tables = {"fact": spark.createDataFrame(
        [(0, 1, 0, 0, 10, 1), (0, 2, 0, 0, 90, 45)],
        "day int, order_id int, item_id int, shop_id int, amount int, cost int")}
    assert VIEW.query(tables, [], ["Cost Share"]).first()[0] == pytest.approx(0.46)


def test_names_are_checked():
    with pytest.raises(MetricViewError, match="no dimension"):
        VIEW.query({}, ["Nope"], ["Rows"])
    with pytest.raises(MetricViewError, match="no measure"):
        VIEW.query({}, ["Day"], ["Nope"])
    with pytest.raises(MetricViewError, match="twice"):
        MetricView("x", "t", (Dimension("A", "a"),), (count("A"),))
    with pytest.raises(MetricViewError, match="unknown join"):
        MetricView("x", "t", (Dimension("A", "a", "b"),), ())
    with pytest.raises(MetricViewError, match="uses"):
        MetricView("x", "t", (), (ratio("R", "P", "Q"),))
    with pytest.raises(MetricViewError, match="not declared before"):
        MetricView("x", "t", (), (), (Join("b", "k", "k", after="a"),))


def test_joined_table_counts_as_declared_source():
    assert VIEW.contract_errors("shop", ["Shop"], ["Amount"]) == []
    assert VIEW.contract_errors("other", ["Nope"], ["None"]) == [
        "source other is not declared", "dimension Nope is missing", "measure None is missing"]


def failing(gate):
    rows = [r.stage for r in gate.collect() if r.verdict == "fail"]
    return rows[0] if rows else None


def test_metrics_gate(spark, tables):
    ok = dict(source="fact", dimensions=["Day"], measures=["Rows"])
    assert failing(metrics_gate(spark, VIEW, tables, **ok)) is None
    assert failing(metrics_gate(spark, None, tables, **ok)) == "describe"
    assert failing(metrics_gate(spark, VIEW, {}, **ok)) == "describe"
    assert failing(metrics_gate(spark, VIEW, tables, "fact", ["Nope"], [])) == "definition"
    assert failing(metrics_gate(spark, VIEW, tables, "nope", ["Day"], [])) == "source"
    empty = {**tables, "fact": tables["fact"].where("false")}
    assert failing(metrics_gate(spark, VIEW, empty, **ok)) == "sanity"


def test_shipped_views_are_well_formed():
    assert len(METRIC_VIEWS) == 7
    assert all(v.dimensions and v.measures for v in METRIC_VIEWS.values())
