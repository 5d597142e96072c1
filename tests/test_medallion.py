"""Golden rows of the order pipeline, worked out by hand."""

from decimal import Decimal

import pytest

from tarn.operators.quality import Rule, expect, expectation_metrics
from tarn.plans import medallion as med
from tarn.sources.tables import inline

CUSTOMERS = ("customer_id string, customer_name string, tier string, region string, contract_type string, "
             "payment_terms_days string, is_active string")
ORDERS = ("order_id string, order_date string, customer_id string, quantity_units string, unit_price string, "
          "freight_cost_per_unit string, product_id string, plant_id string, requested_delivery_date string, status string")


@pytest.fixture
def customers(spark):
    return inline(spark, [
        ("K1", "Alder Co", "Gold", "North", "Annual", "30", "TRUE"), ("K1", "Alder Co B", "Gold", "North", "Annual", "30", "true"),
        ("K2", "Birch", "Silver", "South", "Monthly", "abc", "yes"), ("K3", "Cedar", "Bronze", "South", "Monthly", "400", "1"),
        ("K4", "Dogwood", "Gold", "North", "Annual", "15", "false"), ("K5", "Fir", "Silver", None, "Annual", "10", None),
        (None, "Elm", "Gold", "North", "Annual", "15", "t")], CUSTOMERS)


@pytest.fixture
def orders(spark):
    rows = [("R1", "2024-01-05", "K1", "100", "105.00", "0.010"), ("R2", "2024-02-30", "K1", "3", "333.33", "0.005"),
            ("R3", "2024-03-01", "K2", "10", "1500.00", "0.020"), ("R4", "2024-03-01", "K2", "0", "100.00", "0.010"),
            ("R5", "2024-03-01", "K1", "x", "100.00", "0.010"), (None, "2024-03-01", "K1", "5", "100.00", "0.010"),
            ("R6", "2024-03-01", None, "5", "100.00", "0.010"), ("R7", "2024-03-02", "K9", "7", "200.00", "0.010"),
            ("R8", "2024-04-01", "K4", "2", "100.00", "0.010")]
    return inline(spark, [(*r, "P", "S", "2024-05-01", "open") for r in rows], ORDERS)


def test_silver(customers, orders):
    silver = {r["customer_id"]: r for r in med.silver_customers(customers).collect()}
    assert set(silver) == {"K1", "K2", "K3"}
    assert silver["K1"]["customer_name"] == "Alder Co" and silver["K2"]["payment_terms_days"] is None
    rows = {r["order_id"]: r for r in med.silver_orders(orders).collect()}
    assert set(rows) == {"R1", "R2", "R3", "R7", "R8"} and rows["R2"]["order_date"] is None


def test_violation_counts(customers, orders):
    got = {r["rule"]: r["violations"] for r in expectation_metrics(med.typed_customers(customers), med.CUSTOMER_RULES).collect()}
    assert got == {"valid_customer_id": 1, "valid_payment_terms": 2}
    got = {r["rule"]: r["violations"] for r in expectation_metrics(med.typed_orders(orders), med.ORDER_RULES).collect()}
    assert got["has_order_id"] == 1 and got["has_customer_id"] == 1 and got["has_positive_qty"] == 2
    kept = expectation_metrics(med.silver_orders(orders), med.ORDER_RULES).collect()
    assert {r["rule"]: r["violations"] for r in kept}["plausible_price"] == 1


def test_gold(customers, orders):
    gold = med.gold_customer_summary(med.silver_customers(customers), med.silver_orders(orders))
    by_id = {r["customer_id"]: r for r in gold.collect()}
    k1 = by_id["K1"]
    assert (k1["order_count"], k1["total_units_sold"], k1["lifetime_revenue"], k1["lifetime_freight_cost"]) == (
        2, 103, Decimal("11.50"), Decimal("1.02"))
    assert k1["avg_order_revenue"] == Decimal("5.75") and str(k1["first_order_date"]) == str(k1["last_order_date"]) == "2024-01-05"
    assert by_id["K3"]["order_count"] == 0 and by_id["K3"]["lifetime_revenue"] is None
    region = {r["region"]: r for r in med.gold_region_summary(gold).collect()}
    assert (region["South"]["active_customers"], region["South"]["total_orders"], region["South"]["revenue_per_customer"]) == (
        2, 1, Decimal("7.50"))
    assert region["North"]["total_revenue"] == Decimal("11.50")


def test_fail_stops_the_run(orders):
    with pytest.raises(Exception, match="expectation no_null violated"):
        expect(orders, [Rule("no_null", "order_id IS NOT NULL", "fail")]).collect()


def test_violations_of_each_batch_are_kept(spark, tmp_path):
    from tarn.operators.quality import Rule, load_checked, with_warnings
    from tarn.plans import medallion as med
    from tarn.sources import tables as tb
    from tarn.streaming import ingest

    schema = ", ".join(f"{c} string" for c in ("order_id", "order_date", "customer_id", "product_id", "plant_id", "quantity_units", "unit_price",
                                               "freight_cost_per_unit", "requested_delivery_date", "status"))

    def orders(*rows):
        return spark.createDataFrame([(i, "2024-01-01", c, "p", "q", n, price, "1", "2024-01-02", "x") for i, c, n, price in rows], schema)

    source, out, ck, log = (str(tmp_path / x) for x in ("in", "out", "ck", "log"))
    batches = [orders(("1", "c", "5", "2000"), (None, "c", "5", "10")), orders(("2", None, "0", "10"), ("3", "c", "1", "10")), None]
    for b in batches:
        if b is not None:
            tb.write_table(b, source, "append")
        ingest.silver_orders_stream(spark, source, b.schema if b is not None else batches[0].schema, out, ck, log)
    got = {(r["batch_id"], r["rule"]): r["violations"] for r in spark.read.parquet(log).collect()}
    names = [r.name for r in med.ORDER_RULES]
    assert got == {(0, n): v for n, v in zip(names, (1, 0, 0, 1))} | {(1, n): v for n, v in zip(names, (0, 1, 1, 0))}
    assert sorted(r["order_id"] for r in spark.read.parquet(out).collect()) == ["1", "3"]

    rules = [Rule("small", "v < 3", "warn"), Rule("known", "v IS NOT NULL", "drop"), Rule("even", "v % 2 = 0", "warn")]
    df = spark.createDataFrame([(1,), (4,), (5,), (None,)], "v int")
    load_checked(df, rules, str(tmp_path / "t"), str(tmp_path / "counts"))
    assert {r["rule"]: r["violations"] for r in spark.read.parquet(str(tmp_path / "counts")).collect()} == {"small": 3, "known": 1, "even": 3}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert {r["v"]: r["warnings"] for r in with_warnings(df, rules).collect()} == {1: ["even"], 4: ["small"], 5: ["small", "even"], None: ["small", "even"]}
