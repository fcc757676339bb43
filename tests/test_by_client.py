import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import by_client
from lakestrata.plans.question import top_states

D = dt.date


@pytest.fixture(scope="module")
def shopping(spark, tmp_path_factory):
    """Sales of which one client has a third, and users of whom some lack a state or a birth date."""
    from lakestrata.layout import Layout

    rng = random.Random(3)
    sales = [
        (rng.choice(["TV", "Phone"]), 1 if rng.random() < 0.33 else rng.randrange(60), D(2021 + n % 2, 1 + n % 12, 1 + n % 28))
        for n in range(3000)
    ] + [("TV", None, D(2021, 1, 1))]
    users = [(n, rng.choice(["Ohio", "Utah", None]), rng.choice([D(1990 + n % 15, 5, 5), None])) for n in range(50)]
    sales = spark.createDataFrame(sales, "product_name STRING, client_id INT, purchase_date DATE")
    users = spark.createDataFrame(users, "client_id INT, state STRING, birth_date DATE")
    lake = Layout(str(tmp_path_factory.mktemp("by_client")))
    by_client.load_by_client(spark, lake, sales, users, "gold_clients", buckets=4)
    return sales, users, lake


@pytest.mark.parametrize("ages,window", [
    (None, {}), ((20, 30), {}), ((20, 30), {"first": D(2021, 3, 1), "last": D(2022, 2, 28)}), ((18, 25), {"month": 9, "days": (1, 10)}),
])
def test_answers_are_those_of_the_plain_tables(spark, shopping, ages, window):
    sales, users, _ = shopping
    wanted = top_states(sales, users, "TV", ages, 5, **window).collect()
    assert by_client.top_states_by_client(spark, "gold_clients", "TV", ages, 5, **window).collect() == wanted
    assert wanted


def test_neither_count_nor_join_shuffles_the_sales(spark, shopping):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        answer = by_client.top_states_by_client(spark, "gold_clients", "TV", (20, 30))
        plan = answer._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "Join" in plan and "hashpartitioning(client_id" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(state" in plan


def test_a_hot_client_is_few_rows(spark, shopping):
    sales, _, lake = shopping
    counts = spark.table("gold_clients.sales_counts")
    assert counts.where("client_id = 1").count() <= 2 * 336
    assert counts.agg(F.sum("purchases")).first()[0] == sales.count()
    by_client.load_by_client(spark, lake, sales.limit(0), sales.limit(0).selectExpr("client_id", "'x' AS state", "purchase_date AS birth_date"), "gold_clients_none", 2)
    assert by_client.top_states_by_client(spark, "gold_clients_none", "TV").collect() == []
