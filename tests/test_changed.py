import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import put
from lakestrata import commits, layout, sources
from lakestrata.plans import changed, run_all, sales
from lakestrata.sources import deliveries

D = dt.date
FIRST, LAST = D(2022, 9, 1), D(2022, 9, 10)
HEAD = "CustomerId,PurchaseDate,Product,Price\n"
AS_OF = "2022-09-10"
counter = iter(range(1000))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def run(spark, shop):
    number = next(counter)

    def go(first=FIRST, last=LAST):
        as_of = F.lit(AS_OF).cast("date")
        return changed.run_changed(spark, shop, first, last, as_of, f"silver_c{number}", f"gold_c{number}")

    go.gold = f"gold_c{number}"
    return go


def files(root):
    """Every file of the lake but the delivered ones, with its time."""
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(root) if f"{root}/raw" not in d for f in names
    }


def tables(spark, lake, gold):
    return (
        rows(sales.read_bronze(spark, lake)),
        rows(sources.read_parquet(spark, lake.silver("sales"))),
        rows(sources.read_parquet(spark, lake.silver("customers"))),
        rows(sources.read_parquet(spark, lake.silver("user_profiles"))),
        rows(sources.read_table(spark, gold, "user_profiles_enriched")),
        rows(sources.read_table(spark, gold, "sales")),
    )


def same_as_a_whole_run(spark, lake, gold):
    """A lake built at once from what was delivered."""
    whole = layout.Layout(f"{lake.root}/whole{next(counter)}", lake.root)
    name = f"g{next(counter)}_whole"
    run_all.run_all(spark, whole, "TV", FIRST, LAST, as_of=F.lit(AS_OF).cast("date"), silver=f"s_{name}", gold_db=name)
    assert tables(spark, lake, gold) == tables(spark, whole, name)


def test_a_second_run_writes_nothing(spark, shop, run):
    first = run()
    assert first.sales_days is None and first.customers and first.profiles and first.gold_profiles and first.gold_sales
    same_as_a_whole_run(spark, shop, run.gold)
    before = files(shop.root)
    assert run() == changed.Done()
    assert files(shop.root) == before


def test_a_late_file_rebuilds_one_day(spark, shop, run):
    run()
    before = files(shop.root)
    bronze = commits.latest(spark, shop.bronze("sales")).files(spark).select("file").distinct().collect()
    put(shop.raw("sales/2022-09-4/late.csv"), HEAD + "3,2022-09-2,TV,$1\n3,not a day,TV,$1\n")
    done = run()
    assert done.sales_days == {D(2022, 9, 2)} and done.gold_sales
    assert not (done.customers or done.profiles or done.gold_profiles)
    after = files(shop.root)
    silver = {p for p in {*before, *after} if "/silver/sales/purchase_date" in p and before.get(p) != after.get(p)}
    assert silver and all("purchase_date=2022-09-02" in p for p in silver)
    # Bronze and the other gold days stay as they were.
    kept = [p for p in before if os.path.basename(p) in {r["file"] for r in bronze}]
    assert kept and all(after.get(p) == before[p] for p in kept)
    assert all(after.get(p) == t for p, t in before.items() if "/user_profiles" in p or "/customers" in p)
    assert all(after.get(p) == t for p, t in before.items() if "/warehouse/" in p and "purchase_date=2022-09-01" in p)
    same_as_a_whole_run(spark, shop, run.gold)


def test_replaced_and_removed_files(spark, shop, run):
    put(shop.raw("sales/2022-09-5/a.csv"), HEAD + "".join(f"{n},2022-09-{n % 5 + 4},TV,$7\n" for n in range(50)))
    run()
    put(shop.raw("sales/2022-09-2/s.csv"), HEAD + "2,2022-09-8,TV,$5\n")
    done = run()
    assert done.sales_days == {D(2022, 9, 2), D(2022, 9, 8)}
    same_as_a_whole_run(spark, shop, run.gold)
    os.remove(shop.raw("sales/2022-09-5/a.csv"))
    assert run().sales_days == {D(2022, 9, n) for n in range(4, 9)}
    same_as_a_whole_run(spark, shop, run.gold)
    assert rows(sources.read_parquet(spark, shop.bronze("sales")).drop("run")) == rows(sales.read_bronze(spark, shop))
    assert run() == changed.Done()


def test_new_and_replaced_dumps(spark, shop, run):
    run()
    put(shop.raw("customers/2022-8-20/c.csv"), "Id,F,L,E,R,S\n1,Ann,Lee,anna.lee@example.com,2021-05-1,Ohio\n")
    done = run()
    assert done.customers and done.gold_profiles and not done.profiles and done.sales_days == set() and not done.gold_sales
    assert "Ann" in {r["first_name"] for r in sources.read_table(spark, run.gold, "user_profiles_enriched").collect()}
    os.remove(shop.raw("customers/2022-8-20/c.csv"))
    put(shop.raw("user_profiles/q.json"), '{"email":"new@x.y","full_name":"New One"}\n')
    done = run()
    assert done.customers and done.profiles and done.gold_profiles
    same_as_a_whole_run(spark, shop, run.gold)


@pytest.mark.parametrize("module,name", [("changed", "remember"), ("sales", "replay_days"), ("gold", "reload_gold_days"), ("gold", "load_gold_profiles")])
def test_a_run_that_died_is_made_up_for(spark, shop, run, monkeypatch, module, name):
    run()
    put(shop.raw("sales/2022-09-2/s.csv"), HEAD + "2,2022-09-3,TV,$5\n")
    put(shop.raw("user_profiles/q.json"), '{"email":"new@x.y","full_name":"New One"}\n')
    with monkeypatch.context() as broken:
        broken.setattr(getattr(changed, module, changed), name, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    run()
    same_as_a_whole_run(spark, shop, run.gold)
    assert run() == changed.Done()


def test_another_range_and_too_many_changes(spark, shop, run, monkeypatch):
    run()
    done = run(FIRST, D(2022, 9, 1))
    assert done.gold_sales and sources.read_table(spark, run.gold, "sales").count() == 3
    monkeypatch.setattr(deliveries, "MOST_CHANGED", 1)
    put(shop.raw("sales/2022-09-6/a.csv"), HEAD + "2,2022-09-6,TV,$5\n")
    put(shop.raw("sales/2022-09-6/b.csv"), HEAD + "2,2022-09-6,TV,$6\n")
    assert run().sales_days is None
    same_as_a_whole_run(spark, shop, run.gold)


def test_files_without_rows(spark, lake):
    for text, days in (("", None), ("1,2022-09-1,TV,$5\n", {D(2022, 9, 1)}), ("", {D(2022, 9, 1)}), ("2,2022-09-2,TV,$5\n", {D(2022, 9, 2)})):
        put(lake.raw("sales/2022/s.csv"), HEAD + text)
        assert changed.update_sales(spark, lake) == days
    assert rows(sales.read_bronze(spark, lake).select("CustomerId")) == [("2",)]


def test_a_lake_without_deliveries(spark, lake):
    assert changed.update_sales(spark, lake) == set()
    assert not changed.update_customers(spark, lake) and not changed.update_profiles(spark, lake)
    assert files(lake.root) == {}
