import datetime as dt
import os
import time

import pytest
from pyspark.sql import SparkSession, functions as F

from conftest import put
from lakestrata import catalog, layout, publishing, schemas, sinks, sources
from lakestrata.plans import gold, run_all

D = dt.date
DAY1, DAY2, DAY3 = D(2022, 9, 1), D(2022, 9, 2), D(2022, 9, 3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def watch(monkeypatch, spark, read):
    """Reads before and after every statement and file operation of what follows; returns what was seen."""
    seen, inside = [], []

    def look():
        if not inside:
            inside.append(1)
            try:
                seen.append(read())
            finally:
                inside.pop()

    def between(owner, name):
        real = getattr(owner, name)

        def watched(*args, **kwargs):
            if inside:
                return real(*args, **kwargs)
            look()
            try:
                return real(*args, **kwargs)
            finally:
                look()

        monkeypatch.setattr(owner, name, watched)

    between(SparkSession, "sql")
    for owner, name in ((catalog, "insert_by_name"), (publishing, "delete_folder"), (gold, "reconcile")):
        between(owner, name)
    return seen


def test_sales_readers_see_old_or_new_rows(spark, shop, monkeypatch):
    run_all.process_sales(spark, shop)
    read = lambda: rows(sources.read_table(spark, "gold_seen", "sales"))
    gold.load_gold_sales(spark, shop, DAY1, DAY2, "gold_seen")
    old = read()
    put(shop.raw("sales/2022-09-3/s.csv"), "CustomerId,PurchaseDate,Product,Price\n5,2022-09-2,TV,$5\n5,2022-09-3,TV,$5\n")
    run_all.process_sales(spark, shop)
    for append, days in ((True, (DAY2, DAY3)), (False, (DAY3, DAY3))):
        with monkeypatch.context() as patched:
            seen = watch(patched, spark, read)
            gold.load_gold_sales(spark, shop, *days, "gold_seen", append=append)
        new = read()
        assert new != old and len(seen) > 8 and all(s in (old, new) for s in seen)
        assert seen[0] == old and seen[-1] == new
        old = new
    assert len(new) == 1


def test_profile_readers_see_old_or_new_rows(spark, shop, monkeypatch):
    run_all.process_customers(spark, shop)
    run_all.process_profiles(spark, shop, F.lit("2022-09-10").cast("date"))
    run_all.enrich(spark, shop, F.lit("2022-09-10").cast("date"), "silver_seen", "gold_seen_p")
    read = lambda: rows(sources.read_table(spark, "gold_seen_p", "user_profiles_enriched"))
    old = read()
    good = layout.materialize(sources.read_parquet(spark, shop.gold("user_profiles_enriched")), "good")
    sinks.write_parquet(good.where("client_id > 1").withColumn("state", F.lit("New")), shop.gold("user_profiles_enriched"))
    with monkeypatch.context() as patched:
        seen = watch(patched, spark, read)
        assert gold.load_gold_profiles(spark, shop, "gold_seen_p") == 2
    new = read()
    assert len(old) == 3 and len(new) == 2 and all(s in (old, new) for s in seen)
    # A load that fails leaves the table and no trace after the next one.
    with monkeypatch.context() as patched:
        patched.setattr(gold, "reconcile", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.load_gold_profiles(spark, shop, "gold_seen_p")
    assert read() == new
    gold.load_gold_profiles(spark, shop, "gold_seen_p")
    assert read() == new and len(publishing.numbers(spark, "gold_seen_p", "user_profiles_enriched")) == 1
    assert len([n for n in os.listdir(shop.warehouse("gold_seen_p")) if n.startswith("user_profiles_enriched-")]) == 1


def test_old_versions_stay_until_released(spark, shop):
    run_all.process_sales(spark, shop)
    warehouse = shop.warehouse("gold_kept")
    gold.load_gold_sales(spark, shop, DAY1, DAY2, "gold_kept", keep=3)
    first = catalog.version_table(spark, "gold_kept", "sales")
    gold.load_gold_sales(spark, shop, DAY2, DAY2, "gold_kept", append=True, keep=3)
    gold.load_gold_sales(spark, shop, DAY2, DAY2, "gold_kept", keep=3)
    assert sources.read_table(spark, "gold_kept", first).count() == 5
    assert len(publishing.numbers(spark, "gold_kept", "sales")) == 3
    publishing.release(spark, "gold_kept", "sales", warehouse, keep=2)
    # The second version still uses the first day of the first one.
    second = f"sales{publishing.MARK}{publishing.numbers(spark, 'gold_kept', 'sales')[0]}"
    spark.catalog.refreshTable(f"gold_kept.{second}")
    assert sources.read_table(spark, "gold_kept", second).count() == 5
    publishing.release(spark, "gold_kept", "sales", warehouse)
    assert sources.read_table(spark, "gold_kept", "sales").count() == 2
    assert len([n for n in os.listdir(warehouse) if n.startswith("sales-")]) == 1


def test_a_plain_table_becomes_the_oldest_version(spark, shop):
    run_all.process_sales(spark, shop)
    warehouse = shop.warehouse("gold_plain")
    catalog.create_database(spark, "gold_plain", warehouse)
    catalog.recreate_table(spark, "gold_plain", "sales", schemas.GOLD_SALES, f"{warehouse}/sales", "purchase_date")
    silver = sources.read_parquet(spark, shop.silver("sales"), schemas.SILVER_SALES)
    catalog.insert_by_name(silver.where(F.col("purchase_date") == DAY1), "gold_plain", "sales", overwrite=True)
    assert gold.load_gold_sales(spark, shop, DAY2, DAY2, "gold_plain", append=True) == 2
    assert rows(sources.read_table(spark, "gold_plain", "sales")) == rows(silver.select("product_name", "client_id", "price", "purchase_date"))


@pytest.fixture
def by_year(spark, lake):
    catalog.create_database(spark, "merging", lake.warehouse("merging"))
    location = lake.path("x", "merged")
    catalog.recreate_table(spark, "merging", "t", "id INT, v STRING, year INT", location, "year")
    start = spark.createDataFrame([(n, f"v{n}", 2000 + n % 4) for n in range(12)], "id INT, v STRING, year INT")
    sinks.write_partitioned(start, location, "year")
    catalog.refresh_partitions(spark, "merging", "t")
    yield location
    catalog.drop_table(spark, "merging", "t")


def times(location):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(location) for f in names if f.endswith(".parquet")
    }


def merge(spark, rows_of, **how):
    changes = spark.createDataFrame(rows_of, "id INT, v STRING, year INT")
    touched = [r["year"] for r in catalog.merge_partitions(changes, "merging", "t", ["id"], **how)]
    return sorted(touched, key=lambda y: (y is None, y))


def test_a_merge_rewrites_only_touched_partitions(spark, by_year):
    before = times(by_year)
    time.sleep(0.02)
    # A new value, one that moves, one without a value, a new row in a new year, and one without a key.
    assert merge(spark, [(1, "new", 2001), (5, "moved", 2002), (50, "added", 2010), (None, "lost", 2003)]) == [2001, 2002, 2010]
    after = times(by_year)
    for path, at in before.items():
        untouched = "year=2000" in path or "year=2003" in path
        assert (after.get(path) == at) == untouched
    wanted = [(n, f"v{n}", 2000 + n % 4) for n in range(12) if n not in (1, 5)]
    wanted += [(1, "new", 2001), (5, "moved", 2002), (50, "added", 2010)]
    assert rows(sources.read_table(spark, "merging", "t")) == sorted(wanted, key=repr)


def test_a_merge_reads_only_touched_partitions(spark, by_year, monkeypatch):
    read = []
    real = catalog.upsert
    monkeypatch.setattr(catalog, "upsert", lambda before, *a, **k: (read.extend(before.inputFiles()), real(before, *a, **k))[1])
    merge(spark, [(1, "new", 2001)])
    assert read and all("/year=2001/" in f for f in read)


def test_a_partition_that_lost_its_rows_is_dropped(spark, by_year):
    assert merge(spark, [(3, "a", 2000), (7, "b", 2000), (11, None, 2000)]) == [2000, 2003]
    assert not any("year=2003" in p for p in times(by_year))
    assert [r[0] for r in spark.sql("SHOW PARTITIONS merging.t").collect()] == ["year=2000", "year=2001", "year=2002"]
    kept = {r["id"]: r["v"] for r in sources.read_table(spark, "merging", "t").where("year = 2000").collect()}
    assert kept == {0: "v0", 3: "a", 4: "v4", 7: "b", 8: "v8", 11: "v11"}


def test_a_change_without_partition_stays_where_its_row_lies(spark, by_year):
    assert merge(spark, [(2, "same place", None)]) == [2002]
    assert ("same place", 2002) in {(r["v"], r["year"]) for r in sources.read_table(spark, "merging", "t").collect()}
    assert merge(spark, [(77, "nowhere", None)]) == [None]
    assert merge(spark, [(77, "somewhere", 2001)]) == [2001, None]
    found = sources.read_table(spark, "merging", "t").where("id = 77")
    assert rows(found) == [(77, "somewhere", 2001)]


def test_merge_of_nothing_and_into_a_plain_table(spark, by_year, lake):
    before = times(by_year)
    assert merge(spark, []) == [] and times(by_year) == before
    catalog.recreate_table(spark, "merging", "plain", "id INT", lake.path("x", "plain"))
    with pytest.raises(ValueError, match="not partitioned"):
        catalog.merge_partitions(spark.range(1), "merging", "plain", ["id"])


def test_two_partition_columns_and_odd_values(spark, lake):
    catalog.create_database(spark, "merging2", lake.warehouse("merging2"))
    location = lake.path("x", "two")
    catalog.recreate_table(spark, "merging2", "t", "id INT, v INT, a STRING, b INT", location, "a, b")
    start = [(n, n, a, b) for n, (a, b) in enumerate((a, b) for a in ("it's", "x y") for b in (1, 2))]
    catalog.insert_by_name(spark.createDataFrame(start, "id INT, v INT, a STRING, b INT"), "merging2", "t", overwrite=True)
    before = times(location)
    changes = spark.createDataFrame([(0, 10, "x y", 1)], "id INT, v INT, a STRING, b INT")
    touched = catalog.merge_partitions(changes, "merging2", "t", ["id"])
    assert sorted(map(tuple, touched)) == [("it's", 1), ("x y", 1)]
    assert rows(sources.read_table(spark, "merging2", "t")) == sorted([(0, 10, "x y", 1), *start[1:]], key=repr)
    assert len(set(before) & set(times(location))) == 2
    assert len(spark.sql("SHOW PARTITIONS merging2.t").collect()) == 3
