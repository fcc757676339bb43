import json
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import put
from lakestrata.plans import food, run_all
from lakestrata.queries import inputs

SMALL = "/root/testdata/sf0.001"


def nutrient(name, value, unit):
    return {"nutrientName": name, "value": value, "unitName": unit}


def item(identity, text, kind, category, day, nutrients):
    return {
        "fdcId": identity, "description": text, "dataType": kind, "foodCategory": category,
        "publishedDate": day, "foodNutrients": nutrients,
    }


DOCUMENT = [
    {
        "foods": [
            item(1, "Apple", "Foundation", "Fruits", "2022-01-01",
                 [nutrient("Vitamin C", 100, "mg"), nutrient("Fiber", 5, "g")]),
            item(2, "Kale", "Foundation", "Greens", "2021-06-30",
                 [nutrient("Vitamin C", 50, "mg"), nutrient("Fiber", 10.5, "g"), nutrient("Iron", None, "mg")]),
            item(3, "Pear", "Branded", "Fruits", None,
                 [nutrient("Vitamin C", 0, "mg"), nutrient("Fiber", None, "g")]),
            item(4, "Water", "Branded", "Drinks", "2022-02-02", []),
        ]
    },
    {"foods": None},
]


@pytest.fixture
def flat(spark, lake):
    put(lake.raw("food/food.json"), json.dumps(DOCUMENT, indent=2))
    return food.flat_foods(food.read_foods(spark, lake.raw("food/food.json")))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_derived_rows(flat):
    found = food.derived_foods(flat).select(
        "fdcId", "nutrientName", "nutrientValue", "publicationYear", "nutrientLevel",
        "normalizedNutrientValue",
    )
    assert rows(found) == sorted(
        [
            (1, "Fiber", 5.0, 2022, "Low", 0.0),
            (1, "Vitamin C", 100.0, 2022, "High", 1.0),
            (2, "Fiber", 10.5, 2021, "Medium", 1.0),
            (2, "Iron", None, 2021, "Low", 0.0),
            (2, "Vitamin C", 50.0, 2021, "Medium", 0.5),
            (3, "Fiber", None, None, "Low", None),
            (3, "Vitamin C", 0.0, None, "Low", 0.0),
        ],
        key=repr,
    )


STATISTICS = {
    "avg_nutrient_content": [("Fiber", "g", 7.75), ("Iron", "mg", None), ("Vitamin C", "mg", 50.0)],
    "median_nutrient_value": [("Fiber", "g", 5.0), ("Iron", "mg", None), ("Vitamin C", "mg", 50.0)],
    "unique_food_items_by_nutrient": [("Fiber", 3), ("Iron", 1), ("Vitamin C", 3)],
    "total_nutrient_value_per_category": [
        ("Fruits", "Fiber", 5.0), ("Fruits", "Vitamin C", 100.0), ("Greens", "Fiber", 10.5),
        ("Greens", "Iron", None), ("Greens", "Vitamin C", 50.0),
    ],
    "food_items_per_year": [(None, 2), (2021, 3), (2022, 2)],
}


def test_statistics_in_order(flat):
    found = food.food_statistics(flat)
    assert {name: [tuple(r) for r in df.collect()] for name, df in found.items()} == STATISTICS


def test_distinct_foods_beside_rows(flat):
    found = food.food_statistics(flat, with_distinct_foods=True)["food_items_per_year"]
    assert [tuple(r) for r in found.collect()] == [(None, 2, 1), (2021, 3, 1), (2022, 2, 1)]


def test_lines_equal_documents(spark, lake, flat):
    put(lake.raw("food/lines.json"), "\n".join(json.dumps(d) for d in DOCUMENT))
    lines = food.read_foods(spark, lake.raw("food/lines.json"), lines=True)
    assert rows(food.flat_foods(lines)) == rows(flat)


def test_export(spark, lake, flat):
    run_all.main(
        ["food", "--root", lake.root, "--documents", lake.raw("food/food.json"),
         "--output", lake.path("out", "food"), "--derived", lake.path("out", "derived")]
    )
    derived = spark.read.parquet(lake.path("out", "derived"))
    assert rows(derived) == rows(food.derived_foods(flat))
    for name, wanted in STATISTICS.items():
        back = spark.read.csv(lake.path("out", f"food/{name}"), header=True)
        assert rows(back) == sorted(
            (tuple(None if v is None else str(v) for v in row) for row in wanted), key=repr
        )


def test_only_json_lines_are_refused(spark, lake):
    nutrient = '{"nutrientName": "Iron", "value": 1.0, "unitName": "mg"}'
    one_each = ',\n'.join('{"fdcId": %d, "foodNutrients": [\n%s\n]}' % (n, nutrient) for n in (1, 2))
    valid = {
        "inner-lines": '{"foods": [\n' + one_each + '\n]}',
        "array-of-lines": '[\n{"foods": []},\n{"foods": []}\n]',
        "pretty": json.dumps({"foods": [{"fdcId": 1, "foodNutrients": [json.loads(nutrient)]}]}, indent=1),
        "compact": '{"foods": []}',
        "blank-lines": '\n\n {"foods": []} \n\n',
        "leading-comma": '{"foods": [\n{"fdcId": 1}\n, {"fdcId": 2}\n]}',
    }
    for name, text in valid.items():
        put(lake.raw(f"valid/{name}.json"), text)
        food.refuse_json_lines(spark, lake.raw(f"valid/{name}.json"))
    food.refuse_json_lines(spark, lake.raw("valid"))
    assert food.read_foods(spark, lake.raw("valid/inner-lines.json")).selectExpr("size(foods)").first()[0] == 2
    put(lake.raw("valid/lines.json"), '{"foods": []}\n{"foods": []}\n')
    for path in ("valid/lines.json", "valid"):
        with pytest.raises(ValueError, match="lines.json is JSON Lines"):
            food.refuse_json_lines(spark, lake.raw(path))


def delivered_bytes(path):
    return sum(f.stat().st_size for f in Path(path).rglob("part-*"))


def test_json_lines_are_delivered_compressed_in_bounded_files(spark, monkeypatch):
    lineitem = inputs.table(spark, SMALL, "lineitem")
    documents = inputs.food_documents(lineitem)
    monkeypatch.setattr(inputs, "LINES_PER_FILE", 1000)
    path = inputs.write_food_lines(spark, SMALL)
    text = documents.agg(F.sum(F.length(F.to_json(F.struct("foods"))))).first()[0]
    assert delivered_bytes(path) * 4 < text
    back = food.read_foods(spark, path, lines=True)
    per_file = back.groupBy(F.input_file_name().alias("file")).count()
    assert per_file.agg(F.max("count")).first()[0] <= 1000
    assert back.count() == lineitem.count()
    assert food.flat_foods(back).exceptAll(food.flat_foods(documents)).isEmpty()


def test_whole_file_documents_are_delivered_compressed(spark):
    lineitem = inputs.table(spark, SMALL, "lineitem")
    documents = inputs.food_documents(lineitem)
    text = documents.agg(F.sum(F.length(F.to_json(F.struct("foods"))))).first()[0]
    path = inputs.deliver_food_files(spark, SMALL)
    assert delivered_bytes(path) * 4 < text
    back = food.read_foods(spark, path)
    assert back.count() == lineitem.count()
    assert food.flat_foods(back).exceptAll(food.flat_foods(documents)).isEmpty()


def test_whole_file_documents_hold_a_bounded_number_of_rows():
    arrays = inputs._arrays(2)
    batches = [pa.RecordBatch.from_pydict({"line": lines}) for lines in (["1"], ["2", "3"], [], ["4", "5"])]
    found = [v for batch in arrays(iter(batches)) for v in batch.column("value").to_pylist()]
    assert [json.loads(v) for v in found] == [[1, 2], [3, 4], [5]]
    assert list(arrays(iter([]))) == []
