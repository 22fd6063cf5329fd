"""Copies of the driver tables as written for the path-based audits: one shuffle per table, no sort, one file per partition."""

import os
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from copyaudit.plans import catalog, physical, recipes


@pytest.fixture()
def tables(spark, scratch):
    days = [date(1997, 1 + i % 12, 1 + i % 20) for i in range(240)] + [date(1998, 3, 5), None]
    spark.createDataFrame([(i, d, f"o{i}") for i, d in enumerate(days)], "o_orderkey long, o_orderdate date, o_comment string") \
        .write.parquet(f"{scratch}/orders.parquet")
    spark.createDataFrame([(i, 1 + i % 7, d) for i, d in enumerate(days)], "l_orderkey long, l_linenumber int, l_shipdate date") \
        .write.parquet(f"{scratch}/lineitem.parquet")
    spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 30)) for i in range(90)], "event_id long, ts timestamp") \
        .write.parquet(f"{scratch}/events.parquet")
    return scratch


@pytest.mark.parametrize("most_open", [40, 2])
def test_each_copy_has_its_rows_in_one_file_per_partition(spark, tables, monkeypatch, most_open):
    monkeypatch.setattr(physical, "OPEN_FILES", most_open)
    used = [recipes.ORDERS, recipes.LINEITEM, recipes.EVENTS]
    layout = physical.three_way_layout(spark, "test-copies", catalog.three_way_params())
    parts = recipes.work_items(spark, tables, used)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    physical.write_copies(spark, tables, layout, parts, used)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    work = physical.three_way_work_list(spark, layout.three_way, parts)
    seen = 0
    for loc in physical.copy_locations(work.tables, ["source", "staging", "target"]):
        recipe = recipes.RECIPES[loc.table]
        if loc.db != recipe.db or loc.role not in recipe.weights:
            continue
        seen += 1
        key = f"{loc.table[0] if loc.table != 'events' else 'event'}_{'orderkey' if loc.table != 'events' else 'id'}"
        want = recipes.copy_rows(spark, tables, recipe, loc.role).groupBy(recipe.partition_col, key).count()
        got = spark.read.format(physical.reader_format(loc.fmt)).load(loc.root)
        assert set(got.columns) == set(recipes.base_table(spark, tables, loc.table).columns) | {recipe.partition_col}
        got = got.groupBy(recipe.partition_col, key).count()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        root = re.sub("^file:", "", loc.root)
        for folder in (d for d in os.listdir(root) if d.startswith(f"{recipe.partition_col}=")):
            files = [f for f in os.listdir(f"{root}/{folder}") if f[0] not in "._" and not f.startswith("part-empty")]
            assert len(files) == 1, folder
    assert seen == 7


def test_all_copies_of_a_table_come_from_one_shuffle(spark, tables, monkeypatch):
    written = []
    layout = physical.three_way_layout(spark, "test-shuffles", catalog.three_way_params())
    parts = recipes.work_items(spark, tables, [recipes.LINEITEM]).checkpoint(eager=True)
    real = recipes.base_table
    monkeypatch.setattr(recipes, "base_table", lambda *a: written.append(a[2]) or real(*a))
    physical.write_copies(spark, tables, layout, parts, [recipes.LINEITEM])
    assert written == ["lineitem"]                          # the table is read and shuffled once, not once per copy


def test_one_shuffle_and_no_sort(spark, tables):
    rows = recipes.rows_of_copies(spark, tables, recipes.LINEITEM, ["source", "staging", "target"])
    with physical.open_files(spark, 40):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert rows.where(F.col("copy_role") == "source").count() == 242
