"""Files to bronze to silver to gold, layout, incremental loading."""

import os
from datetime import date
from decimal import Decimal

import pytest
from fixtures import VALID, table, tiny_star
from pyspark.sql import functions as F

from starmart.plans import layout, medallion
from starmart.plans.marts import MARTS
from starmart.schemas import DIM_STORE, FACT_SALES, TABLES
from starmart.sources import catalog
from starmart.sources.delimited import available_inputs, read_csv, write_csv
from starmart.streaming.incremental import load_new_files


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """A folder of delimited inputs; promotions without the none member, facts with a repeat."""
    folder = str(tmp_path_factory.mktemp("inputs"))
    sales = [dict(salesid=i, productid=1 + i % 3, datekey=20230100 + i, promoid=i % 2) for i in range(1, 21)]
    star = tiny_star(spark, sales + sales[:4], products=[dict(productid=i, name=f"P{i}") for i in (1, 2, 3)],
                     start=date(2023, 1, 1), end=date(2023, 1, 31), specials=False)
    for name in TABLES:
        write_csv(star.table(name).coalesce(1), f"{folder}/{name}.csv")
    return folder


def test_medallion_is_repeatable(spark, inputs):
    snapshots = []
    for _ in range(2):
        steps = medallion.run(medallion.medallion_steps(spark, inputs, date(2023, 1, 31)))
        assert [s.status for s in steps] == ["ok"] * 3
        snapshots.append({
            n: sorted(map(str, spark.table(f"gold.{n}").collect())) for n in MARTS})
    assert snapshots[0] == snapshots[1]
    assert spark.table("bronze.fact_sales").count() == 24 and spark.table("silver.fact_sales").count() == 20
    assert {r[0] for r in spark.table("silver.dim_promotion").select("promoid").collect()} == {-1, 0, 1}
    types = dict(spark.table("silver.fact_sales").dtypes)
    assert types["net"] == "decimal(18,2)" and types["hour"] == "tinyint" and "_silver_processed_ts" in types
    row = spark.table("bronze.fact_sales").select("_file_name", "_source_file", "_ingestion_ts").first()
    assert row[0] == "fact_sales.csv" and "fact_sales.csv" in row[1] and row[2] is not None
    found = dict(catalog.listing(spark, "gold", r"^vw_[0-9]{3}_"))
    assert len(found) == 17 and "Revenue, cost and margin" in found["vw_001_product_category_margin"]


def test_special_members_of_a_stored_table(spark):
    catalog.ensure_namespaces(spark, ["members"])
    catalog.publish(table(spark, "dim_promotion", [{"promoid": 3}]), "members", "dim_promotion")
    assert medallion.ensure_special_members(spark, "members", "dim_promotion") == 2
    assert medallion.ensure_special_members(spark, "members", "dim_promotion") == 0
    assert {r[0] for r in spark.table("members.dim_promotion").select("promoid").collect()} == {-1, 0, 3}


def test_pass_through_views_and_query_tables(spark):
    catalog.ensure_namespaces(spark, ["v_src"])
    for n in TABLES:
        catalog.publish(table(spark, n, [{}] if n != "dim_date" else []), "v_src", n)
    catalog.register_views(spark, "v_src", "v_")
    assert spark.table("v_fact_sales").count() == 1
    assert catalog.publish_query(spark, "SELECT sum(net) AS net FROM v_fact_sales", "v_src", "total") == 1
    assert spark.table("v_src.total").first()[0] == Decimal("108.90")


def test_a_failing_step_ends_the_run(spark):
    done = medallion.run([("a", lambda: 1), ("b", lambda: 1 / 0), ("c", lambda: 2)])
    assert [(s.name, s.status) for s in done] == [("a", "ok"), ("b", "failed")]
    assert len(medallion.run([("b", lambda: 1 / 0), ("c", lambda: 2)], stop_on_failure=False)) == 2


def test_missing_inputs_are_reported(spark, tmp_path):
    assert {r[2] for r in available_inputs(spark, str(tmp_path)).collect()} == {"missing"}
    assert {s for _, _, s in medallion.load_bronze(spark, str(tmp_path), "bronze_empty")} == {"missing"}


def test_bad_cells_are_kept_and_listed(spark, tmp_path):
    names = DIM_STORE.names
    good = {**{c: "0" for c in names}, "storeid": "5", "storename": "Ok"}
    bad = {**good, "storeid": "x5", "storename": "Bad"}
    short = "7,Short"
    lines = [",".join(names)] + [",".join(r[c] for c in names) for r in (good, bad)] + [short]
    (tmp_path / "dim_store.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    medallion.load_bronze(spark, str(tmp_path), "bronze_bad")
    assert spark.table("bronze_bad.dim_store").count() == 3
    got = medallion.rejected(spark, "dim_store", "bronze_bad")
    assert {r["_corrupt_record"].split(",")[1] for r in got.collect()} == {"Bad", "Short"}


def test_csv_scan_prunes_columns(spark, inputs):
    df = read_csv(spark, f"{inputs}/fact_sales.csv", FACT_SALES, ["productid", "qty"])
    assert df.columns == ["productid", "qty"] and df.agg(F.sum("qty")).first()[0] == 24
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<productid:int,qty:int>" in scan


def test_fixed_decimals_in_text(spark, tmp_path):
    write_csv(spark.createDataFrame([(1.5,)], "x double"), str(tmp_path / "o"), digits={"x": 3})
    assert spark.read.text(str(tmp_path / "o")).filter("value <> 'x'").first()[0] == "1.500"


def test_reconcile(spark):
    a, b = spark.range(3), spark.range(4)
    medallion.require_reconciled({"t": a}, {"t": a})
    with pytest.raises(ValueError, match="t 3/4"):
        medallion.require_reconciled({"t": a}, {"t": b})


def test_views_comments_and_drops(spark):
    catalog.ensure_namespaces(spark, ["misc"])
    assert catalog.publish(spark.range(5), "misc", "five", comment="it's five") == 5
    catalog.append(spark.range(2), "misc", "five")
    assert spark.table("misc.five").count() == 7
    assert catalog.listing(spark, "misc", "five") == [("five", "it's five")]
    catalog.publish_view(spark, "misc.v_five", "SELECT * FROM misc.five", "five as a view")
    assert spark.table("misc.v_five").count() == 7
    catalog.refresh_statistics(spark, "misc.five")
    catalog.drop(spark, "misc", ["v_five"], "VIEW")
    catalog.drop(spark, "misc", ["five", "five"])
    assert catalog.listing(spark, "misc") == []


def test_clustering_rewrites_in_curve_order(spark):
    catalog.ensure_namespaces(spark, ["lay"])
    rows = [dict(salesid=i, datekey=20230101 + i % 28, productid=i % 50, customerid=i % 40) for i in range(600)]
    facts = table(spark, "fact_sales", rows)
    catalog.publish(facts, "lay", "fact_sales", files=6)
    before = sorted(map(str, spark.table("lay.fact_sales").collect()))
    result = layout.optimize_table(spark, "lay.fact_sales", files=4)
    assert result[:2] == ("lay.fact_sales", "clustered") and result[3] <= 4
    assert sorted(map(str, spark.table("lay.fact_sales").collect())) == before
    # a file covers a part of the key space only
    spans = spark.table("lay.fact_sales").groupBy(F.input_file_name()).agg(
        F.max("datekey") - F.min("datekey"), F.max("productid") - F.min("productid")).collect()
    assert min(r[1] for r in spans) < 27 or min(r[2] for r in spans) < 49
    layout.optimize_table(spark, "lay.fact_sales", files=2)
    assert layout.vacuum(spark, "lay.fact_sales") == []  # younger than the retention
    assert len(layout.vacuum(spark, "lay.fact_sales", retention_hours=0)) == 2  # only told, not removed
    assert len(layout.vacuum(spark, "lay.fact_sales", retention_hours=0, enabled=True)) == 2
    assert layout.vacuum(spark, "lay.fact_sales", retention_hours=0) == []
    assert spark.table("lay.fact_sales").count() == 600
    # publishing again after maintenance replaces rows and schema
    assert catalog.publish(facts.filter("salesid < 10").drop("hour"), "lay", "fact_sales") == 10
    assert spark.table("lay.fact_sales").count() == 10 and "hour" not in spark.table("lay.fact_sales").columns
    assert layout.optimize_table(spark, "lay.fact_sales", files=1)[1] == "clustered"


def test_a_failed_write_keeps_the_earlier_data(spark):
    catalog.ensure_namespaces(spark, ["lay"])
    catalog.publish(spark.range(5), "lay", "kept")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        catalog.publish(spark.range(5).selectExpr("1 / (id - 3) AS x"), "lay", "kept")
    assert spark.table("lay.kept").count() == 5


def test_one_key_in_every_row_still_spreads(spark):
    df = spark.range(4000).select(F.lit(1).alias("a"), F.lit(2).alias("b"), "id")
    parts = layout.cluster(df, ["a", "b"], 4).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r[1] for r in parts) < 2000


def test_compaction_only_above_the_threshold(spark):
    catalog.ensure_namespaces(spark, ["lay"])
    catalog.publish(spark.range(100), "lay", "mart", files=5)
    assert layout.optimize_table(spark, "lay.mart")[1] == "skipped"
    assert layout.optimize_table(spark, "lay.mart", files=1, many=4)[1:] == ("compacted", 5, 1)


def test_layer_errors_are_isolated(spark, monkeypatch):
    catalog.ensure_namespaces(spark, ["lay2"])
    for n in ("a", "b"):
        catalog.publish(spark.range(3), "lay2", n)
    real = layout.optimize_table
    monkeypatch.setattr(layout, "optimize_table", lambda s, t, **o: 1 / 0 if t.endswith("a") else real(s, t, **o))
    out = layout.optimize_layers(spark, ["lay2", "no_such_layer"])
    assert out[0][1].startswith("failed") and out[1][1] == "skipped"


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    src, target, check = (str(tmp_path / n) for n in ("src", "target", "check"))
    os.makedirs(src)

    def drop(name, ids):
        lines = [",".join(DIM_STORE.names)]
        lines += [",".join(str({**{c: 0 for c in DIM_STORE.names}, **VALID["dim_store"], "storeid": i}[c])
                           for c in DIM_STORE.names) for i in ids]
        (tmp_path / "src" / name).write_text("\n".join(lines) + "\n")

    drop("one.csv", [1, 2])
    assert load_new_files(spark, src, DIM_STORE, target, check) == 2
    assert load_new_files(spark, src, DIM_STORE, target, check) == 0
    drop("two.csv", [3])
    assert load_new_files(spark, src, DIM_STORE, target, check) == 1
    got = spark.read.parquet(target)
    assert sorted(r[0] for r in got.select("storeid").collect()) == [1, 2, 3]
    assert "two.csv" in got.filter("storeid = 3").first()["_source_file"]


def test_scratch_folder_follows_the_session(spark):
    from starmart.sources.scratch import materialize, scratch_root

    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir") + "/starmart"
    stored, rows = materialize(spark.range(12))
    assert rows == 12 and scratch_root(spark) in stored.inputFiles()[0]


def test_stream_counts_many_batches_and_keeps_bad_rows(spark, tmp_path):
    src, target, check = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    os.makedirs(src)
    names = DIM_STORE.names
    for i in range(120):
        cells = ["x" if i == 7 and n == "staff" else str(i) if n == "storeid" else "" for n in names]
        with open(f"{src}/{i}.csv", "w") as f:
            f.write(",".join(names) + "\n" + ",".join(cells) + "\n")
    assert load_new_files(spark, src, DIM_STORE, target, check, files_per_batch=1) == 120
    bad = spark.read.parquet(target).filter("_corrupt_record IS NOT NULL").collect()
    assert [r["storeid"] for r in bad] == [7]


def test_publish_switches_in_one_step(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS switched")
    catalog.publish(spark.range(3), "switched", "t")
    with pytest.raises(Exception):
        catalog.publish(spark.range(5).select(F.raise_error(F.lit("late")).cast("long").alias("id")), "switched", "t")
    assert spark.table("switched.t").count() == 3
    catalog.publish(spark.range(5), "switched", "t")
    assert spark.table("switched.t").count() == 5
    catalog.publish(spark.range(2).selectExpr("id", "id AS more"), "switched", "t")
    assert spark.table("switched.t").columns == ["id", "more"] and spark.table("switched.t").count() == 2
