"""Layers as queries: commits that survive a dying writer, digests, statistics, clustering by rank, streaming dedup."""

import os
from datetime import datetime

import pytest
from conftest import SF
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from compare import differences, duck
from starmart.plans import layers, layout, medallion, operator_queries
from starmart.plans.layers import LAYERS, compare_digests
from starmart.schemas import DIM_STORE, FACT_SALES
from starmart.sources import catalog
from starmart.sources.order_lines import OrderLineStar
from starmart.streaming import incremental


def databases(spark):
    return {d.name for d in spark.catalog.listDatabases()}


def test_the_flow_gives_the_same_twice_and_leaves_no_namespace(spark, order_star):
    before = databases(spark)
    first, second = (sorted(map(str, LAYERS["layers_m003"](order_star).collect())) for _ in range(2))
    assert first == second and first
    assert databases(spark) == before


def test_a_failing_step_drops_the_namespaces(spark, order_star, monkeypatch):
    before = databases(spark)
    monkeypatch.setattr(medallion, "clean", lambda df, name: 1 / 0)
    with pytest.raises(RuntimeError, match="silver: division by zero"):
        LAYERS["layers_silver_fact"](order_star)
    assert databases(spark) == before


STEPS = ["write", "commit", "follow", "drop", "create"]


@pytest.mark.parametrize("step", STEPS)
def test_an_overwrite_that_dies_leaves_a_whole_table(spark, monkeypatch, step):
    """Columns change.  Whatever step the writer dies at, readers have the old or the new rows, and the next write works."""
    old, new = spark.range(5), spark.range(3).selectExpr("id", "id * 2 AS more")

    class Dies(Exception):
        pass

    def die(*_, **__):
        raise Dies

    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(old, gold, "t")
        with monkeypatch.context() as m:
            if step in ("commit", "follow"):
                m.setattr(catalog, step, die)
            elif step == "write":
                new = spark.range(3).select("id", F.raise_error(F.lit("late")).cast("long").alias("more"))
            elif step == "drop":
                real = spark.sql
                m.setattr(spark, "sql", lambda q, *a, **b: die() if q.startswith("DROP TABLE") else real(q, *a, **b))
            else:
                kind = type(spark.catalog)
                m.setattr(kind, "createTable", die)
            with pytest.raises(Exception):
                catalog.publish(new, gold, "t")
        got = catalog.table(spark, gold, "t")
        if step in ("write", "commit"):
            assert got.columns == ["id"] and got.count() == 5
        else:
            assert got.columns == ["id", "more"] and got.count() == 3
        assert catalog.publish(spark.range(7), gold, "t") == 7
        assert catalog.table(spark, gold, "t").count() == spark.table(f"{gold}.t").count() == 7


def test_of_two_writers_one_commits(spark):
    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(spark.range(1), gold, "t")
        path = catalog.snapshot_path(spark, gold, "t")
        spark.range(2).write.parquet(path)
        seen = catalog._commits(spark, gold, "t")
        catalog.commit(spark, gold, "t", path, spark.range(2).schema)
        original = catalog._commits
        catalog._commits = lambda *a: seen  # a writer that has not seen the other's commit
        try:
            with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
                catalog.commit(spark, gold, "t", path + "-other", spark.range(2).schema)
        finally:
            catalog._commits = original
        assert catalog.table(spark, gold, "t").count() == 2


def test_readers_mend_an_entry_that_is_behind(spark):
    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(spark.range(1), gold, "t")
        path = catalog.snapshot_path(spark, gold, "t")
        spark.range(4).write.parquet(path)
        catalog.commit(spark, gold, "t", path, spark.range(4).schema)
        assert spark.table(f"{gold}.t").count() == 1
        assert catalog.table(spark, gold, "t").count() == 4 == spark.table(f"{gold}.t").count()


def test_digests_find_what_row_counts_do_not(spark, order_star):
    names = {"dim_store": order_star.table("dim_store").select(DIM_STORE.names)}
    seen = {n: df.agg(*catalog.digest(DIM_STORE.names)).first().asDict() for n, df in names.items()}
    store = names["dim_store"]
    assert compare_digests(seen, names).first()["matches"]
    assert compare_digests(seen, {"dim_store": store.orderBy(F.desc("storeid"))}).first()["matches"]
    keys = sorted(r[0] for r in store.select("storeid").collect())
    swapped = store.withColumn("staff", F.when(F.col("storeid") == keys[3], 999).otherwise(F.col("staff")).cast("smallint"))
    doubled = store.filter(F.col("storeid") != keys[3]).unionByName(store.filter(F.col("storeid") == keys[4]))
    for other in (swapped, doubled):
        found = compare_digests(seen, {"dim_store": other}).first()
        assert found["rows"] == seen["dim_store"]["rows"] and not found["matches"]
    assert not compare_digests(seen, {"dim_store": store.limit(0)}).first()["matches"]


def test_statistics_after_an_overwrite(spark):
    with catalog.scoped_namespaces(spark, ["silver"]) as spaces:
        full = f"{spaces['silver']}.t"
        catalog.publish(spark.range(5).selectExpr("id", "nullif(id, 3) AS gap", "cast(id AS string) AS word"), spaces["silver"], "t")
        assert {tuple(r) for r in catalog.column_statistics(spark, full).collect()} == {(c, None, None, None) for c in ("id", "gap", "word")}
        catalog.refresh_statistics(spark, full)
        assert {tuple(r) for r in catalog.column_statistics(spark, full).collect()} == {
            ("id", "0", "4", 0), ("gap", "0", "4", 1), ("word", None, None, 0)}


def test_special_members_do_not_narrow_the_curve(spark):
    """One row with key -1 used to leave a handful of places to all others."""
    days = spark.range(1400).select((F.col("id") + 19950101).alias("day"), (F.col("id") % 50 + 1).alias("item"))
    odd = spark.createDataFrame([(-1, 1), (0, 2), (None, 3), (10**9, 4)], "day long, item long")
    df = days.unionByName(odd)
    edges = layout.rank_edges(df, ["day", "item"])
    places = df.select("day", layout.rank_place("day", edges["day"]).alias("p"))
    got = {r["day"]: r["p"] for r in places.collect()}
    assert got[None] == 0 and got[-1] == got[0] == 1
    regular = sorted((d, p) for d, p in got.items() if d is not None and d > 0)
    assert [p for _, p in regular] == sorted(p for _, p in regular)
    assert len({p for _, p in regular}) > 100 and max(got.values()) < 1 << layout.RANK_BITS
    assert layout.rank_edges(df.limit(0), ["day"]) == {"day": []}
    skewed = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    assert layout.morton_key(skewed.withColumn("j", F.col("k")), ["k", "j"]).count() == 3000


def test_streamed_keys_are_stored_once_after_a_dead_batch(spark, tmp_path, monkeypatch):
    src, target, check = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    os.makedirs(src)
    names = DIM_STORE.names

    def drop(name, ids):
        rows = [",".join(str(i) if n == "storeid" else "" for n in names) for i in ids]
        with open(f"{src}/{name}", "w") as f:
            f.write(",".join(names) + "\n" + "\n".join(rows) + "\n")

    def load():
        incremental.load_distinct(spark, src, DIM_STORE, target, check, files_per_batch=1)

    def stored():
        return sorted(r[0] for r in incremental.stored_batches(spark, target).select("storeid").collect())

    drop("a.csv", [1, 2, 2, 1])
    load()
    assert stored() == [1, 2]
    drop("b.csv", [2, 3])
    write = DataFrameWriter.parquet

    def dies_after_writing(self, path, *a, **b):
        write(self, path, *a, **b)
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", dies_after_writing)
        with pytest.raises(Exception, match="killed"):
            load()
    drop("c.csv", [3, 4, 1])
    load()
    assert stored() == [1, 2, 3, 4]
    load()
    assert stored() == [1, 2, 3, 4]


def test_keys_are_forgotten_behind_the_watermark(spark, tmp_path):
    src, target, check = (f"{tmp_path}/{x}" for x in ("in", "out", "check"))
    os.makedirs(src)
    names = DIM_STORE.names

    def drop(name, i, city):
        with open(f"{src}/{name}", "w") as f:
            f.write(",".join(names) + "\n" + ",".join({"storeid": str(i), "city": city}.get(n, "") for n in names) + "\n")

    when = F.to_timestamp("city")
    for name, i, day in (("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 2, "2024-03-01"), ("d", 3, "2024-03-02"), ("e", 1, "2024-03-03")):
        assert datetime.fromisoformat(day)
        drop(f"{name}.csv", i, day)
        incremental.load_distinct(spark, src, DIM_STORE, target, check, delay="2 days", event_time=when)
    got = sorted((r[0], r[1]) for r in incremental.stored_batches(spark, target).select("storeid", "city").collect())
    assert got == [(1, "2024-01-01"), (1, "2024-03-03"), (2, "2024-03-01"), (3, "2024-03-02")]


def test_raw_rows_bring_what_real_inputs_bring(order_star):
    raw = layers.raw_rows(order_star, "fact_sales")
    found = raw.agg(F.count("*").alias("n"), F.count_distinct("salesid").alias("d"), F.count_if(F.col("payment") == "").alias("empty"),
                    F.count_if(F.col("channel").contains("‑")).alias("dash"), F.count_if(F.col("hour") == "late").alias("late")).first()
    assert found["n"] > found["d"] and found["empty"] and found["dash"] and found["late"]


def test_compaction_rewrites_small_files_only(spark):
    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(spark.range(20_000).coalesce(1), gold, "t")
        catalog.append(spark.range(20_000, 20_300).repartition(9), gold, "t")
        path = catalog.committed(spark, gold, "t")["path"]
        before = catalog.data_files(spark, path)
        large = max(before, key=before.get)
        told = layout.compact(spark, f"{gold}.t", target=before[large])
        after = catalog.data_files(spark, path)
        assert told == {"before": 10, "rewritten": 9, "after": len(after)} and 2 <= len(after) < 5
        assert after[large] == before[large]
        assert catalog.table(spark, gold, "t").agg(F.count("*"), F.sum("id")).first() == (20_300, sum(range(20_300)))
        assert spark.table(f"{gold}.t").count() == 20_300
        assert layout.compact(spark, f"{gold}.t", target=10)["rewritten"] == 0


def test_compaction_that_dies_is_finished_by_the_next(spark, monkeypatch):
    with catalog.scoped_namespaces(spark, ["gold"]) as spaces:
        gold = spaces["gold"]
        catalog.publish(spark.range(100), gold, "t", files=6)

        def rows():
            return sorted(r[0] for r in catalog.table(spark, gold, "t").collect())

        for step in ("commit", "finish_swap"):
            calls = []
            real = getattr(catalog if step == "commit" else layout, step)

            def dies(*a, **b):
                calls.append(1)
                if step == "commit" or len(calls) == 2:  # the second call follows the commit
                    raise RuntimeError("killed")
                return real(*a, **b)

            with monkeypatch.context() as m:
                m.setattr(catalog if step == "commit" else layout, step, dies)
                with pytest.raises(RuntimeError, match="killed"):
                    layout.compact(spark, f"{gold}.t")
            assert rows() == list(range(100))
        assert catalog.committed(spark, gold, "t")["swap"]
        come = catalog.committed(spark, gold, "t")["swap"]["come"]
        one = next(iter(catalog.data_files(spark, come)))
        there, fs = catalog._place(spark, f"{come}/{one}")
        fs.rename(there, catalog._place(spark, f"{catalog.committed(spark, gold, 't')['path']}/{one}")[0])  # died while moving
        assert rows() == list(range(100))
        assert layout.compact(spark, f"{gold}.t")["before"] == 1
        assert rows() == list(range(100)) and not catalog.committed(spark, gold, "t")["swap"]


def test_clustered_files_hold_no_more_rows_than_a_task_sorts(spark, monkeypatch):
    """However small the files are, the rows of one must fit the task that sorts them."""
    rows = spark.range(6000).selectExpr(
        "CAST(20230101 + id % 28 AS INT) AS datekey", "id % 50 AS productid", "id % 40 AS customerid", "id AS salesid")
    monkeypatch.setattr(layout, "SORT_BYTES", 1000 * (4 + 3 + 4) * layout.CELL_BYTES)  # 1000 such rows
    with catalog.scoped_namespaces(spark, ["silver"]) as spaces:
        catalog.publish(rows, spaces["silver"], "fact_sales", files=3)
        told = layout.optimize_table(spark, f"{spaces['silver']}.fact_sales")
        stored = catalog.table(spark, spaces["silver"], "fact_sales")
        most = max(r[1] for r in stored.groupBy(F.input_file_name()).count().collect())
        assert told[1:] == ("clustered", 3, 6) and most < 2000
        assert sorted(r.salesid for r in stored.collect()) == list(range(6000))


def test_large_files_are_written_by_several_tasks(spark, order_star, monkeypatch):
    want = sorted(map(str, LAYERS["compacted_sales"](order_star).collect()))
    monkeypatch.setattr(layers, "LARGE_FILE_ROWS", 1500)
    sizes, real = [], layout.compact
    monkeypatch.setattr(layout, "compact", lambda s, t, target: (
        sizes.extend(r[1] for r in s.table(t).groupBy(F.input_file_name()).count().collect()), real(s, t, target))[1])
    assert sorted(map(str, LAYERS["compacted_sales"](order_star).collect())) == want
    assert max(sizes) <= 1600 and len(sizes) == 12 + -(-order_star.rows("fact_sales") // 1500)


def test_raw_lines_meet_their_orders_once(spark, order_star):
    """Lines that come twice are repeated in their own task, not read and joined a second time."""
    rows = layers.raw_rows(order_star, "fact_sales")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Union" not in plan
    lines = spark.read.parquet(f"{order_star.folder}/lineitem.parquet")
    assert rows.count() == lines.count() + lines.filter(f"l_orderkey % {layers.REPEATED} = 0").count()


def test_raw_files_of_a_flow_are_compressed(spark, order_star, monkeypatch):
    seen = []
    monkeypatch.setattr(medallion, "load_bronze", lambda s, folder, layer: (
        seen.extend(catalog.data_files(s, f"{folder}/dim_store.csv")), [])[1])
    layers.through_layers(order_star, ["dim_store"], lambda made: spark.range(1))
    assert seen and all(n.endswith(".csv.gz") for n in seen)


def test_keys_of_distinct_loads_are_kept_on_disk(spark, order_star, monkeypatch, tmp_path):
    """A batch writes its own keys, not a copy of all earlier ones, and the session's own settings stay."""
    own = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(own)
    folder = f"{tmp_path}/in"
    layers.write_csv(layers.raw_rows(order_star, "fact_sales").repartition(4), folder)
    incremental.load_distinct(spark, folder, FACT_SALES, f"{tmp_path}/out", f"{tmp_path}/keys", files_per_batch=2)
    kept = [os.path.basename(f) for _, _, files in os.walk(f"{tmp_path}/keys/state") for f in files]
    assert any(f.endswith(".changelog") for f in kept) and not any(f.endswith(".delta") for f in kept)
    assert spark.conf.get(own) == before
    assert incremental.stored_batches(spark, f"{tmp_path}/out").count() == spark.read.parquet(f"{order_star.folder}/lineitem.parquet").count()


def test_distinct_sales_leave_no_shuffle_files_and_their_input_is_compressed(spark, monkeypatch, tmp_path):
    """What the input's join and each batch shuffled is gone when they have ended, whenever the driver collects its garbage."""
    spark.range(300).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "DATE '1995-02-01' AS o_orderdate", "'2-HIGH' AS o_orderpriority") \
        .write.parquet(f"{tmp_path}/star/orders.parquet")
    spark.range(900).selectExpr(
        "id div 3 AS l_orderkey", "id % 3 AS l_linenumber", "id % 11 AS l_partkey", "id % 5 AS l_suppkey", "CAST(2 AS DOUBLE) AS l_quantity",
        "CAST(id + 1 AS DOUBLE) AS l_extendedprice", "CAST(0.1 AS DOUBLE) AS l_discount", "CAST(0 AS DOUBLE) AS l_tax", "'N' AS l_returnflag"
    ).repartition(3).write.parquet(f"{tmp_path}/star/lineitem.parquet")
    dirs = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}
    seen, load = [], operator_queries.load_distinct

    def loaded(spark, folder, *more, **options):
        seen.append((catalog.data_files(spark, folder), shuffled() - before))
        load(spark, folder, *more, **options)
        seen.append((None, shuffled() - before))

    monkeypatch.setattr(operator_queries, "load_distinct", loaded)
    threshold, cleanup = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = [spark.conf.get(k, None) for k in (threshold, cleanup)]
    spark.conf.set(threshold, -1)
    try:
        before = shuffled()
        rows = operator_queries.stream_distinct_sales(OrderLineStar(spark, f"{tmp_path}/star")).collect()
    finally:
        spark.conf.unset(threshold) if own[0] is None else spark.conf.set(threshold, own[0])
    assert len(rows) == 900 and sorted(r.net for r in rows)[0] > 0
    assert seen[0][0] and all(n.endswith(".csv.gz") for n in seen[0][0])
    assert not seen[0][1] and not seen[1][1]
    assert spark.conf.get(cleanup, None) == own[1]
