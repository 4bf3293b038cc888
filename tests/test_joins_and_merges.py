import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.operators import dedupe, lookup, merge, partitions, rules
from skyloom.plans import dims
from skyloom.session import checkpointed

def as_of():
    return F.lit("2026-01-29 06:00:00").cast("timestamp_ntz")



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = dedupe.keep_first(df, ["k"], ["id"])
    assert sorted(rows(first)) == [(0, 0), (1, 1), (2, 2)]
    assert "WindowGroupLimit" in plan(first) and "Partial" in plan(first)


def test_keep_first_treats_null_as_a_value(spark):
    df = spark.createDataFrame([(None, "t", 1), (None, "t", 2), ("a", "t", 3)], "c string, t string, o int")
    assert sorted(r.o for r in dedupe.keep_first(df, ["c", "t"], ["o"]).collect()) == [1, 3]


def test_duplicate_members(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "a int")
    assert rows(dedupe.duplicate_members(df, ["a"])) == [(False, 4)]
    assert rows(dedupe.duplicate_members(df, ["missing"])) == [(False, 5)]
    assert rows(dedupe.duplicate_members(df.distinct(), ["a"])) == [(True, 0)]


def cities(spark):
    return spark.createDataFrame([(1, "Madrid"), (2, "Sevilla"), (3, "Madrid")], "city_id int, city_name string")


def test_unknown_city_is_dropped_and_repeated_name_does_not_fan_out(spark):
    fact = spark.createDataFrame([("Madrid",), ("Sevilla",), ("Nowhere",), (None,)], "city_name string")
    out = lookup.city_lookup(fact, cities(spark), how="inner")
    assert sorted(rows(out)) == [("Madrid", 3), ("Sevilla", 2)]
    left = {r.city_name: r.city_id for r in lookup.city_lookup(fact, cities(spark)).collect()}
    assert left["Nowhere"] is None and len(left) == 4


def test_fallback_name(spark):
    fact = spark.createDataFrame([("X", "Sevilla"), (None, "Madrid"), ("Sevilla", "Madrid")], "city_name string, city string")
    out = lookup.city_lookup(fact, cities(spark), fallback="city")
    assert sorted(r.city_id for r in out.collect()) == [2, 2, 3]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_large_dimension_with_a_hot_key_gives_the_same_rows(spark, how):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"), "id")
    dim = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = lookup.dim_join(fact, dim, "k", "k", {"v": "v"}, how)
    large = lookup.dim_join(fact, dim, "k", "k", {"v": "v"}, how, max_rows=10)
    assert sorted(rows(small), key=repr) == sorted(rows(large), key=repr)
    assert "BroadcastHashJoin" in plan(small)


def test_fits_broadcast_stops_at_the_bound(spark):
    assert lookup.fits_broadcast(spark.range(10), 10)
    assert not lookup.fits_broadcast(spark.range(11), 10)


def test_orphans_and_unknown_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (1, None), (5, "z")], "c int, d string")
    found = lookup.fk_orphans(fact, {"c": (spark.createDataFrame([(1,)], "i int"), "i"),
                                     "d": (spark.createDataFrame([("a",)], "i string"), "i")})
    assert sorted(rows(found)) == [("c", "5", 1), ("d", "z", 1)]


def test_first_keys(spark):
    df = spark.createDataFrame([(k,) for k in "dbacfe" * 2], "k string")
    assert [r.key for r in lookup.first_keys(df, "k", 3).collect()] == ["a", "b", "c"]


def test_wide_side_does_not_fit(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("t"))
    assert lookup.fits_broadcast(wide, 10, max_bytes=2000)
    assert not lookup.fits_broadcast(wide, 10, max_bytes=900)


def test_insert_twice(spark):
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, v string, o int")
    first = merge.insert_if_absent(batch, None, ["k"], ["o"])
    assert sorted(r.v for r in first.collect()) == ["a", "c"]
    assert merge.insert_if_absent(batch, first, ["k"], ["o"]).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.sets(st.integers(-1000, 1000), min_size=1, max_size=200), st.integers(0, 50))
def test_number_rows_is_dense_and_ordered(spark, keys, start):
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(3)
    out = sorted(rows(merge.number_rows(df, ["k"], "n", start)))
    assert out == [(k, start + i + 1) for i, k in enumerate(sorted(keys))]


def test_upsert_keeps_ids_and_numbers_new_keys(spark):
    target = spark.createDataFrame([(7, "a", "old", "x"), (9, "b", "old", "x")], "id int, k string, v string, extra string")
    source = spark.createDataFrame([("b", "n1", 1), ("b", "n2", 2), ("d", "n3", 3), ("c", "n4", 4)], "k string, v string, o int")
    out = merge.upsert(target, source, ["k"], ["v"], on_insert={"extra": F.lit("new")}, ident="id", order=["o"])
    assert sorted(rows(out)) == [(7, "a", "old", "x"), (9, "b", "n2", "x"), (10, "c", "n4", "new"), (11, "d", "n3", "new")]
    again = merge.upsert(out, source, ["k"], ["v"], on_insert={"extra": F.lit("new")}, ident="id", order=["o"])
    assert sorted(rows(again)) == sorted(rows(out))


def test_upsert_into_empty(spark):
    empty = spark.createDataFrame([], dims.CITY_COLUMNS)
    source = spark.createDataFrame([("08019", "Barcelona", 41.38, 2.17, "ES", 1)],
                                   "city_code string, city_name string, latitude double, longitude double, country_code string, is_coastal int")
    row = dims.upsert_cities(empty, source, as_of()).first()
    assert (row.city_id, row.city_code, str(row.latitude)) == (1, "08019", "41.380000")


def months(path):
    return partitions.MonthTable(str(path), "k int, d int", "d", ("k",), 4)


def test_month_partitions_on_disk(spark, tmp_path):
    store = months(tmp_path / "fact")
    assert store.open(spark).count() == 0
    df = spark.createDataFrame([(1, 20231231), (2, 20240101), (3, 20271231), (4, 20280115), (5, 20280201)], "k int, d int")
    assert store.append(store.placed(df)) == 5
    assert {r.p_month for r in store.open(spark).collect()} == {"default", "202401", "202712"}
    ranged = store.between(spark, 20240101, 20240131)
    assert [r.k for r in ranged.collect()] == [2]
    scan = next(line for line in plan(ranged).splitlines() if "FileScan" in line)
    assert "p_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    for _ in range(2):  # repeating it changes nothing
        assert store.add_month(spark, "fact", 2028, 1) == "fact_p202801"
        moved = {r.k: r.p_month for r in store.open(spark).collect()}
        assert moved == {1: "default", 2: "202401", 3: "202712", 4: "202801", 5: "default"}
    # rows whose month was declared later are found in either folder
    assert [r.k for r in store.between(spark, 20280101, 20280131).collect()] == [4]
    for month in (2, 12):
        store.add_month(spark, "fact", 2028 if month == 2 else 2023, month)
    assert {r.k: r.p_month for r in store.open(spark).collect()}[1] == "202312"


def test_a_new_session_finds_the_table(spark, tmp_path):
    store = months(tmp_path / "fact")
    store.append(store.placed(spark.createDataFrame([(1, 20240101)], "k int, d int")))
    spark.sql(f"DROP TABLE {store.name}")  # the catalog of another session does not know it
    assert [tuple(r) for r in store.open(spark).collect()] == [(1, 20240101, "202401")]


def test_batch_meets_the_buckets_where_they_are(spark, tmp_path):
    store = months(tmp_path / "fact")
    rows_ = [(i, 20240101 + 100 * (i % 12)) for i in range(200)]
    store.append(store.dealt(store.placed(spark.createDataFrame(rows_, "k int, d int"))))
    batch = store.placed(spark.createDataFrame([(i, 20240101 + 100 * (i % 12)) for i in range(0, 400, 6) if i % 12 in (0, 6)], "k int, d int"))
    batch = checkpointed(batch)
    merge_joins = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "3"}
    before = {k: spark.conf.get(k) for k in merge_joins}
    for k, v in merge_joins.items():
        spark.conf.set(k, v)
    try:
        known = store.touched(batch).select("k").withColumn("known", F.lit(True))
        met = store.dealt(dedupe.keep_first(batch, ["k"], ["d"])).join(known, "k", "left")
        assert sorted(r.k for r in met.collect() if not r.known) == [i for i in range(0, 400, 6) if i >= 200]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "months_" in line)
    join = max(i for i, line in enumerate(lines[:at]) if "SortMergeJoin" in line)
    side = max(i for i, line in enumerate(lines[:at]) if line.lstrip(" :").startswith("+- *") and i > join and "Sort [" in line)
    assert not any("Exchange" in line or "QueryStage" in line for line in lines[side:at])
    assert any("REPARTITION_BY_NUM" in line for line in lines[join:side])  # the batch moves, the table does not
    assert "Bucketed: true" in lines[at]
    pruned = lines[at].split("PartitionFilters: [")[1].split("]")[0]
    assert all(m in pruned for m in ("202401", "202407", "default")) and "202402" not in pruned
    # of twelve folders two are listed for the scan
    assert "InMemoryFileIndex(2 paths)" in lines[at]


def test_drop_all_null_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, None)], "i int, a double, b double")
    assert [r.i for r in rules.drop_all_null(df, ["a", "b"]).collect()] == [2]


def test_constraints(spark):
    df = spark.createDataFrame([("running",), ("lost",), (None,)], "status string")
    assert rows(rules.check_constraints(df, rules.run_log_rules())) == [("status_known", 1)]
    assert all(r.violations == 0 for r in rules.check_constraints(dims.dim_seasons(spark), rules.season_rules()).collect())
    assert all(r.violations == 0 for r in rules.check_constraints(dims.dim_layers(spark), rules.layer_rules()).collect())


def test_upsert_of_a_repeated_key_without_an_order(spark):
    target = spark.createDataFrame([(1, "a", 10)], "id int, k string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 2), ("a", 5), ("a", 4)], "k string, v int")
    out = merge.upsert(target, source, ["k"], ["v"], ident="id")
    assert sorted(rows(out)) == [(1, "a", 5), (2, "b", 2)]
    assert sorted(rows(merge.upsert(out, source, ["k"], ["v"], ident="id"))) == [(1, "a", 5), (2, "b", 2)]


def test_added_months_are_used_by_later_writes(spark, tmp_path):
    store = months(tmp_path / "facts")
    store.append(store.placed(spark.createDataFrame([(1, 20280105)], "k int, d int")))
    store.add_month(spark, "facts", 2028, 1)
    later = spark.createDataFrame([(2, 20280106), (3, 20290101)], "k int, d int")
    store.append(store.placed(later))
    found = {r.k: str(r.p_month) for r in store.open(spark).collect()}
    assert found == {1: "202801", 2: "202801", 3: "default"}
