import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.plans.silver import latest_changes
from rainledger.schemas import BRONZE_WEATHER, SILVER_ORDERS, SILVER_WEATHER, cdc_schema
from rainledger.session import build_session, configure, scratch, work_dir
from rainledger.sources import bronze, masters, tables
from rainledger.sources.cdc import read_cdc
from rainledger.sources.paths import exists
from tests.helpers import plan, rows, ts


def test_missing_path_has_columns_but_no_rows(spark, tmp_path):
    df = read_cdc(spark, str(tmp_path / "none"), "orders", "parquet")
    assert df.schema == cdc_schema("orders")
    assert df.count() == 0
    assert latest_changes(df, "orders").count() == 0


def test_other_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(Exception, match="avro|DATA_SOURCE"):
        read_cdc(spark, str(tmp_path), "orders", "no-such-format-avro")


def test_nested_folders_and_json(spark, tmp_path):
    deep = tmp_path / "2024" / "01" / "02"
    deep.mkdir(parents=True)
    (deep / "part.json").write_text(
        '{"uuid":"u1","source_timestamp":"2024-01-02T00:00:00Z","source_metadata":{"change_type":"INSERT"},'
        '"payload":{"order_id":"o1","store_id":1,"total_amount":12.5,'
        '"created_at":{"date":"2024-01-02","time":36000000000}}}\n')
    df = read_cdc(spark, str(tmp_path), "orders", "json")
    assert rows(latest_changes(df, "orders"), "order_id", "total_amount", "created_at", "updated_at") == [
        ("o1", 12.5, ts("02 10:00"), None)]


def test_source_timestamp_as_micros(spark, tmp_path):
    schema = T.StructType([T.StructField(f.name, T.LongType()) if f.name == "source_timestamp" else f
                           for f in cdc_schema("stores")])
    spark.sql("SELECT 1704067200000000L AS source_timestamp, 'u' AS uuid").write.parquet(str(tmp_path / "cdc"))
    df = read_cdc(spark, str(tmp_path / "cdc"), "stores", "parquet", schema)
    assert rows(df, "source_timestamp") == [(ts("01 00:00"),)]


def envelopes(spark):
    return spark.createDataFrame(
        [(1, "Hà Nội", "openweather", "2024-01-01T23:30:00+00:00", "{}"),
         (1, "Hà Nội", "openweather", "2024-01-02T00:00:00+00:00", "{}"),
         (1, "Hà Nội", "openmeteo", "2024-01-02T08:00:00+07:00", "{}"),
         (1, "Hà Nội", "openmeteo", "not a time", "{}")], BRONZE_WEATHER)


def test_bronze_folders_and_bounds(spark, tmp_path):
    base = str(tmp_path / "weather")
    bronze.write_bronze_weather(envelopes(spark), base)
    assert (tmp_path / "weather" / "source=openmeteo" / "year=2024" / "month=01" / "day=02").is_dir()
    assert rows(bronze.read_bronze_weather(spark, base)) == rows(envelopes(spark))
    after = bronze.read_bronze_weather(spark, base, lo="2024-01-02T00:00:00")
    assert rows(after, "fetched_at") == [("2024-01-02T08:00:00+07:00",)]
    until = bronze.read_bronze_weather(spark, base, hi="2024-01-02T00:00:00")
    assert rows(until, "fetched_at") == [("2024-01-01T23:30:00+00:00",), ("2024-01-02T00:00:00+00:00",)]
    # the day bound prunes folders
    text = plan(after)
    assert "PartitionFilters: [" in text and "make_date" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert after.inputFiles() and bronze.read_bronze_weather(spark, str(tmp_path / "none"), lo="2024-01-01").count() == 0


def test_envelope_from_struct_keeps_utf8(spark):
    df = spark.createDataFrame([(1, "Hà Nội", "openweather", ts("01 10:00"), ("Mưa",))],
                               "city_id int, city_name string, source string, fetched_at timestamp, payload struct<main: string>")
    assert rows(bronze.bronze_envelope(df), "fetched_at", "raw_json") == [
        ("2024-01-01T10:00:00.000000+00:00", '{"main":"Mưa"}')]


def test_master_data(spark, tmp_path):
    data = {
        "stores": [(1, 10, "A", 1), (2, 20, "B", 0)], "customers": [(1, "x"), (2, "y")],
        "products": [(1, "Food", 2.5, 1), (2, "Food", 3.5, None)], "cities": [(10, "Hanoi", 21.0, 105.0, 1)],
    }
    ddl = {
        "stores": "store_id int, city_id int, store_name string, is_active int", "customers": "customer_id int, name string",
        "products": "product_id int, category string, price double, is_active int",
        "cities": "city_id int, city_name string, lat double, lon double, is_active int",
    }
    for name, values in data.items():
        spark.createDataFrame(values, ddl[name]).write.parquet(str(tmp_path / name))
    dims = masters.load_dims(masters.parquet_reader(spark, str(tmp_path)))
    assert {n: rows(d) for n, d in dims.items()} == {
        "stores": [(1, 10)], "customers": [(1,), (2,)], "products": [(1, "Food", 2.5)],
        "cities": [(10, "Hanoi", 21.0, 105.0)]}
    text = plan(dims["stores"])
    assert "EqualTo(is_active,1)" in text and "store_name" not in text


def test_ensure_and_append(spark):
    name = "silver_test.weather"
    tables.ensure_table(spark, name, SILVER_WEATHER, tables.WEATHER_PARTITIONS)
    tables.ensure_table(spark, name, SILVER_WEATHER, tables.WEATHER_PARTITIONS)
    row = (1, "Hanoi", "openweather", ts("02 10:00"), 1.0, 2, 3.0, 4.0, "Rain", ts("02 11:00"))
    df = spark.createDataFrame([row], SILVER_WEATHER)
    tables.append(df, name, tables.WEATHER_PARTITIONS)
    tables.append(df.select(*reversed(df.columns)), name, tables.WEATHER_PARTITIONS)
    table = spark.table(name)
    assert rows(table.select(*SILVER_WEATHER.names)) == [row, row]
    assert [p.name for p in spark.catalog.listColumns(name) if p.isPartition] == ["source", "fetched_date"]
    tables.ensure_table(spark, "silver_test.orders", SILVER_ORDERS, tables.ORDERS_PARTITIONS)
    assert "created_date" in spark.table("silver_test.orders").columns


def test_materialize_and_register(spark, tmp_path):
    tables.materialize(spark.range(3), "gold_numbers")
    tables.materialize(spark.range(2), "gold_numbers")
    assert spark.table("gold_numbers").count() == 2
    spark.range(4).write.parquet(str(tmp_path / "numbers.parquet"))
    tables.register_sources(spark, str(tmp_path), ["numbers"])
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 4


def test_publish_keeps_the_old_version_until_the_new_is_complete(spark, tmp_path):
    first = tables.publish(spark.range(3), "published", str(tmp_path))
    reader = spark.table("published")
    second = tables.publish(spark.range(5), "published", str(tmp_path))
    assert first != second
    assert reader.count() == 3 and spark.table("published").count() == 5
    with pytest.raises(Exception):
        tables.publish(spark.range(1).select(F.raise_error(F.lit("lost"))), "published", str(tmp_path))
    assert spark.table("published").count() == 5


def test_replace_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, p string")
    tables.replace_partitions(old, path, ["p"], str(tmp_path / "s1"), tables.Batch("a", 0))
    untouched = {f.name for f in (tmp_path / "t" / "p=b").iterdir()}
    # computed from the table it replaces
    table = spark.read.schema("v int, p string").parquet(path)
    new = table.filter("p = 'a' OR p IS NULL").withColumn("v", F.col("v") * 10)
    tables.replace_partitions(new, path, ["p"], str(tmp_path / "s2"), tables.Batch("a", 7))
    again = spark.read.schema("v int, p string").parquet(path)
    want = sorted([(10, "a"), (2, "b"), (30, None)], key=repr)
    assert rows(again) == want
    assert {f.name for f in (tmp_path / "t" / "p=b").iterdir()} == untouched
    # repeating the batch moves the staged rows again instead of computing from the new table
    changed = again.filter("p = 'a'").withColumn("v", F.col("v") * 10)
    tables.replace_partitions(changed, path, ["p"], str(tmp_path / "s2"), tables.Batch("a", 7))
    assert rows(spark.read.schema("v int, p string").parquet(path)) == want
    # the next batch uses the same staging folder for its own rows
    changed = spark.read.schema("v int, p string").parquet(path).filter("p = 'a'").withColumn("v", F.col("v") * 10)
    tables.replace_partitions(changed, path, ["p"], str(tmp_path / "s2"), tables.Batch("a", 8))
    assert rows(spark.read.schema("v int, p string").parquet(path)) == sorted([(100, "a"), (2, "b"), (30, None)], key=repr)


def test_another_stream_with_the_same_batch_number_is_computed(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    for run, value in (("a", 1), ("b", 2)):
        rows_in = spark.createDataFrame([(value, run)], "v int, p string")
        tables.replace_partitions(rows_in, path, ["p"], staging, tables.Batch(run, 0))
    assert rows(spark.read.schema("v int, p string").parquet(path)) == [(1, "a"), (2, "b")]


def test_a_failing_check_keeps_the_old_view(spark, tmp_path):
    at_most_two = lambda df: df.selectExpr("'rows' as rule", "count(*) as n").selectExpr("rule", "greatest(n - 2, 0) as violations")
    tables.publish(spark.range(2), "checked", str(tmp_path), at_most_two)
    with pytest.raises(tables.ChecksFailed, match="rows"):
        tables.publish(spark.range(3), "checked", str(tmp_path), at_most_two)
    assert spark.table("checked").count() == 2


def test_persisted_rows_are_let_go_when_a_job_fails(spark):
    with pytest.raises(RuntimeError), tables.persisted(spark.range(3)) as kept:
        assert kept.count() == 3
        raise RuntimeError
    assert not kept.is_cached


def test_work_dir_comes_from_the_session(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(work_dir(spark)) and scratch(spark, "x") != scratch(spark, "x")
    assert not exists(spark, scratch(spark, "x"))


def test_configure_sets_utc(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    assert configure(other).conf.get("spark.sql.session.timeZone") == "UTC"
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"
