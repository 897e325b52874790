"""Streams give the batch results, whatever the micro-batches, and repeated batches change nothing."""

import pytest
from pyspark.sql import functions as F

from rainledger import bindings as b
from rainledger import jobs
from rainledger.operators.merge import merge_images, merge_upsert
from rainledger.plans import gold, silver
from rainledger.plans.weather import silver_weather
from rainledger.schemas import SILVER_ORDER_DETAILS, SILVER_ORDERS, SILVER_PRODUCTS, SILVER_STORES, SILVER_WEATHER
from rainledger.session import scratch
from rainledger.sources import keyed
from rainledger.sources.cdc import read_cdc_stream
from rainledger.sources.paths import exists
from rainledger.sources.tables import Batch, ChecksFailed
from rainledger.streaming import pipelines
from rainledger.streaming.runner import drain_batches
from tests.helpers import plan, rows, ts

SF_DIR = "/root/testdata/sf0.001"
SPLITS = ["2024-01-05", "2024-01-12", "2024-01-20", "2024-02-20"]


def slices(df, at):
    lo = "2000-01-01"
    for hi in SPLITS:
        yield df.filter((F.col(at) > lo) & (F.col(at) <= hi))
        lo = hi


@pytest.fixture
def work(spark):
    return scratch(spark, "test")


def drained(spark, work, table, events, drain):
    for part in slices(events, "source_timestamp"):
        part.write.mode("append").parquet(f"{work}/landing")
        drain(read_cdc_stream(spark, f"{work}/landing", table, "parquet"))


def test_orders_and_stats(spark, work):
    events = b.order_cdc(spark, SF_DIR)
    drained(spark, work, "orders", events,
            lambda s: pipelines.stream_orders(s, f"{work}/orders", work, f"{work}/stats"))
    target = spark.createDataFrame([], SILVER_ORDERS)
    for part in slices(events, "source_timestamp"):
        target = silver.silver_orders(target, part)
    table = silver.read_orders(spark, f"{work}/orders")
    assert rows(table, *SILVER_ORDERS.names) == rows(target)
    assert rows(spark.read.parquet(f"{work}/stats").select(*gold.order_stats(target).columns)) == rows(gold.order_stats(target))


def stats_match(spark, work):
    want = gold.order_stats(silver.read_orders(spark, f"{work}/orders"))
    return rows(spark.read.parquet(f"{work}/stats").select(*want.columns)) == rows(want)


@pytest.mark.parametrize("lost", [("silver", "staged/orders"), ("pipelines", "staged/stats"), ("after", None)])
def test_statistics_count_a_lost_batch_once(spark, work, monkeypatch, lost):
    """Lost when both images are staged, when the orders have moved, or when all has; each time repeated."""
    class Lost(Exception):
        pass

    module = {"silver": silver, "pipelines": pipelines}.get(lost[0])
    deleted = b.order_cdc(spark, SF_DIR).filter(F.col("payload.store_id") % 4 == 0).withColumn(
        "source_metadata", F.col("source_metadata").withField("change_type", F.lit("DELETE")))
    parts = [*slices(b.order_cdc(spark, SF_DIR), "source_timestamp")][:2]
    parts.append(deleted.withColumn("source_timestamp", F.col("source_timestamp") + F.expr("INTERVAL 90 DAYS")))
    for number, part in enumerate(parts):
        args = part, Batch("run", number), f"{work}/orders", work, f"{work}/stats", True
        if module:
            real = module.replace_partitions
            with monkeypatch.context() as m:
                m.setattr(module, "replace_partitions", lambda *a, **k: (_ for _ in ()).throw(Lost()))
                with pytest.raises(Lost):
                    pipelines.merge_orders_batch(*args)
            assert module.replace_partitions is real
        else:
            pipelines.merge_orders_batch(*args)
        pipelines.merge_orders_batch(*args)
        assert stats_match(spark, work)
    assert spark.read.parquet(f"{work}/stats").filter(F.col("store_id") % 4 == 0).isEmpty()


def test_statistics_change_by_the_keys_of_the_batch(spark, work):
    """A day that holds an order unknown to the statistics shows that no other order is read for them."""
    def batch(number, *orders):
        df = spark.createDataFrame([(k, 1, 1, "x", s, a, ts("01 10:00"), ts(f"02 0{number}:00")) for k, s, a in orders], SILVER_ORDERS)
        changes = []
        silver.merge_orders_table(f"{work}/orders", df, f"{work}/staged/orders", Batch("r", number), before=lambda old, new: changes.append(
            pipelines.staged(gold.added_sums(gold.order_sums(old, -1).unionByName(gold.order_sums(new))), f"{work}/staged/changes", Batch("r", number))))
        return changes[0]

    def stats():
        return sorted((r.status, r.order_count, r.total_revenue, r.avg_order_value) for r in spark.read.parquet(f"{work}/stats").collect())

    for number, orders in enumerate([[("a", "New", 1.5), ("b", "New", None)], [("c", "New", 9.0)]]):
        changes = batch(number, *orders)
        if number == 0:
            pipelines.add_to_stats(changes, f"{work}/stats", f"{work}/orders", f"{work}/staged/stats", Batch("r", 0))
    assert stats() == [("New", 2, 1.5, 1.5)]  # without c
    pipelines.add_to_stats(batch(2, ("a", "Done", 2.5)), f"{work}/stats", f"{work}/orders", f"{work}/staged/stats", Batch("r", 2))
    assert stats() == [("Done", 1, 2.5, 2.5), ("New", 1, None, None)]


def test_repeated_order_batch_changes_nothing(spark, work):
    """The first try is lost after the swap, or between staging and swap: same table either way."""
    first, second, *_ = slices(b.order_cdc(spark, SF_DIR), "source_timestamp")
    path = f"{work}/orders"
    for i, part in enumerate((first, second, second)):
        source = silver.latest_changes(part, "orders").drop("source_timestamp")
        silver.merge_orders_table(path, source, f"{work}/staged", Batch("run", min(i, 1)))
        if i == 1:
            once = rows(silver.read_orders(spark, path))
    assert rows(silver.read_orders(spark, path)) == once


def test_old_days_are_not_rewritten(spark, work, tmp_path):
    path = str(tmp_path / "orders")
    def order(key, month, status, minute):
        at = ts("01 00:00").replace(month=month)
        return (key, 1, 1, "Delivery", status, 1.0, at, at.replace(minute=minute))
    def put(batch, *orders):
        source = spark.createDataFrame(list(orders), SILVER_ORDERS)
        return silver.merge_orders_table(path, source, f"{work}/staged", Batch("run", batch))
    put(0, order("jan", 1, "Pending", 0), order("feb", 2, "Pending", 0))
    january = {f.name for f in (tmp_path / "orders" / "created_date=2024-01-01").iterdir()}
    changed = put(1, order("feb", 2, "Completed", 5), order("mar", 3, "Pending", 0))
    assert rows(changed, "order_id", "status") == [("feb", "Completed"), ("mar", "Pending")]
    assert {f.name for f in (tmp_path / "orders" / "created_date=2024-01-01").iterdir()} == january
    # an update that carries another creation time still finds its order and leaves that time alone
    moved = order("feb", 5, "Cancelled", 0)
    changed = put(2, moved)
    assert rows(silver.read_orders(spark, path), "order_id", "status", "created_date")[0][:2] == ("feb", "Cancelled")
    assert silver.read_orders(spark, path).filter("order_id = 'feb'").count() == 1


def test_order_details(spark, work):
    events = b.order_detail_cdc(spark, SF_DIR)
    work_dir = f"{work}/details"
    first, second = events.filter("source_timestamp < '2024-01-01 01:00:00'"), events
    for part in (first, second, first):
        part.write.mode("append").parquet(f"{work}/landing")
        stream = read_cdc_stream(spark, f"{work}/landing", "order_details", "parquet")
        pipelines.stream_order_details(stream, work_dir, work)
    got = silver.read_order_details(spark, work_dir)
    target = spark.createDataFrame([], SILVER_ORDER_DETAILS)
    for part in (first, second):
        target = silver.silver_order_details(target, part)
    assert rows(got.select(*target.columns)) == rows(target)


@pytest.mark.parametrize("name, events, schema", [
    ("products", b.product_cdc, SILVER_PRODUCTS), ("stores", b.store_cdc, SILVER_STORES)])
def test_dimensions(spark, work, name, events, schema):
    rows_in = events(spark, SF_DIR)
    drained(spark, work, name, rows_in, lambda s: pipelines.stream_dimension(s, name, f"{work}/dim", work))
    step = getattr(silver, f"silver_{name}")
    target = spark.createDataFrame([], schema)
    for part in slices(rows_in, "source_timestamp"):
        target = step(target, part)
    table = silver.scd2_table(spark, f"{work}/dim", schema)
    assert rows(table, *schema.names) == rows(target)
    # closed versions lie with those of their month
    closed = silver.closed_versions(spark, f"{work}/dim", schema)
    assert rows(closed.select(F.col("closed_in") - F.date_format("valid_to", "yyyyMM")).distinct()) == [(0,)]


def test_repeated_dimension_batch_changes_nothing(spark, work):
    path = f"{work}/dim"
    for part in slices(b.product_cdc(spark, SF_DIR), "source_timestamp"):
        for _ in range(2):
            silver.apply_scd2_table(path, SILVER_PRODUCTS, silver.latest_changes(part, "products"), "product_id",
                                    silver.TRACKED["products"])
    target = spark.createDataFrame([], SILVER_PRODUCTS)
    for part in slices(b.product_cdc(spark, SF_DIR), "source_timestamp"):
        target = silver.silver_products(target, part)
    assert rows(silver.scd2_table(spark, path, SILVER_PRODUCTS), *SILVER_PRODUCTS.names) == rows(target)


def parquet_stream(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_weather_copies_in_later_batches(spark, work):
    bronze = b.bronze(spark, SF_DIR)
    for part in (bronze.filter("fetched_at < '2024-01-10'"), bronze, bronze):
        part.write.mode("append").parquet(f"{work}/landing")
        pipelines.stream_weather(parquet_stream(spark, f"{work}/landing", bronze.schema), f"{work}/weather", work, "2024-02-01")
    want = silver_weather(bronze, "2024-02-01")
    assert rows(spark.read.parquet(f"{work}/weather").select(*want.columns)) == rows(want)


READING = "city_id int, city_name string, source string, fetched_at timestamp, condition string"


def test_dedup_keeps_late_readings_within_the_delay_only(spark, work):
    def read(at, condition="Rain"):
        return (1, "Hanoi", "openmeteo", ts(at), condition)
    batches = [[read("01 10:00"), read("01 10:00"), read("01 12:00")],
               [read("01 11:00"), read("01 12:00"), read("02 00:00")],   # late but within the delay
               [read("01 09:00"), read("02 01:00")]]                     # later than the delay: dropped
    for batch in batches:
        spark.createDataFrame(batch, READING).coalesce(1).write.mode("append").parquet(f"{work}/landing")
        stream = parquet_stream(spark, f"{work}/landing", READING)
        dropped = pipelines.stream_dedup(stream, f"{work}/weather", work, "2 hours")
    assert dropped == 1
    assert rows(spark.read.parquet(f"{work}/weather"), "fetched_at") == [
        (ts(t),) for t in ("01 10:00", "01 11:00", "01 12:00", "02 00:00", "02 01:00")]


@pytest.mark.parametrize("late", [False, True])
def test_consensus_counts_every_reading(spark, work, late):
    weather = b.weather(spark, SF_DIR).withColumn("ingested_at", F.current_timestamp())
    parts = list(slices(weather, "fetched_at"))
    for part in reversed(parts) if late else parts:
        part.write.mode("append").parquet(f"{work}/landing")
        stream = parquet_stream(spark, f"{work}/landing", weather.schema)
        pipelines.stream_consensus(stream, f"{work}/weather", f"{work}/consensus", work)
    want = gold.weather_consensus(weather)
    got = spark.read.parquet(f"{work}/consensus")
    keys = ["city_id", "date_hour", "city_name", "majority_condition", "source_count"]
    assert rows(got, *keys) == rows(want, *keys)


def test_enrichment(spark, work):
    orders = b.orders(spark, SF_DIR)
    stores, consensus = b.versioned_stores(spark, SF_DIR), gold.weather_consensus(b.weather(spark, SF_DIR))
    for part in slices(orders, "created_at"):
        part.write.mode("append").parquet(f"{work}/landing")
        stream = parquet_stream(spark, f"{work}/landing", orders.schema)
        pipelines.stream_enrich(stream, stores, consensus, f"{work}/out", work)
    got = spark.read.parquet(f"{work}/out")
    assert got.count() == orders.count()
    assert got.filter("created_at < '2024-01-11'").join(
        b.stores(spark, SF_DIR).select("store_id", F.col("city_id").alias("home")), "store_id"
    ).filter("city_id <> home").count() == 0


def test_current_state_follows_reading_time(spark, work):
    def read(city, at, condition):
        return (city, f"CITY_{city}", ts(at), condition, 20.0, 1.0, 50)
    ddl = ("city_id int, city_name string, fetched_at timestamp, condition string, temperature double, "
           "wind_speed double, humidity int")
    for batch in ([read(1, "02 10:00", "Rain"), read(2, "01 10:00", "Fog")],
                  [read(1, "02 09:00", "Clear"), read(2, "03 10:00", "Clear"), read(3, "01 00:00", "Snow")]):
        spark.createDataFrame(batch, ddl).write.mode("append").parquet(f"{work}/landing")
        pipelines.stream_current_state(parquet_stream(spark, f"{work}/landing", ddl), f"{work}/state", work)
    assert rows(spark.read.parquet(f"{work}/state"), "city_id", "condition") == [(1, "Rain"), (2, "Clear"), (3, "Snow")]


def test_null_keys_are_appended_once(spark, work):
    reading = (None, "Hanoi", None, ts("02 10:00"), 1.0, 2, 3.0, 4.0, "Rain", ts("02 11:00"))
    other = (None, "Hanoi", "openmeteo", ts("02 10:00"), 1.0, 2, 3.0, 4.0, "Rain", ts("02 11:00"))
    for batch in ([reading], [reading, other], [reading]):
        silver.append_weather(f"{work}/weather", spark.createDataFrame(batch, SILVER_WEATHER))
    assert silver.read_weather(spark, f"{work}/weather").count() == 2
    line = (None, "1", 2, 3, 4.0, 5.0)
    for _ in range(2):
        silver.append_order_details(f"{work}/details", spark.createDataFrame([line, ("1-1", *line[1:])], SILVER_ORDER_DETAILS))
    assert silver.read_order_details(spark, f"{work}/details").count() == 2


def test_a_stream_that_starts_over_neither_skips_nor_repeats(spark, work):
    """The checkpoint is reset while the staging folder and the table stay."""
    first, second, *_ = slices(b.order_cdc(spark, SF_DIR), "source_timestamp")
    for part, checkpoint in ((first, "c1"), (second, "c2")):
        part.write.mode("append").parquet(f"{work}/landing")
        stream = read_cdc_stream(spark, f"{work}/landing", "orders", "parquet")

        def merge(rows_in, batch):
            source = silver.latest_changes(rows_in, "orders").drop("source_timestamp")
            silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", batch)

        drain_batches(stream, merge, f"{work}/{checkpoint}")
    target = silver.silver_orders(spark.createDataFrame([], SILVER_ORDERS), first.unionByName(second))
    assert rows(silver.read_orders(spark, f"{work}/orders"), *SILVER_ORDERS.names) == rows(target)


def test_a_small_batch_reads_its_own_partitions_and_shuffles_no_table(spark, work):
    """Of a table in many parts, a batch of one key reads one part of its places, versions and lines, and one day."""
    log = silver.order_details_log(f"{work}/details")._replace(part_rows=500)
    lines = silver.latest_changes(b.order_detail_cdc(spark, SF_DIR), "order_details").drop("source_timestamp")
    log.append(lines, ["detail_id"])
    assert log.depth(spark) > 2
    few = log.rows(spark).limit(1)
    text = plan(log.lookup(few))
    assert "part" in text.split("PartitionFilters")[1].splitlines()[0] and "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert files(log.candidates(few)) == 1 and files(log.rows(spark)) >= 8
    for i, part in enumerate(slices(b.order_cdc(spark, SF_DIR), "source_timestamp")):
        silver.merge_orders_table(f"{work}/orders", silver.latest_changes(part, "orders"), f"{work}/staged", Batch("a", i))
    one = silver.latest_changes(b.order_cdc(spark, SF_DIR).filter("payload.order_id = '7'"), "orders").withColumn("status", F.lit("Moved"))
    changed = silver.merge_orders_table(f"{work}/orders", one.withColumn("updated_at", F.expr("updated_at + INTERVAL 1 DAY")), f"{work}/staged", Batch("a", 9))
    assert len(changed.select("created_date").distinct().collect()) == 1 and changed.filter("status = 'Moved'").count() == 1


def test_parts_grow_and_written_rows_follow_the_batch(spark, work):
    """Batches of equal size into a table that doubles and doubles: each writes its own rows, all rewriting together little more than the table."""
    log = silver.order_details_log(f"{work}/details")._replace(part_rows=40)
    depths, kept = [], 0
    for batch in range(12):
        lines = [(f"{batch}-{i}", str(batch), 1, 1, 1.0, 1.0) for i in range(60)]
        before = set(log.rows(spark).inputFiles()) if batch else set()
        log.append(spark.createDataFrame(lines, SILVER_ORDER_DETAILS), ["detail_id"])
        depths.append(log.depth(spark))
        kept += before <= set(log.rows(spark).inputFiles())
        assert log.rows(spark).count() == 60 * (batch + 1)
        found = log.lookup(spark.createDataFrame([("3-7",), ("0-1",), ("none",)], "detail_id string"))
        assert rows(found, "detail_id") == [(k,) for k in ("0-1", "3-7") if int(k[0]) <= batch]
    assert depths == sorted(depths) and depths[-1] >= 4 and kept >= 7  # the files of the other batches stayed as they were
    log.append(spark.createDataFrame(lines, SILVER_ORDER_DETAILS), ["detail_id"])
    assert log.rows(spark).count() == 720


def test_the_number_of_parts_is_bounded(spark, work, monkeypatch):
    """However large the table, its folders stop doubling; the parts grow then and nothing is lost or repeated."""
    monkeypatch.setattr(keyed, "MAX_DEPTH", 3, raising=False)
    log = silver.order_details_log(f"{work}/details")._replace(part_rows=2)
    for batch in (0, 1, 1, 2):
        lines = [(f"{batch}-{i}", str(batch), 1, 1, 1.0, 1.0) for i in range(200)]
        log.append(spark.createDataFrame(lines, SILVER_ORDER_DETAILS), ["detail_id"])
        assert log.depth(spark) == 3 and log.rows(spark).count() == 200 * (batch + 1)
    assert log.candidates(log.rows(spark)).select("part").distinct().count() == 8
    assert rows(log.lookup(spark.createDataFrame([("0-7",), ("2-199",), ("none",)], "detail_id string")), "detail_id") == [("0-7",), ("2-199",)]


def test_orders_are_found_whatever_creation_time_an_event_has(spark, work):
    def order(status, created, minute):
        at = None if created is None else ts(created)
        return ("a", 1, 1, "Delivery", status, 1.0, at, ts(f"05 00:{minute:02}"))
    for number, row in enumerate((order("Pending", "03 10:00", 0), order("Ready", None, 5), order("Completed", "04 11:00", 9), order("Old", "04 11:00", 1))):
        source = spark.createDataFrame([row], SILVER_ORDERS)
        for _ in range(2):
            silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", Batch("run", number))
    held = silver.read_orders(spark, f"{work}/orders")
    assert rows(held, "order_id", "status", "created_at") == [("a", "Completed", ts("03 10:00"))]
    first = spark.createDataFrame([("b", *order("Pending", None, 0)[1:])], SILVER_ORDERS)
    then = spark.createDataFrame([("b", *order("Ready", "03 10:00", 9)[1:])], SILVER_ORDERS)
    for number, source in enumerate((first, then)):
        silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", Batch("again", number))
    assert rows(silver.read_orders(spark, f"{work}/orders"), "order_id", "status") == [("a", "Completed"), ("b", "Ready")]


def test_places_are_made_for_a_table_that_has_none(spark, work):
    old = spark.createDataFrame([("a", 1, 1, "Delivery", "Pending", 1.0, ts("03 10:00"), ts("03 10:00"))], SILVER_ORDERS)
    old.withColumn("created_date", F.to_date("created_at")).write.partitionBy("created_date").parquet(f"{work}/orders")
    moved = spark.createDataFrame([("a", 1, 1, "Delivery", "Ready", 1.0, ts("09 10:00"), ts("09 10:00"))], SILVER_ORDERS)
    silver.merge_orders_table(f"{work}/orders", moved, f"{work}/staged", Batch("run", 0))
    assert rows(silver.read_orders(spark, f"{work}/orders"), "status", "created_at") == [("Ready", ts("03 10:00"))]


def test_deleted_orders_stay_away(spark, work):
    """Older events change nothing after a delete, newer ones make a new order; a day without orders goes; repeats change nothing."""
    fields = [*SILVER_ORDERS.fields, silver.PLACES["at"]]
    def put(number, events, gone=()):
        source = spark.createDataFrame([(k, 1, 1, "Delivery", s, 1.0, ts(c), ts(at), ts(at)) for k, s, c, at in events], type(SILVER_ORDERS)(fields)).withColumnRenamed("at", "source_timestamp")
        deleted = spark.createDataFrame([(k, ts(at)) for k, at in gone], "order_id string, source_timestamp timestamp")
        for _ in range(2):
            silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", Batch("run", number), deleted=deleted)
        return rows(silver.read_orders(spark, f"{work}/orders"), "order_id", "status")
    assert put(0, [("a", "Pending", "01 10:00", "01 10:00"), ("b", "Pending", "02 10:00", "02 10:00")]) == [("a", "Pending"), ("b", "Pending")]
    assert put(1, [], [("a", "03 00:00"), ("x", "03 00:00")]) == [("b", "Pending")]
    assert put(2, [("a", "Late", "01 10:00", "02 00:00"), ("x", "Late", "01 10:00", "02 00:00")]) == [("b", "Pending")]
    assert put(3, [("a", "Again", "05 10:00", "05 10:00")], [("b", "01 00:00")]) == [("a", "Again"), ("b", "Pending")]


def test_deleted_versions_stay_away_and_late_events_are_counted_once(spark, work):
    def put(events, gone=()):
        make = lambda rows_in, ddl: spark.createDataFrame([(*r[:-1], ts(r[-1])) for r in rows_in], ddl)
        incoming = make(events, "store_id int, city_id int, is_active int, source_timestamp timestamp")
        deleted = make(gone, "store_id int, source_timestamp timestamp")
        late = [silver.apply_scd2_table(f"{work}/dim", SILVER_STORES, incoming, "store_id", ["city_id", "is_active"], deleted) for _ in range(2)]
        table = silver.scd2_table(spark, f"{work}/dim", SILVER_STORES)
        assert late[0] == late[1]
        return late[0], rows(table, "city_id", "valid_from", "valid_to")
    one = (1, ts("01 00:00"), ts("03 00:00"))
    assert put([(7, 1, 1, "01 00:00")]) == (0, [(1, ts("01 00:00"), None)])
    assert put([], [(7, "03 00:00"), (8, "03 00:00")]) == (0, [one])
    assert put([(7, 2, 1, "02 00:00"), (8, 2, 1, "02 00:00")]) == (2, [one])
    assert put([(7, 3, 1, "04 00:00")]) == (0, [one, (3, ts("04 00:00"), None)])
    assert put([(7, 5, 1, "03 12:00")], [(7, "01 12:00")])[1] == [one, (3, ts("04 00:00"), None)]


def test_silver_keys_have_to_be_unique(spark, work):
    twice = spark.createDataFrame([("a", 1, 1, "Delivery", s, 1.0, ts(d), ts(d)) for s, d in (("Pending", "01 00:00"), ("Ready", "02 00:00"))], SILVER_ORDERS)
    twice.withColumn("created_date", F.to_date("created_at")).write.partitionBy("created_date").parquet(f"{work}/lake/silver/orders")
    with pytest.raises(ChecksFailed, match="orders"):
        jobs.check_silver(spark, f"{work}/lake")


def test_jobs_count_what_they_leave_out_and_start_where_told(spark, work):
    bronze = b.bronze(spark, SF_DIR).limit(20)
    odd = bronze.limit(3).withColumn("source", F.lit("unknown")).unionByName(bronze.limit(2).withColumn("fetched_at", F.lit("no time")))
    bronze.unionByName(odd).withColumn("year", F.lit(2024)).write.partitionBy("source", "year").parquet(f"{work}/bronze/weather")
    lost = jobs.silver_weather(spark, f"{work}/bronze", f"{work}/lake")
    assert lost == {"unknown_source": 3, "no_time": 2}
    b.store_cdc(spark, SF_DIR).write.parquet(f"{work}/bronze/cdc/stores")
    assert jobs.silver_cdc(spark, f"{work}/bronze", f"{work}/lake", "parquet", since="2024-01-20") == {"stores": 0}
    kept = jobs.silver_tables(spark, f"{work}/lake")["stores"]
    assert kept.filter("valid_from <= '2024-01-20'").count() == 0 and kept.count() > 0


def test_rows_left_out_are_counted_by_the_jobs_that_write(spark, work, monkeypatch):
    bronze = b.bronze(spark, SF_DIR).limit(20)
    bronze.unionByName(bronze.limit(3).withColumn("source", F.lit("unknown"))).write.parquet(f"{work}/landing")

    def count(df):
        raise AssertionError("a job that only counts")

    monkeypatch.setattr(type(bronze), "count", count)
    lost = pipelines.stream_weather(parquet_stream(spark, f"{work}/landing", bronze.schema), f"{work}/weather", work)
    assert lost == {"unknown_source": 3, "no_time": 0}


def test_late_events_of_whole_batches(spark, work):
    events = silver.latest_changes(b.product_cdc(spark, SF_DIR), "products")
    assert silver.apply_scd2_table(f"{work}/dim", SILVER_PRODUCTS, events, "product_id", ["category"]) == 0
    old = events.withColumn("source_timestamp", F.lit("2000-01-01").cast("timestamp"))
    late = silver.apply_scd2_table(f"{work}/dim", SILVER_PRODUCTS, old, "product_id", ["category"])
    assert late == len(events.collect()) > 0
    empty = silver.apply_scd2_table(f"{work}/dim", SILVER_PRODUCTS, old.limit(0), "product_id", ["category"])
    assert empty == 0


def test_the_job_keeps_the_consensus_fresh(spark, work):
    """Payloads in two runs, into a lake that had readings before it had a consensus; Gold publishes what was kept."""
    bronze = b.bronze(spark, SF_DIR).withColumn("year", F.lit(2024))
    parts = [bronze.filter("fetched_at < '2024-01-10'"), bronze.filter("fetched_at >= '2024-01-10' AND fetched_at < '2024-01-20'"),
             bronze.filter("fetched_at >= '2024-01-20'")]
    landed = lambda part: part.write.mode("append").partitionBy("source", "year").parquet(f"{work}/bronze/weather")
    landed(parts[0])
    silver.append_weather(f"{work}/lake/silver/weather", silver_weather(parts[0]))
    for part in parts[1:]:
        landed(part)
        jobs.silver_weather(spark, f"{work}/bronze", f"{work}/lake", since="2024-01-10")
    kept = jobs.hourly_consensus(spark, f"{work}/lake")
    want = gold.weather_consensus(silver_weather(bronze))
    near = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
    assert rows(kept.select(*near)) == rows(want.select(*near))


def test_gold_is_not_published_over_a_broken_dimension(spark, work):
    """Versions that overlap, as a writer outside could leave them."""
    broken = [(1, 1, 1, ts("01 00:00"), ts("03 00:00"), False, 202401), (1, 2, 1, ts("02 00:00"), ts("04 00:00"), False, 202401)]
    schema = silver.closed_versions(spark, f"{work}/none", SILVER_STORES).schema
    spark.createDataFrame(broken, schema).write.partitionBy("closed_in").parquet(f"{work}/lake/silver/stores/closed")
    with pytest.raises(ChecksFailed, match="overlap"):
        jobs.build_gold(spark, f"{work}/lake", "broken_")


def test_jobs_wait_for_folders_that_are_not_there(spark, work):
    jobs.silver_weather(spark, f"{work}/bronze", f"{work}/lake")
    jobs.silver_cdc(spark, f"{work}/bronze", f"{work}/lake", "parquet")
    b.store_cdc(spark, SF_DIR).write.parquet(f"{work}/bronze/cdc/stores")
    jobs.silver_cdc(spark, f"{work}/bronze", f"{work}/lake", "parquet")
    jobs.register_silver(spark, f"{work}/lake")
    assert spark.sql("SELECT count(*) FROM silver_stores WHERE is_current").first()[0] > 0
    assert {n: t.count() for n, t in jobs.silver_tables(spark, f"{work}/lake").items() if n != "stores"} == {
        "orders": 0, "order_details": 0, "products": 0, "weather": 0}


def test_backlog_in_small_batches(spark, work):
    """Files in order of arrival, one per batch, end in the same orders."""
    events = b.order_cdc(spark, SF_DIR)
    for part in slices(events, "source_timestamp"):
        part.coalesce(1).write.mode("append").parquet(f"{work}/bronze/cdc/orders")
    jobs.silver_cdc(spark, f"{work}/bronze", f"{work}/lake", "parquet", max_files=1)
    target = spark.createDataFrame([], SILVER_ORDERS)
    for part in slices(events, "source_timestamp"):
        target = silver.silver_orders(target, part)
    assert rows(jobs.silver_tables(spark, f"{work}/lake")["orders"], *SILVER_ORDERS.names) == rows(target)


def test_a_batch_of_orders_is_located_once(spark, work):
    """What is read from the places is computed before they are written: Spark forgets it then and would compute it again."""
    first, second, *_ = slices(b.order_cdc(spark, SF_DIR), "source_timestamp")
    silver.merge_orders_table(f"{work}/orders", silver.latest_changes(first, "orders"), f"{work}/staged", Batch("a", 0))
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    source = silver.latest_changes(second, "orders")
    places = silver.order_places(f"{work}/orders")
    real = silver._newest_place
    counted = lambda rows_in: real(rows_in).mapInArrow(count, silver.PLACES)
    held = places.lookup(source).select("order_id").distinct().count()
    with pytest.MonkeyPatch.context() as m:
        m.setattr(silver, "_newest_place", counted)
        silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", Batch("a", 1))
    assert held and seen.value == held


def test_the_first_rows_of_a_log_are_written_once(spark, work):
    """A log that holds nothing gets its parts before its first rows are written, not after."""
    log = silver.order_details_log(f"{work}/details")._replace(part_rows=50)
    lines = silver.latest_changes(b.order_detail_cdc(spark, SF_DIR), "order_details").drop("source_timestamp")
    log.append(lines, ["detail_id"])
    assert log.depth(spark) > 5 and not exists(spark, f"{work}/details/depth=0")
    assert log.rows(spark).count() == lines.count()
    log.append(lines, ["detail_id"])
    assert log.rows(spark).count() == lines.count()


def test_a_changed_image_counts_once_in_each_group(spark, work):
    old = spark.createDataFrame([("a", 1.0, "x", 1), (None, 2.0, "x", 1), ("c", None, "x", 1), ("d", 4.0, "x", 9)], "k string, v double, fixed string, at int")
    new = spark.createDataFrame([("a", 5.0, "y", 2), (None, 6.0, "y", 2), ("c", 7.0, "y", None), ("d", 8.0, "y", 3), ("e", None, "y", None)], old.schema)
    assert rows(merge_images(old, new, "k", "at", ["v", "at"])) == rows(merge_upsert(old, new, "k", "at", ["v", "at"]))


def test_a_growing_log_writes_the_batch_once(spark, work, monkeypatch):
    """The batch that makes the parts too many goes straight into the new ones; a repeated one makes none."""
    log = silver.order_details_log(f"{work}/details")._replace(part_rows=100)
    lines = lambda batch, n: spark.createDataFrame([(f"{batch}-{i}", str(batch), 1, 1, 1.0, 1.0) for i in range(n)], SILVER_ORDER_DETAILS)
    written = []
    real = keyed.KeyedLog._write
    monkeypatch.setattr(keyed.KeyedLog, "_write", lambda self, rows_in, depth, mode: (written.append((rows_in.count(), depth, mode)), real(self, rows_in, depth, mode))[1])
    for batch in (lines(0, 80), lines(0, 80), lines(1, 300)):
        log.append(batch, ["detail_id"])
    assert written == [(80, 0, "append"), (0, 0, "append"), (380, 2, "overwrite")]
    assert log.rows(spark).count() == log.rows(spark).distinct().count() == 380


def test_payloads_are_kept_twice_only_for_the_state(spark, work, monkeypatch):
    kept = []
    real = pipelines.persisted
    monkeypatch.setattr(pipelines, "persisted", lambda df: (kept.append(df), real(df))[1])
    b.bronze(spark, SF_DIR).filter("city_id = 1").write.parquet(f"{work}/landing")
    stream = lambda: spark.readStream.schema(b.bronze(spark, SF_DIR).schema).parquet(f"{work}/landing")
    lost = pipelines.stream_weather(stream(), f"{work}/weather", f"{work}/a")
    assert not kept and lost == {"unknown_source": 0, "no_time": 0}
    assert pipelines.stream_weather(stream(), f"{work}/weather", f"{work}/b", state=f"{work}/state") == lost and len(kept) == 1
    assert silver.read_weather(spark, f"{work}/weather").count() == b.bronze(spark, SF_DIR).filter("city_id = 1").count()
