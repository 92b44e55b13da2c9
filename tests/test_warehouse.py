import datetime as dt

from pyspark.sql import functions as F

from dimwright.contract import DimensionSpec, FactSpec
from dimwright.operators import checks, keys, warehouse


def test_calendar_flags(spark):
    dates = spark.createDataFrame([(dt.date(2024, 5, 5),)], "source_batch_date date")
    cal = {r["date"]: r for r in warehouse.calendar(dates).collect()}
    assert len(cal) == 366
    leap = cal[dt.date(2024, 2, 29)]
    assert leap["date_id"] == 20240229 and leap["is_month_end"] and leap["quarter"] == 1
    iso = cal[dt.date(2024, 12, 30)]
    assert iso["week_of_year"] == 1 and iso["day_name"] == "Monday"
    sunday = cal[dt.date(2024, 3, 31)]
    assert sunday["day_of_week"] == 0 and sunday["is_weekend"] and sunday["is_quarter_end"]
    assert sunday["month_name"] == "March" and sunday["is_month_end"]
    assert cal[dt.date(2024, 4, 1)]["is_quarter_start"] and cal[dt.date(2024, 4, 1)]["is_month_start"]


def test_surrogate_keys_dense_in_natural_key_order(spark):
    df = spark.createDataFrame([(k,) for k in [50, 3, 17, 8, 99, 1, 42]], "nk int").repartition(3)
    got = sorted((r["nk"], r["sk"]) for r in keys.assign_surrogate_keys(df, ["nk"], "sk", partitions=3).collect())
    assert [sk for _, sk in got] == list(range(1, 8))
    base = keys.assign_surrogate_keys(df, ["nk"], "sk", base=100, partitions=2).agg(F.min("sk")).first()[0]
    assert base == 101


def test_merge_upsert_keeps_keys_of_matched_rows(spark):
    target = spark.createDataFrame([("a", "v1", 1), ("b", "v1", 2), ("c", "v1", 3)], "nk string, val string, sk long")
    staging = spark.createDataFrame([("b", "v2"), ("d", "v2"), ("e", "v2")], "nk string, val string")
    out = {r["nk"]: (r["val"], r["sk"]) for r in keys.merge_upsert(target, staging, ["nk"], "sk").collect()}
    assert out == {"a": ("v1", 1), "b": ("v2", 2), "c": ("v1", 3), "d": ("v2", 4), "e": ("v2", 5)}


def test_merge_append_missing_does_nothing_on_conflict(spark):
    t = spark.createDataFrame([(1, "x")], "k int, v string")
    s = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert sorted(tuple(r) for r in keys.merge_append_missing(t, s, ["k"]).collect()) == [(1, "x"), (2, "z")]


def test_fact_drops_orphans_and_check_lists_them(spark):
    base = spark.createDataFrame([
        (1, "d1", dt.date(2024, 1, 1), 10.0, 1), (2, "ghost", dt.date(2024, 1, 1), 20.0, 2)],
        "entity int, driver string, source_batch_date date, amount double, entity_id long")
    drv = spark.createDataFrame([("d1", 7)], "driver string, driver_id long")
    spec = DimensionSpec(name="dim_entity", business_key="entity")
    fact = FactSpec("fact_x", "dim_entity", (("driver_id", "dim_driver", "driver", "driver"),),
                    (("amount_m", "amount"),))
    rows = warehouse.fact_rows(base, spec, fact, {"dim_driver": drv}).collect()
    assert [(r["entity_id"], r["driver_id"], r["date_id"], r["amount_m"]) for r in rows] == [(1, 7, 20240101, 10.0)]
    orphans = checks.fk_orphans(base, drv, "driver", "driver", ["entity"]).collect()
    assert [(r["entity"], r["driver"]) for r in orphans] == [(2, "ghost")]


def test_one_current_catches_entities_without_current_row(spark):
    d = spark.createDataFrame([(1, True), (2, False), (2, False), (3, True), (3, True)],
                              "k int, is_current boolean")
    got = sorted((r["k"], r["current_count"]) for r in checks.one_current(d, "k").collect())
    assert got == [(2, 0), (3, 2)]
