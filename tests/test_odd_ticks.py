"""The odd ticks' queries on more event ids than the range of a long has steps."""

import datetime as dt

import __spark_entry__ as e

STEP = 90_000_000_000_000
IDS = [1, 102_480, 102_481, 102_482, 102_483, 600_000, 6_000_001]


def _tables(spark, tmp_path) -> str:
    at = dt.datetime(2024, 1, 1)
    rows = [(i, at, k + 1, "A", float(i % 1000)) for k, i in enumerate(IDS)]
    (spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
     .write.parquet(f"{tmp_path}/events.parquet"))
    return str(tmp_path)


def test_sequences_stay_in_range_distinct_and_in_order(spark, tmp_path):
    rows = e.queries()["tick_change_odd"](spark, _tables(spark, tmp_path)).collect()
    seq = {r["seq"] for r in rows}
    last = 102_481 * STEP
    assert seq == {STEP, 102_480 * STEP, last, last + 1, last + 2, last + 497_519, last + 5_897_520}
    # ids divisible by 10 have no time and come first; the others follow in the ids' order
    order = sorted(IDS, key=lambda i: (i % 10 != 0, i))
    prices = [r["price"] for r in sorted(rows, key=lambda r: (r["event_time"] is not None, r["seq"]))]
    assert prices == [float(i % 1000) for i in order]
    previous = {r["seq"]: r["prev_price"] for r in rows}
    assert previous[last + 5_897_520] == 483.0 and previous[last + 497_519] == 480.0


def test_latest_is_the_last_id_of_the_last_time(spark, tmp_path):
    got = e.queries()["tick_latest_odd"](spark, _tables(spark, tmp_path)).collect()
    assert [tuple(r) for r in got] == [("A", 1.0, dt.datetime(2024, 1, 1))]
