"""Streaming runners: file source, per-batch alerts replay, windowed restart."""

import pytest
from pyspark.sql import functions as F

from marketlens.session import scratch_dir
from marketlens.sources import fixtures as fx
from marketlens.sources import ticks as tk
from marketlens.streaming import alerts_stream as stx
from tests.conftest import SMALL


def test_micro_batches_are_idempotent(spark):
    ticks = fx.events_ticks(spark, SMALL)
    src_dir = scratch_dir(spark, "t_in")
    tk.ticks_as_json(ticks).repartition(4).write.text(src_dir)
    sink, ck = scratch_dir(spark, "t_sink"), scratch_dir(spark, "t_ck")
    stx.run_to_end(stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src_dir, 1), sink, ck))
    first = stx.read_alerts(spark, sink)
    n_batches = first.select("batch_id").distinct().count()
    assert n_batches >= 2                     # one file per trigger -> several batches
    ids = sorted(r.alert_id for r in first.collect())
    # replaying a batch rewrites its own folders: same rows, same ids
    batch0 = tk.parse_ticks(spark.read.text(src_dir))
    writer = stx.micro_batch_writer(sink, "replayed")
    writer(batch0, 10_000)
    writer(batch0, 10_000)
    again = stx.read_alerts(spark, sink).filter(F.col("batch_id") == 10_000).count()
    assert again == stx.batch_alert_table(batch0, 10_000, "replayed").count()
    # restarting on the same checkpoint processes nothing new
    stx.run_to_end(stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src_dir, 1), sink, ck))
    assert sorted(r.alert_id for r in stx.read_alerts(spark, sink)
                  .filter(F.col("batch_id") != 10_000).collect()) == ids


def test_another_checkpoint_adds_to_the_sink(spark):
    ticks = fx.events_ticks(spark, SMALL)
    src = tk.write_tick_files(ticks, scratch_dir(spark, "a_in"))
    sink = scratch_dir(spark, "a_sink")
    counts = []
    for _ in range(2):
        stx.run_to_end(stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src), sink, scratch_dir(spark, "a_ck")))
        counts.append(stx.read_alerts(spark, sink).count())
    assert counts[1] == 2 * counts[0] > 0
    assert stx.read_alerts(spark, sink).select("alert_id").distinct().count() == counts[1]


def test_empty_batch_writes_nothing(spark):
    sink = scratch_dir(spark, "empty_sink")
    empty = fx.events_ticks(spark, SMALL).limit(0).withColumn("event_time", F.col("event_time").cast("timestamp"))
    stx.micro_batch_writer(sink, "run")(empty.drop("seq"), 0)
    import glob
    assert not glob.glob(sink.replace("file:", "") + "/**/*.parquet", recursive=True)


def test_windowed_stream_equals_batch_windows(spark):
    from marketlens.operators.alerts import window_alerts

    ticks = fx.events_ticks(spark, SMALL)
    src = tk.write_tick_files(ticks.repartition(4), scratch_dir(spark, "w_in"))     # files not split by time
    sink, ck = scratch_dir(spark, "w_sink"), scratch_dir(spark, "w_ck")
    stx.run_to_end(stx.start_windowed_alerts(tk.read_tick_stream(spark, src, 1), sink, ck))
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == 4
    streamed = {r.alert_id: r for r in stx.read_windowed_alerts(spark, sink).collect()}
    batch = {r.alert_id: r for r in window_alerts(ticks).collect()}
    assert streamed and set(streamed) == set(batch)
    for k, r in streamed.items():
        assert r.asDict() == batch[k].asDict()


def test_windowed_runs_into_one_sink(spark):
    from marketlens.operators.alerts import window_alerts

    ticks = fx.events_ticks(spark, SMALL)
    want = {r.alert_id: r for r in window_alerts(ticks).collect()}
    halves = [ticks.filter(F.col("seq") % 5 == 0), ticks.filter(F.col("seq") % 5 != 0)]
    cases = [[(halves[0], None), (halves[1], None)],                              # other ticks: merged
             [(ticks, None), (ticks, None)],                                      # the same ticks: once
             [(halves[0], "feed"), (ticks, "feed")]]                              # a part again, of one named feed
    for case in cases:
        sink = scratch_dir(spark, "m_sink")
        for part, feed in case:
            src = tk.write_tick_files(part, scratch_dir(spark, "m_in"))
            stx.run_to_end(stx.start_windowed_alerts(tk.read_tick_stream(spark, src), sink, scratch_dir(spark, "m_ck"),
                                                     feed=feed))
        got = {r.alert_id: r for r in stx.read_windowed_alerts(spark, sink).collect()}
        assert want and set(got) == set(want)
        for k, r in got.items():
            assert r.price_at_alert == pytest.approx(want[k].price_at_alert)
            assert r.metric_value == pytest.approx(want[k].metric_value, abs=2e-6)


def test_ticks_dropped_by_a_watermark_are_an_error(spark):
    ticks = fx.events_ticks(spark, SMALL)
    src = tk.write_tick_files(ticks.repartition(4), scratch_dir(spark, "l_in"))
    sink, ck = scratch_dir(spark, "l_sink"), scratch_dir(spark, "l_ck")
    q = stx.start_windowed_alerts(tk.read_tick_stream(spark, src, 1), sink, ck, watermark="1 hour")
    with pytest.raises(stx.LateTicksError):
        stx.run_to_end(q)
    stx.run_to_end(q, accept_late=True)


def test_processing_time_trigger(spark):
    ticks = fx.events_ticks(spark, SMALL)
    src = tk.write_tick_files(ticks, scratch_dir(spark, "pt_in"))
    sink, ck = scratch_dir(spark, "pt_sink"), scratch_dir(spark, "pt_ck")
    q = stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src), sink, ck,
                                     trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    out = stx.read_alerts(spark, sink)
    assert out.count() > 0
    assert set(out.columns) >= {"alert_id", "symbol", "alert_type", "metric_value",
                                "threshold_value", "price_at_alert", "triggered_at", "batch_id"}


def _alert_ids(df):
    return sorted(r.alert_id for r in df.collect())


def test_a_quiet_market_has_an_empty_alert_table(spark):
    """One tick, no alert: pages, KPIs and both readers work on sinks without a file."""
    from marketlens.plans import reports as rp

    quiet = fx.events_ticks(spark, SMALL).limit(1)
    src = tk.write_tick_files(quiet, scratch_dir(spark, "q_in"))
    sinks = [scratch_dir(spark, "q_sink") for _ in range(3)]
    stx.run_to_end(stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src), sinks[0], scratch_dir(spark, "q_ck")))
    stx.run_to_end(stx.start_windowed_alerts(tk.read_tick_stream(spark, src), sinks[1], scratch_dir(spark, "q_ck")))
    for alerts in (stx.read_alerts(spark, sinks[0]), stx.read_windowed_alerts(spark, sinks[1]),
                   stx.read_alerts(spark, sinks[2]), stx.read_windowed_alerts(spark, sinks[2])):
        assert alerts.collect() == []
        assert rp.alert_kpis(rp.recent_alerts(alerts)).first().total_alerts == 0


def _files_of(sink, day):
    import glob
    return glob.glob(f"{sink}/day={day}/**/*.parquet", recursive=True) + \
        glob.glob(f"{sink}_compacted/data/day={day}/**/*.parquet", recursive=True)


@pytest.mark.parametrize("windowed", [False, True])
def test_compaction_keeps_the_alerts(spark, monkeypatch, windowed):
    import datetime as dt

    from marketlens.streaming import compaction as cp

    ticks = fx.events_ticks(spark, SMALL)
    src = tk.write_tick_files(ticks.repartition(6), scratch_dir(spark, "c_in"))
    sink, ck = scratch_dir(spark, "c_sink"), scratch_dir(spark, "c_ck")
    start, read, schema, merge = ((stx.start_windowed_alerts, stx.read_windowed_alerts, stx.WINDOW_STATS, stx.fullest) if windowed
                                  else (stx.start_micro_batch_alerts, stx.read_alerts, stx.ALERTS, lambda x: x))
    stx.run_to_end(start(tk.read_tick_stream(spark, src, 1), sink, ck))
    want = _alert_ids(read(spark, sink))
    days = sorted(r.day for r in spark.read.parquet(sink).select("day").distinct().collect())
    border = days[-1]
    before = read(spark, sink)                                # a reader that starts before the switch
    # a crash between the copy and its record: nothing changes
    with monkeypatch.context() as m:
        m.setattr(cp, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            cp.compact(spark, sink, schema, border, merge)
    assert _alert_ids(read(spark, sink)) == want
    assert cp.compact(spark, sink, schema, border, merge) == len(days) - (1 if border in days else 0)
    assert _alert_ids(read(spark, sink)) == want == _alert_ids(before)
    assert cp.compact(spark, sink, schema, border, merge) == 0
    # a batch that comes late for a compacted day, and a batch that is repeated
    extra = spark.read.schema(schema).parquet(sink).filter(F.col("day") == F.lit(days[0]))
    if windowed:
        some = extra.filter("symbol IS NOT NULL")
        stx.write_batch(stx.fullest(some).drop("run_id", "batch_id"), sink, "again", 7)     # nothing new of the same feeds
        grown = want
    else:
        late = extra.withColumns({"alert_id": F.concat("alert_id", F.lit("-late"))}).drop("run_id", "batch_id")
        stx.write_batch(late, sink, "late", 7)
        grown = sorted(want + [r.alert_id for r in late.collect()])
    one = spark.read.schema(schema).parquet(sink).filter((F.col("day") == F.lit(days[0])) & (F.col("batch_id") != 7)).first()
    again = spark.read.schema(schema).parquet(sink).filter((F.col("run_id") == one.run_id) & (F.col("batch_id") == one.batch_id))
    again = spark.createDataFrame(again.collect(), schema).drop("run_id", "batch_id")
    stx.write_batch(again, sink, one.run_id, one.batch_id)
    assert _alert_ids(read(spark, sink)) == grown
    assert cp.compact(spark, sink, schema, border, merge) == 1
    assert _alert_ids(read(spark, sink)) == grown
    assert cp.vacuum(spark, sink, schema) > 0
    assert _alert_ids(read(spark, sink)) == grown
    assert all(len(_files_of(sink, d)) <= 2 for d in days if d < border)
    assert isinstance(border, dt.date)


def test_late_ticks_of_early_batches_are_counted():
    """A query shows its last batches only; what was seen while it ran counts."""
    class Query:
        recentProgress = [{"batchId": 0, "stateOperators": [{"numRowsDroppedByWatermark": 3}]}]

    late = stx.LateTicks(Query)
    assert late.look() == 3
    Query.recentProgress = [{"batchId": b, "stateOperators": [{"numRowsDroppedByWatermark": 0}]} for b in range(120, 220)]
    assert late.look() == 3


def test_previous_price_over_batches_restarts_and_repeats(spark):
    import datetime as dt

    from marketlens.streaming import tick_stream as tsx

    at = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    schema = "symbol string, event_time timestamp, seq long, price double, volume long"
    batches = [[("A", at(1), 1, 10.0, 1), ("A", at(0), 0, 9.0, 1), ("B", at(5), 2, 1.0, 1), (None, at(1), 9, 1.0, 1)],
               [("A", at(9), 3, None, 1), ("C", None, 4, 7.0, 1)],
               [("A", at(8), 5, 12.0, 1), ("B", at(900_000), 6, 2.0, 1), ("C", None, 7, 8.0, 1)],
               [("A", at(900_001), 8, 13.0, 1), ("B", at(900_001), 9, 2.0, 1)]]
    sink, ck = scratch_dir(spark, "p_sink"), scratch_dir(spark, "p_ck")
    write = tsx.change_writer(sink, ck, "run", dt.timedelta(days=7))
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        write(df, i)
        write(df, i)                                          # repeated: the same prices, the same folders
    got = {r.seq: (r.prev_price, r.change_pct, r.direction) for r in tsx.read_changes(spark, sink).collect()}
    assert got == {0: (None, 0.0, None), 1: (9.0, 11.1111, "up"), 2: (None, 0.0, None), 3: (10.0, None, "flat"), 4: (None, 0.0, None),
                   5: (None, 0.0, None), 6: (1.0, 100.0, "up"), 7: (7.0, 14.2857, "up"), 8: (None, 0.0, None), 9: (2.0, 0.0, "flat")}
    state = {r.symbol: r.price for r in tsx.read_state(spark, ck, 3).collect()}
    assert state == {"A": 13.0, "B": 2.0, "C": 8.0}
    assert tsx.read_changes(spark, scratch_dir(spark, "none")).collect() == []


def test_newest_alerts_read_only_the_days_they_need(spark):
    import datetime as dt

    from marketlens.plans import reports as rp
    from marketlens.sources import bars as sb

    rows = [(f"{d:02}-{i}", "S", "PRICE_DROP", 0.1 * i, 0.03, 1.0, dt.datetime(2024, 3, d, 23 - i % 3) if d > 1 else None)
            for d in range(1, 29) for i in range(20)]
    alerts = spark.createDataFrame(rows, "alert_id string, symbol string, alert_type string, metric_value double, "
                                         "threshold_value double, price_at_alert double, triggered_at timestamp_ntz")
    stored = sb.materialise(alerts.withColumn("day", F.to_date("triggered_at")), scratch_dir(spark, "by_day"), partition_by="day")
    for n in (1, 20, 55, 60, 61, 540, 555, 1000):             # ties at the border, nulls, more than there are
        got, want = (rp.newest_alerts(rp.by_day(stored), rp.days_of(stored), n), rp.recent_alerts(alerts, n))
        assert [r.alert_id for r in got.collect()] == [r.alert_id for r in want.collect()], n
    plan = rp.newest_alerts(rp.by_day(stored), rp.days_of(stored), 45)._jdf.queryExecution().executedPlan().toString()
    read = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-03-28" in read and "2024-03-20" not in read, read
    empty = stored.filter("false")
    assert rp.newest_alerts(rp.by_day(empty), rp.days_of(empty), 5).collect() == []
