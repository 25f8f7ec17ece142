from __future__ import annotations

import pathlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwatch.operators import models
from tillwatch.plans import program, shared
from tillwatch.session import shared_path
from tillwatch.sources import csv, tables
from tillwatch.streaming import operators as st
from tillwatch.streaming import replay, runs, seen

ARRIVALS = "tx_id long, event_time timestamp, type string, amount decimal(12,2)"


def arrivals(spark, *batches):
    """A file stream that reads one file per batch, in order."""
    path = shared_path(spark, "arrivals")
    for number, batch in enumerate(batches):
        data = [(i, t, "TRANSFER", Decimal(a)) for i, t, a in batch]
        df = spark.createDataFrame(data, "tx_id long, t string, type string, amount decimal(12,2)")
        df = df.select("tx_id", F.col("t").cast("timestamp").alias("event_time"), "type", "amount")
        df.coalesce(1).write.parquet(f"{path}/{number}")
    session = runs.stream_session(spark)
    return (
        session.readStream.schema(ARRIVALS)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def test_stream_scores_equal_batch_scores(spark, sf_dir):
    model = shared.fitted(spark, sf_dir, "rf")
    events = tables.event_transactions(tables.read_events(spark, sf_dir))
    batch = models.score(model, events).select("tx_id", "prediction")
    stream = tables.event_transactions(tables.read_event_stream(runs.stream_session(spark), sf_dir))
    scored = st.score_stream(stream, model).select("tx_id", "prediction")
    assert rows(runs.append_available(spark, scored, "scored")) == rows(batch)


def test_caller_settings_stay(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    session = runs.stream_session(spark)
    assert session.conf.get(key) == runs.ROCKSDB
    assert spark.conf.get(key) == before
    cores = spark.sparkContext.defaultParallelism
    assert int(session.conf.get("spark.sql.shuffle.partitions")) == cores
    assert int(runs.stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions")) == 3


def test_caller_settings_reach_the_stream(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7m")
    try:
        assert runs.stream_session(spark).conf.get("spark.sql.files.maxPartitionBytes") == "7m"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_run_that_drops_late_rows_fails(spark):
    stream = arrivals(
        spark,
        [(1, "2024-01-03 00:10:00", "5")],
        [(2, "2024-01-03 12:00:00", "5")],
        [(3, "2024-01-01 00:10:00", "5")],
    )
    with pytest.raises(RuntimeError, match="came later"):
        runs.update_available(spark, st.hourly_totals(stream, lateness="2 hours"), "late", ["window_start", "type"])


def test_three_hundred_ids_twice_and_again_after_expiry(spark):
    """Copies between first sight and return must not prolong the memory of an id."""
    first = [(i, "2024-01-01 00:10:00", "5") for i in range(300)]
    second = [(i, "2024-01-01 01:50:00", "5") for i in range(300)]
    late = [(i, "2024-01-01 02:40:00", "5") for i in range(300)]
    pause = [(1000, "2024-01-01 04:30:00", "5")]
    for _ in range(2):
        stream = arrivals(spark, first, second, pause, pause, late)
        unique = runs.append_available(spark, st.first_seen(stream), "expiry", may_drop=True)
        assert unique.filter("tx_id < 1000").count() == 600


KEYS = ["window_start", "type"]


def stored_bytes(folder):
    return sum(f.stat().st_size for f in pathlib.Path(folder.removeprefix("file://")).rglob("part-*"))


def hours(first, count):
    return [(first * 1000 + n, f"2024-01-{1 + n // 24:02d} {n % 24:02d}:10:00", "5") for n in range(count)]


def test_a_batch_writes_its_changed_rows_only(spark):
    """600 windows, then batches that change one of them."""
    stream = arrivals(spark, hours(1, 600), *[[(n, "2024-01-01 00:10:00", "5")] for n in range(5)])
    out = shared_path(spark, "log")
    query = runs.start_updates(st.hourly_totals(stream), out, shared_path(spark, "log-checkpoint"), KEYS)
    runs.finish(query)
    counts = [spark.read.parquet(f"{out}/batch_id={n}").count() for n in range(6)]
    assert counts == [600, 1, 1, 1, 1, 1]
    assert stored_bytes(f"{out}/batch_id=5") < stored_bytes(f"{out}/batch_id=0") / 4
    now = runs.read_updates(spark, st.hourly_totals(stream).schema, out, KEYS)
    assert rows(now.groupBy("n_rows").count()) == [(1, 599), (6, 1)]


@pytest.mark.parametrize("every", [1, 2, 3, 100])
def test_the_log_is_compacted_and_stays_the_same(spark, every):
    stream = arrivals(spark, *[[(n, f"2024-01-01 {n % 3:02d}:10:00", "5")] for n in range(8)])
    out, schema = shared_path(spark, "compacted"), st.hourly_totals(stream).schema
    query = runs.start_updates(
        st.hourly_totals(stream), out, shared_path(spark, "compacted-checkpoint"), KEYS, compact_every=every
    )
    runs.finish(query)
    read = rows(runs.read_updates(spark, schema, out, KEYS).select("n_rows"))
    assert read == [(2,), (3,), (3,)]
    folders = runs.staging.folders(spark, out)
    assert sum(f.startswith("base=") for f in folders) == min(2, 8 // every)
    assert sum(f.startswith("batch_id=") for f in folders) <= 2 * every + 1 or every == 100


def test_a_repeated_batch_changes_nothing(spark):
    schema = "k long, n long"
    out = shared_path(spark, "repeated")

    def write(number, *found, compact=False):
        spark.createDataFrame(list(found), schema).write.mode("overwrite").parquet(f"{out}/batch_id={number}")
        if compact:
            runs._compact(spark, spark.createDataFrame([], schema).schema, out, ["k"], number)

    def read():
        return rows(runs.read_updates(spark, spark.createDataFrame([], schema).schema, out, ["k"]))

    write(0, (1, 1), (2, 1))
    write(1, (1, 2), compact=True)
    assert read() == [(1, 2), (2, 1)]
    write(1, (1, 2), compact=True)  # the batch failed behind its base and comes again
    write(2, (1, 3))
    write(2, (1, 3))
    assert read() == [(1, 3), (2, 1)]
    spark.createDataFrame([(9, 9)], schema).write.parquet(f"{out}/base=2")  # a base that was never marked
    assert read() == [(1, 3), (2, 1)]


@pytest.mark.parametrize("files", [1, 6, 60])
def test_replay_is_never_late_and_closes_every_window(spark, sf_dir, files):
    events = tables.read_events(spark, sf_dir)
    folder = replay.in_time_order(events.repartition(7), "ts", "event_id", files, close_after="4 HOURS")
    assert spark.read.parquet(folder).count() == events.count() + 1
    stream = tables.event_transactions(tables.read_event_files(runs.stream_session(spark), folder, 1))
    totals = runs.append_available(spark, st.hourly_totals(stream, lateness="2 hours"), "replayed")
    assert rows(totals) == rows(st.hourly_totals(tables.event_transactions(events)))


def test_replay_of_an_empty_table(spark, sf_dir):
    events = tables.read_events(spark, sf_dir).limit(0)
    folder = replay.in_time_order(events, "ts", "event_id", 3, close_after="4 HOURS")
    assert spark.read.schema(tables.EVENT_SCHEMA).parquet(folder).count() == 0
    assert replay.file_number(0) == 6 and replay.file_number(10**8) == 100


@pytest.mark.parametrize("files", [1, 6, 60])
def test_unique_ids_of_a_replayed_table(spark, sf_dir, files):
    events = tables.read_events(spark, sf_dir)
    twice = events.unionAll(events.where("event_id % 3 = 0"))
    folder = replay.in_time_order(twice, "ts", "event_id", files)
    stream = tables.event_transactions(tables.read_event_files(runs.stream_session(spark), folder, 1))
    unique = seen.unique_available(spark, stream, "unique")
    assert rows(unique.select("tx_id")) == rows(events.select("event_id"))


def run_unique(spark, stream, **options):
    out, state = shared_path(spark, "seen-out"), shared_path(spark, "seen-state")
    runs.finish(seen.start_unique(stream, out, state, shared_path(spark, "seen-checkpoint"), **options))
    return out, state


def test_state_covers_the_lateness_and_not_the_stream(spark):
    """60 batches an hour apart with 50 ids each: what is remembered is a few of them."""
    batches = [
        [(100 * n + i, f"2024-01-{1 + n // 24:02d} {n % 24:02d}:10:00", "5") for i in range(50)] for n in range(30)
    ]
    out, state = run_unique(spark, arrivals(spark, *batches))
    kept = runs.staging.folders(spark, f"{state}/ids")
    assert len(kept) <= 7 and "29" in kept
    assert spark.read.parquet(out).count() == 30 * 50


def test_ids_return_after_their_time_like_the_built_in_step(spark):
    first = [(i, "2024-01-01 00:10:00", "5") for i in range(300)]
    second = [(i, "2024-01-01 01:50:00", "5") for i in range(300)]
    late = [(i, "2024-01-01 02:40:00", "5") for i in range(300)]
    pause = [(1000, "2024-01-01 04:30:00", "5")]
    out, _ = run_unique(spark, arrivals(spark, first, second, pause, pause, late))
    assert spark.read.parquet(out).filter("tx_id < 1000").count() == 600


def test_a_repeated_batch_of_ids_gives_the_same_rows(spark, monkeypatch):
    """The first run of batch 1 fails after it has written its rows and its ids."""
    batches = [[(1, "2024-01-01 00:10:00", "5")], [(1, "2024-01-01 00:20:00", "5"), (2, "2024-01-01 00:30:00", "5")]]
    stream = arrivals(spark, *batches, [(2, "2024-01-01 00:40:00", "5"), (3, "2024-01-01 00:40:00", "5")])
    out, state, checkpoint = (shared_path(spark, n) for n in ("again-out", "again-state", "again-checkpoint"))
    add = seen.SeenIds.add

    def failing(self, new, batch_id, *rest):
        add(self, new, batch_id, *rest)
        if batch_id == 1:
            raise ValueError("lost")

    monkeypatch.setattr(seen.SeenIds, "add", failing)
    with pytest.raises(Exception, match="lost"):
        runs.finish(seen.start_unique(stream, out, state, checkpoint))
    monkeypatch.setattr(seen.SeenIds, "add", add)
    runs.finish(seen.start_unique(stream, out, state, checkpoint))
    assert rows(spark.read.parquet(out).select("tx_id", "batch_id")) == [(1, 0), (2, 1), (3, 2)]


def test_late_rows_fail_a_run_that_may_not_drop(spark):
    stream = arrivals(spark, [(1, "2024-01-03 00:10:00", "5")], [(2, "2024-01-01 00:10:00", "5")])
    with pytest.raises(Exception, match="came later"):
        run_unique(spark, stream, may_drop=False)


def test_a_hot_id_is_one_row_per_task_before_it_moves(spark):
    hot = spark.range(0, 40_000, 1, 4).selectExpr(
        "CAST(7 AS LONG) AS tx_id", "timestamp_seconds(1704067200 + id % 60) AS event_time", "'TRANSFER' AS type",
        "CAST(5 AS DECIMAL(12,2)) AS amount",
    )
    assert seen.first_rows(hot, "tx_id", "event_time").count() == 1
    plan = seen.first_rows(hot, "tx_id", "event_time")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "partial_min_by" in below


@pytest.fixture
def folder_of_events(spark, sf_dir, tmp_path):
    """The event table as a folder of files in no order of time."""
    events = tables.read_events(spark, sf_dir)
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path), events


def test_totals_over_a_folder_one_file_at_a_time(spark, folder_of_events):
    folder, events = folder_of_events
    batch = st.hourly_totals(tables.event_transactions(events))
    stream = tables.read_event_stream(runs.stream_session(spark), folder, max_files_per_trigger=1)
    totals = runs.update_available(
        spark, st.hourly_totals(tables.event_transactions(stream)), "folder", ["window_start", "type"]
    )
    assert rows(totals) == rows(batch)
    assert totals.agg(F.sum("n_rows")).first()[0] == events.count()


def test_dedup_over_a_folder_one_file_at_a_time(spark, folder_of_events):
    folder, events = folder_of_events
    events.sample(0.3, 1).write.mode("append").parquet(f"{folder}/events.parquet")
    stream = tables.read_event_stream(runs.stream_session(spark), folder, max_files_per_trigger=1)
    unique = st.first_seen(tables.event_transactions(stream), lateness=tables.event_span(events))
    ids = runs.append_available(spark, unique, "folder-ids").select("tx_id")
    assert rows(ids) == rows(events.select("event_id"))


def test_a_missing_event_table_fails(spark, tmp_path):
    with pytest.raises(Exception, match="does not exist|FileNotFound"):
        tables.read_event_stream(spark, str(tmp_path))


def test_totals_of_the_program_in_six_batches(spark, sf_dir):
    raw = csv.read_raw(spark, shared.dirty_csv(spark, sf_dir))
    good = st.with_event_time(csv.good_rows(raw))
    path = shared_path(spark, "six")
    csv.write_lines(raw.repartition(6), [F.col(c) for c in csv.TX_COLUMNS], path)
    stream = csv.read_raw_stream(runs.stream_session(spark), path, max_files_per_trigger=1)
    totals = runs.update_available(
        spark, st.hourly_totals(st.with_event_time(csv.good_rows(stream))), "six", ["window_start", "type"]
    )
    # A surplus field is lost when the parsed rows are written again, so those rows are good here.
    n = raw.filter("amount <> 'zz'").count()
    assert totals.agg(F.sum("n_rows")).first()[0] == n >= good.count()


def test_windows_count_updates_over_batches(spark):
    stream = arrivals(
        spark,
        [(1, "2024-01-01 00:10:00", "5"), (2, "2024-01-01 00:20:00", "6")],
        [(3, "2024-01-01 00:50:00", "7"), (4, "2024-01-01 01:10:00", "8")],
    )
    totals = runs.update_available(spark, st.hourly_totals(stream), "totals", ["window_start", "type"])
    assert rows(totals.select("n_rows", "total_amount")) == [(1, Decimal(8)), (3, Decimal(18))]


def test_rows_later_than_the_watermark_are_dropped(spark):
    stream = arrivals(
        spark,
        [(1, "2024-01-01 00:10:00", "5")],
        [(2, "2024-01-01 12:00:00", "5")],
        [(3, "2024-01-01 12:10:00", "5")],
        [(4, "2024-01-01 00:30:00", "100"), (5, "2024-01-01 11:00:00", "5")],
    )
    totals = runs.update_available(
        spark, st.hourly_totals(stream, lateness="2 hours"), "late", ["window_start", "type"], may_drop=True
    )
    assert rows(totals.select("n_rows", "total_amount")) == [
        (1, Decimal(5)),
        (1, Decimal(5)),
        (2, Decimal(10)),
    ]


def test_repeated_ids_leave_once_across_batches(spark):
    first = [(1, "2024-01-01 00:10:00", "5")] * 20
    second = [(1, "2024-01-01 00:30:00", "5")] * 20 + [(2, "2024-01-01 00:40:00", "5")]
    unique = st.first_seen(arrivals(spark, first, second))
    assert rows(runs.append_available(spark, unique, "unique").select("tx_id")) == [(1,), (2,)]


def test_ids_may_come_back_after_the_watermark(spark):
    stream = arrivals(
        spark,
        [(1, "2024-01-01 00:10:00", "5")],
        [(2, "2024-01-01 12:00:00", "5")],
        [(3, "2024-01-01 12:10:00", "5")],
        [(1, "2024-01-01 12:20:00", "5")],
    )
    unique = runs.append_available(spark, st.first_seen(stream), "again")
    assert rows(unique.select("tx_id")) == [(1,), (1,), (2,), (3,)]


def test_alerts_equal_the_batch_rule(spark, sf_dir):
    events = tables.event_transactions(tables.read_events(spark, sf_dir))
    stream = tables.event_transactions(tables.read_event_stream(runs.stream_session(spark), sf_dir))
    alerts = runs.append_available(spark, st.alert_stream(stream), "alerts")
    assert rows(alerts.select("tx_id")) == rows(st.alert_stream(events).select("tx_id"))
    assert alerts.count() > 0


def test_event_time_of_the_first_hours(spark):
    df = spark.createDataFrame([(1,), (25,)], "step int")
    times = st.with_event_time(df).select(F.date_format("event_time", "yyyy-MM-dd HH:mm").alias("t"))
    assert rows(times) == [("2024-01-01 00:00",), ("2024-01-02 00:00",)]


def test_timeout_is_reported(spark):
    rate = runs.stream_session(spark).readStream.format("rate").load()
    query = runs.start_append(
        rate, shared_path(spark, "rate"), shared_path(spark, "rate-checkpoint"), processingTime="1 second"
    )
    with pytest.raises(TimeoutError):
        runs.finish(query, 2)
    assert not query.isActive


def test_watch_goes_on_where_it_stopped(spark, sf_dir, tx):
    folder, out = shared_path(spark, "inbox"), shared_path(spark, "watch")
    model = shared.fitted(spark, sf_dir, "lr")
    cells = {c: F.col(c) for c in tx.columns}
    kind = F.col("type")
    spoiled = {
        "type": F.when(kind == "CASH_OUT", "CASH_OUT,surplus").otherwise(kind),
        "oldbalanceOrg": F.when(F.col("nameOrig") != "C1231006815", F.col("oldbalanceOrg")),
    }
    for number, factor in enumerate((1, 2000)):
        changed = tx.withColumn("amount", F.col("amount") * factor)
        arriving = {**cells, **(spoiled if number else {})}
        csv.write_lines(changed, list(arriving.values()), f"{folder}/{number}")
        runs.finish(program.watch(spark, f"{folder}/*", model, out), 120)
    written = {n: spark.read.parquet(f"{out}/{n}") for n in ("scored", "unscored", "alerts", "rejects")}
    assert rows(written["scored"].groupBy("batch_id").count()) == [(0, 5), (1, 3)]
    assert rows(written["unscored"].select("batch_id", "nameOrig")) == [(1, "C1231006815")]
    assert written["unscored"].first().oldbalanceOrg is None
    assert rows(written["alerts"].select("batch_id", "nameOrig")) == [(1, "C1305486145")]
    reject = written["rejects"].first()
    assert reject.reject_reason == "malformed record" and "surplus" in reject.raw_line
