import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.operators.counting import group_counts
from vigilog.operators.counting import histogram
from vigilog.operators.grid import grid, grid_histogram, merged
from vigilog.plans.dashboard import LIVE_ARRIVAL, dashboard_rollup, live_dashboard, live_totals, rolled_counts, rolled_kpis
from vigilog.plans.event_view import VIEW, sec_all
from vigilog.schema import EMITTED, EVENT_COLUMNS, EVENT_SCHEMA, as_strings
from vigilog.sources.csv_events import raw_events, read_csv_events, stream_csv_events, stream_raw_csv, typed_events
from vigilog.sources.event_store import ARRIVAL, batch_ledger, latest_rows, newest_batches, read_event_store
from vigilog.streaming import totals as live
from vigilog.streaming.ingest import batch_writer, stamp_arrival, start_ingest
from vigilog.streaming.live import committed_snapshots, latest_snapshot, start_snapshots
from vigilog.streaming.totals import Total, compact, newest_stream, start_totals, total_so_far, totals_writer


class Feed:
    """A drop folder, a store and a checkpoint of one stream."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.drops, self.store, self.checkpoint = (str(root / n) for n in ("drops", "store", "checkpoint"))
        (root / "drops").mkdir()

    def drop(self, name, rows, emitted=None):
        """One CSV file; rows are (user information, protocol, severity, source address)."""
        with open(f"{self.drops}/{name}", "w", newline="") as file:
            writer = csv.DictWriter(file, EVENT_COLUMNS, restval="")
            writer.writeheader()
            for user, protocol, severity, address in rows:
                cells = {"User Information": user, "Protocol": protocol, "Severity Level": severity, "Source IP Address": address}
                writer.writerow(cells | {"Payload Data": 'two\nlines, "quoted"', EMITTED: emitted or ""})

    def events(self, **options):
        return stamp_arrival(stream_csv_events(self.spark, self.drops, **options))

    def ingest(self, checkpoint=None, **options):
        query = start_ingest(self.events(**options), self.store, checkpoint or self.checkpoint)
        query.awaitTermination()
        return query

    def stored(self):
        return read_event_store(self.spark, self.store)

    def users(self):
        return sorted(r[0] for r in self.stored().select("User Information").collect())


def numbered(start, n, severity="Low"):
    return [(f"{i:03d}", "TCP" if i % 2 else "UDP", severity, f"10.0.0.{i % 3}") for i in range(start, start + n)]


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_one_file_per_batch_with_counts(feed):
    for i in range(4):
        feed.drop(f"{i}.csv", numbered(i * 10, 10))
    feed.ingest(max_files=1)
    assert feed.users() == [f"{i:03d}" for i in range(40)]
    assert {r.batch_id: r.rows for r in batch_ledger(feed.spark, feed.store).collect()} == {0: 10, 1: 10, 2: 10, 3: 10}
    assert feed.stored().first()["Payload Data"] == 'two\nlines, "quoted"'


def test_restart_reads_only_new_files(feed):
    feed.drop("a.csv", numbered(0, 5))
    feed.ingest()
    feed.drop("b.csv", numbered(5, 5))
    feed.ingest()
    feed.ingest()
    assert feed.users() == [f"{i:03d}" for i in range(10)]


def test_a_running_stream_takes_files_as_they_come(feed):
    feed.drop("a.csv", numbered(0, 5))
    query = start_ingest(feed.events(), feed.store, feed.checkpoint, every="100 milliseconds")
    try:
        query.processAllAvailable()
        feed.drop("b.csv", numbered(5, 5))
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(feed.users()) == 10


def test_rows_appended_to_a_read_file_are_not_seen(feed):
    feed.drop("a.csv", numbered(0, 5))
    feed.ingest()
    feed.drop("a.csv", numbered(0, 8))
    feed.ingest()
    assert len(feed.users()) == 5


def test_a_batch_delivered_again_replaces_itself(spark, tmp_path):
    write, batch = batch_writer(str(tmp_path / "store")), spark.range(7).selectExpr("CAST(id AS STRING) AS Protocol")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert read_event_store(spark, str(tmp_path / "store")).count() == 14
    ledger = batch_ledger(spark, str(tmp_path / "store")).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r["first"], r["last"]) for r in ledger] == [(0, 7, None, None), (1, 7, None, None)]


def test_a_new_checkpoint_does_not_overwrite_stored_batches(feed, tmp_path):
    feed.drop("a.csv", numbered(0, 5))
    feed.ingest()
    feed.ingest(checkpoint=str(tmp_path / "another"))
    assert len(feed.users()) == 10 and feed.stored().select("stream_id").distinct().count() == 2


def test_arrival_stamp_is_set_only_where_missing(feed):
    feed.drop("a.csv", numbered(0, 2), emitted="2024-01-01 00:00:00")
    feed.drop("b.csv", numbered(2, 2))
    feed.ingest()
    stamps = dict(feed.stored().select("User Information", EMITTED).collect())
    assert stamps["000"] == stamps["001"] == "2024-01-01 00:00:00"
    assert stamps["002"] == stamps["003"] > "2024-01-01 00:00:00" and len(stamps["002"]) == 19


def test_stamp_on_a_frame_without_the_column(spark):
    assert stamp_arrival(spark.range(1)).filter(F.col(EMITTED).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")).count() == 1


def test_latest_rows_follow_arrival(feed):
    from vigilog.operators.ranking import latest

    for i in range(3):
        feed.drop(f"{i}.csv", numbered(i * 10, 10), emitted="2024-01-01 00:00:00")
        feed.ingest()
    last = [r["User Information"] for r in latest(feed.stored(), ["batch_id", "ingest_seq"], 12).collect()]
    assert last == [f"{i:03d}" for i in range(29, 17, -1)]
    assert set(ARRIVAL) <= set(feed.stored().columns)


def test_live_totals_equal_the_batch(spark, feed, rows, tmp_path):
    folder, checkpoint = str(tmp_path / "live"), str(tmp_path / "live-checkpoint")

    def refresh():
        totals = group_counts(feed.events(max_files=1), "Severity Level", "Protocol")
        start_snapshots(totals, folder, checkpoint).awaitTermination()
        return rows(latest_snapshot(spark, folder, totals))

    feed.drop("a.csv", numbered(0, 6, "High"))
    feed.drop("b.csv", numbered(6, 4, "Low"))
    assert refresh() == [("High", "TCP", 3), ("High", "UDP", 3), ("Low", "TCP", 2), ("Low", "UDP", 2)]
    feed.drop("c.csv", numbered(10, 1, "High"))
    assert refresh() == [("High", "TCP", 3), ("High", "UDP", 4), ("Low", "TCP", 2), ("Low", "UDP", 2)]


def test_live_totals_after_a_new_checkpoint(spark, feed, rows, tmp_path):
    """A stream started over counts its batches from 0: its one snapshot is newer than the two of the old one."""
    folder = str(tmp_path / "live")
    totals = group_counts(feed.events(max_files=1), "Protocol")
    feed.drop("a.csv", numbered(0, 1))
    start_snapshots(totals, folder, str(tmp_path / "c1")).awaitTermination()
    feed.drop("b.csv", numbered(1, 1))
    start_snapshots(totals, folder, str(tmp_path / "c1")).awaitTermination()
    feed.drop("b.csv", numbered(1, 6))
    every = group_counts(feed.events(), "Protocol")
    start_snapshots(every, folder, str(tmp_path / "c2"), keep=2).awaitTermination()
    assert sum(r[1] for r in latest_snapshot(spark, folder, every).collect()) == 7
    left = committed_snapshots(spark, folder)
    assert len(left) == 2
    for marker in Path(left[0].removeprefix("file:")).glob("_SUCCESS"):
        marker.unlink()  # not committed yet: the one before counts
    assert sum(r[1] for r in latest_snapshot(spark, folder, every).collect()) == 2


def test_the_stream_parses_as_the_batch(spark, tmp_path, rows):
    drops = tmp_path / "csv"
    drops.mkdir()
    cells = ["503.0,NA,1.5", "x,TCP,NaN", "7,,", "1e3,UDP,abc"]
    (drops / "a.csv").write_text("Packet Length,Protocol,Anomaly Scores\n" + "\n".join(cells) + "\n")
    names = ["Packet Length", "Protocol", "Anomaly Scores"]
    schema = T.StructType([EVENT_SCHEMA[n] for n in names])
    streamed = stream_csv_events(spark, str(drops), schema=schema, na_tokens=["NA"])
    store = str(tmp_path / "typed")
    start_ingest(streamed, store, str(tmp_path / "typed-checkpoint")).awaitTermination()
    stored = rows(spark.read.parquet(store).select(*[F.col(n).cast("string") for n in names]))
    batch = typed_events(read_csv_events(spark, str(drops), na_tokens=["NA"]))
    assert stored == rows(batch.select(*[F.col(n).cast("string") for n in names]))
    assert ("503", None, "1.5") in stored


def test_no_snapshot_yet_is_empty(spark, tmp_path):
    totals = group_counts(spark.range(3), "id")
    assert latest_snapshot(spark, str(tmp_path / "none"), totals).isEmpty()


def test_latest_rows_come_from_the_batches_that_can_hold_them(spark, feed):
    """Stamps tie across batches, an early batch has a late stamp, and only folders that can matter are read."""
    for name, start, stamp in (("a", 0, "2024-01-01"), ("b", 10, "2024-01-03"), ("c", 20, "2024-01-02"), ("d", 30, "2024-01-03"), ("e", 40, "2024-01-01")):
        feed.drop(f"{name}.csv", numbered(start, 10), emitted=stamp)
        feed.ingest()
    for n, batches in ((1, {1, 3}), (12, {1, 3}), (20, {1, 3}), (21, {1, 2, 3}), (31, {0, 1, 2, 3, 4}), (99, {0, 1, 2, 3, 4})):
        assert {r.batch_id for r in newest_batches(batch_ledger(spark, feed.store), n).collect()} == batches
        found = latest_rows(spark, feed.store, n)
        assert found.collect() == feed.stored().orderBy(*[F.desc(c) for c in ARRIVAL]).limit(n).collect()
        assert {f.split("batch_id=")[1][0] for f in found.inputFiles()} == {str(b) for b in batches}
    assert latest_rows(spark, f"{feed.store}-none", 5).count() == 0


def test_a_batch_without_its_ledger_entry_does_not_count_as_whole(spark, feed):
    feed.drop("a.csv", numbered(0, 4))
    feed.ingest()
    write = batch_writer(feed.store)

    class Stopped(Exception):
        pass

    def fail(*_):
        raise Stopped

    from vigilog.streaming import ingest

    written = ingest.write_text
    ingest.write_text = fail
    try:
        with pytest.raises(Stopped):
            write(feed.stored().drop("stream_id", "batch_id"), 7)
    finally:
        ingest.write_text = written
    assert [r.rows for r in batch_ledger(spark, feed.store).collect()] == [4]


def test_columns_go_by_each_files_header(spark, tmp_path, rows):
    drops = tmp_path / "drops"
    drops.mkdir()
    (drops / "a.csv").write_text("Protocol,Packet Length,Severity Level\nTCP,5,\"High,\n\"\"er\"\"\"\nUDP,x,Low\n")
    (drops / "b.csv").write_text("Severity Level,Protocol,Packet Length\nLow,ICMP,7\n,TCP,503.0\n")
    (drops / "c.csv").write_text("Protocol,Packet Length,Severity Level\n")
    (drops / "d.csv").write_text("Packet Length,Protocol\n9,TCP\n")  # lacks a column
    (drops / "e.csv").write_text("Severity Level,Another,Packet Length,Protocol\nLow,x,11,UDP\n")  # has one more
    schema = T.StructType([EVENT_SCHEMA[n] for n in ("Protocol", "Packet Length", "Severity Level")])
    want = rows(spark.createDataFrame([("TCP", 5, 'High,\n"er"'), ("UDP", None, "Low"), ("ICMP", 7, "Low"), ("TCP", 503, None), ("TCP", 9, None), ("UDP", 11, "Low")], schema))
    batch = typed_events(read_csv_events(spark, str(drops)))
    assert rows(batch.select(*schema.names)) == want and set(batch.columns) == {*schema.names, "Another"}
    assert rows(typed_events(read_csv_events(spark, str(drops), schema=as_strings(schema)))) == want
    store = str(tmp_path / "store")
    start_ingest(stream_raw_csv(spark, str(drops), schema), store, str(tmp_path / "c"), prepare=raw_events(schema)).awaitTermination()
    assert rows(spark.read.parquet(store), *schema.names) == want


def test_files_with_one_header_are_read_as_they_are(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("x,y\n1,2\n")
    plan = read_csv_events(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


class Live:
    """The dashboard's totals of a feed."""

    def __init__(self, feed, root):
        self.feed, self.folder, self.checkpoint = feed, str(root / "totals"), str(root / "totals-checkpoint")

    def run(self, checkpoint=None, **options):
        start_totals(self.feed.events(**options), self.folder, checkpoint or self.checkpoint, live_totals()).awaitTermination()

    def charts(self):
        return live_dashboard(self.feed.spark, self.folder)


def test_live_totals_serve_every_chart(spark, feed, rows, tmp_path):
    job = Live(feed, tmp_path)
    assert job.charts() == {}
    feed.drop("a.csv", [*numbered(0, 5, "High"), ("900", "", "", "")])
    feed.drop("b.csv", numbered(5, 3, "Low"))
    job.run(max_files=1)
    feed.drop("c.csv", numbered(8, 1, "High"))
    job.run()
    charts = job.charts()
    assert tuple(charts["kpis"].first()) == (10, 0, 6, None)
    assert rows(charts["protocol_counts"]) == [("TCP", 4), ("UDP", 5)]
    assert rows(charts["severity_counts"]) == [("High", 6), ("Low", 3)]
    assert [tuple(r) for r in charts["top_sources"].collect()] == [("10.0.0.0", 3), ("10.0.0.1", 3), ("10.0.0.2", 3)]
    assert charts["recent"].count() == 10 and charts["recent"].columns[:2] == [EMITTED, "Source IP Address"]
    last = total_so_far(spark, job.folder, "recent", live_totals()["recent"]).orderBy(*[F.desc(c) for c in LIVE_ARRIVAL]).first()
    assert last["User Information"] == "008"


def test_a_new_checkpoint_starts_the_totals_over(spark, feed, rows, tmp_path):
    job = Live(feed, tmp_path)
    feed.drop("a.csv", numbered(0, 4, "High"))
    job.run()
    first = newest_stream(spark, job.folder)
    feed.drop("b.csv", numbered(4, 3, "Low"))
    job.run(checkpoint=str(tmp_path / "another"), max_files=1)
    assert newest_stream(spark, job.folder) != first
    assert rows(job.charts()["severity_counts"]) == [("High", 4), ("Low", 3)]
    assert sum(r.event_count for r in job.charts()["top_sources"].collect()) == 7


def test_a_delivered_again_batch_changes_no_total(spark, tmp_path):
    totals = {"counts": Total(lambda b, _: group_counts(b, "k", name="n"), lambda r: r.groupBy("k").agg(F.sum("n").alias("n")))}
    write = totals_writer(str(tmp_path / "t"), totals)
    batch = spark.range(6).select((F.col("id") % 2).alias("k"))
    for number in (0, 1, 1, 1):
        write(batch, number)
    found = total_so_far(spark, str(tmp_path / "t"), "counts", totals["counts"])
    assert {r.k: r.n for r in found.collect()} == {0: 6, 1: 6}


def test_unbounded_counts_are_written_per_batch_and_compacted(spark, tmp_path, monkeypatch):
    """A batch writes its own keys alone; a base takes over what whole batches hold, but not the last one."""
    monkeypatch.setattr(live, "PENDING", 3)
    total = Total(lambda b, _: group_counts(b, "k", name="n"), lambda r: r.groupBy("k").agg(F.sum("n").alias("n")), bounded=False)
    folder = tmp_path / "t"
    write = totals_writer(str(folder), {"counts": total})
    stream = folder / "stream_id=None"
    for number in range(9):
        write(spark.range(number * 10, number * 10 + 15).select(F.col("id").alias("k")), number)
        assert spark.read.parquet(str(stream / f"batch={number}" / "counts")).count() == 15
        found = total_so_far(spark, str(folder), "counts", total)
        assert found.agg(F.sum("n"), F.count("*")).first()[:] == (15 * (number + 1), 10 * number + 15)
    bases = sorted(p.name for p in stream.glob("base-counts=*"))
    assert bases == ["base-counts=2", "base-counts=5"] and not (stream / "batch=1" / "counts").exists()
    before = rows_of(total_so_far(spark, str(folder), "counts", total))
    compact(spark, str(stream), "counts", total)
    assert rows_of(total_so_far(spark, str(folder), "counts", total)) == before


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_a_grid_of_parts_is_the_grid_of_all(spark, events, parts):
    """Whatever the order in which ranges grow: bounded rows, the same cells, the same bins."""
    values = sec_all(events).select("event_id", VIEW.anomaly)
    wild = values.union(spark.createDataFrame([(1, -7.5e6), (2, 3e9), (3, None), (4, float("nan")), (5, float("inf")), (6, 1e-9)], values.schema))
    for frame in (values, wild):
        whole = grid(frame, VIEW.anomaly)
        union = None
        for part in range(parts):
            own = grid(frame.filter(F.col("event_id") % parts == part), VIEW.anomaly)
            union = own if union is None else merged(union.unionByName(own))
        assert rows_of(union) == rows_of(whole) and whole.count() <= 4096
        assert rows_of(grid_histogram(union)) == rows_of(grid_histogram(whole))
        assert whole.agg(F.sum("cnt")).first()[0] == frame.filter(~F.isnan(VIEW.anomaly) & (F.abs(VIEW.anomaly) < float("inf"))).count()


def test_a_grid_histogram_is_near_the_exact_one(events):
    values = sec_all(events)
    near, exact = ({r["bin"]: r.cnt for r in h.collect()} for h in (grid_histogram(grid(values, VIEW.anomaly)), histogram(values, VIEW.anomaly)))
    assert sum(near.values()) == sum(exact.values()) and sum(abs(near.get(b, 0) - exact.get(b, 0)) for b in range(40)) <= 0.02 * sum(exact.values())


def test_a_grid_of_nothing_and_of_one_value(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert grid(none, "v").count() == 0 and grid_histogram(grid(none, "v")).count() == 0 and merged(grid(none, "v")).count() == 0
    one = grid(spark.createDataFrame([(1e300,), (1e300,)], "v double"), "v")
    assert [r.cnt for r in one.collect()] == [2] and [(r["bin"], r.cnt) for r in grid_histogram(one).collect()] == [(0, 2)]


def test_rollup_equals_the_plain_groups(events, rows):
    log = sec_all(events)
    rolled = dashboard_rollup(log, VIEW)
    for short, column in {"attack": VIEW.attack, "protocol": VIEW.protocol, "traffic": VIEW.traffic_type}.items():
        assert rows(rolled_counts(rolled, short)) == rows(group_counts(log.filter(F.col(column).isNotNull()), column))


def test_rollup_without_some_columns(events):
    kpis = rolled_kpis(dashboard_rollup(sec_all(events).drop(VIEW.attack, VIEW.anomaly), VIEW)).first()
    assert (kpis.total_logs, kpis.attack_types, kpis.avg_anomaly) == (1000, 0, None)
