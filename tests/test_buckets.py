"""Bucketed state and timelines: late changes, untouched files, publication."""

import random
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlake.operators.history import build_history
from ledgerlake.operators.timeline import as_dimension, broken_rows, build_timeline, day_states, splice
from ledgerlake.plans import buckets, warehouse
from ledgerlake.plans.layout import WarehousePaths
from ledgerlake.schemas import CHANGES_V1
from ledgerlake.sinks import buckets as sink
from ledgerlake.sources.buckets import Published, bucket_of, read_published

FEED = warehouse.Feed(CHANGES_V1, tracked=("segment",))
START = datetime(2024, 1, 1)


def feed(spark, rows):
    """rows: (seq, id, hours since START, op, segment)"""
    return spark.createDataFrame([(s, i, START + timedelta(hours=h), op, x, 1.0) for s, i, h, op, x in rows], CHANGES_V1)


def held(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


changes_strategy = st.lists(
    st.tuples(st.integers(1, 2), st.integers(0, 24 * 8 - 1), st.sampled_from("IUD"), st.sampled_from(["a", "b", None])),
    min_size=2, max_size=30,
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes_strategy, st.integers(0, 99))
def test_any_order_of_batches_gives_the_history_of_all(spark, changes, seed):
    rows = [(n, *c) for n, c in enumerate(changes)]
    whole = build_history(feed(spark, rows), ["segment"])
    random.Random(seed).shuffle(rows)
    timeline = build_timeline(day_states(feed(spark, []), ["segment"]), ["segment"])
    for part in (rows[::3], rows[1::3], rows[2::3], rows[::3]):
        timeline = held(spark, splice(timeline, day_states(feed(spark, part), ["segment"]), ["segment"]))
        assert broken_rows(timeline).count() == 0
    found = as_dimension(timeline, ["segment"])
    assert found.columns == whole.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, whole.collect()))


def test_a_late_change_cuts_the_row_it_falls_into(spark):
    rows = [(1, 1, 0, "I", "a"), (2, 1, 24 * 19, "U", "b"), (3, 1, 24 * 5, "U", "a")]
    timeline = build_timeline(day_states(feed(spark, rows), ["segment"]), ["segment"])
    late = day_states(feed(spark, [(9, 1, 24 * 9, "U", "m")]), ["segment"])
    found = as_dimension(splice(timeline, late, ["segment"]), ["segment"]).orderBy("start_date").collect()
    d = lambda n: date(2024, 1, n)
    assert [(r.segment, r.start_date, r.end_date) for r in found] == [("a", d(1), d(10)), ("m", d(10), d(20)), ("b", d(20), None)]
    # The day of the confirmation is remembered: a late change before it lasts until then.
    late = day_states(feed(spark, [(9, 1, 24 * 3, "U", "m")]), ["segment"])
    found = as_dimension(splice(timeline, late, ["segment"]), ["segment"]).orderBy("start_date").collect()
    assert [(r.segment, r.start_date) for r in found] == [("a", d(1)), ("m", d(4)), ("a", d(6)), ("b", d(20))]


def test_rows_beyond_the_neighbours_are_not_cut(spark):
    rows = [(n, 1, 24 * n, "U", "ab"[n % 2]) for n in range(20)]
    timeline = build_timeline(day_states(feed(spark, rows), ["segment"]), ["segment"])
    late = day_states(feed(spark, [(99, 1, 24 * 9 + 1, "U", "z")]), ["segment"])
    found = splice(timeline, late, ["segment"]).orderBy("start_date").collect()
    assert [r.segment for r in found] == ["ab"[n % 2] if n != 9 else "z" for n in range(20)]
    assert all(a.end_date == b.start_date for a, b in zip(found, found[1:], strict=False)) and found[-1].end_date is None


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def deliver(spark, paths, name, rows):
    warehouse.run_curation(feed(spark, rows), FEED, paths, name)


def test_a_batch_rewrites_the_buckets_it_touches_only(spark, tmp_path):
    paths = WarehousePaths.under(str(tmp_path))
    deliver(spark, paths, "d1", [(i, i, 0, "I", "a") for i in range(200)])
    deliver(spark, paths, "d2", [(900, 3, 30, "U", "b"), (901, 4, 30, "D", None)])
    first = buckets.run_bucketed_batch(spark, FEED, paths, "d1", buckets=32)
    before = files(paths.state_buckets) | files(paths.timeline_buckets)
    second = buckets.run_bucketed_batch(spark, FEED, paths, "d2", buckets=999)
    after = files(paths.state_buckets) | files(paths.timeline_buckets)
    touched = {str(r[0]) for r in spark.createDataFrame([(3,), (4,)], "id long").select(bucket_of("id", 32)).collect()}
    assert second.buckets == 32 and second.counters["touched_buckets"] == len(touched)
    assert {k: after[k] for k in before} == before
    assert {p.split("bucket=")[1].split("/")[0] for p in after.keys() - before.keys()} == touched
    for table in first.tables:
        assert {b for b in first.tables[table] if second.tables[table][b] != first.tables[table][b]} == touched
    assert buckets.read_bucketed_state(spark, FEED, paths).count() == 199
    assert buckets.read_bucketed_state(spark, FEED, paths, "d1").count() == 200
    changed = buckets.read_bucketed_dimension(spark, FEED, paths).where("end_date IS NOT NULL OR segment = 'b'")
    assert {(r.id, r.segment) for r in changed.collect()} == {(3, "a"), (3, "b"), (4, "a")}


def test_a_failed_job_leaves_readers_on_the_version_before(spark, tmp_path, monkeypatch):
    paths = WarehousePaths.under(str(tmp_path))
    deliver(spark, paths, "d1", [(1, 1, 0, "I", "a"), (2, 2, 0, "I", "a")])
    deliver(spark, paths, "d2", [(3, 1, 30, "U", "b")])
    buckets.run_bucketed_batch(spark, FEED, paths, "d1", buckets=4)
    real, calls = sink.write_buckets, []

    def failing(*args):
        calls.append(args[1])
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(buckets, "write_buckets", failing)
    with pytest.raises(OSError, match="lost"):
        buckets.run_bucketed_batch(spark, FEED, paths, "d2")
    assert calls == [paths.state_buckets, paths.timeline_buckets]
    read = lambda: {(r.id, r.segment) for r in buckets.read_bucketed_state(spark, FEED, paths).collect()}
    assert read() == {(1, "a"), (2, "a")}
    monkeypatch.setattr(buckets, "write_buckets", real)
    for _ in range(2):  # a rerun, and one more, change nothing further
        buckets.run_bucketed_batch(spark, FEED, paths, "d2")
        assert read() == {(1, "b"), (2, "a")}
        assert buckets.read_bucketed_dimension(spark, FEED, paths).count() == 3


def test_what_fails_the_audit_is_not_published(spark, tmp_path, monkeypatch):
    paths = WarehousePaths.under(str(tmp_path))
    deliver(spark, paths, "d1", [(1, 1, 0, "I", "a"), (2, 2, 0, "I", "a")])
    real = sink.write_buckets
    monkeypatch.setattr(buckets, "write_buckets", lambda rows, *rest: real(rows.where("id = 1"), *rest))
    with pytest.raises(sink.AuditError, match="not in the state"):
        buckets.run_bucketed_batch(spark, FEED, paths, "d1", buckets=4)
    assert read_published(spark, paths.published) is None
    with pytest.raises(ValueError, match="nothing is published"):
        buckets.read_bucketed_state(spark, FEED, paths)


def test_old_versions_go(spark, tmp_path):
    paths = WarehousePaths.under(str(tmp_path))
    for n in range(4):
        deliver(spark, paths, f"d{n}", [(10 * n + i, i, 24 * n, "U", f"s{n}") for i in range(n, 40, n + 1)])
        buckets.run_bucketed_batch(spark, FEED, paths, f"d{n}", buckets=8)
    state = lambda v: {(r.id, r.segment) for r in buckets.read_bucketed_state(spark, FEED, paths, v).collect()}
    kept = {v: state(v) for v in ("d2", "d3")}
    orphan = Path(paths.state_buckets) / "run=d9~never" / "bucket=1"
    orphan.mkdir(parents=True)
    (orphan / "part.parquet").write_text("")
    removed = buckets.run_cleanup(spark, paths, keep=2)
    assert removed and not orphan.parent.exists()
    assert {v: state(v) for v in ("d2", "d3")} == kept
    with pytest.raises(ValueError, match="nothing is published"):
        state("d1")
    needed = {f"run={run}/bucket={b}" for v in ("d2", "d3") for b, run in read_published(spark, paths.published, v).tables["state"].items()}
    there = {str(p.parent.relative_to(paths.state_buckets)) for p in Path(paths.state_buckets).rglob("*.parquet")}
    assert there == needed
    with pytest.raises(ValueError, match="at least one"):
        buckets.run_cleanup(spark, paths, keep=0)


def test_versions_rise(spark, tmp_path):
    paths = WarehousePaths.under(str(tmp_path))
    deliver(spark, paths, "2024-01-02", [(1, 1, 24, "I", "b")])
    deliver(spark, paths, "2024-01-01", [(2, 1, 0, "I", "a")])
    buckets.run_bucketed_batch(spark, FEED, paths, "2024-01-02", buckets=2)
    with pytest.raises(ValueError, match="published already"):
        buckets.run_bucketed_batch(spark, FEED, paths, "2024-01-01")
    buckets.run_bucketed_batch(spark, FEED, paths, "2024-01-01", "2024-01-02.late")
    rows = buckets.read_bucketed_dimension(spark, FEED, paths).orderBy("start_date").collect()
    assert [(r.segment, r.start_date) for r in rows] == [("a", date(2024, 1, 1)), ("b", date(2024, 1, 2))]
    assert [r.segment for r in buckets.read_bucketed_state(spark, FEED, paths).collect()] == ["b"]


def test_an_empty_delivery_and_a_table_without_rows(spark, tmp_path):
    paths = WarehousePaths.under(str(tmp_path))
    deliver(spark, paths, "d1", [])
    found = buckets.run_bucketed_batch(spark, FEED, paths, "d1", buckets=2)
    assert found.tables == {"state": {}, "timeline": {}} and found == read_published(spark, paths.published)
    assert isinstance(found, Published) and buckets.read_bucketed_state(spark, FEED, paths).count() == 0
