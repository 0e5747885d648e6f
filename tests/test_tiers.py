"""Tables in tiers, and the filters of stored keys."""

import itertools
import math

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tickloom.operators import dedup, membership, normalize, ohlcv
from tickloom.plans import maintenance
from tickloom.sinks import storage, tiers
from tickloom.sources import samples
from tickloom.streaming import jobs

DAY = "2024-01-03"


class Crash(Exception):
    pass


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(64).select("id", F.lit(DAY).cast("date").alias("dt"), F.pmod("id", F.lit(32)).alias("part")).persist()


def put(rows, path, batch, fan=4):
    spark = rows.sparkSession
    tiers.append(rows.where(F.col("part") == batch), path, batch, [DAY], ["id"])
    tiers.merge(spark, path, DAY, batch, sort_by=["id"], fan=fan)


def stored(spark, path):
    return sorted(r.id for r in tiers.read(spark, path).collect())


def on_disk(spark, path):
    found = storage.values(spark, f"{path}/dt={DAY}", "tier")
    return [b for t in found for b in storage.values(spark, f"{path}/dt={DAY}/tier={t}", "batch_id")]


def test_folders_grow_with_the_logarithm(spark, rows, tmp_path):
    path, fan = str(tmp_path / "t"), 2
    for batch in range(20):
        put(rows, path, batch, fan)
        listed = len(tiers.folders(spark, path, DAY))
        assert listed <= (fan - 1) * (math.floor(math.log(batch + 1, fan)) + 1) + 1
        assert len(on_disk(spark, path)) <= 2 * listed + fan
        assert len(storage.files(spark, f"{path}/dt={DAY}/_manifest")) <= 2 + 1
    assert stored(spark, path) == sorted(r.id for r in rows.where("part < 20").collect())
    tiers.merge_all(spark, path, DAY)
    assert len(tiers.folders(spark, path, DAY)) == 1
    assert stored(spark, path) == sorted(r.id for r in rows.where("part < 20").collect())
    put(rows, path, 20)
    assert len(stored(spark, path)) == 42


def test_a_crash_at_any_step_loses_and_doubles_nothing(spark, rows, tmp_path, monkeypatch):
    """Every call that changes the storage fails once, before it is done; then the batch is run again."""
    kinds = ("write_text", "rename", "delete")
    real = {kind: getattr(storage, kind) for kind in kinds}
    for fail_at in itertools.count():
        path, calls = str(tmp_path / f"t{fail_at}"), itertools.count()

        def failing(kind):
            def call(*args):
                if next(calls) == fail_at:
                    raise Crash(kind)
                return real[kind](*args)

            return call

        for kind in kinds:
            monkeypatch.setattr(storage, kind, failing(kind))
        crashed = False
        for batch in range(4):
            try:
                put(rows, path, batch, fan=2)
            except Crash:
                crashed = True
                # What readers meet in between is the batches before, with or without this one.
                if tiers.folders(spark, path, DAY):
                    assert stored(spark, path) in [
                        sorted(r.id for r in rows.where(F.col("part") < n).collect()) for n in (batch, batch + 1)
                    ]
                put(rows, path, batch, fan=2)
        assert stored(spark, path) == sorted(r.id for r in rows.where("part < 4").collect())
        if not crashed:
            break
    assert fail_at > 8


def test_replays_read_earlier_batches_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(6):
        put(rows, path, batch, fan=2)
        put(rows, path, batch, fan=2)
        before = tiers.read(spark, path, before=batch)
        assert (0 if before is None else before.count()) == 2 * batch
    assert len(stored(spark, path)) == 12


def test_a_rewrite_for_plain_folders_refuses_tiers(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    put(rows, path, 0)
    for folder in (path, f"{path}/dt={DAY}"):
        with pytest.raises(ValueError):
            maintenance.compact_files(spark, folder)


@pytest.fixture()
def hot_rows(spark, sf_dir):
    return normalize.to_hot(samples.bronze(spark, sf_dir))


def test_compaction_of_hot_states_counts_once(spark, hot_rows, tmp_path):
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    day = hot_rows.where(f"to_date(trade_time) = '{DAY}'")
    for batch in range(3):
        jobs.write_hot_batch(day.where(F.pmod("trade_id", F.lit(3)) == batch), batch, into)
    from datetime import date

    for _ in range(2):
        maintenance.compact_states(spark, into.minute, date.fromisoformat(DAY))
        states = tiers.read(spark, into.minute)
        assert states.count() == states.select("symbol", "bucket_ts").distinct().count()
        assert states.agg(F.sum("trade_count")).first()[0] == dedup.latest(day).count()
    assertDataFrameEqual(ohlcv.bars(states), ohlcv.bars(ohlcv.partial(dedup.latest(day))), rtol=0, atol=0)


def test_filters_admit_what_is_stored_and_little_else(spark):
    keys = spark.range(60_000).select(
        F.lit("A").alias("symbol"), F.col("id").alias("trade_id"), F.lit(f"{DAY} 10:00:00").cast("timestamp").alias("trade_time")
    ).withColumn("dt", F.to_date("trade_time"))
    old = keys.where("trade_id % 2 = 0")
    halves = [membership.filters(old.where(F.col("trade_id") % 4 == k)) for k in (0, 2)]
    words = halves[0].unionByName(halves[1])
    found = membership.admitted(keys, words)
    assert found.where("trade_id % 2 = 0").count() == old.count()
    assert found.where("trade_id % 2 = 1").count() < 300
    merged = membership.union(words.drop("dt")).withColumn("dt", F.lit(DAY).cast("date"))
    assert membership.admitted(old, merged).count() == old.count()
    assert membership.admitted(keys.withColumn("trade_time", F.expr("trade_time + INTERVAL 1 HOUR")), words).isEmpty()


def test_a_full_filter_is_still_right(spark, hot_rows, tmp_path, monkeypatch):
    """With a single word per hour nearly everything is admitted, and the lookup of the rows decides."""
    monkeypatch.setattr(membership, "WORDS", 1)
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    day = hot_rows.where(f"to_date(trade_time) = '{DAY}'")
    for batch, part in enumerate(["trade_id % 2 = 0", "true", "true"]):
        jobs.write_hot_batch(day.where(part), batch, into)
    assertDataFrameEqual(jobs.raw_trades(spark, into).select("symbol", "trade_id"), dedup.latest(day).select("symbol", "trade_id"))


def test_only_days_of_possible_copies_are_opened(spark, hot_rows, tmp_path):
    """A batch with copies of one trade of today and one of two years ago reads those two days of all that are stored."""
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    first = dedup.latest(hot_rows)
    days = F.date_sub(F.to_date("trade_time"), F.when(F.col("trade_id") == 7, 730).otherwise(0).cast("int"))
    shifted = F.col("trade_time") - F.make_dt_interval(F.datediff(F.to_date("trade_time"), days))
    first = first.withColumn("trade_time", shifted)
    jobs.write_hot_batch(first, 0, into)
    new = first.limit(1).withColumns({"trade_id": F.lit(10**9).cast("bigint")})
    batch = first.where("trade_id IN (7, 900)").unionByName(new).withColumn("dt", F.to_date("trade_time"))
    copies = jobs.stored_copies(batch, 1, into)
    opened = {f.split("dt=")[1][:10] for f in copies.inputFiles() if "/trades/" in f}
    wanted = {str(r.dt) for r in batch.where("trade_id < 1000000000").select("dt").collect()}
    assert opened == wanted and len(wanted) == 2 < len(tiers.days(spark, into.raw))
    assert sorted(r.trade_id for r in copies.select("trade_id").collect()) == [7, 900]
    jobs.write_hot_batch(batch.drop("dt"), 1, into)
    assert jobs.raw_trades(spark, into).count() == first.count() + 1
    unknown = new.withColumns({"dt": F.to_date("trade_time"), "trade_id": F.lit(-5).cast("bigint")})
    assert jobs.stored_copies(unknown, 2, into) is None


def jobs_of(spark, work):
    """How many jobs ``work`` runs, in whatever threads."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    work()
    return len(set(tracker.getJobIdsForGroup(None)) - before)


def test_compaction_runs_no_job_per_day(spark, hot_rows, tmp_path):
    """The same trades dealt to three and to nine days, in three batches; each day ends with one folder of its rows."""
    counts = []
    for n in (3, 9):
        into = jobs.HotTables.under(str(tmp_path / f"hot{n}"))
        spread = F.make_dt_interval(F.pmod(F.col("trade_id") * 7 + 1, F.lit(n)).cast("int"))
        rows = dedup.latest(hot_rows).withColumn("trade_time", F.date_trunc("day", F.lit(f"{DAY} 00:00:00").cast("timestamp")) + spread)
        for batch in range(3):
            jobs.write_hot_batch(rows.where(F.pmod("trade_id", F.lit(3)) == batch), batch, into)
        before = jobs.minute_states(spark, into).collect()
        counts.append(jobs_of(spark, lambda: jobs.compact_hot(spark, into)))
        assert len(tiers.days(spark, into.raw)) == n
        for path in (into.raw, into.seen, into.minute):
            assert all(len(tiers.folders(spark, path, day)) == 1 for day in tiers.days(spark, path))
        assertDataFrameEqual(tiers.read(spark, into.minute).select(*jobs.minute_states(spark, into).columns), before)
        assert jobs.raw_trades(spark, into).count() == rows.count()
        jobs.write_hot_batch(rows, 3, into)
        assert jobs.raw_trades(spark, into).count() == rows.count()
    assert counts[0] >= counts[1]


def test_rows_of_a_batch_do_not_depend_on_what_it_writes(spark, hot_rows, tmp_path, monkeypatch):
    """Spark forgets cached rows whose plan reads a table that is written to, and works them out again."""
    into = jobs.HotTables.under(str(tmp_path / "hot"))
    jobs.write_hot_batch(hot_rows.where("trade_id % 2 = 0"), 0, into)
    read, unseen = [], dedup.unseen

    def seen(rows, stored):
        read.extend(stored.inputFiles())
        return unseen(rows, stored)

    monkeypatch.setattr(dedup, "unseen", seen)
    jobs.write_hot_batch(hot_rows, 1, into)
    assert read and not [f for f in read if any(f"{path}/" in f for path in (into.raw, into.seen))]
    assert jobs.raw_trades(spark, into).count() == dedup.latest(hot_rows).count()
