"""Logs that are shorter than the checkpoint, and records that gain members."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom.operators import evolve, normalize
from tickloom.schema import BRONZE, record
from tickloom.sinks import storage, tiers
from tickloom.sources import log, samples
from tickloom.streaming import jobs, position

NONE = record("")


def ranges(spark, *rows):
    schema = "kafka_partition int, kafka_offset bigint"
    return spark.createDataFrame([(p, o) for p, first, last in rows for o in (first, last)], schema)


def test_positions_and_losses(spark, tmp_path):
    path = str(tmp_path / "bronze")

    def run(batch_id, *rows):
        batch = ranges(spark, *rows)
        position.check(batch, path, batch_id, position.RECORD)
        position.advance(batch, path, batch_id)

    run(0, (0, 5, 9), (1, 7, 8))  # the first batch begins wherever the log begins
    run(1, (0, 10, 12))  # nothing is lost, partition 1 is idle
    assert position.recorded(spark, path).isEmpty()
    for _ in range(2):  # a replay leaves one record
        run(2, (0, 20, 21), (1, 9, 9), (2, 3, 4))
    run(3, (0, 22, 22), (1, 2, 3))
    run(4, (1, 4, 4), (2, 5, 5))
    found = sorted(map(tuple, position.recorded(spark, path).collect()))
    assert found == [(0, "gone", 13, 19, 2), (1, "rewound", 4, 9, 3), (2, "gone", 0, 2, 2)]
    left = {r.kafka_partition: r.next_offset for r in position.before_batch(spark, path, 5).collect()}
    assert left == {0: 23, 1: 5, 2: 6}
    assert len(storage.values(spark, f"{path}-position", "batch_id")) <= 2


def test_a_late_start_expects_nothing_of_new_partitions(spark):
    before = spark.createDataFrame([(0, 10)], "kafka_partition int, next_offset bigint")
    found = position.ends(ranges(spark, (0, 10, 11), (5, 900, 901)))
    assert position.losses(found, before, from_start=False).isEmpty()
    assert [r.last_lost for r in position.losses(found, before).collect()] == [899]


def test_a_loss_stops_the_stream_until_it_is_told_to_go_on(spark, sf_dir, tmp_path):
    topic, path = str(tmp_path / "topic"), str(tmp_path / "bronze")
    records = samples.log_records(samples.as_bronze(samples.trades(spark, sf_dir)))

    def land(on_loss):
        rows = jobs.decoded(log.file_log(spark, f"{topic}/*"))
        beside = (f"{path}-bad", f"{path}-commits", f"{path}-check")
        jobs.land_bronze_tiered(rows, path, *beside, interval=None, on_loss=on_loss).awaitTermination()

    records.where("`offset` < 100").write.json(f"{topic}/a")
    land(position.FAIL)
    first = tiers.read(spark, path).count()
    records.where("`offset` BETWEEN 150 AND 200").write.json(f"{topic}/b")
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="gone 100 to 149 of partition 0"):
            land(position.FAIL)
        assert tiers.read(spark, path).count() == first
        assert len(storage.values(spark, f"{path}-position", "batch_id")) == 1
    land(position.RECORD)
    assert tiers.read(spark, path).count() == records.where("`offset` < 100 OR `offset` BETWEEN 150 AND 200").count()
    assert {(r.first_lost, r.last_lost) for r in position.recorded(spark, path).collect()} == {(100, 149)}
    with pytest.raises(ValueError, match="on_loss"):
        land("whatever")


MEMBERS = [
    ('{"symbol":"a"}', None),
    ('{"symbol":"a","x":"text","y":1.5,"z":null}', {"x": "text", "y": "1.5", "z": None}),
    ('{"n":{"a":[1,{"b":2}]},"t":true}', {"n": '{"a":[1,{"b":2}]}', "t": "true"}),
    ('{"Symbol":"other case"}', {"Symbol": "other case"}),
    ("[1]", None), ("text", None), ("", None), (None, None),
]


def test_unknown_members_are_rescued(spark):
    rows = spark.createDataFrame([(v,) for v, _ in MEMBERS], "value string")
    found = rows.select(evolve.rescued(F.col("value"), ["symbol"]).alias("r")).collect()
    assert [r.r for r in found] == [want for _, want in MEMBERS]


def test_widening_loses_nothing(spark):
    rows = spark.createDataFrame(
        [
            (1, None, {"fee": "1.5", "venue": "v"}),
            (2, None, {"fee": "word", "other": "o"}),
            (3, 7.0, {"fee": "8.0"}),
            (4, None, {"fee": None}),
            (5, 9.0, None),
        ],
        "id int, fee double, rescued map<string,string>",
    )
    found = {r.id: (r.fee, r.venue, r.rescued) for r in evolve.widen(rows, record("fee double, venue string")).collect()}
    assert found == {
        1: (1.5, "v", None),
        2: (None, None, {"fee": "word", "other": "o"}),
        3: (7.0, None, {"fee": "8.0"}),
        4: (None, None, None),
        5: (9.0, None, None),
    }
    with pytest.raises(ValueError, match="Price"):
        evolve.evolved(BRONZE, record("Price double"))


def test_tiers_of_two_schemas_keep_all_columns(spark, sf_dir, tmp_path):
    """Folders of before and after a change are merged, and the columns of both are there."""
    path = str(tmp_path / "tiered")
    trades = samples.trades(spark, sf_dir).where("trade_time < '2024-01-03'")
    records = samples.gaining_members(samples.log_records(samples.as_bronze(trades)), 3)
    added = record("venue string, fee double")
    days = set()
    for batch_id, declared in enumerate((None, NONE, added)):
        part = records.where(F.split("key", ":")[1].cast("bigint") % 3 == batch_id)
        rows = normalize.valid(normalize.decode_log(part, declared)).withColumn("dt", F.to_date("kafka_timestamp"))
        touched = [str(r.dt) for r in rows.select("dt").distinct().collect()]
        tiers.append(rows, path, batch_id, touched)
        days.update(touched)
    schema = evolve.evolved(BRONZE, added)
    before = evolve.widen(tiers.read(spark, path, schema=schema), added).select(*schema.fieldNames())
    kept = sorted(map(str, before.collect()))
    for day in days:
        tiers.merge_all(spark, path, day)
    after = evolve.widen(tiers.read(spark, path, schema=schema), added).select(*schema.fieldNames())
    assert sorted(map(str, after.collect())) == kept
    assert after.where("venue IS NOT NULL").count() == records.where("value LIKE '%venue%'").count() > 0
