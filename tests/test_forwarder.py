"""The forwarder: numbers without gaps, bytes unchanged, nothing sent twice."""

from pyspark.sql import functions as F
from test_catalogue import SF_SMALL

from footfall.session import scratch_path
from footfall.sources.bus import bus_envelope
from footfall.streaming.forwarder import HEADS, forwarder_writer, in_publish_order, numbered, read_forwarded

RECORDS = "topic string, offset long, key binary, value binary"


def record(topic, offset):
    return (topic, offset, topic.encode(), b"%d" % offset)


def test_numbers_follow_offsets_over_blocks(spark):
    held = [record("a", n) for n in (4, 9, 17, 18, 40, 41, 95)] + [record("b", n) for n in (1, 2)] + [record("a", 17)] * 3
    heads = spark.createDataFrame([("a", 9, 5)], HEADS)
    out = numbered(spark.createDataFrame(held, RECORDS).repartition(4), heads, block=10)
    got = sorted((r.topic, r.offset, r.seq) for r in out.collect())
    assert got == [("a", 17, 6), ("a", 18, 7), ("a", 40, 8), ("a", 41, 9), ("a", 95, 10), ("b", 1, 1), ("b", 2, 2)]


def test_empty_batch(spark):
    assert numbered(spark.createDataFrame([], RECORDS), spark.createDataFrame([], HEADS)).count() == 0


def test_batches_forward_once_with_bytes_unchanged(spark):
    env = bus_envelope(spark, SF_SMALL, faults=True)
    path = scratch_path(spark, "t_forwarder")
    write = forwarder_writer(path, block=50)
    write(env.filter("offset < 600"), 0)
    write(env.filter("offset < 600"), 0)  # the batch again
    write(env.filter("offset >= 550"), 1)  # the bus delivers fifty records again
    out = read_forwarded(spark, path).persist()
    sent = env.filter(F.expr("is_valid_utf8(value)")).select("topic", "offset", "value")
    assert out.count() == sent.count()
    assert out.select("topic", "offset", "value").exceptAll(sent).isEmpty()
    wrong = out.groupBy("topic").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.countDistinct("seq").alias("n"))
    assert wrong.filter("a <> 1 OR b <> n").isEmpty()
    swapped = out.alias("x").join(out.alias("y"), F.expr("x.topic = y.topic AND x.seq + 1 = y.seq AND x.offset >= y.offset"))
    assert swapped.isEmpty()
    ordered = in_publish_order(out).select("topic", "seq", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at"))
    by_topic = {}
    for r in sorted(ordered.collect(), key=lambda r: r["at"]):
        by_topic.setdefault(r.topic, []).append((r.task, r.seq))
    for held in by_topic.values():
        assert len({t for t, _ in held}) == 1 and [s for _, s in held] == sorted(s for _, s in held)
    out.unpersist()
