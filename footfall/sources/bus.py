"""Message-bus envelopes: ``(topic, key, value, offset, timestamp)``.

``bus_envelope`` renders the sensor-event view as the records a forwarder
would publish (key = topic bytes, value = UTF-8 JSON bytes), optionally with
deterministic transport faults so the UTF-8 gate and the reject path have
work to do. ``kafka_envelope_stream`` reads the same envelope from Kafka
when the connector is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.payload import sensor_event_json
from footfall.sources.events import sensor_events_with_offset

TOPIC_PREFIX = "sensors/"
UNASSIGNED_TOPIC = "unassigned"

# Fixed fault-injection rule (every row is still delivered):
# offsets divisible by INVALID_UTF8_EVERY arrive with two bytes that are not
# UTF-8 in front of the JSON; offsets divisible by LEGACY_FRAME_EVERY arrive
# as a legacy XML frame instead of JSON.
INVALID_UTF8_EVERY = 101
LEGACY_FRAME_EVERY = 103
INVALID_UTF8_PREFIX_HEX = "FFFE"
# Fixed rule of odd fields: offsets divisible by EXTRA_KEY_EVERY carry keys the
# schema does not know, those divisible by MISSING_ID_EVERY no event id.
EXTRA_KEY_EVERY = 107
MISSING_ID_EVERY = 109
EXTRA_KEYS = '"firmware":"2.1","position":{"x":1,"y":[2,3]},'


def topic_for_store(store_id) -> F.Column:
    """Bus topic of a store; events without a store go to ``sensors/unassigned``."""
    return F.concat(F.lit(TOPIC_PREFIX), F.coalesce(store_id, F.lit(UNASSIGNED_TOPIC)))


def bus_envelope(
    spark: SparkSession, sf_dir: str, faults: bool = False, dwell_scale: float = 1.0, odd_fields: bool = False
) -> DataFrame:
    """Envelope records for every sensor event (all rows); ``dwell_scale``
    makes copies of them that can be told from the originals."""
    s = sensor_events_with_offset(spark, sf_dir)
    if odd_fields:
        s = s.withColumn("event_id", F.when(F.col("offset") % MISSING_ID_EVERY != 0, F.col("event_id")))
    s = s.withColumn("dwell_time_seconds", F.col("dwell_time_seconds") * F.lit(dwell_scale))
    topic = topic_for_store(F.col("store_id"))
    text = sensor_event_json()
    if odd_fields:
        odd = F.concat(F.lit("{" + EXTRA_KEYS), F.substring(text, F.lit(2), F.length(text)))
        text = F.when(F.col("offset") % EXTRA_KEY_EVERY == 0, odd).otherwise(text)
    good = F.encode(text, "UTF-8")
    value = good
    if faults:
        off = F.col("offset")
        value = (
            F.when(off % INVALID_UTF8_EVERY == 0, F.concat(F.unhex(F.lit(INVALID_UTF8_PREFIX_HEX)), good))
            .when(
                off % LEGACY_FRAME_EVERY == 0,
                F.encode(F.format_string('<sensor offset="%d"/>', off), "UTF-8"),
            )
            .otherwise(good)
        )
    return s.select(
        topic.alias("topic"),
        F.encode(topic, "UTF-8").alias("key"),
        value.alias("value"),
        F.col("offset"),
        F.col("bus_time").alias("timestamp"),
    )


def kafka_envelope_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    group_id_prefix: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to one topic (all partitions) as a stream of envelopes.

    ``starting_offsets`` applies only to a new checkpoint. A forwarder that
    keys every record by its source topic puts the whole feed into one Kafka
    partition; ``min_partitions`` splits each batch's offset ranges into at
    least that many Spark tasks, so the JSON parse (the CPU cost) runs in
    parallel without a shuffle. ``options`` go to the reader as they are, for
    example ``kafka.security.protocol``. The envelope also carries the Kafka
    ``partition``: offsets are unique only within it. Needs the spark-sql-kafka
    connector.
    """
    starting = starting_offsets.lower()
    if starting not in ("earliest", "latest"):
        raise ValueError("starting_offsets must be 'earliest' or 'latest'")
    reader = (
        spark.readStream.format("kafka")
        .options(**(options or {}))
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if group_id_prefix:
        reader = reader.option("groupIdPrefix", group_id_prefix)
    return reader.load().select(
        F.col("topic"),
        F.col("key"),
        F.col("value"),
        F.col("offset"),
        F.col("timestamp"),
        F.col("partition"),
    )
