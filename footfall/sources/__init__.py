"""Sources: driver tables, the sensor-event view over them, bus envelopes,
dimension tables and stream sources (file replay or Kafka)."""

from footfall.sources.bus import bus_envelope, kafka_envelope_stream
from footfall.sources.dimensions import (
    read_jdbc_dimension,
    stores_dimension,
    zones_dimension,
)
from footfall.sources.events import sensor_events, sensor_events_with_offset
from footfall.sources.replay import (
    envelope_file_stream,
    replay_slice,
    write_replay_files,
)
from footfall.sources.tables import read_table

__all__ = [
    "bus_envelope",
    "envelope_file_stream",
    "kafka_envelope_stream",
    "read_jdbc_dimension",
    "read_table",
    "replay_slice",
    "sensor_events",
    "sensor_events_with_offset",
    "stores_dimension",
    "write_replay_files",
    "zones_dimension",
]
