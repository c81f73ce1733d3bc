"""footfall: Spark-native sensor-traffic analytics.

Decode bus messages, validate and clean sensor events, derive event time and
time-of-day flags, join store and zone dimensions, aggregate visitors and
dwell time into event-time windows (batch or Structured Streaming), write
idempotent change logs, and answer dashboard questions over the results.
"""

from footfall.operators import *  # noqa: F401,F403
from footfall.operators import __all__ as _ops
from footfall.session import build_session, ensure_utc, shared_dir

__all__ = list(_ops) + ["build_session", "ensure_utc", "shared_dir"]
