from skymeter.streaming.alerts import (
    ALERT_THRESHOLD,
    alert_readings,
    flag_readings,
    read_reading_stream,
    write_stream,
)
from skymeter.streaming.batches import read_batches, read_manifests, write_batches

__all__ = [
    "ALERT_THRESHOLD",
    "alert_readings",
    "flag_readings",
    "read_batches",
    "read_manifests",
    "read_reading_stream",
    "write_batches",
    "write_stream",
]
