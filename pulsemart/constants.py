"""Schemas, thresholds and lookup values shared by the batch and streaming code."""

from __future__ import annotations

# These decide which rows and columns come out, so they are stated as given.
ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")
ENVELOPE_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition LONG, offset LONG, timestamp LONG"
)
REFERENCE_BPM_SCHEMA = "device_id INT, time FLOAT, heartrate DOUBLE"
FIRST_PRODUCTION_DEVICE = 102000
WATERMARK_DELAY = "30 seconds"
SALES_GOAL = 390000000
GOAL_PERIOD = ("2024-01-01", "2024-12-31")
STAGING_ROWS = 1000
STATE_CODES = {
    "New South Wales": "NSW",
    "Victoria": "VIC",
    "Queensland": "QLD",
    "South Australia": "SA",
    "Western Australia": "WA",
    "Tasmania": "TAS",
    "Northern Territory": "NT",
    "Australian Capital Territory": "ACT",
}

# A 32-bit FLOAT cannot hold present-day epoch seconds (it snaps them to a 128 s grid),
# so DOUBLE is the default here and the FLOAT schema above is the opt-in for parity.
BPM_SCHEMA = "device_id INT, time DOUBLE, heartrate DOUBLE"

# A total order over messages. `timestamp` alone has ties.
MESSAGE_CURSOR = ("timestamp", "topic", "partition", "offset")
