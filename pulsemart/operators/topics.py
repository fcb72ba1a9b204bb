"""What a topic of the message feed holds and how its rows are cleaned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pulsemart.constants import BPM_SCHEMA, FIRST_PRODUCTION_DEVICE


@dataclass(frozen=True)
class Topic:
    """One topic: its payload schema, its cleaned columns' keys and its quality rules.

    `time_column` holds epoch seconds in the payload and becomes `timestamp` when cleaned;
    None means the payload has no event time. `rules` maps a name to a SQL condition on the
    cleaned columns. `paths` names places in a payload for columns that are not its field of
    the same name; only payloads parsed to VARIANT are read by path.
    """

    name: str
    payload_schema: str
    keys: tuple[str, ...]
    time_column: str | None = "time"
    rules: Mapping[str, str] = field(default_factory=dict, hash=False)
    paths: Mapping[str, str] = field(default_factory=dict, hash=False)


BPM = Topic(
    name="bpm",
    payload_schema=BPM_SCHEMA,
    keys=("device_id", "timestamp"),
    rules={"valid_id": f"device_id IS NOT NULL AND device_id >= {FIRST_PRODUCTION_DEVICE}"},
)
