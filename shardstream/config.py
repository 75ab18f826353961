"""Service limits, starting positions and the row bounds that decide how a group is processed."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

MIB = 1024 * 1024

# A group of up to this many rows is handled by one task, streaming through its sorted partition.
# A larger group is cut into blocks of this size, which are processed in parallel.
GROUP_ROWS = 1 << 20

# Rows a dimension table (shards, checkpoints, streams) may have to be broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000

DEFAULT_SHARD = "DEFAULT"


@dataclass(frozen=True)
class Limits:
    """Limits of the record service; ``aggregate`` turns packing on."""

    # The limits the service documents.
    max_request_records: int = 500
    max_request_bytes: int = 5 * MIB
    max_record_bytes: int = MIB
    max_shard_bytes: int = MIB
    max_shard_records: int = 1000
    max_key_bytes: int = 256
    min_key_bytes: int = 1
    aggregate: bool = True


@dataclass(frozen=True)
class Position:
    """Where a consumer starts in a shard it has no checkpoint for."""

    kind: str
    at: dt.datetime | None = None

    @staticmethod
    def trim_horizon() -> "Position":
        return Position("TRIM_HORIZON")

    @staticmethod
    def latest() -> "Position":
        return Position("LATEST")

    @staticmethod
    def at_timestamp(at: dt.datetime) -> "Position":
        return Position("AT_TIMESTAMP", at)
