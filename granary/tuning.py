"""Spark settings that have to follow the size of the data."""

from __future__ import annotations

MIB = 1024 * 1024
GIB = 1024 * MIB


def settings(input_bytes: int, cores: int, partition_bytes: int = 512 * MIB) -> dict[str, str]:
    """Runtime settings for an input of ``input_bytes`` on ``cores`` executor cores.

    Adaptive execution merges small shuffle partitions and splits skewed ones, but it never makes
    more partitions than the shuffle started with, so the starting number must come from the data:
    enough that an average partition fits in a task's share of memory, and at least two per core.
    Files are split so that every core gets about 64 pieces, within 64 MiB and ``partition_bytes``.
    """
    partitions = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, max(64 * MIB, input_bytes // (64 * cores)))),
        "spark.sql.session.timeZone": "UTC",
    }
