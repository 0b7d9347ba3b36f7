"""Session settings for big reconciliations."""

from __future__ import annotations

import math

MIB = 1024**2
BYTES_PER_PARTITION = 256 * MIB
MOST_PARTITIONS = 65_536
BYTES_PER_READ = 128 * MIB
MOST_READS = 200_000


def shuffle_partitions(
    input_bytes: int,
    bytes_per_partition: int = BYTES_PER_PARTITION,
    at_least: int = 8,
    at_most: int = MOST_PARTITIONS,
) -> int:
    """Shuffle partitions so that one of them fits a task's memory share.

    A comparison shuffles both sides in full, so count the bytes of both,
    uncompressed. Adaptive execution joins small partitions afterwards but
    cannot split big ones of an aggregate: rather choose too many. Beyond
    ``at_most`` partitions grow instead and may spill, because every read task
    writes one block per partition.
    """
    wanted = math.ceil(input_bytes / bytes_per_partition)
    return min(max(at_least, wanted), at_most)


def session_settings(input_bytes: int) -> dict[str, str]:
    """Settings to build a session with, given the bytes of the largest table pair."""
    read_bytes = max(BYTES_PER_READ, math.ceil(input_bytes / MOST_READS))
    return {
        "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)),
        "spark.sql.files.maxPartitionBytes": str(read_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(BYTES_PER_PARTITION),
        "spark.sql.session.timeZone": "UTC",
        "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    }
