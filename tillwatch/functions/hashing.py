"""Row-wise hash buckets: stable under any partitioning, unlike a seeded random split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_percent(*keys: Column) -> Column:
    """Bucket 0..99 from the first 32 bits of the md5 of the keys' text; NULL counts as empty."""
    text = F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    head = F.substring(F.md5(text.cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100
