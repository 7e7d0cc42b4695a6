"""Repeatable draws from row keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

RESOLUTION = 1 << 28


def hash_uniform(key: str | Column, seed: int) -> Column:
    """Repeatable U[0, 1) per key value: the first 28 bits of md5(key:seed)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("double") / float(RESOLUTION)


def hash_place(key: str | Column, seed: int) -> Column:
    """As ``hash_uniform`` with 52 bits: fine enough for places along the weights of any table."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat_ws(":", k.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(1 << 52)
