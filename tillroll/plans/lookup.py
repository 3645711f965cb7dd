"""Joining a lookup table (one row per key) onto a large table.

The lookup is usually small (product codes), but nothing bounds it, and AQE
only demotes a sort-merge join to a broadcast after the large side has been
shuffled. So the lookup is checkpointed and its text measured once, when it
is made: up to ``LOOKUP_BROADCAST_BYTES`` it is broadcast (the large side is
not shuffled at all); above that, a shuffle join is used and AQE splits
skewed keys. The rows are the same either way. A program that names several
reports makes the lookup once and passes it on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans.lineage import checkpointed

# Text of the largest lookup we broadcast, far under Spark's 8 GB limit.
LOOKUP_BROADCAST_BYTES = 64 << 20


@dataclass
class Lookup:
    """A checkpointed lookup and whether it is small enough to broadcast."""
    table: DataFrame
    small: bool

    def join(self, df: DataFrame, on: str, how: str = "left") -> DataFrame:
        return df.join(F.broadcast(self.table) if self.small else self.table, on, how)


def lookup_table(source: DataFrame | Lookup, max_bytes: int = LOOKUP_BROADCAST_BYTES) -> Lookup:
    """The lookup of ``source``; one that is made already stays as it is."""
    if isinstance(source, Lookup):
        return source
    table = checkpointed(source)
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in table.columns), F.lit(0))
    held = table.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]
    return Lookup(table, held <= max_bytes)


def join_lookup(df: DataFrame, lookup: DataFrame | Lookup, on: str, how: str = "left") -> DataFrame:
    return lookup_table(lookup).join(df, on, how)
