"""Joins of fact rows with aggregated lookups that do not deal the facts by a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.session import cut_lineage

#: Lookups of at most so many rows are broadcast (a few MB at these widths).
BROADCAST_ROWS = 50_000
SALTS = 32


def lookup_join(rows: DataFrame, table: DataFrame, keys: Sequence[str],
                broadcast_rows: int = BROADCAST_ROWS, salts: int = SALTS, salt: Column | None = None) -> DataFrame:
    """rows left join table on keys; ``table`` has one row per key.

    The lookup is computed once and counted.  Up to the bound it is broadcast and
    the fact rows stay where they are; beyond it both sides are dealt by (key,
    salt), the lookup repeated for each salt, so a key with a third of the rows
    meets its value in ``salts`` tasks.  Either way the result is the same."""
    own = cut_lineage(table)
    if own.count() <= broadcast_rows:
        return rows.join(F.broadcast(own), list(keys), "left")
    # the salt follows from the row, so a task that runs again deals it the same way
    own_salt = F.xxhash64("shipment_id") if salt is None else salt
    salted = rows.withColumn("_salt", F.pmod(own_salt, F.lit(salts)).cast("int"))
    copies = own.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")
