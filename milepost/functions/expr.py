"""Generic column expressions: hashing, folds, bins, stage-conditional picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def md5_int(salt: str, key, hex_digits: int = 8) -> Column:
    """Leading ``hex_digits`` of md5(salt:key) as a non-negative bigint."""
    text = F.concat(F.lit(f"{salt}:"), _c(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def fold_of(key, salt: str, k: int) -> Column:
    """Group fold of a key: a pure function of the key, so every row of one
    journey lands in the same fold on every executor, without a lookup table."""
    return F.pmod(md5_int(salt, key), F.lit(k)).cast("int")


def latest_observed(stage="snapshot_stage",
                    departure="observed_departure_delay_hours",
                    port="observed_port_arrival_delay_hours",
                    customs="observed_customs_delay_hours") -> Column:
    """Most recent observed delay for a stage: S1 departure, S2 port, any other
    stage customs; no fallback when the picked value is NULL."""
    s = _c(stage)
    return (F.when(s == "ORIGIN_DEPARTED", _c(departure).cast("double"))
            .when(s == "PORT_ARRIVED", _c(port).cast("double"))
            .otherwise(_c(customs).cast("double")))


def right_closed_bin(x, edges: Sequence[float], labels: Sequence[str],
                     include_lowest: bool = False) -> Column:
    """Label of the right-closed interval (e_i, e_{i+1}] holding x; NULL outside."""
    x = _c(x)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower = (x >= lo) if (include_lowest and i == 0) else (x > lo)
        cond = lower & (x <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
