"""Reusable Column expressions (all native Spark, codegen-friendly)."""

from milepost.functions.time import (
    add_hours, add_seconds, hours_between, iso_instant, round_hours_from_micros,
    micros_between,
)
from milepost.functions.expr import (
    fold_of, latest_observed, md5_int, right_closed_bin,
)

__all__ = [
    "add_hours", "add_seconds", "hours_between", "iso_instant",
    "round_hours_from_micros", "micros_between", "fold_of",
    "latest_observed", "md5_int", "right_closed_bin",
]
