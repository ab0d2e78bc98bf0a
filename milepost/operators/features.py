"""Feature operators.

All features are native column expressions keyed by ``snapshot_id``.  The
preprocessor (F12-F14) fits one aggregate row of exact medians / missing
counts and one small frequency table per categorical column, then applies
them as ``coalesce`` / indicator / 0-1 expressions, so the transform stays
inside whole-stage codegen.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.config import MATERIAL_DELAY_HOURS
from milepost.operators.quantile import grouped_medians
from milepost.functions.expr import latest_observed
from milepost.functions.time import hours_between

# Feature names and order of the original pipeline.
CATEGORICAL = ["route_id", "carrier", "snapshot_stage"]
NUMERIC = [
    "planned_remaining_hours",
    "calendar_day_of_week",
    "observed_departure_delay_hours",
    "observed_port_arrival_delay_hours",
    "observed_customs_delay_hours",
    "truck_availability_score",
    "congestion_score",
    "weather_severity",
    "document_readiness_score",
    "event_completeness_score",
]
INTERACTIONS = ["port_delay_x_congestion", "port_delay_x_document_gap",
                "customs_delay_x_truck_shortage"]
TYPICAL = "observed_delay_vs_route_typical"
PRIOR = "route_prior_final_delay"
S2_DROP = ["observed_customs_delay_hours", "truck_availability_score",
           "customs_delay_x_truck_shortage"]
RISK_COLUMNS = [
    "route_id", "carrier", "snapshot_stage", "planned_remaining_hours",
    "arrival_day_of_week", "observed_departure_delay_hours",
    "observed_port_arrival_delay_hours", "observed_customs_delay_hours",
    "congestion_score", "weather_severity", "document_readiness_score",
    "truck_availability_score", "event_completeness_score",
    "port_delay_x_congestion", "port_delay_x_document_gap",
    "customs_delay_x_truck_shortage", "observed_delay_vs_route_typical",
    "route_material_delay_rate", "stage_routed_predicted_final_delay_hours",
    "delay_margin_to_material_threshold",
]
DENY_PREFIXES = ("target_", "actual_")
DENY_COLUMNS = ("snapshot_id", "shipment_id", "snapshot_at", "split", "fold")
START_COLUMN = {
    "ORIGIN_DEPARTED": "scheduled_departure_at",
    "PORT_ARRIVED": "scheduled_port_arrival_at",
    "CUSTOMS_CLEARED": "scheduled_customs_clearance_at",
}


def planned_remaining() -> Column:
    """scheduled final - the stage's own scheduled instant; unknown stage NULL."""
    stage = F.col("snapshot_stage")
    start = None
    for s, c in START_COLUMN.items():
        start = F.when(stage == s, F.col(c)) if start is None else start.when(stage == s, F.col(c))
    return hours_between(start, "scheduled_final_eta")


def calendar_dow() -> Column:
    """weekday (Mon=0) of departure at S1, of port arrival at S2 and S3."""
    stage = F.col("snapshot_stage")
    day = (F.when(stage == "ORIGIN_DEPARTED", F.col("scheduled_departure_at"))
           .when(stage.isin("PORT_ARRIVED", "CUSTOMS_CLEARED"), F.col("scheduled_port_arrival_at")))
    return F.weekday(day).cast("double")


def numeric_coerce(col: str) -> Column:
    """to double, anything unparsable becomes NULL."""
    return _number(F.expr(f"try_cast(`{col}` as double)"))


def _number(c: Column) -> Column:
    """NaN is a missing value."""
    return F.when(~F.isnan(c), c)


def with_base_features(rows: DataFrame) -> DataFrame:
    """F1-F3 added in place (no projection, no join)."""
    return rows.withColumns({
        "route_id": F.col("route").cast("string"),
        "carrier": F.col("carrier").cast("string"),
        "snapshot_stage": F.col("snapshot_stage").cast("string"),
        "planned_remaining_hours": planned_remaining(),
        "calendar_day_of_week": calendar_dow(),
        **{c: numeric_coerce(c) for c in NUMERIC[2:]},
    })


def _unique(cols) -> list:
    seen, out = set(), []
    for c in cols:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return out


def base_features(rows: DataFrame, keep=("snapshot_id",)) -> DataFrame:
    """key columns + 3 categorical + 10 numeric features, nothing else."""
    return with_base_features(rows).select(*_unique(list(keep) + CATEGORICAL + NUMERIC))


def interactions(df: DataFrame) -> DataFrame:
    """port x congestion, port x (1 - documents), customs x (1 - truck)."""
    port = F.col("observed_port_arrival_delay_hours")
    return df.withColumns({
        "port_delay_x_congestion": port * F.col("congestion_score"),
        "port_delay_x_document_gap": port * (1 - F.col("document_readiness_score")),
        "customs_delay_x_truck_shortage": F.col("observed_customs_delay_hours")
        * (1 - F.col("truck_availability_score")),
    })


def v2_features(rows: DataFrame, with_prior: bool, keep=("snapshot_id",)) -> DataFrame:
    """base + interactions + typical deviation (+ route prior).  ``rows``
    must carry ``observed_delay_vs_route_typical`` (and the prior if asked)."""
    extra = [TYPICAL] + ([PRIOR] if with_prior else [])
    v = interactions(with_base_features(rows))
    return v.select(*_unique(list(keep) + CATEGORICAL + NUMERIC + INTERACTIONS + extra))


def risk_feature_frame(rows: DataFrame, keep=("snapshot_id",),
                       threshold: float = MATERIAL_DELAY_HOURS) -> DataFrame:
    """``rows`` carry the typical deviation, ``route_material_delay_rate`` and
    ``stage_routed_predicted_final_delay_hours``; 20 columns in fixed order."""
    extra = ("route_material_delay_rate", "stage_routed_predicted_final_delay_hours")
    v = v2_features(rows, with_prior=False, keep=tuple(keep) + extra)
    v = (v.withColumn("arrival_day_of_week", F.col("calendar_day_of_week"))
         .withColumn("delay_margin_to_material_threshold",
                     F.col("stage_routed_predicted_final_delay_hours") - F.lit(threshold)))
    return v.select(*_unique(list(keep) + RISK_COLUMNS))


def leakage_columns(columns) -> list[str]:
    """F4 deny-list: ids, targets and future (actual) columns among features."""
    return [c for c in columns if c in DENY_COLUMNS or c.startswith(DENY_PREFIXES)]


# --- F12-F14 preprocessing ---------------------------------------------------

def level_name(value) -> str:
    """Column-safe name of a category level."""
    return re.sub(r"\W", "_", str(value))


def level_names(column: str, levels) -> list[str]:
    """A distinct column name per level: levels that clean to the same name are
    numbered in their order ("A B", "A-B" -> x_A_B, x_A_B_2)."""
    taken, out = set(), []
    for v in levels:
        base = name = f"{column}_{level_name(v)}"
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        out.append(name)
    return out


@dataclass
class Preprocessor:
    numeric: list
    medians: dict
    indicators: list
    modes: dict
    levels: dict = field(default_factory=dict)
    output_col: str = "features"

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "Preprocessor":
        return Preprocessor(**json.loads(text))

    def _exprs(self, prefix: str) -> dict:
        out = {f"{prefix}{c}": F.coalesce(_number(F.col(c).cast("double")), F.lit(self.medians[c]))
               for c in self.numeric}
        out.update({f"{prefix}missingindicator_{c}": _number(F.col(c).cast("double")).isNull().cast("double")
                    for c in self.indicators})
        for c, vs in self.levels.items():
            filled = F.coalesce(F.col(c), F.lit(self.modes.get(c)))
            for v, name in zip(vs, level_names(c, vs)):
                out[f"{prefix}{name}"] = (filled == F.lit(v)).cast("double")
        return out

    def imputed(self, df: DataFrame) -> DataFrame:
        """F12/F13 in place: median-imputed numerics, missing indicators,
        mode-imputed categoricals."""
        cols = {c: F.coalesce(_number(F.col(c).cast("double")), F.lit(self.medians[c])) for c in self.numeric}
        cols.update({f"missingindicator_{c}": _number(F.col(c).cast("double")).isNull().cast("double")
                     for c in self.indicators})
        cols.update({c: F.coalesce(F.col(c), F.lit(m)) for c, m in self.modes.items()})
        return df.withColumns(cols)

    def one_hot(self, df: DataFrame) -> DataFrame:
        """0/1 column per fitted level after mode imputation; unseen -> zeros."""
        return df.withColumns({k: v for k, v in self._exprs("").items()
                               if k not in self.numeric and not k.startswith("missingindicator_")})

    def input_columns(self) -> list[str]:
        return list(self._exprs("").keys())

    def transform(self, df: DataFrame, output_col: str | None = None) -> DataFrame:
        """Adds the assembled feature vector; source columns stay untouched."""
        prefix = "__pp_"
        exprs = self._exprs(prefix)
        out = VectorAssembler(inputCols=list(exprs), outputCol=output_col or self.output_col,
                              handleInvalid="keep").transform(df.withColumns(exprs))
        return out.drop(*exprs)


def fit_preprocessor(train: DataFrame, columns, output_col: str = "features") -> Preprocessor:
    """F12-F14 fit.  Columns all-missing at fit are dropped (no median exists);
    medians are exact (operators.quantile).  Ids, targets and future columns are refused."""
    denied = leakage_columns(columns)
    if denied:
        raise ValueError(f"not allowed as features: {denied}")
    numeric = [c for c in columns if c not in CATEGORICAL]
    cats = [c for c in columns if c in CATEGORICAL]
    row = {}
    if numeric:  # two one-row results
        gaps = train.agg(*[F.sum(_number(F.col(c).cast("double")).isNull().cast("int")).alias(f"n{i}")
                           for i, c in enumerate(numeric)]).first()
        middle = grouped_medians(train, [], numeric).first()
        row = gaps.asDict() | {f"m{i}": middle[c] for i, c in enumerate(numeric)}
    medians = {c: float(row[f"m{i}"]) for i, c in enumerate(numeric) if row[f"m{i}"] is not None}
    kept = [c for c in numeric if c in medians]
    indicators = [c for i, c in enumerate(numeric) if c in medians and row[f"n{i}"]]
    modes, levels = {}, {}
    if cats:
        # one job: level counts of every categorical column (dimension-sized)
        stacked = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("level")) for c in cats
        ])).alias("_kv")).select("_kv.col", "_kv.level").where(F.col("level").isNotNull())
        freq = stacked.groupBy("col", "level").agg(F.count(F.lit(1)).alias("n")).collect()
        for c in cats:
            rows = sorted(((r["n"], r["level"]) for r in freq if r["col"] == c),
                          key=lambda t: (-t[0], t[1]))
            levels[c] = sorted(level for _, level in rows)
            if rows:
                modes[c] = rows[0][1]
    return Preprocessor(kept, medians, indicators, modes, levels, output_col)


def mode_table(df: DataFrame, col: str) -> DataFrame:
    """F13 ranking: non-NULL levels by count desc, value asc (first = mode)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(col).asc()))


__all__ = [
    "CATEGORICAL", "NUMERIC", "INTERACTIONS", "TYPICAL", "PRIOR", "S2_DROP", "RISK_COLUMNS",
    "planned_remaining", "calendar_dow", "numeric_coerce", "base_features", "interactions",
    "v2_features", "with_base_features", "risk_feature_frame", "leakage_columns", "Preprocessor",
    "fit_preprocessor", "mode_table", "latest_observed",
]
