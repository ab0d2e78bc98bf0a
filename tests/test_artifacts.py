"""Saved models score as before, stored tables load, deny-list."""
import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from milepost.operators import eta
from milepost.operators import features as FE
from milepost.plans.catalog import load_tables
from milepost.plans.layout import Layout
from milepost.sources import sinks


def test_saved_model_scores_as_before(spark, small, tiny_cfg, tmp_path):
    rows = FE.base_features(small.snapshots_of("train"), keep=("snapshot_id", "target_final_delay_hours"))
    columns = FE.CATEGORICAL + FE.NUMERIC
    fitted = eta._fit(rows, columns, "target_final_delay_hours", tiny_cfg.direct, 1)
    path = sinks.save_fitted(spark, fitted, str(tmp_path / "m"))
    loaded = sinks.load_fitted(spark, path, eta.FittedModel, GBTRegressionModel)
    new = FE.base_features(small.snapshots_of("validation"))
    both = loaded.score(fitted.score(new, "before"), "after")
    assert both.count() > 50 and both.where("before <> after OR after IS NULL").count() == 0


def test_fits_refuse_leaking_columns(small):
    with pytest.raises(ValueError, match="target_final_delay_hours"):
        FE.fit_preprocessor(small.snapshots, ["weather_severity", "target_final_delay_hours"])


def test_stored_tables_give_the_same_splits(spark, small, tmp_path):
    sinks.write_base_tables(Layout(str(tmp_path)), small.shipments, small.events, small.snapshots, small.manifest)
    t = load_tables(spark, str(tmp_path / "data")).materialize()
    for split in ("train", "validation", "test"):
        for of in ("shipments_of", "snapshots_of"):
            own, want = getattr(t, of)(split), getattr(small, of)(split)
            key = "snapshot_id" if of == "snapshots_of" else "shipment_id"
            assert own.count() == want.count()
            assert own.select(key).join(want, key, "left_anti").isEmpty()
    s2 = eta.s2_targets(t.snapshots_of("train").where(F.col("snapshot_stage") == eta.S2), t.shipments_of("train"))
    assert s2.where("customs_deviation_hours IS NOT NULL").count() > 0
