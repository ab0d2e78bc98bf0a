"""Clean data passes; one fault per rule is caught; strict mode order."""
import pytest
from pyspark.sql import functions as F

from milepost.operators import quality as Q
from milepost.plans import queries as QS


def test_clean_data_passes(small):
    rows = Q.quality_report(small.shipments, small.events, small.snapshots).collect()
    assert len(rows) == 13 and all(r.passed for r in rows)


@pytest.mark.parametrize("rule", [r for r, _ in Q.RULES])
def test_each_mutation_is_detected(small, rule):
    n = small.shipments.count()
    sh, ev, sn = QS._mutate(rule, small)
    v = Q.rule_violations(rule, sh, ev, sn, n).first().violations
    assert v > 0, rule
    report = {r.rule: r.violations for r in Q.quality_report(sh, ev, sn, n).collect()}
    assert report[rule] == v


def test_strict_mode_raises_first_failed_rule(small):
    sh, ev, sn = QS._mutate("C05", small)
    with pytest.raises(ValueError, match="supported stages .C05"):
        Q.validate(sh, ev, sn)


def test_null_stage_is_a_violation(spark, small):
    sn = small.snapshots.limit(3).withColumn("snapshot_stage", F.lit(None).cast("string"))
    assert Q.snapshot_violations(sn).first().C05 == 3


def test_zero_event_shipments_only_caught_in_strict_mode(small):
    ev = small.events.where(F.col("shipment_id") != F.lit("1"))
    assert Q.event_count_violations(ev, small.shipments).count() == 0
    assert Q.event_count_violations(ev, small.shipments, strict=True).count() == 1


@pytest.mark.parametrize("rule", ["C02", "C04", "C06", "C07", "C08", "C11", "C13"])
def test_samples_name_offending_rows(small, rule):
    sh, ev, sn = QS._mutate(rule, small)
    found = Q.rule_violations(rule, sh, ev, sn).first()
    table, key = {"C02": (ev, "shipment_id"), "C04": (ev, "shipment_id"), "C08": (sh, "shipment_id"),
                  "C11": (ev, "shipment_id")}.get(rule, (sn, "snapshot_id"))
    assert 1 <= len(found.sample_ids) <= Q.SAMPLES and found.sample_ids == sorted(set(found.sample_ids))
    some = table.where(F.col(key).isin(found.sample_ids))
    assert {r[0] for r in some.select(key).distinct().collect()} == set(found.sample_ids)
    clean = Q.rule_violations(rule, small.shipments, small.events, small.snapshots).first()
    assert clean.sample_ids == []
    only = Q.rule_violations(rule, sh, ev.where(~F.col("shipment_id").isin(found.sample_ids)) if table is ev else ev,
                             sn.where(~F.col(key).isin(found.sample_ids)) if table is sn else sn)
    assert table is sh or only.first().violations < found.violations  # each named id had violations


def test_strict_mode_names_rows(small):
    sh, ev, sn = QS._mutate("C07", small)
    row = next(r for r in Q.quality_report(sh, ev, sn).collect() if r.rule == "C07")
    assert row.sample_ids and not row.passed


def test_samples_skip_missing_ids(spark, small):
    sn = small.snapshots.limit(3).withColumns({"snapshot_stage": F.lit("elsewhere"), "snapshot_id": F.lit(None).cast("string")})
    found = Q.snapshot_violations(sn).first()
    assert found.C05 == 3 and found.C05_ids == []
