"""B8 for any event stream: what had been reported of each milestone when a trigger fell.

Where no key has more than ``STRETCH`` triggers and reports, they are dealt by key once and
one sort per key carries the state of every milestone up to each trigger, which brings its
own columns along.

Else triggers and reports meet in one table with a row per (key, instant): reports of one
instant shrink to their latest per milestone and a count before the shuffle, so rows that
repeat or tie cost nothing later.  One sort per key then carries the state of every
milestone up to each instant.

A key with more than ``STRETCH`` instants is cut into stretches at instants of its own
(an even sample of them, the same in every run).  The state runs inside (key, stretch),
and what the earlier stretches add up to is joined to it, so no key is one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.operators.lookup import lookup_join
from milepost.operators.quantile import range_of
from milepost.session import cut_lineage

#: Instants of one key that are sorted as one stretch.
STRETCH = 200_000
#: What is told of a milestone; only what is asked for moves with the instants.
FIELDS = ("first_at", "last_at", "last_value", "reports")


def _instants(triggers: DataFrame, reports: DataFrame, keys: Sequence[str], milestones: Sequence[str], at: str,
              report_at: str, milestone: str, order: str, value: str, fields: Sequence[str]) -> DataFrame:
    """keys..., _at, _trigger, and for milestone i _l{i} (its latest report of the instant:
    _at, _o, _v; where ``fields`` need it) and _n{i} (its reports of the instant)."""
    report = reports.where(F.col(milestone).isin(list(milestones))).select(
        *keys, F.col(report_at).alias("_at"), F.col(milestone).alias("_m"),
        F.struct(F.col(report_at).alias("_at"), F.col(order).alias("_o"), F.col(value).alias("_v")).alias("_r"),
        F.lit(False).alias("_t"))
    trigger = triggers.select(*keys, F.col(at).alias("_at"), F.lit(True).alias("_t"))
    both = report.unionByName(trigger, allowMissingColumns=True)
    of = [F.col("_m") == m for m in milestones]
    return both.where(_present(["_at", *keys])).groupBy(*keys, "_at").agg(
        F.max("_t").alias("_trigger"),
        *[F.max(F.when(c, F.col("_r"))).alias(f"_l{i}") for i, c in enumerate(of) if _latest(fields)],
        *[F.count(F.when(c, F.lit(1))).alias(f"_n{i}") for i, c in enumerate(of)])


def _latest(fields: Sequence[str]) -> bool:
    return "last_at" in fields or "last_value" in fields


def _state(i: int, over, fields: Sequence[str]) -> list[Column]:
    """First instant, latest report and number of reports of milestone i, by ``over``, as
    far as ``fields`` need them."""
    reported = F.when(F.col(f"_n{i}") > 0, F.col("_at"))
    first = [over(F.min(reported)).alias(f"_f{i}")] if "first_at" in fields else []
    last = [over(F.max(f"_l{i}")).alias(f"_s{i}")] if _latest(fields) else []
    return first + last + ([over(F.sum(f"_n{i}")).alias(f"_c{i}")] if "reports" in fields else [])


def _stretched(instants: DataFrame, large: DataFrame, keys: Sequence[str], stretch: int) -> DataFrame:
    """instants with _b: how many of their key's edges lie before them (0: key not cut)."""
    parts = F.ceil(F.col("_d") / F.lit(stretch)).cast("int")
    salt = F.xxhash64("_at")
    mine = lookup_join(instants, large, keys, salt=salt)
    edges = (mine.where(F.col("_d").isNotNull())
             .groupBy(*keys, F.pmod(salt, parts).alias("_h")).agg(F.min_by("_at", F.xxhash64("_at", F.lit(1))).alias("_e"))
             .groupBy(*keys).agg(F.sort_array(F.collect_list("_e")).alias("_edges"))
             .withColumn("_every32", F.filter("_edges", lambda e, i: i % 32 == 31)))
    cut = lookup_join(instants, edges, keys, salt=salt)
    return cut.withColumn("_b", F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(
        range_of(F.col("_at"), F.col("_edges"), F.col("_every32")))).drop("_edges", "_every32")


def _larger(rows: DataFrame, keys: Sequence[str], most: float) -> bool:
    """Whether some key has more than ``most`` of the rows."""
    return not rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > most).isEmpty()


def _present(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def _by_key(triggers: DataFrame, reports: DataFrame, keys: Sequence[str], milestones: Sequence[str], at: str, report_at: str,
            milestone: str, order: str, value: str, fields: Sequence[str]) -> DataFrame:
    """asof_state where every key's rows fit one sort.  Triggers without key or instant see
    no report; they are dealt by a number of their own (_alone)."""
    own = F.xxhash64(*[c for c, kind in triggers.dtypes if "map<" not in kind])
    trigger = triggers.select(*keys, F.col(at).alias("_at"), F.struct(*triggers.columns).alias("_row"),
                              F.when(_present([*keys, at]), F.lit(0)).otherwise(F.lit(1) + F.pmod(own, F.lit(1 << 20))).alias("_alone"))
    report = reports.where(F.col(milestone).isin(list(milestones)) & _present([*keys, report_at])).select(
        *keys, F.col(report_at).alias("_at"), F.lit(0).cast("bigint").alias("_alone"),
        F.array_position(F.array(*[F.lit(m) for m in milestones]), F.col(milestone)).cast("int").alias("_m"),
        F.struct(F.col(report_at).alias("_at"), F.col(order).alias("_o"), F.col(value).alias("_v")).alias("_r"))
    w = Window.partitionBy(*keys, "_alone").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    told = []
    for i, m in enumerate(milestones, 1):
        one = F.col("_m") == i
        latest = F.max(F.when(one, F.col("_r"))).over(w)
        of = {"first_at": F.min(F.when(one, F.col("_at"))).over(w), "last_at": latest["_at"], "last_value": latest["_v"],
              "reports": F.count(F.when(one, F.lit(1))).over(w)}
        told += [of[x].alias(f"{m}_{x}") for x in FIELDS if x in fields]
    both = trigger.unionByName(report, allowMissingColumns=True)
    return both.select("_row", *told).where(F.col("_row").isNotNull()).select("_row.*", *[
        f"`{m}_{x}`" for m in milestones for x in FIELDS if x in fields])


def asof_state(triggers: DataFrame, reports: DataFrame, keys: Sequence[str], milestones: Sequence[str],
               at: str = "at", report_at: str = "at", milestone: str = "milestone", order: str = "report_id",
               value: str = "value", stretch: int = STRETCH, fields: Sequence[str] = FIELDS,
               cut: bool | None = None) -> DataFrame:
    """triggers with, for each milestone m: ``m_first_at``, ``m_last_at``, ``m_last_value``
    and ``m_reports`` (those of ``fields``), over the reports of the same keys that were made no later than the
    trigger (one of the same instant counts, the trigger's own among them).

    Reports may repeat and come in any order; of one instant the largest ``order`` is the
    latest.  A report without key or instant is a missing one.  A trigger without key
    or instant, or before every report, gets NULLs and 0; each trigger row gives one row.
    ``cut`` False: no key has more than ``stretch`` rows; None: they are counted."""
    if cut is None:
        rows = reports.where(F.col(milestone).isin(list(milestones))).select(*keys).unionByName(triggers.select(*keys))
        cut = _larger(rows.where(_present(keys)), keys, stretch)
    if not cut:
        return _by_key(triggers, reports, keys, milestones, at, report_at, milestone, order, value, fields)
    instants = cut_lineage(_instants(triggers, reports, keys, milestones, at, report_at, milestone, order, value, fields))
    sizes = instants.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"))
    large = cut_lineage(sizes.where(F.col("_d") > stretch))
    many = not large.isEmpty()
    rows = _stretched(instants, large, keys, stretch) if many else instants.withColumn("_b", F.lit(0))
    w = Window.partitionBy(*keys, "_b").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    places = range(len(milestones))
    running = rows.select(*keys, "_b", "_at", "_trigger", *[
        c for i in places for c in _state(i, lambda a: a.over(w), fields)]).where("_trigger")
    if many:
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        ends = rows.groupBy(*keys, "_b").agg(*[c for i in places for c in _state(i, lambda a: a, fields)])
        # how a part of the state takes up what the earlier stretches add up to
        joined = {"_f": (F.min, lambda was, own: F.least(was, own)), "_s": (F.max, lambda was, own: F.greatest(was, own)),
                  "_c": (F.sum, lambda was, own: F.coalesce(was, F.lit(0)) + own)}
        parts = [(f"{p}{i}", *how) for i in places for p, how in joined.items() if f"{p}{i}" in ends.columns]
        carried = ends.select(*keys, "_b", *[add(c).over(before).alias(f"_p{c}") for c, add, _ in parts]).where(F.col("_b") > 0)
        running = running.join(carried, [*keys, "_b"], "left").withColumns(
            {c: both(F.col(f"_p{c}"), F.col(c)) for c, _, both in parts})
    told = {"first_at": "_f{}", "last_at": "_s{}._at", "last_value": "_s{}._v", "reports": "_c{}"}
    state = running.select(
        *[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)], F.col("_at").alias("_state_at"),
        *[F.col(told[x].format(i)).alias(f"{m}_{x}") for i, m in enumerate(milestones) for x in FIELDS if x in fields])
    same = F.col(at) == F.col("_state_at")
    for j, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_k{j}"))
    out = triggers.join(state, same, "left").drop("_state_at", *[f"_k{j}" for j in range(len(keys))])
    if "reports" not in fields:
        return out
    return out.withColumns({f"{m}_reports": F.coalesce(f"{m}_reports", F.lit(0).cast("bigint")) for m in milestones})


def available_as_of(events: DataFrame, key: str = "shipment_id", stages: Sequence[str] | None = None,
                    stretch: int = STRETCH) -> DataFrame:
    """(shipment_id, snapshot_stage, snapshot_at, milestone, reports): the milestones visible
    at each stage's latest report, for any number of milestones in their order (a stage
    looks at itself and the ones before it), on an events table whose reports may repeat."""
    from milepost.config import STAGES
    order = list(stages or STAGES)
    known = events.where(F.col("reported_at").isNotNull() & F.col("milestone").isin(order))
    latest = known.groupBy(key, F.col("milestone").alias("snapshot_stage")).agg(F.max("reported_at").alias("snapshot_at"))
    # a key has at most as many triggers as reports
    cut = _larger(known.where(F.col(key).isNotNull()).select(key), [key], stretch / 2)
    state = asof_state(latest, known, [key], order, at="snapshot_at", report_at="reported_at", order="milestone",
                       value="actual_at", stretch=stretch, fields=("reports",), cut=cut)
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("snapshot_stage"))
    visible = F.filter(F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(m).alias("milestone"),
                                          F.col(f"{m}_reports").alias("reports")) for i, m in enumerate(order)]),
                       lambda x: (x["reports"] > 0) & (x["place"] <= place))
    return state.select(key, "snapshot_stage", "snapshot_at", F.inline(visible)).drop("place")
