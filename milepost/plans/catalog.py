"""Lazy loading of the journey tables for a test-data directory."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.config import Config
from milepost.operators import derive
from milepost.operators.split import known_cuts, split_bounds, split_manifest, split_of, with_split
from milepost.session import configure
from milepost.sources.readers import read_journey_tables
from milepost.sources.testdata import journey_legs


@dataclass
class Journeys:
    journeys: DataFrame     # shipments + reporting array (wide form)
    shipments: DataFrame
    events: DataFrame
    snapshots: DataFrame
    manifest: DataFrame
    cfg: Config
    legs: DataFrame | None = None   # what the journeys are derived from, where not stored
    kept: Journeys | None = field(default=None, repr=False, compare=False)

    def _of(self, *splits) -> DataFrame:
        """Journey rows of the splits: one join for the split label (none where the
        table carries it); everything derived from them is row-local."""
        j = self.journeys
        if "split" not in j.columns:
            j = with_split(j, self.manifest)
        return j.where(F.col("split").isin(list(splits))).drop("split", "split_seed")

    def shipments_of(self, *splits) -> DataFrame:
        return derive.shipments_table(self._of(*splits))

    def materialize(self) -> "Journeys":
        """Write the journey legs once, as columnar files in the shared checkpoint folder.
        They are the narrow form: schedules, delays, reports and the split (by the cuts of
        its order, see split_bounds) follow row by row from pruned columns of them."""
        if self.legs is None:  # they are files already
            return self
        if self.kept is None:
            from milepost.session import ensure_checkpoint_dir
            spark = self.legs.sparkSession
            path = f"{ensure_checkpoint_dir(spark)}/journeys-{uuid.uuid4().hex}"
            self.legs.write.parquet(path)
            legs = spark.read.parquet(path)
            seed, quotas = self.cfg.seed, self.cfg.split_quotas
            cuts = known_cuts(split_bounds(legs, seed, quotas))
            journeys, _, _, _ = derive.derive_all(legs, self.cfg.material_delay_hours)
            journeys = journeys.withColumns({"split": split_of(cuts, seed, quotas), "split_seed": F.lit(seed).cast("int")})
            _, shipments, events, snapshots = derive.derive_from_journeys(journeys, self.cfg.material_delay_hours)
            self.kept = Journeys(journeys, shipments, events, snapshots,
                                 split_manifest(legs, seed, quotas, cuts=cuts), self.cfg)
        return self.kept

    def snapshots_of(self, *splits) -> DataFrame:
        return derive.snapshots_from_journeys(self._of(*splits), self.cfg.material_delay_hours)


@dataclass
class StoredJourneys(Journeys):
    """Journey tables that exist already; ``journeys`` is the shipments table."""

    def _in(self, table: DataFrame, splits) -> DataFrame:
        t = table if "split" in table.columns else with_split(table, self.manifest)
        return t.where(F.col("split").isin(list(splits))).drop("split", "split_seed")

    def shipments_of(self, *splits) -> DataFrame:
        return self._in(self.shipments, splits)

    def snapshots_of(self, *splits) -> DataFrame:
        return self._in(self.snapshots, splits)

    def materialize(self) -> "StoredJourneys":
        """The tables are files already: only the manifest is written, once."""
        from milepost.session import cut_lineage
        return replace(self, manifest=cut_lineage(self.manifest))


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet", cfg: Config | None = None) -> StoredJourneys:
    """A1: shipments, events and snapshots as stored under ``root``."""
    configure(spark)
    cfg = cfg or Config()
    t = read_journey_tables(spark, root, fmt)
    manifest = split_manifest(t["shipments"], cfg.seed, cfg.split_quotas)
    return StoredJourneys(t["shipments"], t["shipments"], t["events"], t["snapshots"], manifest, cfg)


def load(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> Journeys:
    configure(spark)
    cfg = cfg or Config()
    legs = journey_legs(spark, sf_dir)
    journeys, shipments, events, snapshots = derive.derive_all(legs, cfg.material_delay_hours)
    manifest = split_manifest(shipments, cfg.seed, cfg.split_quotas)
    return Journeys(journeys, shipments, events, snapshots, manifest, cfg, legs)
