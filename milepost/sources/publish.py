"""A run replaces all of its tables or none.

Tables are written under a staging folder of the output root.  ``publish`` first writes
one small file that names them (the decision, put in place by a rename), then moves each
table to its place.  A run that stops before the decision leaves every earlier table as it
was; one that stops after it is completed by ``recover``, which the next run calls first.
Only the run's own tables move: other files under the root stay.  One run at a time
writes to a root; a reader that must not see a half-moved run waits while a decision
file exists (``is_settled``)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from milepost.plans.layout import StagedLayout

_STAGING = "_staged-"
_DECISION = "_publish-"


def _fs(spark: SparkSession, folder: str):
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make, make(folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names under root that begin with prefix (a run's leavings: a handful)."""
    make, fs = _fs(spark, root)
    if not fs.exists(make(root)):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(make(root))) if n.startswith(prefix))


def _lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of a small file; read by its own name, as Spark's scans leave out names with ``_``."""
    make, fs = _fs(spark, path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(make(path)), "UTF-8"))
    lines = []
    while (line := reader.readLine()) is not None:
        lines.append(line)
    reader.close()
    return lines


def stage(root: str) -> StagedLayout:
    """A layout whose paths lie in a new staging folder under ``root``."""
    root = root.rstrip("/")
    return StagedLayout(f"{root}/{_STAGING}{uuid.uuid4().hex}", root)


def is_settled(spark: SparkSession, root: str) -> bool:
    """False while a decided run is not yet in place."""
    return not any(n.endswith(".json") for n in _names(spark, root.rstrip("/"), _DECISION))


def _settle(spark: SparkSession, root: str, decision: str) -> None:
    """Move what a decision names; may be run again after it stopped anywhere."""
    make, fs = _fs(spark, root)
    record = json.loads("".join(_lines(spark, f"{root}/{decision}")))
    staging = f"{root}/{record['staging']}"
    for table in record["tables"]:
        source, target = make(f"{staging}/{table}"), make(f"{root}/{table}")
        if fs.exists(source):  # else it is in place already
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"cannot move {source.toString()} to {target.toString()}")
    fs.delete(make(staging), True)
    fs.delete(make(f"{root}/{decision}"), False)


def decide(spark: SparkSession, staged: StagedLayout) -> str:
    """Write the decision that the staged tables replace the earlier ones; its name."""
    make, fs = _fs(spark, staged.final)
    staging = staged.root.rsplit("/", 1)[1]
    missing = [t for t in staged.tables() if not fs.exists(make(f"{staged.root}/{t}"))]
    if missing:
        raise OSError(f"not written: {', '.join(missing)}")
    name = f"{_DECISION}{staging[len(_STAGING):]}.json"
    draft = make(f"{staged.root}/{name}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"staging": staging, "tables": staged.tables()}).encode()))
    out.close()
    if not fs.rename(draft, make(f"{staged.final}/{name}")):
        raise OSError(f"cannot decide {name}")
    return name


def publish(spark: SparkSession, staged: StagedLayout) -> list[str]:
    """Replace the tables under the root by the staged ones; their final paths."""
    _settle(spark, staged.final, decide(spark, staged))
    return [f"{staged.final}/{t}" for t in staged.tables()]


def recover(spark: SparkSession, root: str) -> None:
    """Complete a decided run, drop what undecided ones left."""
    root = root.rstrip("/")
    for decision in _names(spark, root, _DECISION):
        _settle(spark, root, decision)
    make, fs = _fs(spark, root)
    for left in _names(spark, root, _STAGING):
        fs.delete(make(f"{root}/{left}"), True)
