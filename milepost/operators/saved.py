"""Stages of a saved model: fitted preparation, tree ensembles as tables, calibration and
decision, all Spark ML transformers that a PipelineModel writes and reads again (A5).

``FeatureEncoder`` (F12-F14) fits exact medians, modes and levels.  Levels stay a table:
indexed over range partitions, joined to the rows, and one sparse vector holds the
one-hot part, so neither the plan nor the driver grows with their number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from milepost.operators.features import _number, leakage_columns
from milepost.operators.lookup import lookup_join
from milepost.operators.quantile import grouped_medians
from milepost.operators.risk import risk_alert, risk_level, sigmoid_of_line
from milepost.session import cut_lineage, ensure_checkpoint_dir


def numbered(rows: DataFrame, by: Sequence[str], group: str, out: str) -> DataFrame:
    """rows + ``out``: 0, 1, ... within each ``group`` in the order of ``by``.  Rows are
    dealt by ranges; each range numbers its own rows and adds what lies before it (a
    row per range and group), so no task holds a whole group."""
    dealt = rows.repartitionByRange(group, *by).withColumn("_part", F.spark_partition_id())
    own = cut_lineage(dealt.withColumn("_nth", F.row_number().over(
        Window.partitionBy("_part", group).orderBy(*by)) - 1))
    size = own.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_size"))
    before = size.withColumn("_before", F.sum("_size").over(Window.partitionBy(group).orderBy("_part")) - F.col("_size"))
    return own.join(before.drop("_size"), ["_part", group]).withColumn(
        out, F.col("_nth") + F.col("_before")).drop("_part", "_nth", "_before")


class _Encoding(Params):
    numericCols = Param(Params._dummy(), "numericCols", "columns imputed by their median", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns that become one-hot", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "the feature vector", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "medians, indicators, modes and level counts (JSON)", TypeConverters.toString)


class FeatureEncoder(Estimator, _Encoding, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation with indicators, mode imputation, one-hot levels."""

    @keyword_only
    def __init__(self, *, numericCols=(), categoricalCols=(), outputCol="features"):
        super().__init__()
        self._set(numericCols=list(numericCols), categoricalCols=list(categoricalCols), outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> "FeatureEncoderModel":
        numeric, kinds = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        denied = leakage_columns([*numeric, *kinds])
        if denied:
            raise ValueError(f"not allowed as features: {denied}")
        medians, gaps = {}, {}
        if numeric:
            medians = {c: m for c, m in grouped_medians(dataset, [], numeric).first().asDict().items() if m is not None}
            gaps = dataset.agg(*[F.count_if(_number(F.col(c).cast("double")).isNull()).alias(c) for c in numeric]).first().asDict()
        modes, sizes, levels = {}, {}, None
        if kinds:
            stacked = F.inline(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("level")) for c in kinds]))
            counts = cut_lineage(dataset.select(stacked).where("level IS NOT NULL").groupBy("kind", "level")
                                 .agg(F.count(F.lit(1)).alias("n")))
            for r in counts.groupBy("kind").agg(F.min_by("level", F.struct(-F.col("n"), "level")).alias("mode"),
                                                F.count(F.lit(1)).alias("size")).collect():  # one row a column
                modes[r["kind"]], sizes[r["kind"]] = r["mode"], r["size"]
            levels = cut_lineage(numbered(counts.drop("n"), ["level"], "kind", "index"))
        model = FeatureEncoderModel(levels)
        fitted = {"medians": medians, "indicators": [c for c in numeric if c in medians and gaps[c]], "modes": modes, "sizes": sizes}
        return self._copyValues(model)._set(fitted=json.dumps(fitted, sort_keys=True))


class _EncoderWriter(MLWriter):
    def __init__(self, model: "FeatureEncoderModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.levels is not None:
            self.model.levels.write.mode("overwrite").parquet(f"{path}/levels")


class _EncoderReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "FeatureEncoderModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if json.loads(model.getOrDefault("fitted"))["sizes"]:
            model.levels = self.sparkSession.read.parquet(f"{path}/levels")
        return model


class FeatureEncoderModel(Model, _Encoding, MLWritable, MLReadable):
    def __init__(self, levels: DataFrame | None = None):
        super().__init__()
        self.levels = levels

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)

    def _sizes(self) -> dict[str, int]:
        sizes = json.loads(self.getOrDefault("fitted"))["sizes"]
        return {c: sizes[c] for c in self.getOrDefault("categoricalCols") if c in sizes}

    def feature_names(self) -> list[str]:
        """Names of the vector's numeric places; the levels of each column follow."""
        f = json.loads(self.getOrDefault("fitted"))
        return [c for c in self.getOrDefault("numericCols") if c in f["medians"]] + [f"missingindicator_{c}" for c in f["indicators"]]

    def imputed(self, dataset: DataFrame) -> DataFrame:
        """F12 and F13 in place, before the levels are looked up."""
        f = json.loads(self.getOrDefault("fitted"))
        value = {c: _number(F.col(c).cast("double")) for c in self.getOrDefault("numericCols")}
        return dataset.withColumns(
            {c: F.coalesce(value[c], F.lit(m)) for c, m in f["medians"].items()}
            | {f"missingindicator_{c}": value[c].isNull().cast("double") for c in f["indicators"]}
            | {c: F.coalesce(F.col(c).cast("string"), F.lit(m)) for c, m in f["modes"].items()})

    def indexed(self, dataset: DataFrame) -> DataFrame:
        """dataset + ``_ix_<column>``: the place of its level, NULL where it was not seen."""
        for c in self._sizes():
            table = self.levels.where(F.col("kind") == c).select(F.col("level").alias(f"_lv_{c}"), F.col("index").alias(f"_ix_{c}"))
            keyed = dataset.withColumn(f"_lv_{c}", F.col(c))
            dataset = lookup_join(keyed, table, [f"_lv_{c}"], salt=F.xxhash64(*[F.col(x) for x in self.getOrDefault("numericCols")])) \
                .drop(f"_lv_{c}")
        return dataset

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes = self._sizes()
        own = {c: F.col(c) for c in [*self.feature_names(), *sizes]}
        ready = self.indexed(self.imputed(dataset.withColumns({f"_own_{c}": F.col(c) for c in own if c in dataset.columns})))
        names = self.feature_names()
        if sizes:
            ready = ready.withColumns({f"_ix_{c}": F.coalesce(F.col(f"_ix_{c}"), F.lit(n)).cast("double") for c, n in sizes.items()})
            one = dataset.sparkSession.createDataFrame([tuple(float(n - 1) for n in sizes.values())], [f"_ix_{c}" for c in sizes])
            hot = OneHotEncoder(inputCols=one.columns, outputCols=[f"_hot_{c}" for c in sizes], handleInvalid="keep").fit(one)
            ready, names = hot.transform(ready), [*names, *[f"_hot_{c}" for c in sizes]]
        out = self.getOrDefault("outputCol")
        return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep").transform(ready).select(
            *[F.col(f"_own_{c}").alias(c) if c in own else F.col(c) for c in dataset.columns], out)


# tree ensembles as tables

NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, value double"


def node_table(model) -> list[tuple]:
    """Rows (tree, node, feature, cut, left, right, value) of a fitted ensemble; a leaf has
    a value, weighted with its tree, any other node sends x <= cut to the left."""
    out = []
    for t, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        todo, n = [(0, tree._call_java("rootNode"))], 1
        while todo:
            at, node = todo.pop()
            if node.subtreeDepth() == 0:
                out.append((t, at, None, None, None, None, float(node.prediction()) * float(weight)))
                continue
            split, sides = node.split(), [node.leftChild(), node.rightChild()]
            if split.getClass().getSimpleName() == "ContinuousSplit":
                cut = float(split.threshold())
            else:  # of two values, 0 and 1
                cut = 0.5
                if 0.0 not in list(split.leftCategories()):
                    sides.reverse()
            out.append((t, at, int(split.featureIndex()), cut, n, n + 1, None))
            todo += [(n, sides[0]), (n + 1, sides[1])]
            n += 2
    return sorted(out)


def tree_sum(nodes: Sequence[tuple], feature) -> Column:
    """The sum of the leaves that a row reaches; ``feature(i)`` is the i-th feature."""
    trees: dict[int, dict[int, tuple]] = {}
    for tree, node, *rest in nodes:
        trees.setdefault(tree, {})[node] = rest

    def reach(tree: dict, at: int) -> Column:
        i, cut, left, right, value = tree[at]
        return F.lit(float(value)) if i is None else F.when(feature(i) <= cut, reach(tree, left)).otherwise(reach(tree, right))

    total = F.lit(0.0)
    for t in sorted(trees):
        total = total + reach(trees[t], 0)
    return total


class TreeTable(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """An ensemble given as a node table, over columns or a feature vector."""

    nodes = Param(Params._dummy(), "nodes", "rows of the node table (JSON)", TypeConverters.toString)
    inputCols = Param(Params._dummy(), "inputCols", "the features in their order", TypeConverters.toListString)
    vectorCol = Param(Params._dummy(), "vectorCol", "a feature vector in place of columns", TypeConverters.toString)
    probability = Param(Params._dummy(), "probability", "give the probability of a boosted classifier", TypeConverters.toBoolean)
    outputCol = Param(Params._dummy(), "outputCol", "the score", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, nodes="[]", inputCols=(), vectorCol="", probability=False, outputCol="score"):
        super().__init__()
        self._set(nodes=nodes, inputCols=list(inputCols), vectorCol=vectorCol, probability=probability, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nodes, vector, columns = json.loads(self.getOrDefault("nodes")), self.getOrDefault("vectorCol"), self.getOrDefault("inputCols")
        own = dataset.withColumn("_x", vector_to_array(vector) if vector else F.array(*[F.col(c).cast("double") for c in columns]))
        total = tree_sum(nodes, lambda i: F.col("_x")[i])
        if self.getOrDefault("probability"):  # of the positive class
            total = F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * total))
        return own.withColumn(self.getOrDefault("outputCol"), total).drop("_x")


class RiskDecision(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Calibrated probability, level and alert of a raw probability."""

    rawCol = Param(Params._dummy(), "rawCol", "the raw probability", TypeConverters.toString)
    slope = Param(Params._dummy(), "slope", "of the calibration line", TypeConverters.toFloat)
    intercept = Param(Params._dummy(), "intercept", "of the calibration line", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "from which a shipment is alerted", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, rawCol="risk_raw_probability", slope=1.0, intercept=0.0, threshold=0.29):
        super().__init__()
        self._set(rawCol=rawCol, slope=slope, intercept=intercept, threshold=threshold)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        line = sigmoid_of_line(self.getOrDefault("rawCol"), self.getOrDefault("slope"), self.getOrDefault("intercept"))
        return dataset.withColumn("risk_probability", line).withColumns({
            "risk_level": risk_level(), "predicted_material_delay": risk_alert(threshold=self.getOrDefault("threshold"))})


def saved_and_loaded(model: PipelineModel, spark: SparkSession, path: str | None = None) -> PipelineModel:
    """Write a pipeline and read it as a new object."""
    path = path or f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
