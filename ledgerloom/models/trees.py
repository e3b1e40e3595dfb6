"""Tree ensembles whose fits run side by side: forests in parts, boosting by class with early stopping.

Trees only ask on which side of their thresholds a feature lies. Rows that lie alike at all
thresholds form a cell and get the same answer, so an ensemble is asked once for each cell
that occurs, and the answers are joined to the rows.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.models.forest import CountedForest
from ledgerloom.session import cut_lineage, spread

# What a forest may hold of node statistics at once, and how often cached node ids are written.
FOREST_MEMORY_MB, CHECKPOINT_EVERY = 1000, 10

# Most places of a cell in one number of its key, and cells that are sent to all tasks at most.
KEY_RANGE, SENT_CELLS = 2**62, 400_000
_QUESTION = re.compile(r"feature (\d+) (?:<= ([^)]+)|in \{([^}]*)\})")


def thresholds(descriptions) -> dict[int, list[float]]:
    """Ascending values per feature between which no tree tells values apart, from the trees' descriptions."""
    found: dict[int, set[float]] = {}
    for text in descriptions:
        for feature, most, members in set(_QUESTION.findall(text)):
            if most:
                found.setdefault(int(feature), set()).add(float(most))
            else:
                # Categories are whole numbers from 0; those above all named ones are answered alike.
                top = max((int(float(x)) for x in members.split(",") if x), default=-1)
                found.setdefault(int(feature), set()).update(float(i) for i in range(top + 1))
    return {feature: sorted(values) for feature, values in sorted(found.items())}


def _place(value: Column, edge: list[float]) -> Column:
    """How many edges the value exceeds; not a number exceeds all."""
    return F.size(F.filter(F.array(*[F.lit(e) for e in edge]), lambda e: ~(value <= e))).cast("long")


def by_cells(df: DataFrame, edges: dict[int, list[float]], size: int, score, features: str = "features") -> DataFrame:
    """``df`` with the columns that ``score`` adds to a frame of ``features``, asked once for each cell of ``df``.

    A cell is the place of every asked feature among its ``edges``; its features are the least edges that are not less.
    """
    # A column of its own, as a lambda would unpack the vector for every edge.
    values, df = F.col("__values"), df.withColumn("__values", vector_to_array(features))
    keys, radix, parts = [], [], []
    for feature, edge in edges.items():
        place = _place(values[feature], edge)
        if not keys or radix[-1] * (len(edge) + 1) > KEY_RANGE:
            keys.append(place)
            radix.append(1)
        else:
            keys[-1] = keys[-1] + place * F.lit(radix[-1])
        parts.append((len(keys) - 1, radix[-1], feature, edge))
        radix[-1] *= len(edge) + 1
    names = [f"__cell_{i}" for i in range(len(keys))] or ["__cell_0"]
    keyed = df.withColumns(dict(zip(names, keys or [F.lit(0).cast("long")]))).drop("__values")
    point = [F.lit(0.0)] * size
    for key, below, feature, edge in parts:
        place = F.pmod(F.expr(f"{names[key]} div {below}"), F.lit(len(edge) + 1))
        point[feature] = F.get(F.array(*[F.lit(e) for e in [*edge, edge[-1] + 1]]), place.cast("int"))
    cells = cut_lineage(spread(keyed.select(*names).distinct()))
    asked = score(cells.select(*names, array_to_vector(F.array(*point)).alias(features))).drop(features)
    asked = cut_lineage(asked)
    if asked.count() <= SENT_CELLS:
        asked = F.broadcast(asked)
    return keyed.join(asked, names).drop(*names)


class CellForest(RandomForestClassificationModel):
    """A forest that is asked once for each cell of the rows."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if not hasattr(self, "_edges"):
            self._edges = thresholds([self.toDebugString])
        return by_cells(df, self._edges, self.numFeatures, super()._transform, self.getFeaturesCol())


class CellOneVsRest(OneVsRestModel):
    """Boosted models of the classes that are asked once for each cell of the rows."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if not hasattr(self, "_edges"):
            self._edges = thresholds(m.toDebugString for m in self.models)
        return by_cells(df, self._edges, self.models[0].numFeatures, super()._transform, self.getFeaturesCol())


def random_forest(trees: int = 100, depth: int = 10, features: str = "0.35", seed: int = 42, parts: int = 1, **extra):
    """A forest with cached node ids; with ``parts`` its trees are grown in so many concurrent fits.

    Depth is 30 at most, as in MLlib. Class balance comes from the weight column. One fit
    spreads over the partitions of its rows, which suits large tables; on a bounded sample
    in one partition, parts use the cores instead.
    """
    if depth > 30:
        raise ValueError(f"depth {depth} is over 30, the greatest a forest can have")
    options = {"cacheNodeIds": True, "maxMemoryInMB": FOREST_MEMORY_MB, "checkpointInterval": CHECKPOINT_EVERY} | extra
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy=features, weightCol="weight", seed=seed, **options)
    return ForestInParts(forest, min(parts, trees)) if parts > 1 else forest


def counted_forest(trees: int = 100, depth: int = 10, features: float = 0.35, seed: int = 42, parts: int = 1):
    """The forest of ``random_forest`` over any number of rows: its trees are grown over counted cells, see ``forest``."""
    return CountedForest(trees, depth, features, seed, random_forest(trees, depth, str(features), seed, parts))


class ForestInParts:
    """Fits shares of a forest's trees concurrently and joins them in one model."""

    def __init__(self, forest: RandomForestClassifier, parts: int):
        self.forest, self.parts = forest, parts

    def fit(self, df: DataFrame) -> CellForest:
        count, seed = self.forest.getNumTrees(), self.forest.getSeed()
        shares = [count // self.parts + (i < count % self.parts) for i in range(self.parts)]

        def grow(i: int):
            return self.forest.copy({self.forest.numTrees: shares[i], self.forest.seed: seed + i}).fit(df)

        with ThreadPoolExecutor(self.parts) as pool:
            models = list(pool.map(grow, range(self.parts)))
        return join_forests(models)


def join_forests(models: list[RandomForestClassificationModel]) -> CellForest:
    """One forest of all trees."""
    first = models[0]
    gateway = SparkContext._active_spark_context._gateway
    trees = [t for m in models for t in m._java_obj.trees()]
    kind = gateway.jvm.org.apache.spark.ml.classification
    held = gateway.new_array(kind.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        held[i] = tree
    joined = CellForest(kind.RandomForestClassificationModel(first.uid, held, first.numFeatures, first.numClasses))
    joined._set(numTrees=len(trees))
    for param in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol"):
        joined._set(**{param: first.getOrDefault(param)})
    joined._transfer_params_to_java()
    return joined


class BoostedPerClass:
    """One boosted binary model per class, the classes fitted concurrently; MLlib boosting itself is binary.

    Of the rows given, the share ``validation`` (by the column ``digest``) only watches: a class
    stops at the first tree that makes the loss there worse and keeps the best number of trees.
    """

    def __init__(self, iterations: int = 20, depth: int = 5, step: float = 0.1, seed: int = 42, validation: float = 0.15, least_bins: int = 32):
        self.options = {"maxIter": iterations, "maxDepth": depth, "stepSize": step, "seed": seed, "checkpointInterval": CHECKPOINT_EVERY}
        self.validation, self.least_bins = validation, least_bins

    def bins(self, df: DataFrame) -> int:
        """A bin for each category of the widest categorical slot, at least ``least_bins``."""
        attrs = df.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
        return max([self.least_bins, *[len(a.get("vals", [])) + 1 for a in attrs.get("nominal", [])]])

    def fit(self, df: DataFrame) -> CellOneVsRest:
        booster = GBTClassifier(weightCol="weight", maxBins=self.bins(df), **self.options)
        if self.validation:
            watched = F.pmod(F.col("digest"), F.lit(10_000)) < int(10_000 * self.validation)
            df = df.withColumn("watched", watched)
            booster = booster.setParams(validationIndicatorCol="watched", validationTol=0.0)
        classes = len(df.schema["label"].metadata["ml_attr"]["vals"])

        def boost(label: int):
            return booster.fit(df.withColumn("label", (F.col("label") == label).cast("double")))

        with ThreadPoolExecutor(classes) as pool:
            models = list(pool.map(boost, range(classes)))
        joined = CellOneVsRest(models=models)
        OneVsRest(classifier=GBTClassifier())._copyValues(joined)
        return joined


def boosted_trees(iterations: int = 20, depth: int = 5, step: float = 0.1, seed: int = 42, validation: float = 0.15) -> BoostedPerClass:
    return BoostedPerClass(iterations, depth, step, seed, validation)
