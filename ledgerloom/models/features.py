"""Fit/transform stages for model input, as Pipeline-ready Estimators and Transformers."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import PCA, OneHotEncoder, OneHotEncoderModel, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import features as fx
from ledgerloom.functions.rules import first_regex
from ledgerloom.functions.text import lowered_or_null
from ledgerloom.operators.order_stats import medians_of, quantiles_of, value_counts_long
from ledgerloom.session import cut_lineage
from ledgerloom.sources.columns import add_missing

MISSING = "__missing__"
RARE = "__rare__"


class _Learned(HasInputCols):
    """Fitted state as one JSON param, so that the stage saves and loads with its pipeline."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


# Learned category lists longer than this stay a distributed table.
LISTED_VALUES = 100_000


class CategoryCollapser(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which categories are frequent; the others become one word.

    With ``unseenApart`` a value never met in training stays as it is, so that an
    indexer after this stage can tell it from a rare one. Up to ``listed`` learned
    values are kept as a list in the stage; more are kept as a table and joined, with
    the same result. A saved stage holds its table in its own folder.
    """

    threshold = Param(Params._dummy(), "threshold", "least count to keep a category", TypeConverters.toInt)
    unseenApart = Param(Params._dummy(), "unseenApart", "leave unseen values alone", TypeConverters.toBoolean)
    listed = Param(Params._dummy(), "listed", "most learned values to keep as a list", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, threshold=15, unseenApart=False, listed=LISTED_VALUES):
        super().__init__()
        self._setDefault(threshold=15, unseenApart=False, listed=LISTED_VALUES)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        columns, least, apart = self.getInputCols(), self.getOrDefault(self.threshold), self.getOrDefault(self.unseenApart)
        texts = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in columns])
        counts = value_counts_long(texts, columns)
        wanted = counts if apart else counts.filter(F.col("count") >= least)
        wanted = cut_lineage(wanted.select("column", "value", (F.col("count") >= least).alias("frequent")))
        state = {"apart": apart, "keep": {c: [] for c in columns}, "rare": {c: [] for c in columns}}
        if wanted.count() > self.getOrDefault(self.listed):
            model = CategoryCollapserModel(columns, json.dumps(state | {"table": True}))
            model.table = wanted
            return model
        for r in wanted.collect():
            state["keep" if r["frequent"] else "rare"][r["column"]].append(r["value"])
        return CategoryCollapserModel(columns, json.dumps(state, sort_keys=True))


class _CollapserWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter(self.stage).saveImpl(path)
        if self.stage.table is not None:
            self.stage.table.write.parquet(f"{path}/learned")


class _CollapserReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        stage = DefaultParamsReader(self.kind).load(path)
        if "table" in stage.learned():
            stage.table = self.sparkSession.read.parquet(f"{path}/learned")
        return stage


class CategoryCollapserModel(Model, _Learned, DefaultParamsReadable, DefaultParamsWritable):
    table: DataFrame | None = None

    def write(self) -> MLWriter:
        return _CollapserWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CollapserReader(cls)

    def __init__(self, columns=None, state=None):
        super().__init__()
        if columns is not None:
            self._set(inputCols=columns, state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = self.learned()
        if "table" in learned:
            return self._joined(df, learned)
        out = {}
        for c in self.getInputCols():
            text = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
            if learned["apart"]:
                out[c] = F.when(text.isin(learned["rare"][c]), RARE).otherwise(text) if learned["rare"][c] else text
            else:
                out[c] = F.when(text.isin(learned["keep"][c]), text).otherwise(RARE)
        return df.withColumns(out)

    def _joined(self, df: DataFrame, learned: dict) -> DataFrame:
        for c in self.getInputCols():
            known = self.table.filter(F.col("column") == c).select(F.col("value").alias("__value"), F.col("frequent").alias("__frequent"))
            df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(MISSING)))
            df = df.join(known, F.col(c) == F.col("__value"), "left")
            rare = ~F.col("__frequent") if learned["apart"] else F.col("__frequent").isNull()
            df = df.withColumn(c, F.when(rare, RARE).otherwise(F.col(c))).drop("__value", "__frequent")
        return df


class QuantileBinner(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Equal-frequency, right-closed bins on exact training quantiles.

    Repeated edges are dropped, columns with few distinct values skipped, NULL
    becomes the missing word. Values beyond the training range fall into the end
    bins. Adds ``<c>_bin`` holding '1', '2', ...
    """

    bins = Param(Params._dummy(), "bins", "number of bins", TypeConverters.toInt)
    leastDistinct = Param(Params._dummy(), "leastDistinct", "skip columns with fewer values", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, bins=6, leastDistinct=8):
        super().__init__()
        self._setDefault(bins=6, leastDistinct=8)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        columns, bins, least = self.getInputCols(), self.getOrDefault(self.bins), self.getOrDefault(self.leastDistinct)
        rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
        doubtful = [c for c in columns if rough[c] < 4 * least]
        if doubtful:
            rough |= df.agg(*[F.count_distinct(c).alias(c) for c in doubtful]).first().asDict()
        used = [c for c in columns if rough[c] >= least]
        found = quantiles_of(df, used, [i / bins for i in range(bins + 1)]) if used else {}
        edges = {c: sorted(set(found[c].values())) for c in used}
        return QuantileBinnerModel(used, json.dumps({"edges": edges}, sort_keys=True))


class QuantileBinnerModel(Model, _Learned, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columns=None, state=None):
        super().__init__()
        if columns is not None:
            self._set(inputCols=columns, state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, edges in self.learned()["edges"].items():
            inner, chain = edges[1:-1], F.when(F.col(c).isNull(), MISSING)
            for i, edge in enumerate(inner, start=1):
                chain = chain.when(F.col(c) <= F.lit(edge), str(i))
            out[f"{c}_bin"] = chain.otherwise(str(len(inner) + 1))
        return df.withColumns(out)


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """NULL to the training median, then (x - mean) / population deviation as ``<c>_scaled``."""

    fillMedian = Param(Params._dummy(), "fillMedian", "fill NULL with the median", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, fillMedian=True):
        super().__init__()
        self._setDefault(fillMedian=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame):
        columns = self.getInputCols()
        fill = medians_of(df, columns) if self.getOrDefault(self.fillMedian) else {}
        ready = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(fill.get(c))).alias(c) for c in columns])
        row = ready.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
        state = {c: [row[f"m_{c}"], row[f"s_{c}"] or 1.0, fill.get(c)] for c in columns}
        return PopulationScalerModel(columns, json.dumps(state))


class PopulationScalerModel(Model, _Learned, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columns=None, state=None):
        super().__init__()
        if columns is not None:
            self._set(inputCols=columns, state=state)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = self.learned()
        return df.withColumns({
            f"{c}_scaled": (F.coalesce(F.col(c).cast("double"), F.lit(fill)) - F.lit(mean)) / F.lit(spread)
            for c, (mean, spread, fill) in learned.items()
        })


class AssetFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Serving-time features of an asset: areas, ratios, logs and a keyword bucket."""

    config = Param(Params._dummy(), "config", "column names and bucket rules as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, config=None):
        super().__init__()
        if config is not None:
            self._set(config=config)

    @classmethod
    def build(cls, object_area: str, land_area: str, price: str, category: str, texts, bucket_rules, default="other"):
        return cls(config=json.dumps({
            "object_area": object_area, "land_area": land_area, "price": price, "category": category,
            "texts": list(texts), "bucket_rules": [list(r) for r in bucket_rules], "default": default,
        }))

    def _transform(self, df: DataFrame) -> DataFrame:
        cfg = json.loads(self.getOrDefault(self.config))
        numbers = {"o": cfg["object_area"], "l": cfg["land_area"], "p": cfg["price"]}
        df = add_missing(df, {c: "double" for c in numbers.values()} | {c: "string" for c in [*cfg["texts"], cfg["category"]]})
        df = df.withColumns({c: F.col(c).try_cast("double") for c in numbers.values()})
        o, l, p = (fx.zero_if_null(c) for c in numbers.values())
        total = o + l
        out = {"total_area_m2_custom": total, **fx.area_flags(o, l, "_custom")}
        for name, a, b in [("object_to_land_ratio", o, l), ("price_per_total_m2", p, total), ("price_per_land_m2", p, l), ("price_per_object_m2", p, o)]:
            out[f"{name}_custom"] = fx.guarded_ratio(a, b, floor=1e-6)
        out["log_price_custom"], out["log_total_area_custom"] = fx.log_amount(p), fx.log_amount(total)
        df = df.withColumns(out).withColumns({c: lowered_or_null(c) for c in cfg["texts"]})
        bucket = first_regex(F.lower(F.coalesce(F.col(cfg["category"]), F.lit(""))), cfg["bucket_rules"], cfg["default"])
        return df.withColumn("asset_type_bucket_custom", bucket)


def one_hot_stages(categorical, min_frequency: int = 5) -> list:
    """Collapse, index and encode so that rare values share a slot and unseen ones are all zero.

    The indexer keeps unseen values in an extra last slot, which ``dropLast``
    takes away again.
    """
    if not categorical:
        return []
    return [
        CategoryCollapser(inputCols=list(categorical), threshold=min_frequency, unseenApart=True),
        StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_idx" for c in categorical], stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], dropLast=True, handleInvalid="error"),
    ]


def ordinal_stage(categorical) -> StringIndexer:
    """Alphabetical index; unseen values take the index after the last."""
    return StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_idx" for c in categorical], stringOrderType="alphabetAsc", handleInvalid="keep")


def matrix_stages(categorical, numeric, min_frequency: int = 5, scale: bool = True, ordinal: bool = False) -> list:
    """Stages ending in ``features``; columns not named here do not take part."""
    stages = [ordinal_stage(categorical)] if ordinal and categorical else one_hot_stages(categorical, min_frequency)
    encoded = [f"{c}_idx" if ordinal else f"{c}_hot" for c in categorical]
    if numeric:
        stages.append(PopulationScaler(inputCols=list(numeric)))
    inputs = [*encoded, *[f"{c}_scaled" for c in numeric]] if scale else [*encoded, *numeric]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Slot names from the assembler's metadata."""
    attrs = df.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]


def slot_columns(stages, df: DataFrame, column: str = "features") -> list[str]:
    """The input column that each slot of ``features`` came from, through scalers and encoders."""
    assembler = next(s for s in reversed(stages) if isinstance(s, VectorAssembler) and s.getOutputCol() == column)
    source = {}
    for stage in stages:
        inputs = stage.getInputCols() if stage.hasParam("inputCols") and stage.isSet("inputCols") else []
        if isinstance(stage, (StringIndexerModel, OneHotEncoderModel)):
            source |= {out: source.get(c, c) for c, out in zip(inputs, stage.getOutputCols())}
        elif isinstance(stage, PopulationScalerModel):
            source |= {f"{c}_scaled": source.get(c, c) for c in inputs}
        elif hasattr(stage, "stat_columns"):
            source |= {out: c for c, outs in stage.stat_columns().items() for out in outs}
    found = []
    for c in assembler.getInputCols():
        attr = df.schema[c].metadata.get("ml_attr", {})
        width = sum(len(group) for group in attr["attrs"].values()) if "attrs" in attr else attr.get("num_attrs", 1)
        found += [source.get(c, c)] * width
    return found


def pca_projection(df: DataFrame, vector: str, k: int, into: str = "projected", standardize: bool = False):
    """(projected frame, explained variance per component); input is centred first."""
    stages = Pipeline(stages=[
        StandardScaler(inputCol=vector, outputCol="__centred", withMean=True, withStd=standardize),
        PCA(k=k, inputCol="__centred", outputCol=into),
    ])
    model = stages.fit(df)
    return model.transform(df).drop("__centred"), [float(v) for v in model.stages[-1].explainedVariance]


__all__ = [
    "AssetFeatures", "CategoryCollapser", "PopulationScaler", "QuantileBinner", "array_to_vector", "feature_names",
    "matrix_stages", "one_hot_stages", "ordinal_stage", "pca_projection", "slot_columns", "vector_to_array",
]
