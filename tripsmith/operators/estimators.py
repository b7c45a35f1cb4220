"""``pyspark.ml`` Estimator / Model pairs of the library's models (J1, J2, J4, J9, J12), their
persistence (A12) and walk-forward validation of any estimator (J10).

Each pair fits by the DataFrame functions of its module, works as a stage of a ``Pipeline`` and is
saved and loaded like MLlib's own: parameters as MLlib writes them, the fitted state as Parquet
tables beside them.  Models add ``predictionCol`` to every row that comes in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from . import boosted as B
from . import calibration as CA
from .metrics import five_metrics
from .models import LOOKUP_KEYS, complete, fit_lookup, fit_ols, linear_expression, predict_lookup
from .splits import Fold, assign_folds


# -- persistence (A12) ------------------------------------------------------------------------
class _StateWriter(MLWriter):
    """MLlib's metadata, and what the model writes of its state under ``path``/state."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model._write_state(self.sparkSession, f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model._read_state(self.sparkSession, f"{path}/state")
        return model


class SavedModel(Model, MLWritable):
    """A model whose state outlives its session."""

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)

    @classmethod
    def load(cls, path: str):
        return cls.read().load(path)

    def _write_state(self, spark: SparkSession, path: str) -> None:
        raise NotImplementedError

    def _read_state(self, spark: SparkSession, path: str) -> None:
        raise NotImplementedError


def _put(spark: SparkSession, path: str, state: dict) -> None:
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.parquet(path)


def _got(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()[0])


# -- parameters -------------------------------------------------------------------------------
class _Common(HasLabelCol, HasPredictionCol, Params):
    inputCols = Param(Params._dummy(), "inputCols", "features or lookup keys", TypeConverters.toListString)
    weightCol = Param(Params._dummy(), "weightCol", "column of row weights; empty: none", TypeConverters.toString)
    clip = Param(Params._dummy(), "clip", "least prediction; NaN: none", TypeConverters.toFloat)
    keyCol = Param(Params._dummy(), "keyCol", "row key that samples are drawn by", TypeConverters.toString)
    validationCol = Param(Params._dummy(), "validationCol", "boolean column of validation rows; empty: none", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "settings of a boosted fit, by name", TypeConverters.identity)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol=C.TARGET, predictionCol="prediction", inputCols=list(C.FEATURES), weightCol="", clip=float("nan"),
                         keyCol=C.KEY_COL, validationCol="", settings={})

    def _of(self, name: str):
        return self.getOrDefault(name)

    def _clipped(self, column):
        low = self._of("clip")
        return column if low != low else F.greatest(column, F.lit(low))


class _Fits(_Common, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator that is set by keyword: ``LeastSquares(inputCols=[...], clip=60.0)``."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def setParams(self, **params):
        return self._set(**params)

    def _done(self, model):
        return self._copyValues(model)


# -- J1 ---------------------------------------------------------------------------------------
class LookupModel(_Common, SavedModel):
    """Mean target per key cell; unseen cells get the overall mean and ``is_fallback``."""

    def __init__(self, cells: DataFrame | None = None, overall: float | None = None):
        super().__init__()
        self.cells, self.overall = cells, overall

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        mean = spark.createDataFrame([(self.overall,)], "global_mean double")
        return predict_lookup(df, self.cells, mean, self._of("inputCols"), out=self._of("predictionCol"))

    def _write_state(self, spark, path):
        _put(spark, f"{path}/overall", {"overall": self.overall})
        self.cells.write.parquet(f"{path}/cells")

    def _read_state(self, spark, path):
        self.overall, self.cells = _got(spark, f"{path}/overall")["overall"], spark.read.parquet(f"{path}/cells")


class LookupBaseline(_Fits):
    """J1 as an estimator; ``inputCols`` are the lookup keys.  With the default keys the table has 168 rows at most."""

    def __init__(self, **params):
        super().__init__(**{"inputCols": list(LOOKUP_KEYS), **params})

    def _fit(self, df: DataFrame) -> LookupModel:
        target, keys = self._of("labelCol"), self._of("inputCols")
        cells = fit_lookup(df, target, keys).checkpoint()
        overall = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
        return self._done(LookupModel(cells, overall))


# -- J2 ---------------------------------------------------------------------------------------
class LeastSquaresModel(_Common, SavedModel):
    """``intercept + sum(w * x)``; a row that lacks a feature has a NULL prediction."""

    def __init__(self, coefficients: dict[str, float] | None = None, intercept: float = 0.0, spread: dict[str, float] | None = None):
        super().__init__()
        self.coefficients, self.intercept, self.spread = coefficients or {}, intercept, spread or {}

    def _transform(self, df: DataFrame) -> DataFrame:
        value = self._clipped(linear_expression(self.coefficients, self.intercept))
        return df.withColumn(self._of("predictionCol"), F.when(complete(list(self.coefficients)), value))

    def _write_state(self, spark, path):
        _put(spark, path, {"coefficients": self.coefficients, "intercept": self.intercept, "spread": self.spread})

    def _read_state(self, spark, path):
        state = _got(spark, path)
        self.coefficients, self.intercept, self.spread = state["coefficients"], state["intercept"], state["spread"]


class LeastSquares(_Fits):
    """J2 in closed form, optionally weighted (J7) and clipped."""

    def _fit(self, df: DataFrame) -> LeastSquaresModel:
        return self._done(LeastSquaresModel(*fit_ols(df, self._of("inputCols"), self._of("labelCol"), self._of("weightCol") or None)))


# -- J4 ---------------------------------------------------------------------------------------
class BoostedTreesModel(_Common, SavedModel):
    def __init__(self, model: B.BoostedModel | None = None):
        super().__init__()
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self._of("predictionCol"), self._clipped(self.model.score()))

    def _write_state(self, spark, path):
        self.model.save(spark, path)

    def _read_state(self, spark, path):
        self.model = B.BoostedModel.load(spark, path)


class BoostedTrees(_Fits):
    """J4 / J7; rows where ``validationCol`` is true stop the fit early."""

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        val = self._of("validationCol")
        train, held = (df.where(~F.col(val)), df.where(F.col(val))) if val else (df, None)
        return self._done(BoostedTreesModel(B.fit_boosted(
            train, self._of("inputCols"), self._of("labelCol"), held, self._of("weightCol") or None, self._of("keyCol"),
            B.Params(**self._of("settings")))))


# -- E11 / J12, J9 ----------------------------------------------------------------------------
class SpikeBinsModel(_Common, SavedModel):
    """The spike probability of the bin that a prediction (the one input column) falls into."""

    def __init__(self, bins: DataFrame | None = None):
        super().__init__()
        self.bins = bins

    def _transform(self, df: DataFrame) -> DataFrame:
        return CA.spike_probability(df, self.bins, self._of("inputCols")[0], self._of("predictionCol"))

    def _write_state(self, spark, path):
        self.bins.write.parquet(path)

    def _read_state(self, spark, path):
        self.bins = spark.read.parquet(path)


class SpikeBins(_Fits):
    """E11 as an estimator over a prediction column and a 0/1 label."""

    def __init__(self, **params):
        super().__init__(**{"inputCols": ["prediction"], "labelCol": "spike", "predictionCol": "spike_prob", **params})

    def _fit(self, df: DataFrame) -> SpikeBinsModel:
        return self._done(SpikeBinsModel(CA.spike_bins(df, self._of("inputCols")[0], self._of("labelCol")).checkpoint()))


class CalibratorModel(_Common, SavedModel):
    def __init__(self, model: IsotonicRegressionModel | None = None):
        super().__init__()
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        return CA.apply_isotonic(self.model, df, self._of("inputCols")[0], self._of("predictionCol"))

    def _write_state(self, spark, path):
        self.model.write().save(path)

    def _read_state(self, spark, path):
        self.model = IsotonicRegressionModel.load(path)


class Calibrator(_Fits):
    """A non-decreasing map of a probability column, fitted on a 0/1 label."""

    def __init__(self, **params):
        super().__init__(**{"inputCols": ["spike_prob"], "labelCol": "spike", "predictionCol": "calibrated_prob", **params})

    def _fit(self, df: DataFrame) -> CalibratorModel:
        return self._done(CalibratorModel(CA.fit_isotonic(df, self._of("inputCols")[0], self._of("labelCol"))))


# -- J10 --------------------------------------------------------------------------------------
def walk_forward(df: DataFrame, folds: Sequence[Fold], estimator: Estimator, params: dict | None = None, target: str = C.TARGET,
                 prediction: str = "prediction", parallelism: int = 2,
                 each: Callable[[str, Transformer], None] | None = None) -> DataFrame:
    """J10 for any estimator: a row of metrics per fold.

    ``params`` (by name) are set on a copy of the estimator.  Fold rows are written once to the shared
    folder, partitioned by fold and role, so that a fit reads its own rows only; ``parallelism`` folds
    are fitted at a time.  A fold without training or validation rows has no metrics row.  ``each``
    gets every fold's name and fitted model.
    """
    from ..sources.sinks import scratch_path
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "folds")
    assigned = assign_folds(df, folds).where(F.col("role").isin("train", "val"))
    assigned.write.partitionBy("fold", "role").parquet(path)
    held = spark.read.schema(assigned.schema).parquet(path)
    present = {(r.fold, r.role) for r in held.select("fold", "role").distinct().collect()}  # two rows a fold at most
    chosen = estimator.copy({estimator.getParam(k): v for k, v in (params or {}).items()})

    def run(fold: Fold) -> DataFrame | None:
        if not {(fold.name, "train"), (fold.name, "val")} <= present:
            return None
        part = held.where(F.col("fold") == fold.name)
        model = chosen.fit(part.where(F.col("role") == "train"))
        if each is not None:
            each(fold.name, model)
        return model.transform(part.where(F.col("role") == "val")).select("fold", target, prediction)

    pool = ThreadPool(max(1, min(parallelism, len(folds))))
    try:
        scored = [s for s in pool.map(run, folds) if s is not None]
    finally:
        pool.close()
    if not scored:
        raise ValueError("no fold has training and validation rows")
    out = scored[0]
    for s in scored[1:]:
        out = out.unionByName(s)
    return five_metrics(out, target, prediction, by=["fold"])
