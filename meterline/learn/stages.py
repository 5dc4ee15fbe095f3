"""Fitted pieces as pipeline stages, so that clusters and discriminants are saved like other models."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from meterline.learn import prep
from meterline.learn.lloyd import Centres
from meterline.learn.mixture import Mixture, Summary
from meterline.learn.reduction import Components, Discriminant, discriminate


class ColumnScaler(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - centre) / width of named columns, as fitted."""

    centres = Param(Params._dummy(), "centres", "a value per column", TypeConverters.toListFloat)
    widths = Param(Params._dummy(), "widths", "a unit per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, centres=None, widths=None):  # noqa: N803
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(
            self.getInputCols(),
            self.getOrDefault(self.centres),
            self.getOrDefault(self.widths),
            strict=True,
        )
        return prep.standardise(dataset, {c: (m, s) for c, m, s in fitted})


class NearestCentre(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, the index of the nearest centre to ``features``."""

    points = Param(Params._dummy(), "points", "all centres, end to end", TypeConverters.toListFloat)
    width = Param(Params._dummy(), "width", "numbers of a centre", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, points=None, width=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802  as the fitted models of Spark
        flat = np.array(self.getOrDefault(self.points))
        return list(flat.reshape(-1, self.getOrDefault(self.width)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return Centres(np.array(self.clusterCenters()), 0.0, 0).transform(dataset)


class MixtureStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction`` of a fitted mixture of ``features``."""

    weights = Param(Params._dummy(), "weights", "a share per component", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "k x d, row by row", TypeConverters.toListFloat)
    covariances = Param(Params._dummy(), "covariances", "k x d x d", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, weights=None, means=None, covariances=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> Mixture:
        weights = np.array(self.getOrDefault(self.weights))
        means = np.array(self.getOrDefault(self.means)).reshape(len(weights), -1)
        covariances = np.array(self.getOrDefault(self.covariances))
        d = means.shape[1]
        return Mixture(weights, means, covariances.reshape(-1, d, d), Summary(float("nan"), 0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted().transform(dataset)


class DiscriminantStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds LD1..LDk and ``prediction`` of a fitted linear discriminant."""

    classes = Param(Params._dummy(), "classes", "class labels", TypeConverters.toListFloat)
    centre = Param(Params._dummy(), "centre", "mean of all rows", TypeConverters.toListFloat)
    projection = Param(Params._dummy(), "projection", "d x k, row by row", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "d x classes, row by row", TypeConverters.toListFloat)
    offsets = Param(Params._dummy(), "offsets", "a constant per class", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, classes=None, centre=None, projection=None, weights=None, offsets=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> Discriminant:
        centre = np.array(self.getOrDefault(self.centre))
        projection = np.array(self.getOrDefault(self.projection)).reshape(len(centre), -1)
        weights = np.array(self.getOrDefault(self.weights)).reshape(len(centre), -1)
        return Discriminant(
            classes=self.getOrDefault(self.classes),
            centre=centre,
            projection=projection,
            weights=weights,
            offsets=np.array(self.getOrDefault(self.offsets)),
            ratios=np.zeros(projection.shape[1]),
            count=projection.shape[1],
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return discriminate(self.fitted(), dataset)


def _floats(values) -> list[float]:
    return [float(v) for v in np.ravel(values)]


def stage_of(model: Model | Centres | Mixture | Components | Discriminant) -> Transformer:
    """The model as a stage over ``features``."""
    if isinstance(model, Centres):
        return NearestCentre(points=_floats(model.points), width=model.points.shape[1])
    if isinstance(model, Mixture):
        return MixtureStage(
            weights=_floats(model.weights),
            means=_floats(model.means),
            covariances=_floats(model.covariances),
        )
    if isinstance(model, Components):
        return model.model
    if isinstance(model, Discriminant):
        return DiscriminantStage(
            classes=_floats(model.classes),
            centre=_floats(model.centre),
            projection=_floats(model.projection),
            weights=_floats(model.weights),
            offsets=_floats(model.offsets),
        )
    return model


def scaled_pipeline(
    model: Model | Centres | Mixture | Components | Discriminant,
    columns: Sequence[str],
    scales: dict[str, tuple[float, float]],
) -> PipelineModel:
    """Scaling, assembly and model in one, over the original columns."""
    scaler = ColumnScaler(
        inputCols=list(columns),
        centres=[float(scales[c][0]) for c in columns],
        widths=[float(scales[c][1]) for c in columns],
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return PipelineModel([scaler, assembler, stage_of(model)])
