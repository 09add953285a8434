"""Persist and reload fitted pipelines and models (all stages, including
the custom feature transformers, which are ``DefaultParamsWritable``)."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(cls, path: str):
    """Load a single fitted model, e.g. ``load_model(LogisticRegressionModel, p)``."""
    return cls.load(path)
