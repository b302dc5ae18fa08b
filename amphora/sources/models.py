"""Classifier persistence in MLlib's own format (load if present,
else train and save)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from amphora.sources.files import path_exists


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml.classification import LogisticRegressionModel

    return LogisticRegressionModel.load(path)


def load_or_train(path: str, train: Callable[[], object]):
    """The model at ``path`` if one was saved there whole, else a trained and
    saved one. The file system tells whether it is there; any other failure to
    load is an error."""
    if path_exists(SparkSession.active(), f"{path}/metadata/_SUCCESS"):
        return load_model(path)
    model = train()
    save_model(model, path)
    return model
