"""Store of fitted fold models: ``<folder>/<model>/<feature_set>/fold=<k>/target=<name>``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader


def model_path(folder: str, model: str, feature_set: str, fold: int, target: str) -> str:
    return f"{folder}/{model}/{feature_set}/fold={fold}/target={target}"


def save_models(models: Mapping[tuple[int, str], Model], folder: str, model: str, feature_set: str) -> list[str]:
    paths = []
    for (fold, target), fitted in models.items():
        paths.append(model_path(folder, model, feature_set, fold, target))
        fitted.write().overwrite().save(paths[-1])
    return paths


def load_models(
    spark, folder: str, model: str, feature_set: str, folds: Sequence[int], targets: Sequence[str]
) -> dict[tuple[int, str], Model]:
    """All fold models; a path that is missing or holds no fitted model is an error."""
    loaded = {}
    for fold in folds:
        for target in targets:
            path = model_path(folder, model, feature_set, fold, target)
            fitted = DefaultParamsReader.loadParamsInstance(path, spark)
            if not isinstance(fitted, Model):
                raise TypeError(f"{path} does not hold a fitted model")
            loaded[fold, target] = fitted
    return loaded
