"""Fitted models on shared storage."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import SparkSession

M = TypeVar("M", bound=MLWritable)


def save_model(model: M, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def model_exists(spark: SparkSession, path: str) -> bool:
    """Whether a completely written model lies at ``path``, on any file system."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/metadata/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def load_or_fit(
    spark: SparkSession, path: str, kind: type[MLReadable], fit: Callable[[], M]
) -> M:
    """Load the model at ``path``; where there is none, fit one and save it.

    Only absence triggers a fit. A model that is there but cannot be read is an
    error to be seen, not a reason to retrain silently.
    """
    if model_exists(spark, path):
        return kind.load(path)
    model = fit()
    save_model(model, path)
    return model
