"""Named sources that are run together into one tagged fact frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.operators.cleaning import normalize

Loader = Callable[[SparkSession, str], DataFrame]


class SourceRegistry:
    """Loaders by name; each takes the session and the landing folder and returns a frame."""

    def __init__(self) -> None:
        self._loaders: dict[str, Loader] = {}

    def register(self, name: str, loader: Loader) -> None:
        if name in self._loaders:
            raise ValueError(f"source {name!r} is already registered")
        if not callable(loader):
            raise TypeError(f"source {name!r} is not callable")
        self._loaders[name] = loader

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def load_all(self, spark: SparkSession, folder: str) -> DataFrame:
        """Normalised rows of all sources in name order, each tagged with its source."""
        if not self._loaders:
            raise RuntimeError("no source is registered")
        out = None
        for name in self.names():
            df = self._loaders[name](spark, folder)
            if not isinstance(df, DataFrame):
                raise TypeError(f"source {name!r} must return a DataFrame, not {type(df).__name__}")
            tagged = normalize(df.withColumn("scraper_origen", F.lit(name)))
            out = tagged if out is None else out.unionByName(tagged)
        return out
