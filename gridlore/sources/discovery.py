"""Sources found as modules of a package."""

from __future__ import annotations

import importlib
import os
import pkgutil
import shutil
import tempfile
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from gridlore.functions.numbers import parse_int, parse_number
from gridlore.schema import FACT_COLUMNS
from gridlore.sources.registry import Loader, SourceRegistry

# fixed values: how a source module and its entry are named
PREFIX, ENTRY = "scraper_", "ejecutar_extraccion"


def discover(package: str | ModuleType) -> SourceRegistry:
    """A registry of the package's ``scraper_*`` modules, each under its own name.

    A module's ``ejecutar_extraccion`` takes the session and the landing folder, or nothing, and returns a DataFrame or a list of
    dictionaries (a small source read on the driver). A module without it, a wrong return and a package without sources are
    errors that name the module or package. Nothing is read here: all sources are read by one job once their union is used.
    """
    found = importlib.import_module(package) if isinstance(package, str) else package
    names = sorted(m.name for m in pkgutil.iter_modules(found.__path__) if m.name.startswith(PREFIX))
    if not names:
        raise RuntimeError(f"no {PREFIX}* module in {found.__name__}")
    registry = SourceRegistry()
    for name in names:
        entry = getattr(importlib.import_module(f"{found.__name__}.{name}"), ENTRY, None)
        if not callable(entry):
            raise AttributeError(f"{name} has no {ENTRY}")
        registry.register(name, _loader(name, entry))
    return registry


def _loader(name: str, entry) -> Loader:
    def load(spark: SparkSession, folder: str) -> DataFrame:
        code = getattr(entry, "__code__", None)
        result = entry() if code is not None and code.co_argcount == 0 else entry(spark, folder)
        if isinstance(result, DataFrame):
            return result
        if not isinstance(result, list):
            raise TypeError(f"{name}.{ENTRY} must return a DataFrame or a list, not {type(result).__name__}")
        for record in result:
            if not isinstance(record, dict):
                raise TypeError(f"{name}.{ENTRY} must return dictionaries, not {type(record).__name__}")
        return _facts(spark, result)

    return load


def _facts(spark: SparkSession, records: list[dict]) -> DataFrame:
    """The records' fact columns as text, with ``valor`` and ``periodo`` read as numbers; other fields are left out."""
    text = [tuple(None if r.get(c) is None else str(r[c]) for c in FACT_COLUMNS) for r in records]
    rows = spark.createDataFrame(text, ", ".join(f"{c} string" for c in FACT_COLUMNS))
    return rows.withColumns({"valor": parse_number("valor", "string"), "periodo": parse_int("periodo")})


def ship(spark: SparkSession, package: str | ModuleType) -> None:
    """Sends the package of sources to the executors, for loaders whose functions run there."""
    found = importlib.import_module(package) if isinstance(package, str) else package
    top = found.__name__.split(".")[0]
    root = os.path.dirname(os.path.abspath(importlib.import_module(top).__path__[0]))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="sources-"), top), "zip", root, found.__name__.replace(".", "/"))
    spark.addArtifacts(archive, pyfile=True)
