"""Batches that reruns replace, tallies from the writes, and sources found by name."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridlore.functions.numbers import currency_to_double
from gridlore.operators import batches
from gridlore.session import new_path
from gridlore.sources.discovery import discover, ship


def prices(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, valor string")


def append(spark, texts, path, batch):
    return batches.append_batch(prices(spark, texts), "valor", currency_to_double("valor"), path, batch)


def test_a_batch_run_again_replaces_itself(spark, rows):
    path = new_path(spark, "batches")
    assert append(spark, ["£1.50", "x", None], path, "a") == {"exitosos": 1, "fallidos": 2}
    assert append(spark, ["£2.00"], path, "b") == {"exitosos": 1, "fallidos": 0}
    assert append(spark, ["£1.50", "x", None], path, "a") == {"exitosos": 1, "fallidos": 2}
    assert rows(batches.batch_rows(spark, path, "cargado")) == [(0, 1.5, "a"), (0, 2.0, "b")]
    held = batches.batch_rows(spark, path, "cuarentena")
    assert rows(held.select("id", "valor", "valor_crudo", "lote")) == [(1, None, "x", "a"), (2, None, None, "a")]
    append(spark, ["£7.00"], path, "a")  # now nothing is held back
    assert batches.batch_rows(spark, path, "cuarentena").count() == 0
    assert append(spark, [], path, "a") == {"exitosos": 0, "fallidos": 0}
    assert rows(batches.batch_rows(spark, path, "cargado")) == [(0, 2.0, "b")]


def test_a_write_that_dies_leaves_what_was_there(spark, rows):
    path = new_path(spark, "batches")
    append(spark, ["£1.50", "£3.00"], path, "a")
    broken = F.when(F.col("id") == 1, F.raise_error(F.lit("lost")).cast("double")).otherwise(currency_to_double("valor"))
    for batch in ("a", "new"):
        with pytest.raises(PySparkException):
            batches.append_batch(prices(spark, ["£9.00"] * 40), "valor", broken, path, batch)
    assert rows(batches.batch_rows(spark, path, "cargado")) == [(0, 1.5, "a"), (1, 3.0, "a")]


def test_tallies_count_every_row_once(spark):
    path = new_path(spark, "observed")
    seen = batches.observed_write(spark.range(1000).repartition(7), lambda df: df.write.parquet(path), n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"n": 1000, "odd": 500} and spark.read.parquet(path).count() == 1000


def package(folder, name, **modules):
    root = folder / name
    root.mkdir()
    (root / "__init__.py").write_text("")
    for module, code in modules.items():
        (root / f"{module}.py").write_text(code)
    return name


def test_modules_are_found_by_name(spark, tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    listed = "def ejecutar_extraccion():\n    return [{'item': ' a ', 'valor': '1,5', 'otro': 3}, {'item': 'b', 'periodo': '2020'}]\n"
    name = package(tmp_path, "found_sources", scraper_b=listed, scraper_a=listed, helper="raise ValueError")
    assert discover(name).names() == ["scraper_a", "scraper_b"]
    got = discover(name).load_all(spark, "here").select("scraper_origen", "item", "valor", "periodo").collect()
    assert sorted((tuple(r) for r in got), key=str) == [
        ("scraper_a", "a", 1.5, None), ("scraper_a", "b", None, 2020), ("scraper_b", "a", 1.5, None), ("scraper_b", "b", None, 2020)]


@pytest.mark.parametrize("code, error, named", [
    ("x = 1\n", AttributeError, "scraper_bad"), ("def ejecutar_extraccion(spark, folder):\n    return 3\n", TypeError, "scraper_bad"),
    ("def ejecutar_extraccion():\n    return [1]\n", TypeError, "scraper_bad"), (None, RuntimeError, "bad_sources")])
def test_a_bad_module_is_named(spark, tmp_path, monkeypatch, code, error, named):
    monkeypatch.syspath_prepend(str(tmp_path))
    name = package(tmp_path, f"bad_sources_{error.__name__}_{len(code or '')}", **({"scraper_bad": code} if code else {}))
    with pytest.raises(error, match=named):
        discover(name).load_all(spark, "here")


def test_a_package_reaches_the_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(str(tmp_path))
    name = package(tmp_path, "shipped_sources", scraper_a="def twice(x):\n    return 2 * x\n\ndef ejecutar_extraccion(spark, folder):\n    return spark.range(1)\n")
    ship(spark, name)

    def run(batches_):
        import pyarrow as pa
        import shipped_sources.scraper_a as a
        for batch in batches_:
            yield pa.RecordBatch.from_arrays([pa.array([a.twice(x) for x in batch.column(0).to_pylist()])], names=["id"])

    assert sorted(r[0] for r in spark.range(3).mapInArrow(run, "id long").collect()) == [0, 2, 4]
