import os

import pytest

from gridlore.plans import inputs, jobs
from gridlore.session import materialize, new_path
from gridlore.sources.registry import SourceRegistry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_integrate_twice_changes_nothing(spark):
    registry = SourceRegistry()
    registry.register("scraper_lines", inputs.line_facts)
    registry.register("scraper_orders", inputs.order_facts)
    store, export = new_path(spark, "store"), new_path(spark, "export")
    clean, first = jobs.integrate(spark, registry, FOLDER, store, export)
    stored = spark.read.parquet(store)
    assert first.first()["inserted"] == stored.count() <= clean.count()
    assert [r[0] for r in clean.select("periodo").distinct().collect()] == [2001]
    assert spark.read.option("header", True).csv(f"{export}/csv").count() == clean.count()
    _, second = jobs.integrate(spark, registry, FOLDER, store, export)
    assert second.first()["inserted"] == 0 and second.first()["modified"] == 0
    with pytest.raises(ValueError, match="1990"):
        jobs.integrate(spark, registry, FOLDER, store, year=1990)


def test_analysis_jobs(spark):
    facts = materialize(inputs.line_facts(spark, FOLDER), "facts")
    out = new_path(spark, "out")
    features = jobs.explore(facts, f"{out}/eda")
    assert spark.read.option("header", True).csv(f"{out}/eda/correlacion_spearman").count() == 16
    clustered, k = jobs.cluster(features, f"{out}/clusters")
    assert 2 <= k <= 10 and clustered.count() == features.count()
    assert spark.read.option("header", True).csv(f"{out}/clusters/clusters_dbscan").count() == features.count()
    board = jobs.supervise(clustered, f"{out}/models")
    assert board.count() == 4
    assert spark.read.option("header", True).csv(f"{out}/models/metricas_regresion").count() == 1
