import pytest
from pyspark.sql import functions as F

from gridlore.operators import cleaning, periods, profiles, stats
from gridlore.schema import FACT_COLUMNS, SchemaError, project


def facts(spark, *rows):
    keys = sorted({k for r in rows for k in r})
    types = {"valor": "double", "periodo": "int"}
    ddl = ", ".join(f"{k} {types.get(k, 'string')}" for k in keys)
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in rows], ddl)


def test_project_adds_missing_columns(spark):
    out = project(facts(spark, {"item": "a", "valor": 1.0}))
    assert out.columns == FACT_COLUMNS and out.first()["item"] == "a" and out.first()["pais"] is None


def test_normalize_reads_text_numbers(spark):
    df = spark.createDataFrame([(" a ", "1.234,5", "2024.0"), ("", "x", "y")], "item string, valor string, periodo string")
    assert [tuple(r) for r in cleaning.normalize(df, ["item", "valor", "periodo"]).collect()] == [
        (2024, "a", 1234.5), (None, None, None)]


def test_clean_facts(spark):
    base = {"dataset": "d", "item": "x", "periodo": 2024, "indicador": "i", "integrante": "m", "valor": 2.0}
    df = facts(spark, base, {**base, "actor": "other"}, {**base, "periodo": None}, {**base, "periodo": None},
               {**base, "item": " \t"}, {**base, "valor": 0.0}, {**base, "valor": float("nan")}, {**base, "valor": None},
               {**base, "valor": 3.0, "categoria_energia": "Fosil"})
    got = cleaning.clean_facts(df)
    assert sorted((r["periodo"] or 0, r["valor"], r["categoria_energia"]) for r in got.collect()) == [
        (0, 2.0, "Otra"), (2024, 2.0, "Otra"), (2024, 3.0, "Fosil")]


def test_dedupe_is_independent_of_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("v"))
    kept = [sorted(map(tuple, cleaning.distinct_by(df.repartition(n), ["k"]).collect())) for n in (1, 8)]
    assert kept[0] == kept[1] and len(kept[0]) == 7


def test_missing_columns_are_named(spark):
    with pytest.raises(SchemaError, match="indicador"):
        cleaning.analysis_facts(facts(spark, {"region": "r", "valor": 1.0}))


def test_exclude_members_keeps_nulls(spark):
    df = facts(spark, {"tecnologia": "Total"}, {"tecnologia": None}, {"tecnologia": "Coal"})
    assert sorted(str(r[0]) for r in cleaning.exclude_members(df, {"tecnologia": cleaning.SUBTOTALS}).collect()) == [
        "Coal", "None"]


def test_quality_checks(spark):
    empty = facts(spark, {"periodo": 1}).filter("false")
    assert tuple(cleaning.quality_checks(empty).first()) == (False, False, False, False)
    assert tuple(cleaning.quality_checks(facts(spark, {"periodo": 1}, {"periodo": 1}), 2, 1).first()) == (True,) * 4


def years(spark, *pairs):
    return spark.createDataFrame(list(pairs), "dataset string, periodo int")


def test_common_year(spark):
    df = years(spark, ("a", 2020), ("a", 2021), ("b", 2021), ("b", 2020), ("b", 2022), ("c", None))
    assert periods.resolve_common_year(df) == 2021
    assert periods.resolve_common_year(df, 2020) == 2020
    with pytest.raises(ValueError, match="lacking: a"):
        periods.resolve_common_year(df, 2022)
    assert {tuple(r) for r in periods.keep_common_year(df).collect()} == {("a", 2021), ("b", 2021)}


def test_no_common_year(spark):
    df = years(spark, ("a", 2020), ("b", 2021))
    assert periods.common_year(df).first()[0] is None and periods.keep_common_year(df).isEmpty()
    with pytest.raises(ValueError, match="share no period"):
        periods.resolve_common_year(df)
    with pytest.raises(ValueError, match="no dataset"):
        periods.resolve_common_year(years(spark, ("a", None)))


def profile_facts(spark):
    rows = []
    for region, category, gen, co2 in [("r1", "Fosil", 10.0, 5.0), ("r1", "Nuclear", 30.0, 3.0), ("r1", "Otra", 60.0, None),
                                       ("r2", "Fosil", 8.0, 8.0)]:
        common = {"periodo": 2024, "region": region, "categoria_energia": category}
        rows.append({**common, "indicador": profiles.GENERATION, "valor": gen})
        if co2:
            rows.append({**common, "indicador": profiles.EMISSIONS, "valor": co2})
    return facts(spark, *rows)


def test_profile_share_counts_surviving_profiles_only(spark):
    got = {(r["region"], r["categoria_energia"]): r for r in profiles.profile_features(profile_facts(spark)).collect()}
    assert len(got) == 3 and got["r1", "Fosil"]["participacion_generacion"] == 0.25
    assert sorted(map(tuple, profiles.aligned_measures(profile_facts(spark)).collect())) == sorted(
        map(tuple, profiles.aligned_measures_by_join(profile_facts(spark)).collect()))


def test_zscore_edge_cases(spark):
    def z(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return [r["z"] for r in profiles.add_zscore(df, "x", "z").collect()]
    assert z(5.0) == [0.0] and z(3.0, 3.0) == [0.0, 0.0] and sorted(z(1.0, 3.0)) == pytest.approx([-(0.5 ** 0.5), 0.5 ** 0.5])


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 100]], "x double")
    flagged = profiles.flag_outliers(df, "x", "out")
    assert [r["x"] for r in flagged.filter("out").collect()] == [100.0]
    empty = df.filter("false")
    assert profiles.iqr_bounds(empty, "x").first()["lower"] is None
    assert profiles.flag_outliers(empty, "x", "out").isEmpty()
    approx = profiles.iqr_bounds(df, "x", 0.01).first()
    assert approx["q1"] <= approx["q3"]


def test_null_profile_and_confusion(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", None)], "a string, b int")
    assert tuple(stats.null_profile(df).first()) == (1, 2)
    pairs = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    assert [tuple(r) for r in stats.confusion(pairs, "label", "prediction", [0.0, 1.0, 2.0]).collect()] == [
        (0.0, 1, 1, 0), (1.0, 0, 2, 0)]


def test_distinct_rows_of_one_text_stand_together(spark):
    """Rows that share their text are neighbours in what a task writes, which keeps shuffles and files small."""
    df = spark.range(4000).selectExpr("concat('planta ', id % 5) AS item", "cast(id AS double) AS valor", "cast(id % 3 AS string) AS nota")
    out = cleaning.distinct_by(df.unionByName(df), ["item", "valor"])
    items = [r["item"] for r in out.collect()]
    assert len(items) == 4000
    # at most once a shuffle partition
    assert sum(a != b for a, b in zip(items, items[1:])) < 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))
