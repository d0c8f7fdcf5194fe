import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.operators import pages
from gridlore.session import new_path
from gridlore.sources import files, loaders, sinks
from gridlore.sources.registry import SourceRegistry


def land(spark, name, lines):
    path = new_path(spark, name)
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    return path


GENERATION = T.StructType([T.StructField("Year", T.IntegerType()), *[
    T.StructField(n, T.StringType()) for n in ("State", "Type of Producer", "Energy Source")],
    T.StructField("Generation (Megawatthours)", T.DoubleType())])


def test_banner_csv(spark, rows):
    path = land(spark, "banner", ["Net generation,,,,", "Year,State,Type of Producer,Energy Source,Generation (Megawatthours)",
                                  "2021,AK,Total Industry,Coal,10.5", '2019,AK,"A, B",Coal,1', "2021,AK,Total Industry,Total,99",
                                  "2022,,x,Wind,3", "2022,TX,x,Wind,bad", "2022,TX,x,Wind,0"])
    df = files.read_csv_with_banner(spark, path, GENERATION)
    assert df.columns == ["year", "state", "type_of_producer", "energy_source", "generation_megawatthours"]
    assert df.count() == 6
    out = loaders.load_generation(df, {"integrante": "m"})
    assert [(r["periodo"], r["region"], r["valor"], r["categoria_energia"], r["item"], r["dataset"], r["integrante"])
            for r in out.collect()] == [(2021, "AK", 10.5, "Fosil", "AK - Coal", "annual_generation_state", "m")]


def test_labels_and_text_columns(spark):
    df = spark.createDataFrame([(2021, "AK", "p", "Wind", 2.0)],
                               "year int, state string, producer_type string, energy_source string, co2_metric_tons double")
    labels = loaders.source_labels("m", "2024-01-01 00:00:00", "g", "t", "s", "u", "Chile")
    row = loaders.load_emissions(df, labels).first()
    assert (row["integrante"], row["pais"], row["fuente_sitio"], row["scraper_origen"]) == ("m", "Chile", "s", None)
    path = new_path(spark, "as-text")
    sinks.export_json(loaders.load_emissions(df, labels), path, as_text=["periodo"])
    assert spark.read.json(path).first()["periodo"] == "2021"


def test_emissions_keep_zeros(spark):
    df = spark.createDataFrame([(2021, "AK", "p", "Coal", 0.0), (2021, "AK", "p", "Coal", -1.0), (2021, "AK", "p", "All Sources", 5.0)],
                               "year int, state string, producer_type string, energy_source string, co2_metric_tons double")
    assert [r["valor"] for r in loaders.load_emissions(df, {}).collect()] == [0.0]
    assert [r["valor"] for r in loaders.load_emissions(df, {}, subtotals={}).collect()] == [0.0, 5.0]


def test_parts_and_projects(spark, rows):
    root = new_path(spark, "book")
    headers = {"PMGD": ["Proyecto", "Ubicación", "Tipo de tecnología", "Fecha estimada de interconexión", "Potencia neta [MW]"],
               "BESS": ["Proyecto", "Ubicación", "Tipo de tecnología", "Fecha estimada de interconexión", "Potencia neta [MW]",
                        "Capacidad de almacenamiento [MWh]"],
               "Notas": ["Texto", "Otro"]}
    bodies = {"PMGD": ["Sol 1,Norte,Fotovoltaico,2026-03-01,9", "Sol 2,Norte,Fotovoltaico,pronto,3", ",,,,7"],
              "BESS": ["Pila,Sur,BESS,2026-05-01,10,40"], "Notas": ["a,b"]}
    for name, header in headers.items():
        lines = ["Tabla" + "," * (len(header) - 1), ",".join(header), *bodies[name]]
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(f"{root}/{name}")
    df = files.read_parts(spark, [f"{root}/{n}" for n in headers], lambda p: headers[p.rsplit("/", 1)[-1]])
    out = loaders.load_projects(df, {"pais": "Chile"})
    assert sorted((r["dataset"], r["item"], r["periodo"], r["indicador"], r["valor"], r["unidad"], r["categoria_energia"])
                  for r in out.filter("periodo is not null").collect()) == [
        ("bess", "Pila", 2026, "capacidad_almacenamiento", 40.0, "MWh", "Almacenamiento"),
        ("bess", "Pila", 2026, "potencia_neta", 10.0, "MW", "Almacenamiento"),
        ("pmgd", "Sol 1", 2026, "potencia_neta", 9.0, "MW", "Renovable")]
    assert out.count() == 4
    with pytest.raises(ValueError, match="proyecto"):
        files.read_parts(spark, [f"{root}/Notas"], lambda p: headers["Notas"])


def test_first_available(spark):
    full = spark.range(3)
    sources = [("none", lambda: spark.read.schema("a int").json(new_path(spark, "none"))),
               ("empty", lambda: full.filter("false")), ("full", lambda: full)]
    assert files.read_first_available(sources)[1] == "full"
    with pytest.raises(FileNotFoundError, match="empty: empty"):
        files.read_first_available(sources[:2])
    with pytest.raises(FileNotFoundError):
        files.read_first_available(sources, only="none")


def test_registry(spark):
    registry = SourceRegistry()
    with pytest.raises(RuntimeError):
        registry.load_all(spark, "")
    registry.register("scraper_b", lambda s, _: s.createDataFrame([("1.234,5", " x ")], "valor string, item string"))
    registry.register("scraper_a", lambda s, _: s.createDataFrame([(2.0,)], "valor double"))
    assert registry.names() == ["scraper_a", "scraper_b"]
    got = registry.load_all(spark, "").select("scraper_origen", "valor", "item").collect()
    assert [tuple(r) for r in got] == [("scraper_a", 2.0, None), ("scraper_b", 1234.5, "x")]
    with pytest.raises(ValueError):
        registry.register("scraper_a", lambda s, _: None)
    registry.register("scraper_c", lambda s, _: [])
    with pytest.raises(TypeError, match="scraper_c"):
        registry.load_all(spark, "")


def test_exports_keep_text_and_order(spark):
    df = spark.createDataFrame([("m", "d", 'a "b", c', 1.5), ("m", "d", None, 2.0), ("l", "z", "ñ", None)],
                               "integrante string, dataset string, item string, valor double")
    for write, read in ((sinks.export_csv, lambda p: files.read_csv(spark, p, df.schema)),
                        (sinks.export_json, lambda p: files.read_collection(spark, df.schema, "json", p))):
        path = new_path(spark, "export")
        write(df, path)
        assert sorted(map(str, read(path).collect())) == sorted(map(str, df.collect()))


BASE = "https://shop.test/catalogue/list/page-1.html?x=1"


def test_links(spark):
    cases = {"page-2.html": "https://shop.test/catalogue/list/page-2.html", "/a/b": "https://shop.test/a/b",
             "../c/d.html": "https://shop.test/catalogue/c/d.html", "../../../e": "https://shop.test/e",
             "./f": "https://shop.test/catalogue/list/f", "//cdn.test/g": "https://cdn.test/g", "http://o.test/h": "http://o.test/h",
             "?p=2": "https://shop.test/catalogue/list/page-1.html?p=2", "#top": BASE + "#top", "": BASE,
             "mailto:a@b.test": "mailto:a@b.test"}
    df = spark.createDataFrame([(BASE, h) for h in cases], "base string, href string")
    got = {r[0]: r[1] for r in df.select("href", pages.resolve_link(F.col("base"), F.col("href"))).collect()}
    assert got == cases
    site = spark.createDataFrame([("https://s.test", "a/b")], "base string, href string")
    assert site.select(pages.resolve_link(F.col("base"), F.col("href"))).first()[0] == "https://s.test/a/b"


HTML = """<html><head><title>Libros</title></head><body><h2> Uno </h2><h2 class="x">Dos</h2>
<article class="product_pod"><h3><a title="A Light in the Attic" href="a.html">A Light in ...</a></h3><p class="price_color">£51.77</p></article>
<article class="product_pod"><h3><a href="b.html">Sin titulo</a></h3><p class="price_color">£10.00</p></article>
<article class="product_pod"><div>anuncio</div></article><li class="next"><a href="page-2.html">next</a></li>
<p>Please solve the CAPTCHA</p></body></html>"""


def test_page_extraction(spark, rows):
    df = spark.createDataFrame([(1, BASE, HTML), (2, BASE, "<html></html>")], "id int, url string, html string")
    assert [r[0] for r in df.orderBy("id").select(pages.title()).collect()] == ["Libros", ""]
    assert rows(pages.element_texts(df, "h2", ["id"])) == [(1, 0, "Uno"), (1, 1, "Dos")]
    fields = {"titulo": r'title="([^"]*)"', "texto": r"<a[^>]*>([^<]*)</a>", "precio": r'price_color">([^<]*)<'}
    card = r'(?s)<article class="product_pod">(.*?)</article>'
    found = pages.cards(df, card, fields, ["id"]).withColumn("item", pages.prefer(F.col("titulo"), F.col("texto")))
    good, bad = pages.split_rejects(found, ["item", "precio"])
    assert rows(good.select("posicion", "item", "precio")) == [(0, "A Light in the Attic", "£51.77"), (1, "Sin titulo", "£10.00")]
    assert rows(bad.select("posicion")) == [(2,)]
    assert pages.cards(df, card, fields, ["id"], first=1).count() == 1
    follow = pages.next_links(df, r'<li class="next"><a href="([^"]*)"', ["id"])
    assert rows(follow) == [(1, "https://shop.test/catalogue/list/page-2.html")]
    assert [r[0] for r in df.orderBy("id").select(pages.blocked()).collect()] == [True, False]
    assert pages.stamp(df, "g", "t").select("grupo", "fecha_captura").first() == ("g", "t")


def test_next_pages_stop_at_the_limit(spark, rows):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(
        ["http://a.test/l?page=1&r=x", "http://a.test/l?q=1&page=2", "http://a.test/l?page=3", "http://a.test/l"])], "id int, url string")
    assert rows(pages.next_pages(df, ["id"])) == [(0, 1, "http://a.test/l?page=2&r=x"), (1, 2, "http://a.test/l?q=1&page=3")]


def test_compressed_exports_read_back(spark, rows, tmp_path):
    """Compressed exports are small and hold the rows of plain ones."""
    df = spark.range(5000).selectExpr("concat('m', id % 3) AS integrante", "'d' AS dataset", "cast(id AS string) AS item",
                                      "CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'una, \"nota\"' END AS nota")
    for write, read in ((sinks.export_csv, lambda p: files.read_csv(spark, p, df.schema)),
                        (sinks.export_json, lambda p: files.read_collection(spark, df.schema, "json", p))):
        plain, packed = (str(tmp_path / f"{write.__name__}-{name}") for name in ("plain", "packed"))
        write(df, plain)
        write(df, packed, compression="gzip")
        assert rows(read(packed)) == rows(read(plain)) and read(packed).count() == 5000
        size = [sum(f.stat().st_size for f in pathlib.Path(p).glob("part-*")) for p in (plain, packed)]
        assert size[1] * 3 < size[0]
