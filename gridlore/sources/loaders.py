"""From the columns of each landed source to fact rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.functions.numbers import parse_int, to_double
from gridlore.functions.text import classify, item_label, year_of
from gridlore.operators.cleaning import SUBTOTALS, exclude_members, positive
from gridlore.operators.reshape import measures_to_rows
from gridlore.schema import FACT_SCHEMA, column_or, project, with_constants

# fixed values: source headers and the fact columns they become
GENERATION_COLUMNS = {"type_of_producer": "actor", "energy_source": "tecnologia",
                      "generation_megawatthours": "valor", "year": "periodo", "state": "region"}
EMISSION_COLUMNS = {"producer_type": "actor", "energy_source": "tecnologia",
                    "co2_metric_tons": "valor", "year": "periodo", "state": "region"}
PROJECT_MEASURES = {"potencia_neta_mw": ("potencia_neta", "MW"),
                    "capacidad_de_almacenamiento_mwh": ("capacidad_almacenamiento", "MWh")}
FIRST_YEAR = 2020


def source_labels(member: str, captured: str, group: str, theme: str, site: str, address: str, country: str) -> dict[str, str]:
    """What a source stamps on all its rows; the capture time is given, so a repeated run writes the same rows."""
    return {"integrante": member, "fecha_extraccion": captured, "grupo": group, "tema": theme, "fuente_sitio": site,
            "url_origen": address, "pais": country}


def _numeric(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    if types["valor"] != "double":
        df = df.withColumn("valor", to_double("valor"))
    if types["periodo"] != "int":
        df = df.withColumn("periodo", parse_int("periodo"))
    return df


def _state_table(df: DataFrame, columns: Mapping[str, str], first_year: int,
                 subtotals: Mapping[str, list[str]] | None) -> DataFrame:
    named = _numeric(df.withColumnsRenamed(dict(columns)))
    kept = named.filter((F.col("periodo") >= first_year) & F.col("region").isNotNull()
                        & F.col("tecnologia").isNotNull())
    kept = exclude_members(kept, {"tecnologia": SUBTOTALS} if subtotals is None else subtotals)
    return kept.withColumns({"categoria_energia": classify("tecnologia"),
                             "item": item_label("region", "tecnologia")})


def load_generation(df: DataFrame, labels: Mapping[str, object], first_year: int = FIRST_YEAR,
                    subtotals: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Yearly generation per state, producer and source; positive values only."""
    rows = _state_table(df, GENERATION_COLUMNS, first_year, subtotals).filter(positive())
    fixed = {"dataset": "annual_generation_state", "indicador": "generacion_electrica", "unidad": "MWh"}
    return project(with_constants(rows, {**fixed, **labels}), FACT_SCHEMA)


def load_emissions(df: DataFrame, labels: Mapping[str, object], first_year: int = FIRST_YEAR,
                   subtotals: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Yearly emissions; a zero is a valid value here and is only dropped by the integration rules."""
    rows = _state_table(df, EMISSION_COLUMNS, first_year, subtotals)
    rows = rows.filter((F.col("valor") >= 0) & ~F.isnan("valor"))
    fixed = {"dataset": "emission_annual", "indicador": "emisiones_co2", "unidad": "metric_tons_co2"}
    return project(with_constants(rows, {**fixed, **labels}), FACT_SCHEMA)


def load_projects(df: DataFrame, labels: Mapping[str, object]) -> DataFrame:
    """Project sheets: net power, and storage capacity where the sheet has that column."""
    technology = column_or(df, "tipo_de_tecnologia")
    base = df.withColumns({
        "region": column_or(df, "ubicacion"),
        "periodo": year_of(column_or(df, "fecha_estimada_de_interconexion", None)),
        "categoria_energia": classify(technology),
        "tecnologia": technology,
        "actor": column_or(df, "propietario"),
        "item": F.col("proyecto"),
    })
    keep = ["dataset", "region", "periodo", "categoria_energia", "tecnologia", "actor", "item"]
    rows = measures_to_rows(base, PROJECT_MEASURES, keep).filter(F.col("item").isNotNull() & positive())
    return project(with_constants(rows, labels), FACT_SCHEMA)
