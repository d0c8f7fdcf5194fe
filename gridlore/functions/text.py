"""Text normalisation, keyword categories and record keys."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.schema import SchemaError

# fixed values: keywords of each category, tested in this order on lower-cased text
CATEGORY_KEYWORDS = [
    ("Almacenamiento", ["bess", "storage", "almacenamiento"]),
    ("Renovable", ["solar", "wind", "hydro", "geothermal", "wood", "biomass", "waste", "renewable",
                   "fotovoltaico", "eolico", "hidro"]),
    ("Fosil", ["coal", "petroleum", "natural gas", "other gases", "diesel", "carbon"]),
    ("Nuclear", ["nuclear"]),
]
DEFAULT_CATEGORY = "Otra"

# fixed values: fields of the record key, in order, and their separator
KEY_FIELDS = ["integrante", "dataset", "pais", "region", "periodo", "indicador", "categoria_energia",
              "tecnologia", "actor", "item"]
KEY_SEPARATOR = "||"

# fixed values: characters that become "_", accented letters with their plain form, dropped characters
_TO_UNDERSCORE = " \n-/"
_ACCENTED, _PLAIN = "áéíóúñ", "aeioun"
_DROPPED = ".,[]()"

# fixed value: all characters that count as white space
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Removes all white space at both ends; a plain ``trim`` would leave tabs and line ends."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, null where nothing is left. Text that starts and ends in printable ASCII is taken as it is: most needs no search."""
    text = _col(c)
    last = F.substring(text.cast("binary"), -1, 1)  # a byte: characters would be counted up to it
    bare = (text >= "!") & (text < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(bare, text).otherwise(F.nullif(strip(text), F.lit("")))


def classify(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = CATEGORY_KEYWORDS,
             default: str = DEFAULT_CATEGORY) -> Column:
    """First category with a keyword in the lower-cased text."""
    text = F.lower(_col(c))
    out = None
    for category, words in rules:
        hit = reduce(or_, [text.contains(w) for w in words])
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise(default)


def snake(c: Column | str) -> Column:
    """snake_case of a value."""
    swapped = F.translate(F.lower(strip(c)), _TO_UNDERSCORE + _ACCENTED + _DROPPED,
                          "_" * len(_TO_UNDERSCORE) + _PLAIN)
    return F.regexp_replace(F.regexp_replace(swapped, "_+", "_"), "^_|_$", "")


def snake_name(name: str) -> str:
    """snake_case of a column name; the same rule as :func:`snake`, on driver metadata."""
    table = str.maketrans(_TO_UNDERSCORE + _ACCENTED, "_" * len(_TO_UNDERSCORE) + _PLAIN, _DROPPED)
    return re.sub("_+", "_", name.strip().lower().translate(table)).strip("_")


def snake_columns(df: DataFrame) -> DataFrame:
    names = [snake_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise SchemaError(f"headers collide after normalisation: {twice}")
    return df.toDF(*names)


def item_label(region: Column | str, technology: Column | str) -> Column:
    return F.concat(_col(region), F.lit(" - "), _col(technology))


def first_token(c: Column | str) -> Column:
    return F.split(_col(c), " ")[0]


def record_key(fields: Sequence[str] = KEY_FIELDS) -> Column:
    """SHA-256 of the joined fields. ``concat_ws`` skips nulls, hence the coalesce."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def year_of(c: Column | str) -> Column:
    return F.year(F.try_to_timestamp(_col(c)))
