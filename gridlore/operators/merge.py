"""Keyed upsert, replacement by predicate and quarantining append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridlore.session import materialize, shuffles_removed

STATE = "_estado"


def latest_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``newest`` columns, then the greatest rest.

    An aggregate, so a key with very many versions is reduced before the shuffle.
    """
    order = [*newest, *[c for c in df.columns if c not in keys and c not in newest]]
    kept = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target after setting every source field on the row with the same key, with the row's ``_estado``.

    Both sides hold a key once, so the full outer join has no hot key. A source null overwrites; columns only
    the target has are kept; columns only the source has are added.
    """
    s_cols = [c for c in source.columns if c != key]
    t_cols = [c for c in target.columns if c != key]
    s = source.select(F.col(key).alias("_s_key"), *[F.col(c).alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_s_side"))
    both = target.withColumn("_t_side", F.lit(True)).join(s, F.col(key).eqNullSafe(F.col("_s_key")), "full_outer")
    # side flags are literals: a null key is a key like any other
    in_source, in_target = F.col("_s_side").isNotNull(), F.col("_t_side").isNotNull()
    same = F.lit(True)
    for c in s_cols:
        same = same & (F.col(c).eqNullSafe(F.col(f"_s_{c}")) if c in t_cols else F.lit(False))
    state = (F.when(~in_source, "untouched").when(~in_target, "inserted")
             .when(same, "matched").otherwise("modified"))
    out = [F.when(in_source, F.col("_s_key")).otherwise(F.col(key)).alias(key)]
    for c in [*t_cols, *[c for c in s_cols if c not in t_cols]]:
        if c not in s_cols:
            out.append(F.col(c))
        elif c not in t_cols:
            out.append(F.col(f"_s_{c}").alias(c))
        else:
            out.append(F.when(in_source, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    return both.select(*out, state.alias(STATE))


def upsert_counters(merged: DataFrame) -> DataFrame:
    """``matched`` counts every source row with a stored partner, changed or not."""
    return merged.agg(
        F.count_if(F.col(STATE) == "inserted").alias("inserted"),
        F.count_if(F.col(STATE) == "modified").alias("modified"),
        F.count_if(F.col(STATE).isin("matched", "modified")).alias("matched"))


def partitions_of(df: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the partitions the source has rows for.

    The values of each partition column become literals, so other partitions are not even listed for reading; they
    are folder names of the table, which the driver lists anyway. The semi-join then keeps the exact combinations.
    """
    values = source.agg(*[F.collect_set(c).alias(c) for c in columns],
                        *[F.max(F.col(c).isNull()).alias(f"_null_{c}") for c in columns]).first()
    for c in columns:
        wanted = F.col(c).isin(values[c])
        df = df.filter(wanted | F.col(c).isNull() if values[f"_null_{c}"] else wanted)
    pairs = source.select(*[F.col(c).alias(f"_p_{c}") for c in columns]).distinct()
    return df.join(pairs, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in columns], "left_semi")


def upsert_table(path: str, source: DataFrame, key: str, partition_by: Sequence[str],
                 newest: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """Upserts into a partitioned Parquet table and returns the counters.

    Of source rows sharing a key the one with the greatest ``newest`` columns, then the greatest rest, is taken.
    ``partition_by`` must be part of what the key is made of, so a key never changes partition. Only partitions
    the source touches are read and replaced. The merge is written aside first: the table is never read and
    written in one job, and repeating a failed run gives the same table. Columns that only the table has are kept: its
    own schema, merged over its files, is read unless ``schema`` gives it. Partitions are replaced one after the other, so
    a reader meanwhile can see old and new ones.
    """
    spark = source.sparkSession
    source = materialize(latest_by(source, [key], newest), "upsert-source")
    stored = _stored(source, path, schema)
    if stored is None:
        replace_partitions(source, path, partition_by)
        return upsert_counters(source.withColumn(STATE, F.lit("inserted")))
    merged = materialize(upsert(partitions_of(stored, source, partition_by), source, key), "upsert-merged")
    replace_partitions(merged.drop(STATE), path, partition_by)
    return upsert_counters(merged)


def _stored(source: DataFrame, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table with all its columns; types are the source's where it has the column. None where there is no table."""
    read = source.sparkSession.read
    try:
        if schema is None:
            own = {f.name: f for f in source.schema}
            found = source.sparkSession.read.option("mergeSchema", True).parquet(path).schema
            schema = StructType([own.get(f.name, f) for f in found])
        return read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions ``df`` has rows for; large ones are split over tasks, small ones share one."""
    with shuffles_removed(df.sparkSession):
        (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))


def replace_where(target: DataFrame, source: DataFrame, condition: Column) -> DataFrame:
    """Target without the rows that meet the condition, plus the source. A null condition keeps the row."""
    kept = target.filter(~F.coalesce(condition, F.lit(False)))
    return kept.unionByName(source, allowMissingColumns=True)


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same with the key values the source holds."""
    return _others(target, source, keys).unionByName(source, allowMissingColumns=True)


def _others(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key values the source does not hold; null equals null."""
    held = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    return target.join(held, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")


def replace_table(path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Replaces the rows of a stored table that share the source's key values and returns ``deleted`` and ``inserted``.

    ``partition_by`` must be among ``keys``, so only partitions the source touches are read and replaced. Columns only the
    table has are kept and null in the new rows. A repeated run gives the same table.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"{sorted(set(partition_by) - set(keys))} are not among the keys")
    source = materialize(source, "replace-source")
    inserted = source.agg(F.count("*").alias("inserted"))
    stored = _stored(source, path)
    if stored is None:
        replace_partitions(source, path, partition_by)
        return inserted.select(F.lit(0).cast("long").alias("deleted"), "inserted")
    touched = partitions_of(stored, source, partition_by)
    kept = _others(touched, source, keys)
    tallies = materialize(touched.agg(F.count("*").alias("n")), "replace-before").withColumn("kept", kept.agg(F.count("*")).scalar())
    tallies = materialize(tallies.select((F.col("n") - F.col("kept")).alias("deleted")), "replace-counters")
    after = materialize(kept.unionByName(source, allowMissingColumns=True), "replace-after")
    replace_partitions(after, path, partition_by)
    return tallies.withColumn("inserted", inserted.scalar())


def replace_counters(target: DataFrame, source: DataFrame, condition: Column) -> DataFrame:
    inserted = source.agg(F.count("*").alias("inserted")).scalar()
    return target.agg(F.count_if(condition).alias("deleted")).withColumn("inserted", inserted)


def convert_or_quarantine(df: DataFrame, column: str, converted: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose value converts (converted), and the others as they came."""
    tagged = df.withColumn("_converted", converted)
    good = tagged.filter(F.col("_converted").isNotNull()).withColumn(column, F.col("_converted")).drop("_converted")
    return good, tagged.filter(F.col("_converted").isNull()).drop("_converted")


def append_with_quarantine(df: DataFrame, column: str, converted: Column, path: str, quarantine: str) -> DataFrame:
    """Appends both parts to their tables and returns how many rows each got."""
    tagged = materialize(df.withColumn("_converted", converted), "append-converted")
    good, bad = convert_or_quarantine(tagged.drop("_converted"), column, converted)
    good.write.mode("append").parquet(path)
    bad.write.mode("append").parquet(quarantine)
    return tagged.agg(F.count_if(F.col("_converted").isNotNull()).alias("exitosos"),
                      F.count_if(F.col("_converted").isNull()).alias("fallidos"))
