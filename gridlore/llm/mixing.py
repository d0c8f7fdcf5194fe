"""Mixing sources to target weights by pivotal dependent rounding of copy counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlore.llm.common import WORD, class_held, table, text_of, unused
from gridlore.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Units rounded together in one group, and groups combined in one node of the tree.
FAN = 256


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``position`` from 0 by code point, null last: ranges first, then places inside a range."""
    order = [F.col("source").isNull(), F.col("source")]
    ranges = materialize(sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "sources")
    sizes = ranges.groupBy("range").count()
    # one row per range, of which there are at most as many as partitions
    before = sizes.select("range", (F.sum("count").over(Window.orderBy("range")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return ranges.join(before, "range").select("source", "source_size", "n", (F.col("before") + place).alias("position"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most_copies: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, n, target`` from rows of ``source, size``.

    Sources in order of code points, null last, take the weights in turn. They share ``share`` times all sizes; a target
    stops at ``most_copies`` times its source's size and the excess goes to the others by weight until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = materialize(_ranked(sources).withColumn("weight", weight), "ranked-sources")
    cap = F.col("source_size") * float(most_copies)
    whole = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    wanted = share * (whole["s"] or 0)
    level, capped = wanted / (whole["w"] or 1.0), 0
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, cap)).alias("cap"),
                         F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        if row["n"] == capped or not row["w"]:
            break
        capped, level = row["n"], (wanted - row["cap"]) / row["w"]
    return ranked.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight"))).drop("position")


def _uniform(*columns: Column) -> Column:
    """0 to 1, fixed by the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


#: A fraction this near to 0 or 1 is rounding noise.
_NOISE = 1e-9


def _step(seed: int):
    """One pivotal step: a unit is paired with the pool of all that follow it, mass moves at random until either is integral.

    What the pool gains or gives is spread over its units, each in proportion to its room or mass, so the units' fractions
    become ``scale * p + shift``. ``weight`` and ``mass`` are the pool's, the unit included.
    """

    def step(state: Column, unit: Column) -> Column:
        w, p = unit["w"], F.least(F.lit(1.0), F.greatest(F.lit(0.0), state["scale"] * unit["p"] + state["shift"]))
        pool = F.greatest(F.lit(0.0), F.least(state["mass"] - w * p, state["weight"] - w))
        room = F.greatest(F.lit(0.0), state["weight"] - w - pool)
        up, down = F.least(w * (1.0 - p), pool), F.least(w * p, room)
        # the chance of either move is the size of the other, so every expected value stays
        rises = _uniform(F.lit(seed), unit["h"], unit["size"]) * (up + down) < down
        moved = F.when(up + down <= 0, p).when(rises, p + up / w).otherwise(p - down / w)
        exact = F.when(moved < _NOISE, 0.0).when(moved > 1 - _NOISE, 1.0).otherwise(moved)
        give = F.when(rises & (pool > 0), 1.0 - up / pool).otherwise(1.0)
        gain = F.when(~rises & (room > 0), 1.0 - down / room).otherwise(1.0)
        return F.struct((state["weight"] - w).alias("weight"), F.when(rises, pool - up).otherwise(pool + down).alias("mass"),
                        (state["scale"] * give * gain).alias("scale"), (state["shift"] * give * gain + 1.0 - gain).alias("shift"),
                        F.array_append(state["done"], unit.withField("p", exact)).alias("done"))

    return step


def _round_groups(units: DataFrame, seed: int) -> DataFrame:
    """``source, chunk, unit``: of the units of a chunk all but one are 0 or 1 afterwards. Large units come first."""
    kind = units.schema["unit"].dataType.simpleString()
    lists = units.groupBy("source", "chunk").agg(
        F.array_sort(F.collect_list("unit")).alias("units"), F.sum("unit.w").alias("weight"),
        F.sum(F.col("unit.w") * F.col("unit.p")).alias("mass"))
    start = F.struct(F.col("weight"), F.col("mass"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"),
                     F.array().cast(f"array<{kind}>").alias("done"))
    return lists.select("source", "chunk", F.explode(F.aggregate("units", start, _step(seed), lambda s: s["done"])).alias("unit"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_copies: int = MOST_COPIES,
        seed: int = 17, fan: int = FAN) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies, taken``, one row per row of ``docs``.

    ``size`` is the number of words, 0 for null texts. Every document of a source is due ``target / source_size``
    copies: the whole part is taken, the fraction is rounded by pivotal steps weighted by size, first inside groups of about
    ``fan`` documents, then between the groups' residuals up a tree. Large documents are settled first against the pool of all smaller ones,
    so a source mostly misses its target by less than a small document; where that pool is full or empty, by less than one copy of its
    largest. In expectation it misses by nothing, and no copy count exceeds ``most_copies``. Draws are hashes, so reruns agree. Rows
    that share id, source and size are one unit and get as many copies each. An empty table gives none.
    """
    sized = docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))
    thin = materialize(sized, "sizes")
    sources = materialize(source_targets(thin, weights, share, most_copies), "targets")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("whole", F.floor(due)).withColumn("part", due - F.floor(due))
    same = F.col("t.source").eqNullSafe(F.col("s.source"))
    rows = thin.alias("t").join(sources.alias("s"), same).select("t.*", "s.n", "s.whole", "s.part")
    settled = rows.filter("part = 0 or size = 0").select("doc_id", "source", "size", F.lit(1).cast("long").alias("times"), F.col("whole").alias("copies"))

    grouped = rows.filter("part > 0 and size > 0").groupBy("doc_id", "source", "size", "n", "whole", "part").agg(F.count("*").alias("times"))
    h = F.xxhash64(F.lit(seed), "doc_id", "size")
    w = (F.col("size") * F.col("times")).cast("double")
    unit = F.struct((-w).alias("order"), h.alias("h"), F.col("doc_id"), F.col("size"), F.col("times"), F.col("whole"),
                    w.alias("w"), F.col("part").alias("p"))
    units = grouped.select("source", F.pmod(h, F.ceil(F.col("n") / fan)).alias("chunk"), unit.alias("unit"))
    open_unit = (F.col("unit.p") > 0) & (F.col("unit.p") < 1)
    done, level = [], 0
    while True:
        groups = materialize(_round_groups(units, seed + level), "rounded")
        done.append(groups.filter(~open_unit).select("source", "unit"))
        residuals = groups.filter(open_unit)
        if not groups.agg(F.max("chunk")).first()[0]:
            break
        units = residuals.select("source", F.floor(F.col("chunk") / fan).alias("chunk"), "unit")
        level += 1
    chance = _uniform(F.lit(seed), F.lit("last"), F.col("unit.h"), F.col("unit.size"))
    last = residuals.select("source", F.col("unit").withField("p", F.when(chance < F.col("unit.p"), 1.0).otherwise(0.0)).alias("unit"))
    for part in done:
        last = last.unionByName(part)
    rounded = last.select("unit.doc_id", "source", "unit.size", "unit.times",
                          (F.col("unit.whole") + F.col("unit.p").cast("long")).alias("copies"))
    every = materialize(settled.unionByName(rounded), "copies")
    return every.alias("t").join(sources.alias("s"), same).withColumn(
        "again", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        "doc_id", "size", "t.source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: Different copy counts that are told by a map of ids, all there are unless ``most_copies`` is raised; rows of others are joined.
_TOLD = 3


def take(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns; documents without words are not taken.

    Every row has a count in the mix, so where all ids of its hash have one count that is its own. Only the other rows, which
    grow towards all beyond some ten million documents, are shuffled to be joined with the counts.
    """
    size, again = unused(docs, "_size"), unused(docs, "_copy")
    copies = mix(docs, **settings).select("doc_id", "source", "size", F.when(F.col("size") > 0, F.col("copies")).otherwise(0).alias("copies"))
    copies = materialize(copies.distinct(), "taken")
    counts = [r["copies"] for r in copies.select("copies").distinct().orderBy("copies").limit(_TOLD).collect()]
    place = F.array_position(F.array(*[F.lit(n) for n in counts or [0]]), F.col("copies")) - 1
    classed = copies.withColumn("class", F.when(place >= 0, place).otherwise(_TOLD))
    only = F.get(F.array(*[F.lit(n).cast("int") for n in counts], *[F.lit(None).cast("int")] * (_TOLD + 1 - len(counts))), class_held(classed))
    told = docs.withColumn(again, F.explode(F.array_repeat(F.lit(0), only)))
    sized = docs.filter(only.isNull()).withColumn(size, F.regexp_count(text_of(), F.lit(WORD)).cast("long"))
    same = [F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), F.col("d.source").eqNullSafe(F.col("c.source")),
            F.col(f"d.{size}") == F.col("c.size")]
    joined = sized.alias("d").join(copies.filter("copies > 0").alias("c"), same)
    rest = joined.withColumn(again, F.explode(F.sequence(F.lit(1), F.col("c.copies").cast("int")))).select("d.*").drop(size)
    return told.drop(again).union(rest)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
