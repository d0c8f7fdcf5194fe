"""Chains of next-page links over landed pages, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.operators.pages import PAGE_LIMIT
from gridlore.session import materialize


def landed_links(links: DataFrame) -> DataFrame:
    """``pagina, siguiente, estado`` once per landed page: ``sigue``, ``fin`` (no next page) or ``ausente`` (its next page was not landed).

    ``links`` has the addresses ``pagina`` and ``siguiente``. Of several rows of a page the least next address counts; rows
    without a page are left out.
    """
    one = links.filter(F.col("pagina").isNotNull()).groupBy("pagina").agg(F.min("siguiente").alias("siguiente"))
    there = one.select(F.col("pagina").alias("_landed"))
    state = F.when(F.col("siguiente").isNull(), "fin").when(F.col("_landed").isNull(), "ausente").otherwise("sigue")
    return materialize(one.join(there, F.col("siguiente") == F.col("_landed"), "left").select("pagina", "siguiente", state.alias("estado")), "links")


def _jumps(pages: DataFrame) -> DataFrame:
    return pages.filter("estado = 'sigue'").select("pagina", "siguiente")


def _twice(jumps: DataFrame) -> DataFrame:
    """Jumps of double length; pages whose jump would leave the landed pages have none."""
    far = jumps.select(F.col("pagina").alias("siguiente"), F.col("siguiente").alias("_far"))
    return materialize(jumps.join(far, "siguiente").select("pagina", F.col("_far").alias("siguiente")), "jumps")


def cycle_pages(pages: DataFrame) -> DataFrame:
    """``pagina, ciclo`` of every page on a cycle; a cycle is named by its least page.

    Jumps are doubled until the set of pages they reach no longer shrinks: a jump then only permutes these pages, so they
    are the cycles. Doubling windows along them finds the least page. Rounds grow with the logarithm of the longest chain.
    """
    jumps = step = materialize(_jumps(pages), "jumps")
    reached, size = jumps.select(F.col("siguiente").alias("pagina")).distinct(), -1
    while (now := reached.count()) not in (0, size):
        size, jumps = now, _twice(jumps)
        reached = jumps.select(F.col("siguiente").alias("pagina")).distinct()
    on = materialize(step.join(reached, "pagina", "left_semi").withColumn("ciclo", F.col("pagina")), "cycles")
    while True:
        far = on.select(F.col("pagina").alias("siguiente"), F.col("siguiente").alias("_far"), F.col("ciclo").alias("_low"))
        wider = materialize(on.join(far, "siguiente").select(
            "pagina", F.col("_far").alias("siguiente"), F.least("ciclo", "_low").alias("ciclo"), (F.col("_low") < F.col("ciclo")).alias("_moved")), "cycles")
        on = wider.drop("_moved")
        if wider.filter("_moved").isEmpty():
            return on.select("pagina", "ciclo")


def start_pages(pages: DataFrame) -> DataFrame:
    """``inicio``: pages no other landed page leads to, and the least page of every cycle that nothing outside leads to."""
    jumps = _jumps(pages)
    led_to = jumps.filter("pagina <> siguiente").select(F.col("siguiente").alias("pagina")).distinct()
    heads = pages.join(led_to, "pagina", "left_anti").select(F.col("pagina").alias("inicio"))
    cycles = materialize(cycle_pages(pages), "on-cycles")
    into = jumps.join(cycles.select(F.col("pagina").alias("siguiente"), "ciclo"), "siguiente").join(
        cycles.select("pagina"), "pagina", "left_anti").select("ciclo").distinct()
    alone = cycles.select("ciclo").distinct().join(into, "ciclo", "left_anti").select(F.col("ciclo").alias("inicio"))
    return heads.union(alone).distinct()


def page_chains(links: DataFrame, limit: int | None = PAGE_LIMIT, starts: DataFrame | None = None) -> DataFrame:
    """``inicio, posicion, pagina, termina``: the landed pages from every start page on, in order, at most ``limit`` of them.

    ``termina`` tells, on a chain's last page, why it ends: ``fin``, ``ausente``, ``limite`` (the limit was reached and there was
    more), ``ciclo`` (the next page is already part of it); null before. ``starts`` has the column ``inicio``; those that were not
    landed give no row. Every round doubles the known part of all chains with one join: a chain of a million pages takes twenty
    rounds, and the limit 3 takes two. A page many chains pass is only frequent on one side of the join, which Spark can split.
    """
    if limit is not None and limit < 1:
        raise ValueError("the page limit is at least 1")
    pages = landed_links(links)
    found = start_pages(pages) if starts is None else starts.select("inicio").join(
        pages.select(F.col("pagina").alias("inicio")), "inicio", "left_semi").distinct()
    chains = materialize(found.select("inicio", F.lit(0).cast("long").alias("posicion"), F.col("inicio").alias("pagina")), "chains")
    jumps, length, known = materialize(_jumps(pages), "jumps"), 1, chains.count()
    while limit is None or length < limit:
        ahead = chains.join(jumps, "pagina").select("inicio", (F.col("posicion") + length).alias("posicion"), F.col("siguiente").alias("pagina"))
        if limit is not None:
            ahead = ahead.filter(F.col("posicion") < limit)
        # once a chain meets itself it repeats for good: of each page the first visit stays
        longer = materialize(chains.unionByName(ahead).groupBy("inicio", "pagina").agg(F.min("posicion").alias("posicion")), "chains")
        chains, length, before, known = longer, 2 * length, known, longer.count()
        if known == before:
            break
        if limit is None or length < limit:
            jumps = _twice(jumps)
    last = chains.groupBy("inicio").agg(F.max("posicion").alias("_last"))
    ended = chains.join(last, "inicio").join(pages, "pagina")
    # the only landed page that may follow a chain's last page and is not its next: one of its own, or one beyond the limit
    seen = chains.select(F.col("inicio").alias("_i"), F.col("pagina").alias("_p"))
    ended = ended.join(seen, (F.col("inicio") == F.col("_i")) & (F.col("siguiente") == F.col("_p")), "left")
    why = F.when(F.col("estado") != "sigue", F.col("estado")).when(F.col("_p").isNotNull(), "ciclo").otherwise("limite")
    return ended.select("inicio", F.col("posicion").cast("int").alias("posicion"), "pagina", F.when(F.col("posicion") == F.col("_last"), why).alias("termina"))
