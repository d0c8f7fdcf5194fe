"""N-gram Jaccard join: prefixes of single tokens and token pairs find candidates, the whole sets verify them.

A token is a distinct run of ``n`` words. Every set orders its tokens by how often they occur, rare ones first. Two sets
that link differ in few tokens, so they share a signature among their first ones: a rare token alone, or a pair
of frequent tokens. Frequent tokens fall into small classes by hash and only pairs within a class count; that keeps the
number of pairs linear in the prefix. A prefix is long enough when more tokens would have to go than a link allows before
the last signature is gone: one for each rare token, all but one of the tokens of a class.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import broadcast_bits, may_hold, released, table, text_of
from gridlore.llm.components import components
from gridlore.llm.forests import contract
from gridlore.llm.kernels import mix, shingle_sets
from gridlore.session import materialize

#: log2 of the counters of the token sketch, of the bits of the signature filter and of the document filter: fixed sizes of
#: 4, 8 and 1 MB on every executor, whatever the data.
SKETCH_BITS, FILTER_BITS, DOC_BITS = 20, 26, 23
#: Bits of a set's parity map: differing bits are differing tokens at least.
PARITY_BITS = 1024
#: log2 of the counters of the sketch sent as one row.
_CHUNK_BITS = 14
#: Tokens of a full set per class of frequent tokens.
_CLASS = 13
#: Sets and tokens of a block of one component; two blocks are compared by a task, so many token columns at a time.
_BLOCK_SETS, _BLOCK_TOKENS, _COLUMNS = 256, 250_000, 4096
_PAIR = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))


def _digest(tokens: np.ndarray, seed: int) -> tuple[int, int]:
    """Two independent 64-bit sums over a set."""
    a = mix(tokens ^ np.uint64(0x5851F42D4C957F2D + seed)).sum(dtype=np.uint64)
    b = mix(tokens + np.uint64(0x14057B7EF767814F + seed)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Whether an odd number of tokens falls on each bit, as signed 64-bit numbers."""
    odd = np.bincount((mix(tokens) >> np.uint64(40)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _allowed(size: int, percent: int) -> int:
    """Tokens of a set that may be missing in a linked one."""
    return size - -(-percent * size // 100)


def _pairs(tokens: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Signatures of all pairs within a class; ``tokens`` stand in the global order."""
    order = np.argsort(classes, kind="stable")
    tokens, classes = tokens[order], classes[order]
    found = []
    lag = 1
    while lag < len(tokens):
        same = classes[lag:] == classes[:-lag]
        if not same.any():
            break
        found.append(mix(tokens[:-lag][same] * _PAIR[0] + mix(tokens[lag:][same] * _PAIR[1])))
        lag += 1
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def signatures(tokens: np.ndarray, counts: np.ndarray, frequent: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set and the most tokens it can share with a set that it meets there.

    ``counts`` are the tokens' (over-)counts, the same for every set; ``tokens`` are sorted. Sets of one size band, a power of two,
    share their classes; a set that may link with one of the band below gives signatures for that as well.
    A linked pair shares its first common rare token, before which it shares none; sets that meet in a pair of frequent tokens first
    share no rare token at all, since both prefixes hold all their rare ones.
    """
    size = len(tokens)
    if size < 2:  # links only with its equals
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = np.argsort(counts, kind="stable")
    tokens = tokens[order]
    rare = int(np.searchsorted(counts[order], frequent, side="right"))
    needed = _allowed(size, percent) + 1
    band = size.bit_length()
    bands = [band]
    if percent * size <= 100 * ((1 << (band - 1)) - 1):
        bands.append(band - 1)
    out, rest = [], []
    for at in bands:
        mark = np.uint64(at * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        single = tokens[:min(rare, needed)]
        out.append(mix(single ^ mark))
        rest.append(size - np.arange(len(single), dtype=np.int64))
        if rare < needed:
            after = tokens[rare:]
            classes = (mix(after ^ np.uint64(0xA24BAED4963EE407)) % np.uint64(max(1, (1 << (at - 1)) // _CLASS))).astype(np.int64)
            by_class = np.argsort(classes, kind="stable")
            first = np.ones(len(after), dtype=bool)
            first[by_class[1:]] = classes[by_class[1:]] != classes[by_class[:-1]]
            upto = int(np.searchsorted(np.cumsum(~first), needed - rare, side="left")) + 1
            pairs = _pairs(after[:upto], classes[:upto])
            out.append(mix(pairs ^ mark))
            rest.append(np.full(len(pairs), size - rare, dtype=np.int64))
    return np.concatenate(out), np.concatenate(rest)


def _scan(docs: DataFrame, n: int, seed: int) -> DataFrame:
    """Rows of kind 0: digest, size and parity map of every document's set. Rows of kind 1: parts of the task's token counts."""
    from gridlore.llm.packing import batch_type

    kind = batch_type(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            sizes, digests, parities, held, room = [], [], [], [], 0
            for tokens in shingle_sets(batch.column(1), n):
                sizes.append(len(tokens))
                digests.append(_digest(tokens, seed))
                parities.append(_parity(tokens))
                held.append(tokens)
                room += len(tokens)
                if room > 500_000:
                    _count(counts, held)
                    held, room = [], 0
            _count(counts, held)
            size = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * size, pa.int32()), batch.column(0).cast(kind), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array(parities, pa.list_(pa.int64())), pa.nulls(size, pa.binary())], names=names)
        parts = counts.reshape(-1, 1 << _CHUNK_BITS)
        used = np.flatnonzero(parts.any(axis=1))
        empty = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * len(used), pa.int32()), pa.nulls(len(used), kind), empty, pa.array(used, pa.int64()), empty, empty,
             pa.nulls(len(used), pa.list_(pa.int64())), pa.array([parts[i].astype("<u4").tobytes() for i in used], pa.binary())], names=names)

    names = ["kind", "doc_id", "text_key", "n", "d1", "d2", "parity", "counts"]
    return docs.select("doc_id", "text", F.xxhash64(text_of()).alias("text_key")).mapInArrow(
        released(run), f"kind int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key long, n long, d1 long, d2 long, parity array<long>, counts binary")


def _count(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        at = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
        counts += np.bincount(at.astype(np.int64), minlength=len(counts)).astype(np.uint32)


def _sketch(scanned: DataFrame) -> np.ndarray:
    """Sum of the tasks' counts; a part is summed by one task, the whole has a fixed size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = np.frombuffer(raw.as_buffer(), dtype="<u4").astype(np.uint64)
                sums[part] = sums[part] + value if part in sums else value
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         names=["part", "counts"])

    rows = scanned.filter("kind = 1").select("n", "counts").repartition("n").mapInArrow(released(run), "part long, counts binary").toArrow()
    whole = np.zeros((1 << (SKETCH_BITS - _CHUNK_BITS), 1 << _CHUNK_BITS), dtype=np.uint64)
    for part, raw in zip(rows["part"].to_pylist(), rows["counts"].to_pylist()):
        whole[part] = np.frombuffer(raw, dtype=np.uint64)
    return np.minimum(whole.reshape(-1), 0xFFFFFFFF).astype(np.uint32)


def _signature_rows(docs: DataFrame, n: int, seed: int, percent: int, counts, frequent: int, only=None) -> DataFrame:
    """``sig, node, n, rest`` of every document; with ``only`` the signatures whose bit is set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = counts.value
        wanted = only.value if only is not None else None
        for batch in batches:
            held, room = [], 0
            for tokens in shingle_sets(batch.column(0), n):
                if len(tokens) < 2:
                    continue
                sigs, rest = signatures(tokens, sketch[tokens >> np.uint64(64 - SKETCH_BITS)], frequent, percent)
                if wanted is not None:
                    keep = _has(wanted, sigs >> np.uint64(64 - FILTER_BITS))
                    sigs, rest = sigs[keep], rest[keep]
                if len(sigs):
                    held.append((sigs, rest, _digest(tokens, seed)[0], len(tokens)))
                    room += len(sigs)
                if room > 200_000:
                    yield _rows(held)
                    held, room = [], 0
            yield _rows(held)

    return docs.select("text").mapInArrow(released(run), "sig long, node long, n int, rest int")


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _rows(held: list[tuple]) -> pa.RecordBatch:
    each = [len(h[0]) for h in held]
    sigs = np.concatenate([h[0] for h in held]).view(np.int64) if held else np.zeros(0, np.int64)
    rest = np.concatenate([h[1] for h in held]) if held else np.zeros(0, np.int64)
    nodes = np.repeat(np.array([h[2] for h in held], dtype=np.int64), each)
    sizes = np.repeat(np.array([h[3] for h in held], dtype=np.int64), each)
    return pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(nodes), pa.array(sizes.astype(np.int32)), pa.array(rest.astype(np.int32))],
                                      names=["sig", "node", "n", "rest"])


def _sets(docs: DataFrame, n: int, seed: int, ids) -> DataFrame:
    """``node, tokens`` of the documents whose bit is set, and of those without an id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        bits = ids.value
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            column = batch.column(1).filter(pa.array(_has(bits, at)))
            for start in range(0, len(column), 500):
                sets = [s for s in shingle_sets(column.slice(start, 500), n) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s, seed)[0] for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "tokens"])

    return docs.select(_bit_of(F.col("doc_id")).alias("at"), "text").mapInArrow(released(run), "node long, tokens binary")


def _bit_of(doc_id: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id), 64 - DOC_BITS)


def _can_link(a: str, b: str, percent: int) -> Column:
    """Sizes and the most shared tokens allow a link: |x and y| >= percent / (100 + percent) * (|x| + |y|)."""
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    return ((percent * F.greatest(f"{a}.n", f"{b}.n") <= 100 * F.least(f"{a}.n", f"{b}.n"))
            & ((100 + percent) * F.least(f"{a}.rest", f"{b}.rest").cast("long") >= percent * sizes))


def _close(a: Column, b: Column, sizes: Column, percent: int) -> Column:
    """Whether the parity maps allow a link: differing tokens are at least as many as differing bits."""
    bits = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return (100 + percent) * (sizes - bits) >= 2 * percent * sizes


def _fetched(docs: DataFrame, pairs: DataFrame, known: DataFrame, n: int, seed: int) -> DataFrame:
    """``node, tokens`` of the nodes in ``pairs``."""
    asked = materialize(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct(), "asked")
    ids = known.join(asked, "node", "left_semi").select(_bit_of(F.col("doc_id")).alias("at"))
    found = _sets(docs, n, seed, broadcast_bits(ids, "at", DOC_BITS)).join(asked, "node", "left_semi")
    return materialize(found.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose sets link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(links, pa.bool_()))

    left = pairs.join(sets.select(F.col("node").alias("u"), F.col("tokens").alias("x")), "u")
    both = left.join(sets.select(F.col("node").alias("v"), F.col("tokens").alias("y")), "v")
    return both.select("u", "v", "x", "y").mapInArrow(released(run), "u long, v long")


def linked(xs: list[np.ndarray], ys: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets ``xs`` link with which of ``ys``: a matrix of shared tokens, summed over blocks of columns."""
    x_at, y_at = (np.repeat(np.arange(len(s)), [len(t) for t in s]) for s in (xs, ys))
    x, y = np.concatenate(xs), np.concatenate(ys)
    common = np.intersect1d(x, y)
    both = np.zeros((len(xs), len(ys)), dtype=np.int64)
    for start in range(0, len(common), _COLUMNS):
        part = common[start:start + _COLUMNS]
        sides = []
        for tokens, at, size in ((x, x_at, len(xs)), (y, y_at, len(ys))):
            column = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
            here = part[column] == tokens
            has = np.zeros((size, len(part)), dtype=np.float32)
            has[at[here], column[here]] = 1
            sides.append(has)
        both += (sides[0] @ sides[1].T).astype(np.int64)
    sizes = np.array([len(t) for t in xs])[:, None] + np.array([len(t) for t in ys])[None, :]
    return (both > 0) & (100 * both >= percent * (sizes - both))


def _degrees(found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, n_links`` of all nodes of ``found``: links never leave a component, so all pairs of sets of one are compared.

    A component is dealt by hash over blocks of a bounded number of sets and tokens. Every two blocks are one group of rows;
    its pairs exist inside the task only, so rows grow with a component's sets times its blocks.
    """
    sizes = sets.select("node", (F.octet_length("tokens") / 8).cast("long").alias("n"))
    placed = materialize(found.join(sizes, "node").select("node", "component", "n"), "placed")
    parts = F.greatest(F.ceil(F.count("*") / _BLOCK_SETS), F.ceil(F.sum("n") / _BLOCK_TOKENS)).cast("long")
    blocks = materialize(placed.groupBy("component").agg(F.count("*").alias("m"), parts.alias("blocks")), "blocks")
    placed = placed.join(blocks, "component")
    own = F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks"))
    dealt = materialize(placed.filter("m > 2").select("node", "component", "blocks", own.alias("own")), "dealt")
    other = dealt.select("node", "component", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    tiles = other.select("node", "component", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def run(table: pa.Table) -> pa.Table:
        own, low, high = (table[c].to_numpy() for c in ("own", "low", "high"))
        tokens = [np.frombuffer(raw.as_buffer(), np.uint64) for raw in table["tokens"].combine_chunks()]
        first, second = np.flatnonzero(own == low[0]), np.flatnonzero(own == high[0])
        links = np.zeros(len(own), dtype=np.int64)
        if len(first) and len(second):
            met = linked([tokens[i] for i in first], [tokens[i] for i in second], percent)
            if low[0] == high[0]:
                np.fill_diagonal(met, False)
            else:
                links[second] = met.sum(axis=0)
            links[first] = met.sum(axis=1)
        return pa.table({"node": table["node"], "links": pa.array(links)})

    counted = tiles.join(sets, "node").groupBy("component", "low", "high").applyInArrow(run, "node long, links long")
    counted = materialize(counted, "tiles").groupBy("node").agg(F.sum("links").alias("n_links"))
    return counted.unionByName(placed.filter("m = 2").select("node", F.lit(1).cast("long").alias("n_links")))


def jaccard_classes(docs: DataFrame, n: int = 4, percent: int = 85, links: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, text_key, stays``, one row per row of ``docs`` (``doc_id, text``).

    Documents link when 100 * intersection >= ``percent`` * union of their distinct ``n``-word runs, A-Z lower-cased;
    fewer words are one run; without words or text a document links with nothing and is its own component.
    ``component_id`` is the smallest id reachable by links; ``stays`` marks its row. ``n_links`` counts all links of the document's set to
    different sets; without ``links`` it is null.

    Equal sets are one node, told apart by a 64-bit digest; a second one of 64 bits shows collisions, upon which the digest
    changes. First every set meets the one of each shared signature that can share most tokens; then only sets of different
    components that meet in a signature are compared, all of them. Parity maps of 1,024 bits rule out most pairs before whole sets
    are fetched; what they rule out cannot link. That settles the components; links are then counted over all pairs of sets of each.
    """
    docs = docs.select("doc_id", "text")
    for seed in range(1 << 20):
        scanned = materialize(_scan(docs, n, seed), "shingles")
        nodes = scanned.filter("kind = 0").select("doc_id", "text_key", "n", "d1", "d2", "parity")
        if nodes.groupBy("d1").agg(F.min("d2").alias("a"), F.max("d2").alias("b")).filter("a <> b").isEmpty():
            break
    sketch = _sketch(scanned)
    counts = docs.sparkSession.sparkContext.broadcast(sketch)
    frequent = 32 + 4 * int(sketch.sum(dtype=np.uint64) >> np.uint64(SKETCH_BITS))

    every = _signature_rows(docs, n, seed, percent, counts, frequent)
    shared = materialize(every.groupBy("sig").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("sig"),
                         "signatures")
    bits = broadcast_bits(shared.select(F.shiftrightunsigned("sig", 64 - FILTER_BITS).alias("at")), "at", FILTER_BITS)
    some = _signature_rows(docs, n, seed, percent, counts, frequent, bits)
    some = some.groupBy("sig", "node").agg(F.max("n").alias("n"), F.max("rest").alias("rest"))
    members = materialize(some.join(shared, "sig", "left_semi"), "members")

    asked = materialize(members.select("node").distinct(), "asked")
    known = materialize(nodes.groupBy(F.col("d1").alias("node")).agg(F.min("doc_id").alias("doc_id"), F.first("parity").alias("parity"))
                        .join(asked, "node", "left_semi"), "nodes")
    parity = known.select("node", "parity")

    top = members.groupBy("sig").agg(F.max(F.struct("rest", "n", "node")).alias("top")).select("sig", "top.*")
    met = members.alias("a").join(materialize(top, "tops").alias("b"), "sig")
    ordered = [F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"), (F.col("a.n") + F.col("b.n")).alias("sizes")]
    differ = F.col("a.node") != F.col("b.node")
    first = materialize(met.filter(differ & _can_link("a", "b", percent)).select(*ordered).distinct(), "pairs")
    near = first.join(parity.select(F.col("node").alias("u"), F.col("parity").alias("x")), "u").join(
        parity.select(F.col("node").alias("v"), F.col("parity").alias("y")), "v")
    near = materialize(near.filter(_close(F.col("x"), F.col("y"), F.col("sizes"), percent)).select("u", "v"), "pairs")
    sets = _fetched(docs, near, known, n, seed)
    edges = materialize(_verified(near, sets, percent), "links")

    # a signature of two sets is done; of others only members of different components remain
    found = components(edges, contract)
    placed = materialize(members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    split = placed.groupBy("sig").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m"))
    split = materialize(split.filter("x <> y and m > 2").select("sig"), "unsettled-signatures")
    unsettled = materialize(placed.join(split, "sig", "left_semi").join(parity, "node"), "unsettled")
    left, right = unsettled.alias("a"), unsettled.alias("b")
    second = left.join(right, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.node") < F.col("b.node"))
                       & (F.col("a.component") != F.col("b.component")) & _can_link("a", "b", percent)
                       & _close(F.col("a.parity"), F.col("b.parity"), F.col("a.n") + F.col("b.n"), percent))
    second = materialize(second.select(*ordered[:2]).distinct().join(near, ["u", "v"], "left_anti"), "pairs")
    if not second.isEmpty():
        others = _fetched(docs, second, known, n, seed)
        more = materialize(_verified(second, others, percent), "links")
        found = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more), contract)
        sets = sets.unionByName(others.join(sets, "node", "left_anti"))
    count = _degrees(found, sets, percent) if links else found.select("node", F.lit(None).cast("long").alias("n_links"))
    degree = materialize(found.join(count, "node"), "degrees")
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("text_key"))
    each = nodes.filter("n > 0").withColumnRenamed("d1", "node").join(degree, "node", "left").select(
        "doc_id", "text_key", "n", F.coalesce("component", "node").alias("component"),
        (F.coalesce("n_links", F.lit(0)) if links else F.col("n_links")).alias("n_links"))
    each = materialize(each, "documents")
    least = materialize(each.groupBy("component").agg(F.min(place).alias("first")), "least")
    linked = each.join(least, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), "n_links", "text_key", (place == F.col("first")).alias("stays"))
    alone = nodes.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                         F.lit(0 if links else None).cast("long").alias("n_links"), "text_key", F.lit(True).alias("stays"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of every component of ``docs`` and all rows without words, with all their columns.

    The smallest id stays, null last, then the smallest hash of the text. Rows repeated with their id and text stay or go together.
    """
    classes = jaccard_classes(docs, n, percent, links=False)
    gone = materialize(classes.filter("not stays").select("doc_id", "text_key").distinct(), "near-copies")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("g.text_key"))
    doubtful = may_hold(gone)  # no other row needs its text shuffled
    return docs.filter(~doubtful).union(docs.filter(doubtful).alias("d").join(gone.alias("g"), same, "left_anti"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id", "n_links")
