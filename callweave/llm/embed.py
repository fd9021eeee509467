"""Embedding near-dedup by sorted projection passes.

Every pass gives each vector a key of random hashes, the signs of its projections on random directions put one after the
other, sorts all vectors by that key, and compares each with a bounded window of neighbours. Where more vectors share the
leading signs than a window holds, all of them are compared, in blocks. So every pair that shares these signs is
compared, and how often a pair does depends on its own angle only, not on the vectors around it. Pairs that verify are
united over all passes. Inside each component found, all pairs are then compared in blocks, so that links are counted in
full however many vectors a component holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.components import components
from callweave.llm.registry import query
from callweave.session import cut_lineage

#: Neighbours after each vector that a pass compares it with.
WINDOW = 48
#: Vectors of a sorted block; a task compares a block and the window after it.
BLOCK = 4096
#: Vectors of a block inside a component or a stretch of equal leading signs.
CELL = 2048
#: Passes whose keys alone are made first, to see how many pairs share the leading signs.
PROBES = 3


def _bits(n: int, window: int = WINDOW) -> float:
    return max(1.0, math.log2(max(n, 2) / window))


def passes_for(n: int, threshold: float, recall: float, window: int = WINDOW) -> int:
    """Passes needed so that a pair at the threshold meets in one of them with the probability ``recall``.

    All vectors with equal first log2(n / window) signs, rounded down, are compared in a pass.
    """
    bits = _bits(n, window)
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - together))) if together < 1 else 2


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, dim, unit vector as float64 bytes) of the vectors that can be compared."""
    for batch in batches:
        ids, dims, units = [], [], []
        for i, v in zip(batch.column(0), batch.column(1), strict=True):
            v = v.as_py()
            if not v or any(x is None for x in v) or not i.is_valid:
                continue
            v = np.array(v, np.float64)
            top = np.abs(v).max()
            if not np.isfinite(top) or top == 0 or not np.isfinite(v).all():
                continue
            v = v / top
            ids.append(i.as_py())
            dims.append(len(v))
            units.append((v / np.linalg.norm(v)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], ["id", "dim", "unit"])


def _keyed(passes: int, seed: int):
    """One row per vector and pass with the pass's 64 signs, most significant first, as an unsigned sort key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[tuple[int, int], np.ndarray] = {}
        weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                x = np.frombuffer(b"".join(own.column("unit").to_pylist()), np.float64).reshape(-1, dim)
                for p in range(passes):
                    if (dim, p) not in directions:
                        directions[dim, p] = np.random.default_rng([seed, int(dim), p]).standard_normal((dim, 64))
                    signs = (x @ directions[dim, p] > 0).astype(np.uint64) @ weights
                    # the sign bit is turned so that signed order is bit order
                    key = (signs ^ np.uint64(1 << 63)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(x), pa.int32()), pa.array(key), *own.columns], ["pass", "key", *own.schema.names])

    return run


def _rows_of_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal ``keys`` out of sorted batches, one bounded group at a time."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i in range(len(rows) + 1):
            if i < len(rows) and rows[i] == (rows[start] if i > start else rows[i]):
                continue
            if i > start:
                if held and at != rows[start]:
                    yield at, pa.Table.from_batches(held)
                    held = []
                at = rows[start]
                held.append(batch.slice(start, i - start))
                start = i
    if held:
        yield at, pa.Table.from_batches(held)


def _matrix(table: pa.Table) -> np.ndarray:
    units = table.column("unit").to_pylist()
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def _window_links(threshold: float, window: int, size: int):
    """Links in the windows of a block of ``size`` ranks, and in its wide stretches unless one touches the first or last rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, block), table in _rows_of_groups(batches, ["pass", "dim", "block"]):
            table = table.sort_by("rank")
            x, ids, rank = _matrix(table), table.column("id").to_numpy(), table.column("rank").to_numpy()
            roots = np.arange(len(x))
            for gap in range(1, min(window, len(x) - 1) + 1):
                near = np.flatnonzero(np.einsum("ij,ij->i", x[gap:], x[:-gap]) >= threshold)
                _unite(roots, near, near + gap)
            own = int(np.searchsorted(rank, (block + 1) * size))
            prefix = table.column("prefix").to_numpy()[:own]
            ends = [0, *(np.flatnonzero(prefix[1:] != prefix[:-1]) + 1), own]
            for start, end in zip(ends[:-1], ends[1:], strict=True):
                if end - start > window + 1 and rank[start] % size != 0 and rank[end - 1] % size != size - 1:
                    _unite_near(roots, x, np.arange(start, end), np.arange(start, end), threshold)
            yield _to_roots(roots, ids)

    return run


def _cell_links(keys: list[str], threshold: float):
    """Links between the two sides of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (*_, low, high), table in _rows_of_groups(batches, [*keys, "low", "high"]):
            x, ids, side = _matrix(table), table.column("id").to_numpy(), table.column("sub").to_numpy()
            roots = np.arange(len(x))
            _unite_near(roots, x, np.flatnonzero(side == low), np.flatnonzero(side == high), threshold)
            yield _to_roots(roots, ids)

    return run


def _unite_near(roots: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray, threshold: float, step: int = 512) -> None:
    """Unites the rows and columns that link; a few rows at a time, so that their products stay small."""
    others = x[cols].T
    for start in range(0, len(rows), step):
        part = rows[start : start + step]
        a, b = np.nonzero(x[part] @ others >= threshold)
        a, b = part[a], cols[b]
        # most links of a dense group repeat what is united already
        apart = roots[a] != roots[b]
        _unite(roots, a[apart], b[apart])
        roots[:] = [_root(roots, i) for i in range(len(roots))] if apart.any() else roots


def _unite(roots: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        a, b = _root(roots, a), _root(roots, b)
        roots[max(a, b)] = min(a, b)


def _to_roots(roots: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    top = np.array([_root(roots, i) for i in range(len(roots))], np.int64)
    moved = top != np.arange(len(roots))
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[top[moved]])], ["a", "b"])


def _root(roots: np.ndarray, i: int) -> int:
    while roots[i] != i:
        roots[i] = roots[roots[i]]
        i = roots[i]
    return i


def _cell_counts(threshold: float):
    """Links of each vector with the vectors of the other side of its cell, by copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), table in _rows_of_groups(batches, ["component", "low", "high"]):
            x, ids, n = _matrix(table), table.column("id").to_numpy(), table.column("copies").to_numpy()
            side = table.column("sub").to_numpy()
            rows, cols = np.flatnonzero(side == low), np.flatnonzero(side == high)
            near = x[rows] @ x[cols].T >= threshold
            found, links = [ids[rows]], [near @ n[cols]]
            if low != high:
                found.append(ids[cols])
                links.append(near.T @ n[rows])
            else:
                # a vector and itself, which rounding may put below the threshold, count once: its copies
                links[0] = links[0] + np.where(near.diagonal(), 0, n[rows])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(links).astype(np.int64))], ["id", "links"])

    return run


def _in_cells(rows: DataFrame, keys: list[str], sizes: DataFrame) -> DataFrame:
    """``rows`` dealt into cells (low, high), two sides ``sub`` of about ``CELL`` rows; ``sizes`` has ``keys`` and ``cells``.

    Any two rows with equal keys meet in one cell.
    """
    dealt = rows.join(sizes, keys).withColumn("sub", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    dealt = dealt.withColumn("low", F.least("sub", "other")).withColumn("high", F.greatest("sub", "other")).drop("cells", "other")
    return dealt.repartition(*keys, "low", "high").sortWithinPartitions(*keys, "low", "high")


def _cells(rows: str) -> Column:
    return F.ceil(F.col(rows) / CELL).cast("int").alias("cells")


def _every_pair(copies: DataFrame, threshold: float, seed: int, n: int, passes: int, prefix: Column) -> DataFrame | None:
    """Links by comparing every pair once, where close vectors make the passes compare more pairs than there are."""
    probes = min(PROBES, passes)
    probe = copies.select("id", "dim", "unit").mapInArrow(_keyed(probes, seed), "pass int, key long, id long, dim int, unit binary")
    shared = probe.groupBy("pass", "dim", prefix.alias("prefix")).agg(F.count("*").cast("double").alias("n"))
    shared = shared.agg(F.coalesce(F.sum(F.col("n") * F.col("n")) / 2, F.lit(0.0))).first()[0]
    dims = copies.groupBy("dim").agg(F.count("*").alias("n"))
    every = dims.agg(F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")) / 2, F.lit(0.0))).first()[0]
    if passes * (n * WINDOW + shared / probes) <= every:
        return None
    # one row for each length of vector
    cells = _in_cells(copies.select("dim", "id", "unit"), ["dim"], F.broadcast(dims.select("dim", _cells("n"))))
    return cells.mapInArrow(_cell_links(["dim"], threshold), "a long, b long")


def _links(copies: DataFrame, threshold: float, recall: float, seed: int, cheapest: bool) -> DataFrame:
    """(a, b) of vectors that link, enough of them to connect every component the passes find."""
    n = copies.count()
    passes = passes_for(n, threshold, recall)
    # rounded down: a pair shares these signs at least as often as the passes were reckoned for
    bits = min(63, int(_bits(n)))
    prefix = F.shiftright("key", 64 - bits)
    if cheapest:
        every = _every_pair(copies, threshold, seed, n, passes, prefix)
        if every is not None:
            return every
    # 1. sorted order of every pass, over range partitions; ranks are places inside them plus the sizes before
    keyed = copies.select("id", "dim", "unit").mapInArrow(_keyed(passes, seed), "pass int, key long, id long, dim int, unit binary")
    sorted_rows = cut_lineage(keyed.repartitionByRange("dim", "pass", "key", "id").withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part", "dim", "pass").orderBy("key", "id")
    earlier = Window.partitionBy("dim", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sorted_rows.groupBy("part", "dim", "pass").count().withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).drop("count")
    ranked = sorted_rows.withColumn("within", F.row_number().over(inside) - 1).join(offsets, ["part", "dim", "pass"])
    ranked = ranked.withColumn("rank", F.col("within") + F.col("before")).withColumn("prefix", prefix)
    # 2. each block with the window that follows it
    block = F.floor(F.col("rank") / BLOCK)
    blocks = F.when((F.col("rank") % BLOCK < WINDOW) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    dealt = ranked.select("pass", "dim", "rank", "prefix", "id", "unit", F.explode(blocks).alias("block"))
    dealt = dealt.repartition("pass", "dim", "block").sortWithinPartitions("pass", "dim", "block")
    links = dealt.mapInArrow(_window_links(threshold, WINDOW, BLOCK), "a long, b long")
    # stretches of equal leading signs that are wider than a window and not inside a block; two for each block at most
    keys = ["pass", "dim", "prefix"]
    wide = ranked.groupBy(*keys).agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.count("*").alias("n")).filter(F.col("n") > WINDOW + 1)
    at = lambda c: F.floor(F.col(c) / BLOCK)
    wide = wide.filter((at("first") != at("last")) | (F.col("first") % BLOCK == 0) | (F.col("last") % BLOCK == BLOCK - 1))
    cells = _in_cells(ranked.select(*keys, "id", "unit"), keys, wide.select(*keys, _cells("n")))
    return links.unionByName(cells.mapInArrow(_cell_links(keys, threshold), "a long, b long"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95, recall: float = 0.995, seed: int = 7, cheapest: bool = True) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept``, one row per vector.

    Two vectors of one length link when their cosine in double precision reaches ``threshold``. ``n_links`` counts
    the others linked directly, ``component_id`` is the smallest id reachable, ``kept`` marks that one. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing; a row with a null id comes back with a null
    ``component_id`` and is not kept. Vectors with equal values are compared once and counted as often as there are
    ids. Repeated rows (same id, same vector) come back once. Other columns are left out. No pair below the threshold is
    linked; of those at the threshold ``recall`` are met in one of the passes at least, the nearer ones more often, however
    close together the vectors lie. ``cheapest`` compares all pairs instead where that is less work than the passes.
    """
    given = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v")).distinct()
    units = given.mapInArrow(_unit, "id long, dim int, unit binary")
    copies = cut_lineage(units.groupBy("dim", "unit").agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies"), F.sha2("unit", 256).alias("digest")))
    # 1. and 2. sorted passes
    # 3. union over all passes
    found = components(_links(copies, threshold, recall, seed, cheapest))
    # 4. all pairs inside each component, in cells of bounded size
    members = copies.join(found, "id")
    sizes = members.groupBy("component").agg(F.count("*").alias("n")).select("component", _cells("n"))
    cells = _in_cells(members.select("component", "id", "copies", "unit"), ["component"], sizes)
    counted = cells.mapInArrow(_cell_counts(threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))
    classes = copies.select("id", "digest", "copies").join(found, "id", "left").join(counted, "id", "left")
    classes = classes.select(
        "digest",
        (F.coalesce("links", "copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    named = units.select("id", F.sha2("unit", 256).alias("digest")).distinct().join(classes, "digest").drop("digest")
    lone = given.select("id").join(named, "id", "left_anti").distinct()
    lone = lone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = named.unionByName(lone)
    return out.select(F.col("id").alias(id_col), F.col("n_links").cast("long"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), ok AS (
  SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), r(vec_id, root) AS (SELECT vec_id, vec_id FROM e UNION SELECT y, root FROM r JOIN l ON x = vec_id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(root) AS component_id FROM r GROUP BY 1) LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY 1) USING (vec_id)
"""


@query("op3_embedding_dedup", SQL)
def op3_embedding_dedup(spark, folder):
    """Links and components of all embeddings, by the sorted passes whatever their number."""
    return near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"), cheapest=False)
