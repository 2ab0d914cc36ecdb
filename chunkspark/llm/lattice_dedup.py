"""Near-duplicate embeddings by lattice hashing.

Vectors are normalised, projected to 16 dimensions by ``TABLES`` random matrices, scaled,
and each half is decoded to its nearest point of the E8 lattice; the two points are the cell. Two
neighbouring points per half, the best steps along the lattice's shortest vectors, are probed as well,
so each vector has 5 cells a table. Vectors that share any cell are compared by cosine in double
precision, once per pair, in the smallest cell they share. Equal vectors are one vertex. Large cells are
compared in blocks, every two parts of a cell in a group of their own; tasks hand on counts and spanning links, no pairs.

What travels to all cells of a vector is thin: the signs of ``SIGNS`` random projections. Rows without a partner in
their group whose signs agree as often as those of a pair at the threshold, less six standard deviations, go no further (a link
is lost so with a chance under 1e-7). Those left get their list of cells, and rows without such a partner that they meet there first go; only
then are vectors brought to their groups, to be verified.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
different lengths. A null vec_id links with nothing, has no component, and is kept. Rows repeated with the same vec_id count as
vectors of their own among the links. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkspark.llm.common import bounded_batches, stored
from chunkspark.llm.pairing import LINKS_DDL, components, key_table, linked, meets_first, pairs, whole_groups
from chunkspark.plans.registry import query
from chunkspark.session import read_table

TABLES, HALVES, WIDTH = 8, 2, 0.85
COSINE = 0.9
BLOCK = 512
SIGNS = 256
GROUP = ("cell", "_a", "_b")
PLACED = "cell long, _a int, _b int, _own int, at long"


def nearest(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the nearer of the two cosets' points of even coordinate sum."""
    def even(x):
        point = np.rint(x)
        rest = x - point
        odd = np.flatnonzero(point.sum(axis=1).astype(np.int64) & 1)
        worst = np.argmax(np.abs(rest[odd]), axis=1)
        point[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
        return point

    whole, half = even(y), even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def neighbours(y: np.ndarray, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best step with two whole coordinates and the best with eight half ones."""
    rest = y - point
    sign, size = np.where(rest >= 0, 1.0, -1.0), np.abs(rest)
    order, row = np.argsort(-size, axis=1, kind="stable"), np.arange(len(y))
    two, eight = np.zeros_like(y), sign * 0.5
    for k in range(2):
        two[row, order[:, k]] = sign[row, order[:, k]]
    odd = np.flatnonzero((sign < 0).sum(axis=1) & 1)
    eight[odd, order[odd, -1]] *= -1
    return point + two, point + eight


def cells(unit: np.ndarray) -> np.ndarray:
    """Cells of normalised vectors, ascending, as hashed longs."""
    rng = np.random.default_rng(unit.shape[1])
    out = []
    for _ in range(TABLES):
        matrix = rng.standard_normal((unit.shape[1], 8 * HALVES)) / np.sqrt(8) / WIDTH
        factors = rng.integers(1, 1 << 62, size=8 * HALVES, dtype=np.int64) * 2 + 1
        salt = rng.integers(1, 1 << 62, dtype=np.int64)
        y = unit @ matrix
        codes = []
        for half in range(HALVES):
            part = slice(8 * half, 8 * half + 8)
            point = nearest(y[:, part])
            codes.append([(np.rint(2 * p).astype(np.int64) * factors[part]).sum(axis=1) for p in (point, *neighbours(y[:, part], point))])
        home = sum(c[0] for c in codes) + salt
        out += [home, *[home - c[0] + c[k] for c in codes for k in (1, 2)]]
    return np.sort(np.stack(out, axis=1), axis=1)


def signs(unit: np.ndarray) -> np.ndarray:
    """Signs of random projections of normalised vectors, 64 to a long."""
    rng = np.random.default_rng([SIGNS, unit.shape[1]])
    bits = unit @ rng.standard_normal((unit.shape[1], SIGNS)) >= 0
    return np.packbits(bits, axis=1).view(np.int64)


def most_differing(threshold: float) -> int:
    """Signs in which a pair at the threshold differs at most, but for a chance under 1e-7."""
    share = np.arccos(np.clip(threshold, -1.0, 1.0)) / np.pi
    return int(np.ceil(SIGNS * share + 6 * np.sqrt(SIGNS * share * (1 - share))))


def _vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v, dtype=np.float64) for v in column.to_pylist()]


def _hashed(batches):
    schema = pa.schema([("at", pa.int64()), ("vertex", pa.int64()), ("weight", pa.int64()), ("size", pa.int32()), ("unit", pa.binary()), ("cells", pa.list_(pa.int64())),
                        ("signs", pa.list_(pa.int64()))])
    for batch in batches:
        rows, ids, weights = (np.asarray(batch.column(c)) for c in ("at", "vertex", "weight"))
        vectors = _vectors(batch.column("vector"))
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = np.stack([vectors[i] for i in at])
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            found = cells(x)
            yield pa.record_batch([
                pa.array(rows[at]), pa.array(ids[at]), pa.array(weights[at]), pa.array(np.full(len(at), size, dtype=np.int32)), pa.array([r.tobytes() for r in x], pa.binary()),
                pa.array([np.unique(r) for r in found], pa.list_(pa.int64())), pa.array(list(signs(x)), pa.list_(pa.int64())),
            ], schema=schema)


def _meet(group: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows of one group are to be compared there: in a group of two parts, rows of different parts only."""
    across, own = group.column("_a").to_numpy() != group.column("_b").to_numpy(), group.column("_own").to_numpy()
    return ~(across[i] & (own[i] == own[j]))


def _promising(threshold: float):
    """Rows with a partner in their group whose signs agree enough; where rows bring their cells, one they meet there first."""
    most = most_differing(threshold)

    def run(batches):
        for group, starts in whole_groups(batches, GROUP):
            words = [group.column(f"s{k}").to_numpy().view(np.uint64) for k in range(SIGNS // 64)]
            keys = key_table(group.column("cells")) if "cells" in group.column_names else None
            here, found = group.column("cell").to_numpy(), np.zeros(group.num_rows, dtype=bool)
            for i, j in pairs(starts):
                near = sum(np.bitwise_count(w[i] ^ w[j]).astype(np.int64) for w in words) <= most
                near &= _meet(group, i, j)
                i, j = i[near], j[near]
                if keys is not None:
                    kept = meets_first(keys, here, i, j)
                    i, j = i[kept], j[kept]
                found[i] = found[j] = True
            if found.any():
                yield from group.select([*GROUP, "_own", "at"]).filter(pa.array(found)).combine_chunks().to_batches()

    return run


def _compared(threshold: float):
    def run(batches):
        for group, starts in whole_groups(batches, GROUP):
            vertex, weight = group.column("vertex").to_numpy(), group.column("weight").to_numpy()
            size, here = group.column("size").to_numpy(), group.column("cell").to_numpy()
            flat = np.frombuffer(b"".join(group.column("unit").to_pylist()), dtype=np.float64)
            first = np.concatenate(([0], np.cumsum(size)[:-1]))
            keys = key_table(group.column("cells"))
            for i, j in pairs(starts):
                meet = (size[i] == size[j]) & _meet(group, i, j)
                i, j = i[meet], j[meet]
                close = np.zeros(len(i), dtype=bool)
                for length in np.unique(size[i]):
                    for at in np.array_split(np.flatnonzero(size[i] == length), max(1, len(i) * int(length) >> 21)):
                        span = np.arange(length)
                        a, b = flat[first[i[at]][:, None] + span], flat[first[j[at]][:, None] + span]
                        close[at] = np.einsum("ij,ij->i", a, b) >= threshold
                i, j = i[close], j[close]
                kept = meets_first(keys, here, i, j)
                if kept.any():
                    yield linked(i[kept], j[kept], vertex, weight)

    return run


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "at")


def _dealt(met: DataFrame) -> DataFrame:
    """Rows (cell, at, ...) with the groups they are compared in. A cell of over ``BLOCK`` rows is dealt into parts by a hash of
    ``at``, a vector's number, and every two parts meet in a group of their own; ``_own`` is a row's part.

    Large cells are at most one in ``BLOCK`` rows; whether they are broadcast is decided by the size of their table.
    """
    large = met.groupBy("cell").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > BLOCK)
    large = stored(large.select("cell", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_parts")), "large")
    named = met.join(large, "cell", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    named = named.withColumn("_own", F.pmod(F.xxhash64(F.lit(77), "at"), F.col("_parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    placed = named.withColumn("_other", other).withColumn("_a", F.least("_own", "_other")).withColumn("_b", F.greatest("_own", "_other"))
    return placed.drop("_parts", "_other")


def lattice_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("_v"))
    usable = (F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("_v", lambda x: x != 0))
    rows = rows.withColumn("_v", F.when(usable, F.col("_v")))
    alike = rows.filter(F.col("_v").isNotNull()).groupBy("_v").agg(F.min("vec_id").alias("vertex"), F.count(F.lit(1)).alias("weight"))
    # Vectors are numbered, since different ones may have the same vec_id.
    alike = stored(alike.select(F.monotonically_increasing_id().alias("at"), F.col("_v").alias("vector"), "vertex", "weight"), "vectors")
    hashed = stored(alike.mapInArrow(_hashed, "at long, vertex long, weight long, size int, unit binary, cells array<long>, signs array<long>"), "cells")
    words = [F.col("signs")[k].alias(f"s{k}") for k in range(SIGNS // 64)]
    met = _dealt(hashed.select(F.explode("cells").alias("cell"), "at", *words))
    near = stored(_grouped(met).mapInArrow(_promising(threshold), PLACED), "near")
    near = _grouped(near.join(hashed.select("at", "cells", *words), "at")).mapInArrow(_promising(threshold), PLACED)
    near = stored(near, "met").join(hashed.select("at", "vertex", "weight", "size", "unit", "cells"), "at")
    linked_rows = stored(_grouped(near).mapInArrow(_compared(threshold), LINKS_DDL), "links")
    counts = linked_rows.groupBy("vertex").agg(F.sum("links").alias("links"))
    groups = components(linked_rows.select("vertex", "root"))
    told = alike.select("vector", "vertex", "weight").join(counts, "vertex", "left").join(groups, "vertex", "left").select(
        F.col("vector").alias("_v"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "vertex").alias("component_id"))
    return rows.join(told, "_v", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op8_embedding_near_dedup")
def op8_embedding_near_dedup(spark, sf_dir):
    return lattice_links(read_table(spark, sf_dir, "embeddings"))
