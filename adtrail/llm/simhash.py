"""SimHash near-duplicates: fingerprints linked at a small bit distance by generalised pigeonhole search.

The 64 bits are grouped into a few partitions of correlated bits. If two fingerprints differ in at most ``t`` bits and
the partitions have thresholds ``t_i`` with ``sum(t_i + 1) = t + 1``, then in some partition they differ in at most
``t_i`` bits; a threshold of -1 leaves a partition out. The number of partitions and their thresholds come from dynamic
programming over the estimated cost of each choice: probes plus candidates, the latter from exact counts of equal
partition values over all fingerprints and the bits' frequencies. Each fingerprint probes the values within ``t_i``
bits of its own; candidates are verified by their full distance.

A partition value that more than ``CROWD`` fingerprints share would give pairs in the square of their number. Those
that probe such a value meet instead at the midpoints of their links: each names all fingerprints within ``t / 2`` bits
of itself, and those that name the same one are linked through it. That is exact as well and costs a fixed number of
rows per fingerprint.

Equal fingerprints are one node; links and components are tables, never gathered on the driver.

Defined cases: a null or empty text has fingerprint 0 and links like any other; fewer words than a shingle make one
shingle of the whole; repeated rows are linked; null ids are linked too but never a component's id while it has
another; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.llm.graph import components
from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import blocks

BITS = 64
CROWD = 32
PARTITIONS = (2, 3, 4)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(data: bytes | None, shingle: int, seed: int = 42) -> int:
    """The SimHash of a text, as an unsigned number: a bit is 1 if over half of the shingles' XXH64 have it."""
    words = (data or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    count, ones = len(starts), np.zeros(BITS, np.int64)
    for at in range(0, count, 1 << 16):
        part = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id: str, text: str, shingle: int) -> DataFrame:
    """(_id, _key, fp): ``_key`` is a 64-bit hash of the text, ``fp`` the fingerprint as a signed number."""
    slim = docs.select(F.col(id).alias("_id"), F.xxhash64(F.col(text)).alias("_key"), F.col(text).cast("string").cast("binary").alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                fps = np.array([fingerprint(data, shingle) for data in part.column("_text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_key"), pa.array(fps.view(np.int64))], names=["_id", "_key", "fp"])

    return slim.mapInArrow(run, f"_id {kind}, _key bigint, fp bigint")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and in how many of them each two bits are both 1; 64 x 64 numbers at any size."""

    def count(batches):
        total, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total, both = total + len(bits), both + (bits.T @ bits).astype(np.float64)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(range(-1, BITS * BITS), pa.int32()), "n": pa.array([total, *both.ravel().astype(np.int64).tolist()], pa.int64())})

    rows = nodes.select("fp").mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = {r["cell"]: r["n"] for r in rows}
    total = found.get(-1, 0)
    return total, np.array([found.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def correlated_parts(total: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of near equal size, each grown from a bit by adding what correlates most with it."""
    n = max(total, 1)
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    tie = np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (tie[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (tie[b, group].sum(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Least total cost of giving ``units`` units to the partitions; ``costs[i][u]``: partition i with u units, threshold u - 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for u, extra in enumerate(options[: units - used + 1]):
                offer = (cost + extra, [*chosen, u - 1])
                if used + u not in step or offer < step[used + u]:
                    step[used + u] = offer
        best = step
    return best[units]


def threshold_costs(total: int, both: np.ndarray, bits: list[int], pairs: float, distance: int) -> list[float]:
    """Cost of a partition at thresholds -1 to ``distance``: probes of all fingerprints, and candidates.

    ``pairs`` is the exact cost at threshold 0, from the values that fingerprints share; each further differing bit
    multiplies it by the odds that two fingerprints differ in it.
    """
    p = np.diag(both)[bits] / max(total, 1)
    differ = 2 * p * (1 - p)
    odds = differ / np.maximum(1 - differ, 1e-9)
    ways, probes = np.zeros(distance + 1), np.zeros(distance + 1)
    ways[0] = probes[0] = 1
    for odd in odds:
        ways[1:] += odd * ways[:-1].copy()
        probes[1:] += probes[:-1].copy()
    return [0.0, *(total * np.cumsum(probes) + 2 * pairs * np.cumsum(ways)).tolist()]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _mask(bits) -> int:
    return _signed(sum(1 << b for b in bits))


def plan_search(nodes: DataFrame, distance: int, folder: str, partitions: tuple[int, ...] = PARTITIONS, crowd: int = CROWD) -> tuple[list[tuple[int, list[int], int]], DataFrame]:
    """([(partition number, its bits, threshold)], values): the cheapest plan, and how often partition values occur.

    ``values`` (part, key, n) has the values that two or more fingerprints share.
    """
    total, both = bit_counts(nodes)
    layouts = {m: correlated_parts(total, both, m) for m in partitions}
    numbered = {(m, i): m * BITS + i for m in partitions for i in range(m)}
    cells = F.array(*[
        F.struct(F.lit(number).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(layouts[m][i]))).alias("key")) for (m, i), number in numbered.items()
    ])
    values = nodes.select(F.explode(cells).alias("c")).groupBy("c.part", "c.key").agg(F.count("*").alias("n"))
    values = written(values.where("n > 1"), f"{folder}/values")
    # A crowded value makes no pairs: each of its fingerprints names its midpoints instead.
    n, midpoints = F.col("n"), len(_within(distance - distance // 2))
    cost = F.when(n > crowd, n * midpoints).otherwise(n * (n - 1) / 2)
    pairs = {r["part"]: r["p"] for r in values.groupBy("part").agg(F.sum(cost).alias("p")).collect()}
    plans = []
    for m in partitions:
        costs = [threshold_costs(total, both, bits, pairs.get(numbered[m, i], 0.0), distance) for i, bits in enumerate(layouts[m])]
        cost, thresholds = allocate(costs, distance + 1)
        plans.append((cost, m, thresholds))
    _, m, thresholds = min(plans)
    return [(numbered[m, i], layouts[m][i], t) for i, t in enumerate(thresholds) if t >= 0], values


def _within(radius: int, bits=range(BITS)) -> list[int]:
    """Masks of up to ``radius`` of ``bits``."""
    return [_mask(flips) for n in range(radius + 1) for flips in combinations(bits, n)]


def links(nodes: DataFrame, distance: int, folder: str, partitions: tuple[int, ...] = PARTITIONS, crowd: int = CROWD) -> DataFrame:
    """(a, b): links enough to connect all fingerprints that differ in ``distance`` bits or fewer; none between others."""
    plan, values = plan_search(nodes, distance, folder, partitions, crowd)
    fp = F.col("fp")
    probe = lambda part, bits, flip: F.struct(
        F.lit(part).alias("part"), fp.bitwiseXOR(F.lit(flip)).bitwiseAND(F.lit(_mask(bits))).alias("key"), F.lit(flip == 0).alias("own")
    )
    probes = F.array(*[probe(part, bits, flip) for part, bits, t in plan for flip in _within(t, bits)])
    crowded = values.where(F.col("n") > crowd).select("part", "key", F.lit(True).alias("crowded"))
    laid = nodes.select("fp", F.explode(probes).alias("p")).select("fp", "p.part", "p.key", "p.own").join(crowded, ["part", "key"], "left")
    laid = written(laid, f"{folder}/probes")
    thin = laid.where("crowded is null")
    met = thin.select("part", "key", F.col("fp").alias("a")).join(thin.where("own").select("part", "key", F.col("fp").alias("b")), ["part", "key"])
    found = met.where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")

    near, far = distance // 2, distance - distance // 2
    ball, core = _within(far), len(_within(near))
    named = F.posexplode(F.array(*[fp.bitwiseXOR(F.lit(m)) for m in ball])).alias("n", "midpoint")
    named = laid.where("crowded").select("fp").distinct().select("fp", named)
    # A midpoint is named by no more fingerprints than lie within the radius of it.
    groups = named.groupBy("midpoint").agg(F.collect_list("fp").alias("all"), F.min(F.when(F.col("n") < core, fp)).alias("a"))
    through = groups.where((F.size("all") > 1) & F.col("a").isNotNull()).select("a", F.explode("all").alias("b")).where("a <> b")
    return written(found.union(through), f"{folder}/links")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2, partitions: tuple[int, ...] = PARTITIONS, crowd: int = CROWD) -> DataFrame:
    """(id, _key, fingerprint, component_id, _root) per row; ``component_id`` is the least id that links reach, ``_root`` names the
    group even where groups share an id."""
    folder = fresh_folder(docs.sparkSession, "simhash")
    rows = written(fingerprints(docs, id, text, shingle), f"{folder}/rows")
    nodes = written(rows.groupBy("fp").agg(F.min("_id").alias("rep")), f"{folder}/nodes")
    found = links(nodes, distance, folder, partitions, crowd)
    roots = written(components(found, f"{folder}/components").withColumnRenamed("node", "fp"), f"{folder}/roots")
    rooted = written(nodes.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), f"{folder}/rooted")
    least = written(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), f"{folder}/least")
    labelled = written(rooted.join(least, "root").select("fp", "component_id", F.col("root").alias("_root")), f"{folder}/labelled")
    return rows.join(labelled, "fp").select(F.col("_id").alias(id), "_key", hex_of(F.col("fp")).alias("fingerprint"), "component_id", "_root")
