"""Substring dedup: runs of words that an earlier document holds are found by prefix-partitioned suffix trees.

A window is ``window`` consecutive words. Suffixes are indexed where it matters: every window names as its anchor the
start of its least-hashed run of PREFIX words, so equal windows name equal anchors, and about one word in twenty is one.
The PREFIX words at an anchor are the prefix by which suffixes are parted:

* a prefix that only one document holds can't repeat and goes no further;
* a prefix with up to ``crowd`` places forms, with others, a group that fits in memory. Its suffixes are sorted level by
  level (1, 2, 4 ... words), which parts them like the nodes of their suffix tree; those that still stand together at
  depth ``window`` hang under one deep internal node, a repeat;
* a prefix with more places is lengthened. Neighbouring windows under such prefixes are joined to one stretch, whose words
  are written once; in it every window names its least-hashed run of 16 words, then of 32, and so on. Each level is
  written; prefixes that have become short of places go the two ways above, and only what is still crowded goes on;
* a prefix of all ``window`` words is a deep node by itself, and no group is needed for it: its least document id, found
  by folding before the shuffle, is its owner. Owners are told which windows are theirs, so rows of a passage that a
  third of the documents hold are never joined with one another, nor with its node.

A word is removed if it is covered by a window that also starts in a document with a smaller id. Windows are judged on
the input. Documents with the same words are one: of such copies only those with the least id are searched.

Defined cases: a null or empty text has no words; a text shorter than the window loses nothing; null ids count as
larger than all others; rows with one id are one document, which never removes its own words; an empty table gives no
rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import blocks, gram_hashes, hashed

WINDOW = 50
PREFIX = 8
CROWD = 200
GROUP_WORDS = 400_000


def least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start, where the least of ``width`` values stands; of equal ones the first."""
    at, span = np.arange(len(grams)), 1
    while span < width:
        step = min(span, width - span)
        other = at[step:]
        mine = at[: len(other)]
        at = np.where(grams[other] < grams[mine], other, mine)
        span += step
    return at


def anchors(texts: list[list[bytes]], window: int, length: int) -> tuple[np.ndarray, ...]:
    """(text number, prefix, place, first window, last window) of each anchor: the least-hashed run of ``length`` words.

    Places count from the start of the text. Windows with one anchor stand side by side.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    words = hashed([w for t in texts for w in t])
    grams = gram_hashes(words, length)
    at = least_places(grams, window - length + 1)[: max(0, len(words) - window + 1)]
    starts = np.arange(len(at))
    inside = starts + window <= np.repeat(ends, sizes)[: len(starts)]
    starts, at = starts[inside], at[inside]
    owner = np.searchsorted(ends, at, side="right")
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    los = np.flatnonzero(first)
    his = np.append(los[1:], len(at))[: len(los)] - 1
    base = (ends - sizes)[owner[los]]
    return owner[los], grams[at[los]].view(np.int64), at[los] - base, starts[los] - base, starts[his] - base


def _scan(docs: DataFrame, window: int) -> DataFrame:
    """(_id, _key, n_words, sha, keys, ats, los): words and anchors of each row; ``los`` are the first windows of the anchors."""
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                texts = [(data or b"").split() for data in part.column("_text").to_pylist()]
                sizes = np.array([len(t) for t in texts])
                owner, keys, at, los, _ = anchors(texts, window, PREFIX)
                offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                listed = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))
                shas = [hashlib.sha256(b" ".join(t)).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"), part.column("_key"), pa.array(sizes, pa.int64()), pa.array(shas),
                        listed(keys, pa.int64()), listed(at, pa.int32()), listed(los, pa.int32()),
                    ],
                    names=["_id", "_key", "n_words", "sha", "keys", "ats", "los"],
                )

    return docs.mapInArrow(run, f"_id {kind}, _key bigint, n_words bigint, sha string, keys array<bigint>, ats array<int>, los array<int>")


#: What becomes of a window: it repeats nowhere, is decided within a group, or its prefix is lengthened.
ALONE, GROUPED, LENGTHENED = 0, 1, 2


def _parted(rows: DataFrame, window: int, unmarked: int) -> DataFrame:
    """(_id, _key, prefix, lo, hi, words): places of groups and, without a prefix, stretches of windows to lengthen.

    ``rows`` are (_id, _key, start, _text, marks): words from place ``start`` on, and the ``way`` of windows lo to hi;
    windows without a mark go the way ``unmarked``. ``words`` are those of the windows lo to hi. Of equal rows, which meet
    in one task, the first is enough.
    """
    kind = rows.schema["_id"].dataType.simpleString()
    names = ["_id", "_key", "prefix", "lo", "hi", "words"]

    def run(batches):
        seen = set()
        for batch in batches:
            types = [batch.schema.field("_id").type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            schema = pa.schema(list(zip(names, types)))
            rowed = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            for first, last in blocks(batch, "_text"):
                part, out = batch.slice(first, last - first), []
                for id, key, start, data, marks in zip(*[part.column(c).to_pylist() for c in ("_id", "_key", "start", "_text", "marks")], strict=True):
                    if (id, key, start) in seen:
                        continue
                    seen.add((id, key, start))
                    words = data.split()
                    joined = b" ".join(words)
                    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1).tolist()
                    begin = [0, *ends]
                    held = lambda lo, hi: joined[begin[lo - start] : ends[hi - start + window - 1] - 1]
                    ways = np.full(len(words) - window + 3, unmarked, np.int8)
                    ways[[0, -1]] = ALONE  # a frame, so that every stretch has both edges
                    for mark in marks or []:
                        lo, hi = mark["lo"], mark["hi"]
                        ways[lo - start + 1 : hi - start + 2] = mark["way"]
                        if mark["way"] == GROUPED:
                            out.append((id, key, mark["prefix"], lo, hi, held(lo, hi)))
                    edges = np.flatnonzero(np.diff((ways == LENGTHENED).astype(np.int8)))
                    for lo, end in edges.reshape(-1, 2).tolist():
                        out.append((id, key, None, start + lo, start + end - 1, held(start + lo, start + end - 1)))
                    if len(out) > 10_000:
                        yield rowed(out)
                        out = []
                if out:
                    yield rowed(out)

    return rows.mapInArrow(run, f"_id {kind}, _key bigint, prefix bigint, lo int, hi int, words binary")


def _lengthened(stretches: DataFrame, window: int, length: int) -> DataFrame:
    """(_id, _key, start, prefix, lo, hi): the anchors of ``length`` words in stretches that begin at ``start``."""
    kind = stretches.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, last in blocks(batch, "words"):
                part = batch.slice(first, last - first)
                texts = [held.split() for held in part.column("words").to_pylist()]
                owner, keys, _, los, his = anchors(texts, window, length)
                start = np.array(part.column("lo").to_pylist(), np.int64)[owner]
                owner = pa.array(owner)
                columns = [part.column("_id").take(owner), part.column("_key").take(owner)]
                columns += [pa.array(start, pa.int32()), pa.array(keys), pa.array(start + los, pa.int32()), pa.array(start + his, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "_key", "start", "prefix", "lo", "hi"])

    return stretches.select("_id", "_key", "lo", "words").mapInArrow(run, f"_id {kind}, _key bigint, start int, prefix bigint, lo int, hi int")


def _whole_prefixes(stretches: DataFrame, window: int) -> DataFrame:
    """(_id, _key, lo, node) of each window of each stretch: the digest of its words names the node."""
    kind = stretches.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, last in blocks(batch, "words"):
                part = batch.slice(first, last - first)
                for i, (lo, held) in enumerate(zip(part.column("lo").to_pylist(), part.column("words").to_pylist(), strict=True)):
                    words = held.split()
                    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                    count = len(words) - window + 1
                    cuts = zip([0, *ends.tolist()], (ends[window - 1 :] - 1).tolist())
                    nodes = [hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in cuts]
                    same = pa.array(np.full(count, i))
                    columns = [part.column("_id").take(same), part.column("_key").take(same), pa.array(np.arange(lo, lo + count), pa.int32()), pa.array(nodes, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["_id", "_key", "lo", "node"])

    return stretches.select("_id", "_key", "lo", "words").mapInArrow(run, f"_id {kind}, _key bigint, lo int, node binary")


def deep_nodes(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, node) of every run of ``depth`` words; equal runs, and only those, share a node.

    Suffixes are ranked by their first 1, 2, 4 ... words; a rank of twice the words is that of two ranks side by side.
    """
    sizes = np.array([len(t) for t in texts])
    ranks = pd.factorize(np.array([w for t in texts for w in t] + [None], object)[:-1])[0].astype(np.int64)
    owner, place = np.repeat(np.arange(len(texts)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    room = np.repeat(sizes, sizes) - place
    span = 1
    while span < depth:
        step = min(span, depth - span)
        pairs = ranks[:-step] * (int(ranks.max(initial=0)) + 1) + ranks[step:] if len(ranks) > step else np.zeros(0, np.int64)
        ranks = np.concatenate([pd.factorize(pairs)[0].astype(np.int64), np.zeros(len(ranks) - len(pairs), np.int64)])
        span += step
    whole = room >= depth
    return owner[whole], place[whole], ranks[whole]


def _repeats(places: DataFrame, window: int) -> DataFrame:
    """(_id, _key, lo, hi): runs of windows, of short prefixes' places, that a document with a smaller id holds."""
    kind = places.schema["_id"].dataType.simpleString()

    def found(rows: list[dict]):
        texts = [r["words"].split(b" ") for r in rows]
        owner, place, node = deep_nodes(texts, window)
        order = {id: i for i, id in enumerate(sorted({r["_id"] for r in rows if r["_id"] is not None}))}
        ids = np.array([order.get(r["_id"], len(order)) for r in rows])[owner]
        least = np.full(int(node.max(initial=-1)) + 1, len(order) + 1)
        np.minimum.at(least, node, ids)
        later = ids > least[node]
        owner, place = owner[later], place[later]
        if not len(owner):
            return
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(owner)) - 1
        for a, b in zip(first.tolist(), last.tolist()):
            row = rows[owner[a]]
            yield row["_id"], row["_key"], row["lo"] + int(place[a]), row["lo"] + int(place[b])

    def run(batches):
        held, size = [], 0
        schema = None

        def flush():
            out = list(found(held))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([("_id", batch.schema.field("_id").type), ("_key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
            for row in batch.to_pylist():
                if held and size > GROUP_WORDS and row["prefix"] != held[-1]["prefix"]:
                    yield from flush()
                    held, size = [], 0
                held.append(row)
                size += row["words"].count(b" ") + 1
        if held:
            yield from flush()

    laid = places.repartition("prefix").sortWithinPartitions("prefix")
    return laid.mapInArrow(run, f"_id {kind}, _key bigint, lo int, hi int")


def _kept(texts: DataFrame, window: int) -> DataFrame:
    """(_id, _key, n_removed, kept_sha256) of documents: windows in ``runs`` go, and those in ``crowded`` that are not ``owned``."""
    kind = texts.schema["_id"].dataType.simpleString()

    def work(data: bytes, runs: list[dict], crowded: list[dict], owned: list[int]) -> tuple[int, str]:
        words = data.split()
        repeats = np.zeros(len(words), bool)
        for stretch in crowded:
            repeats[stretch["lo"] : stretch["hi"] + 1] = True
        repeats[owned] = False
        for stretch in runs:
            repeats[stretch["lo"] : stretch["hi"] + 1] = True
        edges = np.zeros(len(words) + 1, np.int64)
        starts = np.flatnonzero(repeats)
        edges[starts] += 1
        edges[starts + window] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
        return int(gone.sum()), hashlib.sha256(kept).hexdigest()

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                rows = [work(*row) for row in zip(*[part.column(c).to_pylist() for c in ("_text", "runs", "crowded", "owned")], strict=True)]
                columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_key"), *columns], names=["_id", "_key", "n_removed", "kept_sha256"])

    return texts.mapInArrow(run, f"_id {kind}, _key bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, crowd: int = CROWD) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row of ``docs``."""
    if window < PREFIX:
        raise ValueError(f"a window has at least {PREFIX} words")
    folder = fresh_folder(docs.sparkSession, "substring")
    slim = docs.select(F.col(id).alias("_id"), F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"))
    scanned = written(_scan(slim, window), f"{folder}/scanned")

    # Of documents with the same words, the least id (null is largest) stands for all.
    stands = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")).alias("rep")
    reps = written(scanned.where(F.col("n_words") >= window).groupBy("sha").agg(stands), f"{folder}/reps")
    own = scanned.select("_id", "_key", "n_words", "sha", F.arrays_zip("keys", "ats", "los").alias("anchors"))
    own = own.join(reps.select(F.col("sha").alias("_s"), "rep").hint("shuffle_hash"), (F.col("sha") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("rep._id")) & (F.col("_key") == F.col("rep._key")))
    # An anchor's windows end where the next one's begin.
    last = F.transform(F.col("anchors"), lambda a, i: F.struct(
        a["keys"].alias("prefix"), a["los"].alias("lo"),
        F.coalesce(F.try_element_at("anchors", i + 2)["los"], F.col("n_words").cast("int") - window + 1) - 1,
    ).cast("struct<prefix:bigint,lo:int,hi:int>"))
    placed = written(own.select("_id", "_key", F.explode(last).alias("a")).select("_id", "_key", "a.prefix", "a.lo", "a.hi"), f"{folder}/anchors")
    counts = placed.groupBy("prefix").agg(F.count("*").alias("n"), F.min("_id").alias("least"), F.max("_id").alias("most"), F.count("_id").alias("named"))
    several = (F.col("least") != F.col("most")) | ((F.col("named") > 0) & (F.col("named") < F.col("n")))
    way = F.when(F.col("n") > crowd, LENGTHENED).otherwise(GROUPED).alias("way")
    shared = written(counts.where(several).select("prefix", way), f"{folder}/shared")
    # Anchors of one document come together: no more than its words.
    marks = F.collect_set(F.struct("prefix", "lo", "hi", "way")).alias("marks")
    wanted = written(placed.join(shared, "prefix").groupBy("_id", "_key").agg(marks), f"{folder}/wanted")

    def with_texts(side: DataFrame, *columns: str) -> DataFrame:
        """The small side is the one that is hashed; texts stream past it unsorted."""
        small = side.select(F.col("_id").alias("_i"), F.col("_key").alias("_k"), *columns).hint("shuffle_hash")
        return slim.join(small, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k"))).select("_id", "_key", "_text", *columns)

    first = _parted(with_texts(wanted, "marks").withColumn("start", F.lit(0)), window, ALONE)
    levels, length = [written(first, f"{folder}/places-{PREFIX}")], PREFIX * 2
    while length < window:
        stretches = levels[-1].where("prefix is null")
        longer = written(_lengthened(stretches, window, length), f"{folder}/anchors-{length}")
        held = longer.groupBy("prefix").agg(F.count("*").alias("n"), F.min("_id").alias("least"), F.max("_id").alias("most"), F.count("_id").alias("named"))
        # Crowded prefixes take no part in the join: windows without a mark are lengthened again.
        settled = held.where(~several | (F.col("n") <= crowd)).select("prefix", F.when(several, GROUPED).otherwise(ALONE).alias("way"))
        found = longer.join(settled, "prefix").groupBy("_id", "_key", "start").agg(marks)
        found = found.select(F.col("_id").alias("_i"), F.col("_key").alias("_k"), F.col("start").alias("_s"), "marks").hint("shuffle_hash")
        same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")) & (F.col("lo") == F.col("_s"))
        rows = stretches.join(found, same, "left").select("_id", "_key", F.col("lo").alias("start"), F.col("words").alias("_text"), "marks")
        levels.append(written(_parted(rows, window, LENGTHENED), f"{folder}/places-{length}"))
        length *= 2
    places = reduce(DataFrame.union, [level.where("prefix is not null") for level in levels])
    short = _repeats(places.select("_id", "_key", "prefix", "lo", "words"), window)
    crowded = levels[-1].where("prefix is null")
    nodes = written(_whole_prefixes(crowded, window), f"{folder}/nodes")
    owners = nodes.groupBy("node").agg(F.min("_id").alias("_owner"))  # null only if all are null
    owners = owners.withColumnRenamed("node", "_node")
    owned = nodes.join(owners, (F.col("node") == F.col("_node")) & F.col("_id").eqNullSafe(F.col("_owner")), "left_semi")
    span = "struct<lo:int,hi:int>"
    found = (
        short.select("_id", "_key", F.struct("lo", "hi").alias("runs"), F.lit(None).cast(span).alias("crowded"), F.lit(None).cast("int").alias("owned"))
        .union(crowded.select("_id", "_key", F.lit(None).cast(span), F.struct("lo", "hi"), F.lit(None).cast("int")))
        .union(owned.select("_id", "_key", F.lit(None).cast(span), F.lit(None).cast(span), "lo"))
    )
    # No longer than the document has words.
    lists = [F.collect_list(c).alias(c) for c in ("runs", "crowded", "owned")]
    runs = written(found.groupBy("_id", "_key").agg(*lists), f"{folder}/runs")
    cut = written(_kept(with_texts(runs, "runs", "crowded", "owned"), window).distinct(), f"{folder}/cut")

    results = written(
        reps.select("sha", F.col("rep._id").alias("_i"), F.col("rep._key").alias("_k"))
        .join(cut.withColumnsRenamed({"_id": "_ci", "_key": "_ck"}), F.col("_i").eqNullSafe(F.col("_ci")) & (F.col("_k") == F.col("_ck")), "left")
        .select("sha", F.col("_i").alias("first"), "n_removed", "kept_sha256", F.lit(True).alias("searched")),
        f"{folder}/results",
    )
    copy = F.col("searched") & F.col("first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("first"))
    return scanned.select("_id", "n_words", "sha").join(results, "sha", "left").select(
        F.col("_id").alias(id),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
