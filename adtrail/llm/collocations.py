"""Phrase collocation mining by dynamic itemset counting.

The corpus is coded once into words and dealt over SHARDS shards by task. Step t scans shard t mod SHARDS. Words are counted
from step 0 on; a longer phrase becomes active once the phrases without its last and without its first word have both
been seen ``least`` times, in whatever shards were scanned so far, and stays so for one full cycle. So lengths are counted
side by side, and the corpus is read as often as late phrases need, not once for each length.

A phrase that occurs ``least`` times must occur least / shards times in one of the shards. So an active phrase is taken
into the state only by a shard that holds it that often, and is then counted for a full cycle from there on; shards that
were scanned before it was taken in come again in that cycle. All other active phrases are forgotten after each scan.

What is reached by which step is known to the scanning tasks through byte tables of a fixed size, by hash slot: the least
and the greatest step of the phrases of a slot, and until when phrases of a slot are counted. They can only let too many
phrases pass, never too few; what is in the state is counted truly, each shard once, and a phrase that ought not to be
active can't reach ``least``, as its parts have not.

A word is its 64-bit code, made of the word and its language, so languages never mix; the code table is checked for two
words of one code among those that count, and coded anew with another seed if there are any.

State (phrases that have not completed their cycle, and frequent ones that have) is merged with a scan's counts by phrase
in one shuffle, written, and read back; counts are pre-aggregated in each task. Memory of a task does not depend on how
frequent a phrase is.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count again; an empty table gives no rows.
Only the text and language columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm.store import fresh_folder, removed, written
from adtrail.llm.words import blocks, hashed, mixed

LEAST = 100
LONGEST = 5
SHARDS = 4
SLOT_BITS = 21
NEVER = 255
#: Texts that a task takes from Spark at once.
BATCH_ROWS = 1000
#: Coded texts in a file: a file is read by one task, which holds the distinct phrases of all its texts.
FILE_ROWS = 1000

#: Separators become full stops, tabs spaces, and A-Z lower case.
TABLE = bytes(0x2E if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    """The words of a text, with a full stop between pieces and at the end."""
    return (data.translate(TABLE) + b".").replace(b".", b" . ").split()


def _coded_block(part: pa.RecordBatch, seed: int):
    """A block's words in a row with their numbers, codes, whether they are full stops and their languages; the languages' names; words a text."""
    texts = [words_of(data or b"") for data in part.column("_text").to_pylist()]
    langs = part.column("_lang").to_pylist()
    known = sorted(set(langs))
    sizes = [len(t) for t in texts]
    flat = np.empty(sum(sizes), object)
    flat[:] = [w for t in texts for w in t]
    number, words = pd.factorize(flat)
    stop = np.fromiter((w == b"." for w in words), bool, len(words))[number]
    lang = np.repeat([known.index(x) for x in langs], sizes)
    salt = hashed([f"{seed}:{x}".encode() for x in known])
    codes = np.maximum(mixed(hashed(list(words))[number] ^ salt[lang]), np.uint64(1))
    codes[stop] = 0
    return flat, number, codes, stop, lang, known, sizes


def _coded(docs: DataFrame, seed: int, shards: int) -> DataFrame:
    """Texts as rows (shard, lang, n_words, body): a body is the codes of a text's words."""

    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                flat, number, codes, stop, lang, known, sizes = _coded_block(part, seed)
                data, ends = codes.astype("<u8").tobytes(), np.cumsum(sizes)
                bodies = [data[8 * (e - n) : 8 * e] for e, n in zip(ends.tolist(), sizes)]
                counts = np.add.reduceat(~stop, ends - sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), shard), pa.int32()), part.column("_lang"), pa.array(counts, pa.int64()), pa.array(bodies, pa.binary())],
                    names=["shard", "lang", "n_words", "body"],
                )

    return docs.mapInArrow(run, "shard int, lang string, n_words bigint, body binary")


def _named(docs: DataFrame, seed: int, wanted: np.ndarray) -> DataFrame:
    """(gram, lang, word) of the distinct words whose codes fall into the wanted slots."""
    bits = len(wanted).bit_length() - 1

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                flat, number, codes, stop, lang, known, sizes = _coded_block(batch.slice(start, end - start), seed)
                at = np.flatnonzero(~stop & wanted[slots(codes, bits)])
                at = at[_first(pd.factorize(number[at] * len(known) + lang[at])[0])]
                yield pa.RecordBatch.from_arrays(
                    [_binary(codes[at].reshape(-1, 1)), pa.array([known[i] for i in lang[at].tolist()], pa.string()), pa.array(flat[at].tolist(), pa.binary())],
                    names=["gram", "lang", "word"],
                )

    return docs.mapInArrow(run, "gram binary, lang string, word binary").distinct()


def _first(numbers: np.ndarray) -> np.ndarray:
    """Where each of the numbers 0, 1 ... stands first."""
    out = np.zeros(int(numbers.max(initial=-1)) + 1, np.int64)
    out[numbers[::-1]] = np.arange(len(numbers))[::-1]
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of 64-bit codes as bytes."""
    width = 8 * rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows, "<u8").tobytes())])


def lengthened(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + codes)


def slots(hashes: np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).view(np.int64)


def active(codes: np.ndarray, step: int, shards: int, longest: int, early: np.ndarray, late: np.ndarray, counted: np.ndarray):
    """(length, places, hashes, whether active) of the phrases active at ``step`` or still counted; code 0 parts pieces."""
    bits = len(early).bit_length() - 1
    at = np.flatnonzero(codes)
    hashes = codes[at]
    if step < shards:
        yield 1, at, hashes, np.ones(len(at), bool)
    slot = slots(hashes, bits)
    for length in range(2, longest + 1):
        reached = np.flatnonzero(early[slot] < step)
        at, hashes, since = at[reached], hashes[reached], late[slot[reached]]
        both = np.flatnonzero(at[1:] == at[:-1] + 1)  # a phrase's two parts stand at neighbouring places
        if not len(both):
            return
        since = np.maximum(since[both], since[both + 1])
        at = at[both]
        hashes = lengthened(hashes[both], codes[at + length - 1])
        slot = slots(hashes, bits)
        fits = since.astype(np.int32) + shards >= step
        taken = fits | (counted[slot] >= step)
        if taken.any():
            yield length, at[taken], hashes[taken], fits[taken]


def folded(codes: np.ndarray, length: int, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the phrases at ``at`` are the first of their words, and how often each of them stands there."""
    number = pd.factorize(hashes)[0]
    first = _first(number)
    if length > 1:  # a word's hash is its code
        again = np.ones(len(at), bool)
        again[first] = False
        again = np.flatnonzero(again)
        here, there = at[again], at[first[number[again]]]
        if any((codes[here + i] != codes[there + i]).any() for i in range(length)):  # two phrases of one hash: by their words
            _, first, number = np.unique(codes[at[:, None] + np.arange(length)], axis=0, return_index=True, return_inverse=True)
    return first, np.bincount(number.ravel(), minlength=len(first))


def _scanned(bodies: DataFrame, step: int, shards: int, longest: int, early: np.ndarray, late: np.ndarray, counted: np.ndarray) -> DataFrame:
    """(gram, n, fits): phrases counted in one scan, folded over blocks of texts, and whether they are active."""

    def run(batches):
        for batch in batches:
            for start, end in blocks(batch, "body"):
                codes = np.frombuffer(b"".join(batch.column("body").slice(start, end - start).to_pylist()), "<u8")
                for length, at, hashes, fits in active(codes, step, shards, longest, early, late, counted):
                    first, counts = folded(codes, length, at, hashes)
                    rows = codes[at[first][:, None] + np.arange(length)]
                    yield pa.RecordBatch.from_arrays([_binary(rows), pa.array(counts.astype(np.int64)), pa.array(fits[first])], names=["gram", "n", "fits"])

    return bodies.mapInArrow(run, "gram binary, n bigint, fits boolean")


def _slots_of(grams: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of phrases (gram, fresh, until) the distinct slots, whether a fresh one is there, and the greatest ``until``; no more than 2 ** bits."""

    def run(batches):
        for batch in batches:
            gram = batch.column("gram")
            words = pa.compute.binary_length(gram).to_numpy(zero_copy_only=False) // 8
            slot = np.zeros(len(words), np.int32)
            for k in np.unique(words).tolist():
                codes = np.frombuffer(b"".join(gram.filter(pa.array(words == k)).to_pylist()), "<u8").reshape(-1, k)
                h = codes[:, 0]
                for i in range(1, k):
                    h = lengthened(h, codes[:, i])
                slot[words == k] = slots(h, bits)
            yield pa.RecordBatch.from_arrays([pa.array(slot), batch.column("fresh"), batch.column("until")], names=["slot", "fresh", "until"])

    by_slot = grams.select("gram", "fresh", "until").mapInArrow(run, "slot int, fresh boolean, until int").groupBy("slot").agg(F.max("fresh").alias("fresh"), F.max("until").alias("until"))
    found = by_slot.toArrow()
    return tuple(found.column(c).to_numpy() for c in ("slot", "fresh", "until"))


def _settled(df: DataFrame, path: str, file_rows: int = 0) -> DataFrame:
    """``written`` in small batches and closely packed; the shuffle files behind it go at once instead of at some later collection of the driver's garbage."""
    conf = df.sparkSession.conf
    meant = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.parquet.compression.codec": "zstd", "spark.sql.files.maxRecordsPerFile": str(file_rows),
    }
    before = {key: conf.get(key) for key in meant}
    try:
        for key, value in meant.items():
            conf.set(key, value)
        return written(df, path)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def frequent_phrases(coded: DataFrame, folder: str, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = SLOT_BITS) -> DataFrame:
    """(gram, f) of every phrase of one to ``longest`` words that occurs ``least`` times."""
    spark = coded.sparkSession
    early, late, counted = np.full(1 << bits, NEVER, np.uint8), np.zeros(1 << bits, np.uint8), np.zeros(1 << bits, np.uint8)
    state = spark.createDataFrame([], "gram binary, total bigint, until int")
    single, share = F.octet_length("gram") == 8, -(-least // shards)
    step, last = 0, shards - 1
    while step <= last:
        if step + shards >= NEVER:
            raise ValueError("too many steps for the byte tables: choose fewer shards")
        bodies = coded.where(F.col("shard") == step % shards).select("body")
        scan = _scanned(bodies, step, shards, longest, early, late, counted)
        merged = scan.unionByName(state.select("gram", "total", "until"), allowMissingColumns=True).groupBy("gram").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("fits").alias("fits"), F.max("total").alias("before"), F.max("until").alias("until")
        )
        held = F.col("until").isNotNull()
        # Words are all taken in, so their cycle is the first one, whichever shard has them first.
        merged = merged.where(held | single | (F.col("fits") & (F.col("n") >= share)))
        ends = F.when(held, F.col("until")).when(single, F.lit(shards - 1)).otherwise(F.lit(step + shards - 1))
        before = F.coalesce("before", F.lit(0))
        total = before + F.when(ends >= step, F.col("n")).otherwise(0)
        counts = merged.select("gram", total.alias("total"), ends.cast("int").alias("until"), ((total >= least) & (before < least)).alias("fresh"))
        # A phrase whose cycle is complete stays only if it is frequent.
        now = _settled(counts.where((F.col("until") > step) | (F.col("total") >= least)), f"{folder}/state-{step}")
        if step:
            removed(spark, f"{folder}/state-{step - 1}")
        fresh = F.col("fresh") & (F.octet_length("gram") < 8 * longest)
        slot, fresh, until = _slots_of(now.withColumn("fresh", fresh).where(F.col("fresh") | (~single & (F.col("until") > step))), bits)
        counted[slot] = np.maximum(counted[slot], until)
        found = slot[fresh]
        if len(found):
            late[found] = step
            early[found] = np.minimum(early[found], step)
            last = max(last, step + shards)
        last = max(last, int(until.max(initial=0)))
        state = now
        step += 1
    return _settled(state.where(F.col("total") >= least).select("gram", F.col("total").alias("f")), f"{folder}/frequent")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(gram, lang, a, l, r, n, score) of each phrase of two words or more at its lowest-scoring cut.

    ``frequent`` has (gram, f, lang); the arithmetic is that of decimals with 38 digits.
    """
    cuts = frequent.where(F.octet_length("gram") > 8).withColumn("cut", F.explode(F.sequence(F.lit(1), F.expr("cast(octet_length(gram) / 8 - 1 as int)"))))
    cuts = cuts.select("gram", "lang", F.col("f").alias("a"), "cut", F.expr("substring(gram, 1, 8 * cut)").alias("_head"), F.expr("substring(gram, 8 * cut + 1)").alias("_tail"))
    part = lambda key, name: frequent.select(F.col("gram").alias(key), F.col("f").alias(name))
    joined = cuts.join(part("_head", "l"), "_head").join(part("_tail", "r"), "_tail").join(totals, "lang")
    wide = lambda c: f"cast({c} as decimal(20, 0))"
    score = F.expr(f"(cast(1000 as decimal(4, 0)) * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    least = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("s")
    return joined.groupBy("gram", "lang", "a", "n").agg(least).select("gram", "lang", "a", "s.l", "s.r", "n", "s.score")


def not_contained(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates without those whose words lie inside a longer one that occurs ``percent`` per cent as often, or more."""
    spans = "flatten(transform(sequence(2, k - 1), w -> transform(sequence(0, k - w), i -> substring(gram, 8 * i + 1, 8 * w))))"
    longer = candidates.withColumn("k", F.expr("cast(octet_length(gram) / 8 as int)")).where("k > 2").select(F.explode(F.expr(spans)).alias("gram"), F.col("a").alias("_longer"))
    most = longer.groupBy("gram").agg(F.max("_longer").alias("_longer"))
    wide = lambda c, by: F.col(c).cast("decimal(20, 0)") * F.lit(by)
    return candidates.join(most, "gram", "left").where(F.col("_longer").isNull() | (wide("_longer", 100) < wide("a", percent))).drop("_longer")


def _spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with the words of their codes."""
    each = phrases.select("gram", F.posexplode(F.expr("transform(sequence(0, cast(octet_length(gram) / 8 - 1 as int)), i -> substring(gram, 8 * i + 1, 8))")).alias("place", "code"))
    spelled = each.join(words.select(F.col("gram").alias("code"), "word"), "code").groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
    return phrases.join(spelled.select("gram", F.array_join(F.transform("w", lambda x: x["word"].cast("string")), " ").alias("phrase")), "gram")


def mine_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int | None = 2000,
    percent: int = 100, shards: int = SHARDS, bits: int = SLOT_BITS, seed: int = 0,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``top`` phrases (all of them, if None) by score."""
    spark = docs.sparkSession
    folder = fresh_folder(spark, "collocations")
    slim = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"), F.col(text).cast("string").cast("binary").alias("_text"))
    coded = _settled(_coded(slim, seed, shards), f"{folder}/coded", FILE_ROWS)
    frequent = frequent_phrases(coded, folder, least, longest, shards, bits)
    single = frequent.where(F.octet_length("gram") == 8)
    # Words are spelled by reading the texts again: a table of all words of all blocks would be far larger than that of the frequent ones.
    wanted = np.zeros(1 << bits, bool)
    wanted[_slots_of(single.select("gram", F.lit(True).alias("fresh"), F.lit(0).alias("until")), bits)[0]] = True
    # Grouped first, joined then: Spark would put a semi join before the grouping, where each task brings its own row of a word.
    named = _named(slim, seed, wanted).groupBy("gram").agg(F.min(F.struct("lang", "word")).alias("w"), F.count("*").alias("n"))
    spelled = _settled(named.join(single.select("gram"), "gram"), f"{folder}/words")
    if not spelled.where("n > 1").isEmpty():
        return mine_phrases(docs, text, lang, least, longest, top, percent, shards, bits, seed + 1)
    words = spelled.select("gram", "w.lang", "w.word")
    totals = coded.groupBy("lang").agg(F.sum("n_words").alias("n"))
    tongue = words.select(F.col("gram").alias("_first"), "lang")
    known = frequent.withColumn("_first", F.expr("substring(gram, 1, 8)")).join(tongue, "_first").drop("_first")
    best = _settled(not_contained(scored(known, totals), percent), f"{folder}/best")
    if top is not None:  # ties at the end are told apart by their words, so all that tie stay until they are spelled
        order = [F.col("score").desc(), F.col("a").desc()]
        salt = F.pmod(F.xxhash64("gram"), F.lit(64))
        best = best.withColumn("_r", F.rank().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("_r") <= top)
        best = best.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_r") <= top).drop("_r")
    ranked = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = _spelled(best, words).withColumn("rank", F.row_number().over(ranked).cast("long"))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
