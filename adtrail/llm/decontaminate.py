"""Benchmark decontamination: n-gram seeds join passages to test items; Smith-Waterman alignment decides.

1. The corpus says how often each n-gram of the test items occurs (one pass; a bitmap of fixed size in front lets
   hardly any other n-gram through, and partial counts are added up before and after the shuffle).
2. Every n-gram of an item that occurs in the corpus is a seed, however rare or common: which n-grams of a copy are
   left whole by its edits cannot be told from counts.
3. A second pass cuts out the passages around seeds, on either side as wide as the longest alignment that can count;
   seeds near each other share a passage. A join by seed brings passages and items together.
4. Each pair is aligned word by word (match 2, mismatch and gap -1). An item counts as leaked if the best local
   alignment reaches ``least`` of its full score and ``least_words`` matching words' worth. Pieces of a passage whose
   words alone, in whatever order, cannot reach that are not aligned.

An alignment is found if at least one run of n of its words is unedited; copies with an edit in every n words have no seed.

Words are lower-cased and parted at white space and ASCII punctuation.

Defined cases: null and empty texts and items have no words and match nothing; items with fewer words than ``least_words``
or than an n-gram are never found; repeated rows each count, and pairs (id, item) come out once, with the best score; of
passages with equal scores the first is reported; null ids and items are values like others; empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import blocks, gram_hashes, hashed, run_starts

NGRAM = 3
BITMAP_BITS = 24  # 2 MB, whatever the size of the benchmark: a fuller bitmap lets more through, and the join decides

_FOLD = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def item_words(data: bytes | None) -> list[bytes]:
    return (data or b"").decode("utf-8", "replace").lower().encode().translate(_FOLD).split()


class Bitmap:
    """A set of 64-bit hashes, in part: what it does not hold is certainly not in the set."""

    def __init__(self, packed: bytes):
        self.flags = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)

    def where(self, grams: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.flags[(grams >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])


def bitmap_of(grams: DataFrame, column: str) -> bytes:
    """The bitmap of a column of hashes; its bytes are set in parts of the table and the parts are joined by OR."""

    def part(batches):
        flags = np.zeros(1 << BITMAP_BITS, bool)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            flags[(values >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] = True
        packed = np.packbits(flags)
        at = np.flatnonzero(packed)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "bits": pa.array(packed[at], pa.int32())})

    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    rows = grams.select(column).mapInArrow(part, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    for row in rows.toLocalIterator():  # two million small rows at most
        out[row["at"]] = row["bits"]
    return out.tobytes()


def _items(benchmark: DataFrame, item: str, text: str, n: int) -> DataFrame:
    """(item, words, grams): hashed words of each item and the hashes of its n-grams in order."""
    slim = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").cast("binary").alias("_text"))
    kind = slim.schema["item"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words = [hashed(item_words(t)) for t in batch.column("_text").to_pylist()]
            columns = [pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())), pa.array([gram_hashes(w, n).view(np.int64) for w in words], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("item"), *columns], names=["item", "words", "grams"])

    return slim.mapInArrow(run, f"item {kind}, words array<bigint>, grams array<bigint>")


def _block_words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of a block's texts laid end to end, and where each text ends."""
    texts = [item_words(data) for data in part.column("_text").to_pylist()]
    return hashed([w for t in texts for w in t]), np.cumsum([len(t) for t in texts])


def gram_counts(slim: DataFrame, bitmap, n: int) -> DataFrame:
    """(gram, n): occurrences in the corpus of the n-grams that the bitmap lets through."""

    def run(batches):
        grams_in = Bitmap(bitmap.value)
        held: dict[int, int] = {}
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                words, ends = _block_words(batch.slice(start, end - start))
                grams = gram_hashes(words, n)
                inside = run_starts(np.diff(ends, prepend=0), n)[: len(grams)]
                found, counts = np.unique(grams[inside][grams_in.where(grams[inside])], return_counts=True)
                for gram, count in zip(found.view(np.int64).tolist(), counts.tolist()):
                    held[gram] = held.get(gram, 0) + count
                if len(held) > 200_000:
                    yield pa.RecordBatch.from_pydict({"gram": pa.array(held, pa.int64()), "n": pa.array(held.values(), pa.int64())})
                    held = {}
        yield pa.RecordBatch.from_pydict({"gram": pa.array(held, pa.int64()), "n": pa.array(held.values(), pa.int64())})

    return slim.select("_text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def pick_seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, item): the n-grams of each item that occur in the corpus."""
    return items.select("item", F.explode(F.array_distinct("grams")).alias("gram")).join(counts, "gram", "left_semi").select("gram", "item")


def passages(slim: DataFrame, bitmap, known, n: int, reach: int) -> DataFrame:
    """(_id, start, words, grams): stretches of text around what the bitmap lets through, ``reach`` words on either side.

    ``known``: the bitmap of the items' words. Any other word matches nothing and is written as 0, which packs well.
    """
    kind = slim.schema["_id"].dataType.simpleString()

    def run(batches):
        grams_in, words_in = Bitmap(bitmap.value), Bitmap(known.value)
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                words, ends = _block_words(part)
                grams = gram_hashes(words, n)
                inside = run_starts(np.diff(ends, prepend=0), n)[: len(grams)]
                at = grams_in.where(grams)
                at = at[inside[at]]
                if not len(at):
                    continue
                owner = np.searchsorted(ends, at, side="right")
                fresh = np.ones(len(at), bool)
                fresh[1:] = (owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > 2 * reach)
                first = np.flatnonzero(fresh)
                last = np.append(first[1:], len(at)) - 1
                begins = np.concatenate([[0], ends[:-1]])[owner[first]]
                lo = np.maximum(at[first] - reach, begins)
                hi = np.minimum(at[last] + n + reach, ends[owner[first]])
                signed, signed_grams = np.zeros(len(words), np.int64), grams.view(np.int64)
                shared = words_in.where(words)
                signed[shared] = words.view(np.int64)[shared]
                columns = [
                    pa.array(lo - begins, pa.int64()),
                    pa.array([signed[a:b] for a, b in zip(lo, hi)], pa.list_(pa.int64())),
                    pa.array([np.unique(signed_grams[at[a : b + 1]]) for a, b in zip(first, last)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([part.column("_id").take(pa.array(owner[first])), *columns], names=["_id", "start", "words", "grams"])

    return slim.mapInArrow(run, f"_id {kind}, start bigint, words array<bigint>, grams array<bigint>")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local score, where it ends in ``text``, exclusive), with match 2, mismatch -1, gap -1; one row per item word."""
    steps = np.arange(len(text) + 1)
    above, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    row = np.zeros(len(text) + 1, np.int64)
    for word in item:
        row[1:] = np.maximum(above[:-1] + np.where(text == word, 2, -1), above[1:] - 1)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + steps) - steps  # gaps in the text, from any place to the left
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above, row = row, np.zeros_like(row)
    return best, end


def longest(words: int, least: float) -> int:
    """Words of text that an alignment of ``least`` of an item's full score spans at most: 3 a match, less the score."""
    return math.ceil(words * (3 - 2 * least))


def best_alignment(item: np.ndarray, text: np.ndarray, least: float = 0.0, least_words: int = 0) -> tuple[int, int]:
    """align() over a text of any length, in overlapping pieces that hold any alignment whole; (0, 0) if none reaches the bounds.

    No alignment scores more than a stretch of the piece in which each word that the item holds counts 2 and any other -1:
    pieces without such a stretch are passed over.
    """
    span = longest(len(item), least)
    need = max(2 * len(item) * least, 2 * least_words, 1)
    sums = np.concatenate([[0], np.cumsum(np.where(np.isin(text, item), 2, -1))])
    best = (0, 0)
    for at in range(0, max(1, len(text) - span), span):
        piece = sums[at : at + 2 * span + 1]
        if (piece - np.minimum.accumulate(piece)).max() < need:
            continue
        score, end = align(item, text[at : at + 2 * span])
        if score >= need and score > best[0]:
            best = score, at + end
    return best


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", n: int = NGRAM, least: float = 0.5, least_words: int = 6) -> DataFrame:
    """(id, item, score, position) of leaked items: ``score`` is the share of the item's full alignment score, ``position``
    the word of the text after which the best alignment ends."""
    spark, folder = docs.sparkSession, fresh_folder(docs.sparkSession, "leaks")
    slim = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"))
    items = written(_items(benchmark, item, item_text, n).where(F.size("words") >= least_words), f"{folder}/items")
    reach = longest(items.agg(F.max(F.size("words"))).first()[0] or 0, least)
    every = spark.sparkContext.broadcast(bitmap_of(items.select(F.explode("grams").alias("gram")), "gram"))
    counts = gram_counts(slim, every, n)
    seeds = written(pick_seeds(items, counts), f"{folder}/seeds")
    wanted = spark.sparkContext.broadcast(bitmap_of(seeds, "gram"))
    known = spark.sparkContext.broadcast(bitmap_of(items.select(F.explode("words").alias("word")), "word"))
    cut = written(passages(slim, wanted, known, n, reach).withColumn("passage", F.monotonically_increasing_id()), f"{folder}/passages")

    pairs = cut.select("passage", F.explode("grams").alias("gram")).join(seeds, "gram").select("passage", "item").distinct()
    pairs = written(pairs, f"{folder}/pairs")
    met = pairs.join(cut.select("passage", "_id", "start", F.col("words").alias("_there")), "passage")
    met = met.join(items.select(F.col("item").alias("_item"), F.col("words").alias("_words")), F.col("item").eqNullSafe(F.col("_item")))
    met = met.select("_id", "item", "start", "_there", "_words")
    kinds = {f.name: f.dataType.simpleString() for f in met.schema}

    def score(batches):
        for batch in batches:
            there, words = batch.column("_there"), batch.column("_words")
            found = [best_alignment(words[i].values.to_numpy(), there[i].values.to_numpy(), least, least_words) for i in range(batch.num_rows)]
            share = [s / (2 * len(words[i])) for i, (s, _) in enumerate(found)]
            ends = [a + e for a, (_, e) in zip(batch.column("start").to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("item"), pa.array(share, pa.float64()), pa.array(ends, pa.int64()), pa.array([s for s, _ in found], pa.int64())], names=["_id", "item", "score", "position", "raw"])

    scored = met.mapInArrow(score, f"_id {kinds['_id']}, item {kinds['item']}, score double, position bigint, raw bigint")
    best = scored.where((F.col("score") >= least) & (F.col("raw") >= 2 * least_words)).groupBy("_id", "item").agg(F.min(F.struct((-F.col("score")).alias("s"), "position")).alias("b"))
    return best.select(F.col("_id").alias(id), F.col("item").alias(item), (-F.col("b.s")).alias("score"), F.col("b.position").alias("position"))
