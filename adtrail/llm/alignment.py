"""Cross-tokenizer alignment: which tokens of one tokenizer stand for which of another, text by text and corpus-wide.

Each text is encoded by both tokenizers. The byte offsets at which tokens end are the keys of two dictionaries, end to
token number; the offsets that both dictionaries hold, sorted, cut both id lists into groups, and every token of a group
is linked to every token of the other side in it. A group's links are kept as (id, id, how often), so a long group costs
its distinct pairs.

Where neither tokenizer has a token that reaches over the space before a word, texts are cut there first, and the
alignment of each word is remembered; other texts are aligned as a whole.

Corpus-wide counts (how many documents hold an id pair) go back to documents without a row per document and pair: a block
of texts names its distinct pairs once, these are counted and looked up, and each block gets the counts of its own pairs,
no more than it has tokens. No dictionary of the whole corpus is sent to a task.

Defined cases: a null or empty text, and a text whose tokens do not give back a space and its bytes on both sides, has no
tokens; bytes that are not UTF-8 are read with U+FFFD, so such texts are among the latter. Repeated rows and null ids are
documents of their own. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import blocks

SPACE_MARK = "▁"
#: Text bytes of a block, and links up to which a group is linked token by token.
BLOCK = 1 << 20
WIDE = 256


# --- the two tokenizers --------------------------------------------------------------

class ByteLevelSide:
    """A byte-level BPE file; special tokens inside texts are plain text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        signs = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in set(signs)]
        byte_of = {chr(b): b for b in signs} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        parted = spec.get("pre_tokenizer") or {}
        self.by_words = spec.get("normalizer") is None and parted.get("type") == "ByteLevel" and parted.get("use_regex", True) and not parted.get("add_prefix_space")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of a space and each text."""
        return [self.tokenizer.encode(" " + t, add_special_tokens=False).ids for t in texts]


class PieceSide:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [self._bytes(p, i) for i, p in enumerate(pieces)]
        self.by_words = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces)

    def _bytes(self, piece: str, number: int) -> bytes:
        if self.model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def cuts(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offset, tokens of a, tokens of b up to there) wherever tokens of both sides end; sizes are the tokens' bytes."""
    a_ends = dict(zip(np.cumsum(a_sizes).tolist(), range(1, len(a_sizes) + 1)))
    b_ends = dict(zip(np.cumsum(b_sizes).tolist(), range(1, len(b_sizes) + 1)))
    both = sorted(a_ends.keys() & b_ends.keys())
    at = lambda ends: np.fromiter(map(ends.__getitem__, both), np.int64, len(both))
    return np.array(both, np.int64), at(a_ends), at(b_ends)


def crossed(a_ids, b_ids, a_from, b_from, a_size, b_size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of the links inside groups: small groups link by link, large ones by their distinct ids."""
    links = a_size * b_size
    small = np.flatnonzero(links <= WIDE)
    sizes = links[small]
    group = np.repeat(small, sizes)
    nth = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pair = a_ids[a_from[group] + nth // b_size[group]] << 32 | b_ids[b_from[group] + nth % b_size[group]]
    parts = [(group, pair, np.ones(len(group), np.int64))]
    for g in np.flatnonzero(links > WIDE).tolist():
        a, n = np.unique(a_ids[a_from[g] : a_from[g] + a_size[g]], return_counts=True)
        b, m = np.unique(b_ids[b_from[g] : b_from[g] + b_size[g]], return_counts=True)
        parts.append((np.full(len(a) * len(b), g), (a[:, None] << 32 | b).ravel(), np.outer(n, m).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts))


class Aligner:
    """Alignments of texts, or of the words of texts, by number: listed groups, sizes and links."""

    #: Words remembered; when the memo is full it starts anew, which costs time and changes no result.
    MEMO = 200_000
    #: Characters of remembered words and listed groups, likewise.
    MEMO_CHARACTERS = 50_000_000

    def __init__(self, a: ByteLevelSide, b: PieceSide):
        self.a, self.b = a, b
        self.by_words = a.by_words and b.by_words
        self.a_sizes, self.b_sizes = (np.array(list(map(len, side.bytes_of)), np.int64) for side in (a, b))
        self.a_count, self.b_count = len(a.bytes_of), len(b.bytes_of)
        self.names = [f"{i}{sign}" for count, signs in ((self.a_count, ",|"), (self.b_count, ",;")) for sign in signs for i in range(count)]
        #: Texts with a space after white space or at the end are not cut.
        self.whole = re.compile(r"\s | \Z").search
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.listed: list[str] = []
        self.characters = 0
        self.sizes = array("q")  # by alignment: tokens of a, of b, groups, links, distinct pairs
        self.pairs, self.times = array("q"), array("q")
        self.broken: set[int] = set()  # alignments of texts that have no tokens

    def _learn(self, texts: list[str]) -> None:
        """Add the alignments of ``texts`` to those that are known, all at once: they stand end to end."""
        a_lists, b_lists = self.a.encode(texts), self.b.encode(texts)
        data = [b" " + t.encode() for t in texts]
        whole = [
            b"".join([self.a.bytes_of[i] for i in a]) == d and b"".join([self.b.bytes_of[i] for i in b]) == d
            for a, b, d in zip(a_lists, b_lists, data)
        ]
        base = len(self.listed)
        self.places.update(zip(texts, range(base, base + len(texts))))
        self.broken.update(base + i for i, fine in enumerate(whole) if not fine)
        kept = [i for i, fine in enumerate(whole) if fine]
        listed, sizes = [""] * len(texts), np.zeros((len(texts), 5), np.int64)
        if kept:
            a_ids = np.array([x for i in kept for x in a_lists[i]], np.int64)
            b_ids = np.array([x for i in kept for x in b_lists[i]], np.int64)
            offset, a_to, b_to = cuts(self.a_sizes[a_ids], self.b_sizes[b_ids])
            a_from, b_from = np.concatenate([[0], a_to[:-1]]), np.concatenate([[0], b_to[:-1]])
            a_size, b_size = a_to - a_from, b_to - b_from
            ends = np.cumsum([len(data[i]) for i in kept])
            text = np.searchsorted(ends, offset)  # of each group
            group, pair, times = crossed(a_ids, b_ids, a_from, b_from, a_size, b_size)
            order = np.lexsort((pair, text[group]))
            of, pair, times = text[group][order], pair[order], times[order]
            first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (pair[1:] != pair[:-1])]))
            times = np.add.reduceat(times, first)
            self.pairs.frombytes(pair[first].tobytes())
            self.times.frombytes(times.tobytes())
            n = len(kept)
            count = lambda weights: np.bincount(text, weights, n).astype(np.int64)
            sizes[kept] = np.stack([count(a_size), count(b_size), count(None), np.bincount(of[first], times, n).astype(np.int64), np.bincount(of[first], minlength=n)], axis=1)
            # Groups as text: each id with the sign that follows it, in the order of the groups.
            names = np.zeros(len(a_ids) + len(b_ids), np.int64)
            a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
            a_last[a_to - 1], b_last[b_to - 1] = True, True
            names[np.arange(len(a_ids)) + np.repeat(b_from, a_size)] = a_ids + a_last * self.a_count
            names[np.arange(len(b_ids)) + np.repeat(a_to, b_size)] = 2 * self.a_count + b_ids + b_last * self.b_count
            spelled = list(map(self.names.__getitem__, names.tolist()))
            upto = np.cumsum(sizes[kept, 0] + sizes[kept, 1]).tolist()
            for i, start, end in zip(kept, [0, *upto], upto):
                listed[i] = "".join(spelled[start:end])[:-1]
        self.listed += listed
        self.sizes.frombytes(sizes.tobytes())
        self.characters += sum(map(len, texts)) + sum(map(len, listed))

    def align(self, texts: list[str]) -> list[list[int]]:
        """For each text the numbers of the alignments that make it up, side by side."""
        if len(self.listed) > self.MEMO or self.characters > self.MEMO_CHARACTERS:
            self._clear()
        parted = [[] if not t else [t] if not self.by_words or self.whole(" " + t) else t.split(" ") for t in texts]
        held = [list(map(self.places.get, words)) for words in parted]
        new = list({w for words, places in zip(parted, held) if None in places for w, place in zip(words, places) if place is None})
        for first in range(0, len(new), 5_000):
            self._learn(new[first : first + 5_000])
        return [list(map(self.places.__getitem__, words)) if None in places else places for words, places in zip(parted, held)]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_of(a_path: str, b_path: str) -> Aligner:
    """The aligner of two tokenizer files, built once per worker process."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(ByteLevelSide(a_path), PieceSide(b_path))
    return _ALIGNERS[a_path, b_path]


# --- documents -----------------------------------------------------------------------

def _column_sums(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, np.int64)
    np.add.at(out, owner, values)
    return out


def _aligned(docs: DataFrame, a_path: str, b_path: str, with_groups: bool) -> DataFrame:
    """Rows of documents, with their distinct pairs as numbers of the block's list, and one row with that list per block."""
    kind = docs.schema["_id"].dataType.simpleString()
    extra = [("listed", pa.string())] if with_groups else []

    def run(batches):
        aligner, number = aligner_of(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            schema = pa.schema([
                ("block", pa.int64()), ("_id", batch.schema.field("_id").type), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("held", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
                ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())), *extra,
            ])
            for start, end in blocks(batch, "_text", BLOCK):
                part = batch.slice(start, end - start)
                parts = aligner.align([(data or b"").decode("utf-8", "replace") if _is_text(data) else "" for data in part.column("_text").to_pylist()])
                listed, each = aligner.listed, np.array(aligner.sizes, np.int64).reshape(-1, 5)
                parts = [p if aligner.broken.isdisjoint(p) else [] for p in parts]
                owner = np.repeat(np.arange(len(parts)), list(map(len, parts)))
                used = np.array([i for p in parts for i in p], np.int64)
                totals = [_column_sums(owner, each[used, c], len(parts)) for c in range(4)]
                strings = [";".join([listed[i] for i in p]) for p in parts]
                shas = [hashlib.sha256(s.encode()).hexdigest() if p else "" for s, p in zip(strings, parts)]
                # Distinct pairs of each document, as places in the block's sorted list.
                begin = np.cumsum(each[:, 4]) - each[:, 4]
                sizes = each[used, 4]
                at = np.repeat(begin[used] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                codes, times = np.array(aligner.pairs, np.int64), np.array(aligner.times, np.int64)
                pairs, place = np.unique(codes[at], return_inverse=True)
                keys, of_key = np.unique(np.repeat(owner, sizes) * max(1, len(pairs)) + place, return_inverse=True)
                often = np.zeros(len(keys), np.int64)
                np.add.at(often, of_key, times[at])
                doc, held = np.divmod(keys, max(1, len(pairs)))
                offsets = pa.array(np.searchsorted(doc, np.arange(len(parts) + 1)), pa.int32())
                nothing = pa.nulls(len(parts), pa.list_(pa.int64()))
                number += 1
                columns = [
                    pa.array(np.full(len(parts), number)), part.column("_id"), *map(pa.array, totals), pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(held, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(often)), nothing, nothing,
                ]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(strings, pa.string())] if extra else [])], schema=schema)
                head = {"block": number, "pairs": pairs, "docs": np.bincount(held, minlength=len(pairs)).astype(np.int64)}
                yield pa.RecordBatch.from_arrays([pa.array([head.get(f.name)], f.type) for f in schema], schema=schema)

    more = ", listed string" if with_groups else ""
    return docs.mapInArrow(run, f"block bigint, _id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                                f"held array<int>, times array<bigint>, pairs array<bigint>, docs array<bigint>{more}")


def _is_text(data: bytes | None) -> bool:
    if not data:
        return False
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best) from (pair, docs): documents that hold each pair, and whether that is the most of its first id."""
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))  # no more rows than the other vocabulary has ids
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def _scored(docs: DataFrame, looked_up: DataFrame, with_groups: bool) -> DataFrame:
    """Documents with n_best and count_sum, block by block, from the block's pairs (place, count, best)."""
    names = ["_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["listed"] if with_groups else [])]
    kind = docs.schema["_id"].dataType.simpleString()

    def run(_, left, right):
        counts = np.zeros(right.num_rows, np.int64)
        best = np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        counts[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        held, times = left.column("held").combine_chunks(), left.column("times").combine_chunks()
        owner = np.repeat(np.arange(left.num_rows), np.diff(held.offsets.to_numpy()))
        held, times = held.flatten().to_numpy(), times.flatten().to_numpy()
        sums = [_column_sums(owner, times * values[held], left.num_rows) for values in (best, counts)]
        return pa.Table.from_arrays([*[left.column(n) for n in names], *map(pa.array, sums)], names=[*names, "n_best", "count_sum"])

    extra = ", listed string" if with_groups else ""
    schema = f"_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string{extra}, n_best bigint, count_sum bigint"
    return docs.groupBy("block").cogroup(looked_up.groupBy("block")).applyInArrow(run, schema)


class Alignment:
    """The alignment of a table of texts: ``documents()`` per row, ``links()`` per id pair."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", with_groups: bool = False):
        """The tokenizer files must exist on every executor. ``with_groups`` keeps each document's groups as text."""
        self.id, self.with_groups = id, with_groups
        self.folder = fresh_folder(docs.sparkSession, "alignment")
        slim = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"))
        self.rows = written(_aligned(slim, a_path, b_path, with_groups), f"{self.folder}/rows")
        heads = self.rows.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p"))
        self.named = written(heads.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs")), f"{self.folder}/named")
        self.counts = written(pair_counts(self.named), f"{self.folder}/counts")

    def links(self) -> DataFrame:
        """(a, b, count, best) of every linked id pair."""
        return self.counts.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "count", "best")

    def documents(self) -> DataFrame:
        """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, listed]) per row."""
        looked_up = self.named.join(self.counts, "pair").select("block", "place", "count", "best")
        docs = self.rows.where("pairs is null").drop("pairs", "docs")
        out = _scored(docs, looked_up, self.with_groups)
        return out.select(F.col("_id").alias(self.id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["listed"] if self.with_groups else []))
