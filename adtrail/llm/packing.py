"""Best-fit packing: documents, as token ids, laid into sequences of a fixed room by patterns of lengths.

A document is its ids and an end id. Only documents longer than a sequence are cut, into pieces of a whole sequence; the
last piece may be shorter. What is packed is the histogram of piece lengths, which has no more entries than a sequence
has tokens, however large the corpus:

* patterns of up to PATTERN_DOCS lengths that fill a sequence are enumerated over UNITS length classes; non-negative
  least squares fits how often each pattern is repeated to the histogram of classes, and the counts are rounded down;
* a repeated pattern takes exact lengths from its classes and is closed by a document that fills it to the last token;
* what is left, where rounding or missing lengths let a pattern down, is packed by best fit, longest first;
* of the fitted counts all, or only a share, are laid as patterns, so that best fit has short documents to fill gaps with:
  the plan with the fewest sequences counts.

The plan is a list of runs: so many pieces of one length, numbered from here on, go to these sequences at this offset.
Pieces are numbered within their length by (task, place in the task), and find their run by binary search, so no group
of equal lengths meets in one task.

Defined cases: a null or empty text is the end id alone; bytes that are not UTF-8 are read with U+FFFD; repeated rows
and null ids are documents like others; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from adtrail.llm.store import fresh_folder, written
from adtrail.llm.words import blocks

UNITS = 64
PATTERN_DOCS = 4
SHARES = (1.0, 0.95, 0.9, 0.8, 0.65, 0.5)


# --- token ids -----------------------------------------------------------------------

class Lists:
    """Growing lists of ids, by number."""

    def __init__(self):
        self.sizes, self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def extend(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def side_by_side(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of the lists ``at``, end to end, the size of each)."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))], sizes


class WordEncoder:
    """Ids of texts by a tokenizer file.

    Where the file's steps are to normalise, to part by a pattern that drops white space, and to merge inside each part,
    texts of common Latin characters (on which NFC changes nothing) are put in lower case and parted by that pattern here,
    and each part goes to the tokenizer's model once and is remembered. All other texts, and those that may hold a special
    token, are encoded by the tokenizer as a whole.
    """

    #: Parts remembered; when the memo is full it starts anew, which costs time and changes no result.
    MEMO = 500_000
    #: White space, printable ASCII, Latin letters and signs, dashes and quotation marks: no combining marks.
    COMMON = "[\t-\r -~\u00a1-\u024f\u2010-\u2027\u2030-\u205e]*"
    GAP = "\x00"

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        steps = [step["type"] for step in (spec.get("normalizer") or {}).get("normalizers") or []]
        drops_space = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        levels = [(r.get("type"), r.get("use_regex"), r.get("add_prefix_space")) for r in rest] == [("ByteLevel", False, False)]
        self.by_parts = drops_space and levels and steps == ["NFC", "Replace", "Lowercase"]
        self.find_parts = regex.compile(split["pattern"]["Regex"]).findall if self.by_parts else None
        self.merged = self.tokenizer.model.tokenize
        self.to_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        marks = [token["content"] for token in spec.get("added_tokens") or []]
        self.special = regex.compile("|".join(map(regex.escape, marks)) if marks else "(?!)").search
        self.common = regex.compile(self.COMMON).fullmatch
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {self.GAP: 0}  # stands between texts and has no ids
        self.lists = Lists()
        self.lists.extend(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _learn(self, parts: list[str]) -> None:
        each = [[t.id for t in self.merged(p if p.isascii() else self.to_bytes(p)[0][0])] for p in parts]
        self.places.update(zip(parts, range(len(self.places), len(self.places) + len(parts))))
        self.lists.extend(np.array([i for ids in each for i in ids], np.uint32), np.array(list(map(len, each)), np.int64))

    def _encode_common(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.places) > self.MEMO:
            self._clear()
        parts = self.find_parts("".join([f"{t} {self.GAP} " for t in texts]).lower())
        at = list(map(self.places.get, parts))
        new = [i for i, place in enumerate(at) if place is None]
        if new:
            self._learn(list({parts[i] for i in new}))
            for i in new:
                at[i] = self.places[parts[i]]
        at = np.array(at, np.int64)
        ids, sizes = self.lists.side_by_side(at)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(upto[np.concatenate([[0], np.flatnonzero(at == 0)])])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        read = [t.decode("utf-8", "replace") for t in texts]
        common = np.array([self.by_parts and self.common(t) is not None and self.special(t) is None for t in read], bool)
        sizes = np.zeros(len(read), np.int64)
        ids = np.zeros(0, np.uint32)
        if common.any():
            ids, sizes[common] = self._encode_common([t for t, c in zip(read, common) if c])
        if common.all():
            return ids, sizes
        others = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t, c in zip(read, common) if not c]
        sizes[~common] = list(map(len, others))
        of_common = np.repeat(common, sizes)
        out = np.zeros(len(of_common), np.uint32)
        out[of_common], out[~of_common] = ids, np.concatenate(others)
        return out, sizes


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of a tokenizer file, built once per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def cut(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, length) of documents of ``sizes`` tokens."""
    counts = -(-sizes // room)
    owner = np.repeat(np.arange(len(sizes)), counts)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, piece, np.minimum(room, sizes[owner] - piece * room)


def _pieces(docs: DataFrame, path: str, end_id: int, room: int, with_ids: bool) -> DataFrame:
    """(_id, piece, start, length, ids_crc32, part, nth[, ids]): ``nth`` counts the task's pieces of the same length."""
    kind = docs.schema["_id"].dataType.simpleString()
    names = ["_id", "piece", "start", "length", "ids_crc32", "part", "nth", *(["ids"] if with_ids else [])]

    def run(batches):
        encoder, part_number = encoder_of(path), TaskContext.get().partitionId()
        seen = np.zeros(room + 1, np.int64)
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                ids, counts = encoder.encode([data or b"" for data in part.column("_text").to_pylist()])
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                sizes = counts + 1
                owner, piece, length = cut(sizes, room)
                begin = (np.cumsum(sizes) - sizes)[owner] + piece * room
                crcs = [zlib.crc32(ids[a : a + n]) for a, n in zip(begin.tolist(), length.tolist())]
                nth = seen[length] + pd.Series(length).groupby(length).cumcount().to_numpy()
                seen += np.bincount(length, minlength=room + 1)
                columns = [
                    part.column("_id").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(piece * room, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crcs, pa.int64()), pa.array(np.full(len(owner), part_number), pa.int32()), pa.array(nth, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    extra = ", ids array<int>" if with_ids else ""
    return docs.mapInArrow(run, f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint{extra}")


# --- the plan ------------------------------------------------------------------------

def patterns(units: int, most: int) -> np.ndarray:
    """All ways to fill ``units`` with one to ``most`` classes, as rows of class counts (column u is class u + 1)."""
    out: list[list[int]] = []

    def extend(chosen: list[int], left: int, largest: int) -> None:
        if left == 0:
            out.append(chosen)
        elif len(chosen) < most:
            for u in range(min(left, largest), 0, -1):
                if u * (most - len(chosen)) < left:
                    break
                extend([*chosen, u], left - u, u)

    extend([], units, units)
    table = np.zeros((len(out), units))
    for row, chosen in enumerate(out):
        for u in chosen:
            table[row, u - 1] += 1
    return table


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with the least ||a x - b||, by the active-set method of Lawson and Hanson (1974)."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-10 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        gain = a.T @ (b - a @ x)
        gain[active] = 0
        best = int(gain.argmax())
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            fitted = np.zeros(len(x))
            fitted[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            sinking = active & (fitted <= 0)
            if not sinking.any():
                break
            step = (x[sinking] / np.maximum(x[sinking] - fitted[sinking], 1e-300)).min()
            x = x + step * (fitted - x)
            fallen = active & (x <= tolerance)
            if not fallen.any():
                fallen = sinking
            x[fallen], active[fallen] = 0, False
        x = fitted
    return x


class Plan:
    """Runs (length, first number, first sequence, pieces per sequence, offset) for a histogram of lengths."""

    def __init__(self, histogram: np.ndarray, room: int, share: float = 1.0, units: int = UNITS, most: int = PATTERN_DOCS):
        self.left, self.room, self.share = histogram.astype(np.int64).copy(), room, share
        self.used = np.zeros(room + 1, np.int64)
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.free: dict[int, list[tuple[int, int]]] = {}  # open room -> (first sequence, how many)
        if self.left[room]:
            whole = int(self.left[room])
            self._open(whole)
            self._put(room, whole, 0, 1, 0)
        self._patterns(min(units, room), most)
        self._best_fit()
        order = np.lexsort(([r[1] for r in self.runs], [r[0] for r in self.runs])) if self.runs else []
        self.table = np.array(self.runs, np.int64).reshape(-1, 5)[order]

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _put(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), sequence, each, offset))
        self.used[length] += count
        self.left[length] -= count

    def _longest(self, low: int, high: int, taken: list[int]) -> int:
        """The longest length in (low, high] with a piece left beside those ``taken``; 0 if none."""
        for length in range(high, max(low, 0), -1):
            if self.left[length] > taken.count(length):
                return length
        return 0

    def _patterns(self, units: int, most: int) -> None:
        unit = -(-self.room // units)
        units = self.room // unit
        lengths = np.arange(1, units * unit + 1)
        classes = np.bincount((lengths - 1) // unit, weights=self.left[lengths], minlength=units)
        total = classes.sum()
        if not total:
            return
        table = patterns(units, most)
        fitted = np.floor(non_negative_least_squares(table.T, classes / total) * total * self.share).astype(np.int64)
        for row in np.argsort(-fitted, kind="stable").tolist():
            chosen = [u + 1 for u in range(units - 1, -1, -1) for _ in range(int(table[row, u]))]
            repeats = int(fitted[row])
            while repeats > 0:
                taken: list[int] = []
                for u in chosen[:-1]:
                    length = self._longest((u - 1) * unit, u * unit, taken)
                    if not length:
                        break
                    taken.append(length)
                if len(taken) < len(chosen) - 1:
                    break
                closing = self.room - sum(taken)
                if self.left[closing] <= taken.count(closing):
                    # No piece closes it exactly: let the last one before it give way, within its class.
                    closing = self._exchange(taken, chosen, unit)
                    if not closing:
                        break
                taken.append(closing)
                count = min([repeats, *(int(self.left[n]) // taken.count(n) for n in taken)])
                first, offset = self._open(count), 0
                for length in taken:
                    self._put(length, count, first, 1, offset)
                    offset += length
                self._leave(offset, first, count)
                repeats -= count

    def _exchange(self, taken: list[int], chosen: list[int], unit: int) -> int:
        """A closing length that exactly fills the sequence once the last of ``taken`` is exchanged; 0 if there is none."""
        if not taken:
            return 0
        last = taken.pop()
        open_room = self.room - sum(taken)
        for length in range(last, max((chosen[-2] - 1) * unit, 0), -1):
            closing = open_room - length
            if closing > 0 and self.left[length] > taken.count(length) and self.left[closing] > taken.count(closing) + (closing == length):
                taken.append(length)
                return closing
        return 0

    def _leave(self, filled: int, first: int, count: int) -> None:
        if filled < self.room and count:
            self.free.setdefault(self.room - filled, []).append((first, count))

    def _fill(self, length: int, room: int, first: int, count: int) -> None:
        """Lay pieces of ``length`` into ``count`` sequences with ``room`` left, each as full as it gets."""
        offset, each, have = self.room - room, room // length, int(self.left[length])
        full = min(count, have // each)
        if full:
            self._put(length, full * each, first, each, offset)
            self._leave(offset + each * length, first, full)
        rest = have - full * each
        if full < count and rest:
            self._put(length, rest, first + full, rest, offset)
            self._leave(offset + rest * length, first + full, 1)
            full += 1
        self._leave(offset, first + full, count - full)

    def _best_fit(self) -> None:
        for length in range(self.room, 0, -1):
            for room in sorted(r for r in self.free if r >= length):
                for first, count in self.free.pop(room):
                    if self.left[length]:
                        self._fill(length, room, first, count)
                    else:
                        self.free.setdefault(room, []).append((first, count))
                if not self.left[length]:
                    break
            if self.left[length]:
                count = -(-int(self.left[length]) // (self.room // length))
                self._fill(length, self.room, self._open(count), count)


def best_plan(histogram: np.ndarray, room: int) -> Plan:
    """The plan with the fewest sequences; of equal ones that with the most patterns."""
    bound = -(-int((histogram * np.arange(room + 1)).sum()) // room)
    best = None
    for share in SHARES:
        plan = Plan(histogram, room, share)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences == bound:
            break
    return best


def _laid(pieces: DataFrame, table: np.ndarray, with_ids: bool) -> DataFrame:
    """``pieces`` (with ``number`` within their length) with sequence_id and offset."""
    kind = pieces.schema["_id"].dataType.simpleString()
    names = ["_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches):
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            starts = np.searchsorted(table[:, 0], length, side="left")
            ends = np.searchsorted(table[:, 0], length, side="right")
            at = np.zeros(len(length), np.int64)
            for value in np.unique(length).tolist():
                here = length == value
                a, b = int(starts[here][0]), int(ends[here][0])
                at[here] = a + np.searchsorted(table[a:b, 1], number[here], side="right") - 1
            beyond = number - table[at, 1]
            sequence = table[at, 2] + beyond // table[at, 3]
            offset = table[at, 4] + beyond % table[at, 3] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    extra = ", ids array<int>" if with_ids else ""
    return pieces.mapInArrow(run, f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint{extra}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_file: str, room: int = 2048, end_id: int = 0, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece, and with ``with_ids`` its ids.

    ``tokenizer_file`` must exist on every executor.
    """
    folder = fresh_folder(docs.sparkSession, "packing")
    slim = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"))
    pieces = written(_pieces(slim, tokenizer_file, end_id, room, with_ids), f"{folder}/pieces")
    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = written(counted.select("length", "part", "n", F.coalesce(before, F.lit(0)).alias("base")), f"{folder}/bases")
    histogram = np.zeros(room + 1, np.int64)
    for row in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():  # no more rows than a sequence has tokens
        histogram[row["length"]] = row["n"]
    plan = best_plan(histogram, room)
    numbered = pieces.join(bases.select("length", "part", "base"), ["length", "part"]).withColumn("number", F.col("base") + F.col("nth"))
    return _laid(numbered, plan.table, with_ids).withColumnRenamed("_id", id)


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the sequences themselves, from a table packed ``with_ids``. A sequence holds no more than its room."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))
