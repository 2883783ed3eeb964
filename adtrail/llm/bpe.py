"""Byte-level BPE by backtracking over longest matches, on an automaton of the whole vocabulary.

Vocabulary entries are byte strings; they go into a pyahocorasick automaton as Latin-1 text, one character per byte.
A piece of text is encoded left to right. At each place the longest entry is tried first; it may stand after the last
token only if the two are compatible: encoding their joined bytes gives just these two tokens. If no entry fits, the
last token is given up for the next shorter one. Places known to lead nowhere are marked, and compatibility of a pair
is found once and remembered, so each place is passed a bounded number of times. The result is the merge order's own.

Compatibility of (a, b) needs no text: undo the merges of both along the seam, later merges first, and see whether
the seam would have been merged before the tokens themselves were formed.

Defined cases: a null text is the empty text, without tokens; bytes that are not UTF-8 (a Spark string can hold them)
are decoded with U+FFFD first, as Python's ``errors="replace"`` does; repeated rows each get their tokens. Only the id
and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm.words import blocks


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Encoder and decoder for one rank table and splitting pattern."""

    #: Entries of each memo; when one is full it starts anew, which costs time and changes no result.
    MEMO = 300_000

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.rank = ranks
        self.pattern = regex.compile(pattern)
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.halves = self._halves()
        self.pairs = {halves: token for token, halves in self.halves.items()}
        self.reached = self._reached()
        self.automaton = ahocorasick.Automaton()
        for token in self.reached:
            self.automaton.add_word(self.bytes_of[token].decode("latin-1"), token)
        self.automaton.make_automaton()
        self.shorter = self._shorter()
        self.compatible: dict[int, bool] = {}
        self.encoded: dict[str, tuple[tuple[int, ...], str]] = {}

    def _halves(self) -> dict[int, tuple[int, int]]:
        """The last merge that makes each token of two bytes or more: by merging its bytes with lower ranks only."""
        out = {}
        for token, rank in self.rank.items():
            if len(token) > 1:
                parts = self._merged(token, rank)
                if len(parts) == 2:
                    out[rank] = tuple(parts)
        return out

    def _merged(self, token: bytes, below: int) -> list[int]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            least, at = min((self.rank.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def _reached(self) -> set[int]:
        """Tokens that merging makes from their own bytes. Others come out only where they are a whole piece."""
        return {rank for token, rank in self.rank.items() if len(token) == 1 or rank in self.halves}

    def _shorter(self) -> dict[int, int]:
        """For each token, the longest other token that it starts with."""
        out = {}
        for token in self.reached:
            data = self.bytes_of[token]
            for n in range(len(data) - 1, 0, -1):
                start = self.rank.get(data[:n])
                if start is not None and start in self.reached:
                    out[token] = start
                    break
        return out

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` apart where they meet."""
        pair = left << 32 | right
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) >= self.MEMO * 3:
                self.compatible.clear()
            known = self.compatible[pair] = self._apart(left, right)
        return known

    def _apart(self, a: int, b: int) -> bool:
        bound = float("inf")  # a merge across the seam counts only if it comes before this rank
        while True:
            if self.pairs.get((a, b), bound) < bound:
                return False
            left, right = self.halves.get(a), self.halves.get(b)
            # The merge made last is undone first. Of equal ranks that is the right one, as merging goes left to right.
            if right is not None and (left is None or b >= a):
                bound, b = b + 1, right[0]
            elif left is not None:
                bound, a = a, left[1]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        whole = self.rank.get(piece)
        if whole is not None:  # a piece that is an entry is taken as it stands
            return [whole]
        if not piece:
            return []
        text, size = piece.decode("latin-1"), len(piece)
        out = [token for _, token in self.automaton.iter_long(text)]
        length, shorter, known, fits = self.length, self.shorter, self.compatible.get, self._fits
        at, last, good = length[out[0]], out[0], 1
        for token in out[1:]:  # longest matches stand as long as none of them has to be given up
            pair = last << 32 | token
            if not (known(pair) or (known(pair) is None and fits(last, token))):
                break
            at, last, good = at + length[token], token, good + 1
        else:
            return out
        del out[good:]
        closed = set()
        longest = self.automaton.iter_long
        while at < size:
            end = at + length[token]
            if end not in closed:
                if out:
                    pair = out[-1] << 32 | token
                    apart = known(pair)
                    if apart is None:
                        apart = fits(out[-1], token)
                else:
                    apart = True
                if apart:
                    out.append(token)
                    at = end
                    if at < size:
                        token = next(longest(text, at))[1]
                    continue
            token = shorter.get(token)
            if token is None:
                closed.add(at)
                token = out.pop()  # it ends at the place just closed, so a shorter one follows
                at -= length[token]
        return out

    def _piece(self, piece: str) -> tuple[tuple[int, ...], str]:
        """The ids of a piece, and the same in decimal joined by commas. Pieces recur: short ones are remembered."""
        ids = tuple(self.encode_piece(piece.encode("utf-8")))
        found = ids, ",".join(map(str, ids))
        if len(piece) <= 64:
            if len(self.encoded) >= self.MEMO:
                self.encoded.clear()
            self.encoded[piece] = found
        return found

    def pieces(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """The encoded matches of the pattern in a whole text, each encoded by itself."""
        known, find = self.encoded.get, self._piece
        return [known(piece) or find(piece) for piece in self.pattern.findall(text)]

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        return [token for ids, _ in self.pieces(text) for token in ids]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def digest(codec: Codec, data: bytes | None, with_ids: bool = False) -> tuple:
    """(number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded bytes[, ids])."""
    text = (data or b"").decode("utf-8", "replace")
    pieces = codec.pieces(text)
    ids = [token for tokens, _ in pieces for token in tokens]
    listed = ",".join([decimal for _, decimal in pieces]).encode()
    out = len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()
    return (*out, ids) if with_ids else out


_CODECS: dict[tuple[str, str], Codec] = {}


def codec_of(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once per worker process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row, and with ``with_ids`` the ids themselves.

    ``rank_file`` must exist on every executor, as the tokenizer package does.
    """
    slim = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").cast("binary").alias("_text"))
    extra = ", ids array<int>" if with_ids else ""
    kind = slim.schema["_id"].dataType.simpleString()

    def run(batches):
        codec = codec_of(rank_file, pattern)
        names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
        types = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32())] if with_ids else [])]
        for batch in batches:
            for start, end in blocks(batch, "_text"):
                part = batch.slice(start, end - start)
                rows = [digest(codec, data, with_ids) for data in part.column("_text").to_pylist()]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], names=["_id", *names])

    out = slim.mapInArrow(run, f"_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}")
    return out.withColumnRenamed("_id", id)
