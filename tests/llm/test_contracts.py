"""Every query on a small folder against its plain version, and on empty tables."""

import base64
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from adtrail.llm.queries import QUERIES, RANK_FILE, URL_RULES
from tests.llm import brute
from tests.llm.conftest import PAGES, documents

ROWS = documents()
TEXTS = {row[0]: row[1] for row in ROWS}


def rows(spark, folder, name, columns):
    found = QUERIES[name](spark, folder).select("doc_id" if name not in ("op2_url_filter", "op9_warc") else "page_id", *columns).collect()
    out = {}
    for r in found:
        assert out.setdefault(r[0], tuple(r[1:])) == tuple(r[1:])  # repeated rows agree
    return len(found), out


def test_secrets(spark, folder):
    n, got = rows(spark, folder, "op1_secret_scan", ["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    want = {i: brute.secrets(t) for i, t in TEXTS.items()}
    assert n == len(ROWS) and {i: g[:4] for i, g in got.items()} == {i: w[:4] for i, w in want.items()}
    assert got[9][4].startswith(f"private_key:0:{len(TEXTS[9])},access:32:72")
    for i, w in want.items():
        assert {f"{k}:{s}:{e}" for s, _, k, e in w[4]} <= set(got[i][4].split(","))


def test_urls(spark, folder):
    n, got = rows(spark, folder, "op2_url_filter", ["host", "path", "rule", "verdict"])
    assert n == len(PAGES) and got == {p: brute.url_verdict(u, URL_RULES) for p, u, _ in PAGES}


def test_licences(spark, folder):
    n, got = rows(spark, folder, "op3_license_scan", ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    assert n == len(ROWS) and {i: g[:5] for i, g in got.items()} == {i: brute.licences(t) for i, t in TEXTS.items()}
    assert "mit" in got[11][5].split(",") and got[11][6] == 1.0
    for g in got.values():
        assert set(filter(None, g[4].split(","))) <= set(g[5].split(",")) and 0 <= g[6] <= 1


def test_simhash(spark, folder):
    n, got = rows(spark, folder, "op5_simhash_dedup", ["fingerprint", "component_id"])
    assert n == len(ROWS) and got == brute.simhash_groups(TEXTS.items())


def test_shards(spark, folder):
    found = QUERIES["op6_shards"](spark, folder).collect()
    assert len(found) == len(ROWS)
    slots = {}
    for r in found:
        text = TEXTS[r.doc_id]
        assert (r.size, r.text_crc32, r.law) == (len((text or "").encode()) + 8, brute.crc(text), "key")
        assert (r.shard, r.grown_shard) == (brute.shard(f"k{r.doc_id}", 24), brute.shard(f"k{r.doc_id}", 25))
        assert r.grown_shard in (r.shard, 24)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_substrings(spark, folder):
    n, got = rows(spark, folder, "op7_substring_dedup", ["n_words", "n_removed", "kept_sha256"])
    assert n == len(ROWS) and got == brute.without_repeats(TEXTS.items())


def test_bpe(spark, folder):
    n, got = rows(spark, folder, "op8_bpe", ["n_tokens", "ids_sha256", "decoded_sha256"])
    with open(public_tokenizers.path(RANK_FILE), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    peer = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {i: peer.encode_ordinary(t or "") for i, t in TEXTS.items()}
    assert n == len(ROWS) and got == {i: (len(x), brute.SHA(",".join(map(str, x))), brute.SHA(TEXTS[i] or "")) for i, x in ids.items()}


def test_warc(spark, folder):
    n, got = rows(spark, folder, "op9_warc", ["payload_bytes", "payload_digest", "record_type", "refers_to"])
    assert n == len(PAGES) and got == brute.archive([(p, h) for p, _, h in PAGES])


def test_quality(spark, folder):
    n, got = rows(spark, folder, "op10_quality_rules", ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])
    want = {i: brute.measures(t) for i, t in TEXTS.items()}
    assert n == len(ROWS) and {i: g[:5] for i, g in got.items()} == want
    for i, g in got.items():
        assert g[5] == (want[i][0] < 20 or 100 * want[i][4] > 30 * want[i][0]) and not (g[5] and g[6])


def test_leaks(spark, folder):
    found = QUERIES["op4_decontaminate"](spark, folder).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in found] == [(60, 1, 1.0)]


def test_packing(spark, folder):
    found = QUERIES["op11_packing"](spark, folder).collect()
    peer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for row in ROWS:
        ids = [*peer.encode(row[1] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[row[0], piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in found) // 2048) + 1


def test_collocations(spark, folder):
    found = QUERIES["op12_collocations"](spark, folder).collect()
    assert sorted(map(tuple, found)) == brute.phrases([(r[2], r[1]) for r in ROWS], 100) != []


def test_alignment(spark, folder):
    found = QUERIES["op13_alignment"](spark, folder).collect()
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        of_a = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    want = brute.alignment([(r[0], r[1]) for r in ROWS], (lambda t: a.encode(" " + t, add_special_tokens=False).ids, of_a.__getitem__), (b.encode, of_b))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(want)


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(spark, empty, folder, name):
    df = QUERIES[name](spark, empty)
    assert df.count() == 0
