"""Plain single-process versions of the query contracts."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHA = lambda text: hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def secrets(text: str | None) -> tuple[int, int, int, str, list[tuple[int, int, str]]]:
    text = text or ""
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
    ]
    spans = sorted((m.start(), rank, kind, m.end()) for rank, (kind, p, group, least) in enumerate(kinds) for m in p.finditer(text) if len(m[group]) >= least)
    count = Counter(s[2] for s in spans)
    return count["assign"], count["access"], count["hex"], SHA(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)), spans


def url_verdict(url: str | None, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = lower(host)
    fits = [(h.count("."), len(p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def licences(text: str | None):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def simhash_groups(rows, shingle: int = 3, distance: int = 2) -> dict:
    """id -> (fingerprint, least id reachable)."""
    fps = {i: fingerprint(t, shingle) for i, t in rows}
    return {i: (f"{fps[i]:016x}", c) for i, c in grouped(fps, distance).items()}


def grouped(fps: dict, distance: int) -> dict:
    distinct = np.array(sorted(set(fps.values())), np.uint64)
    parent = list(range(len(distinct)))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(distinct)):
        for b in np.flatnonzero(np.bitwise_count(distinct ^ distinct[a]) <= distance).tolist():
            parent[top(a)] = top(b)
    place = {int(f): k for k, f in enumerate(distinct)}
    least: dict = {}
    for i, f in fps.items():
        r = top(place[f])
        least[r] = min(least.get(r, i), i)
    return {i: least[top(place[f])] for i, f in fps.items()}


def without_repeats(rows, window: int = 50) -> dict:
    """id -> (n_words, n_removed, sha of what is kept)."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    least: dict = {}
    for i, w in words.items():
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            least[g] = min(least.get(g, i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if least[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out[i] = (len(w), sum(gone), SHA(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def archive(rows, least: int = 0) -> dict:
    """page id -> (bytes, digest, type, refers to)."""
    first: dict = {}
    data = {i: (h or "").encode() for i, h in rows}
    for i, d in data.items():
        first[d] = min(first.get(d, i), i)
    out = {}
    for i, d in data.items():
        later = len(d) >= least and first[d] != i
        out[i] = (len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "revisit" if later else "response", first[d] if later else None)
    return out


def measures(text: str | None):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for s in range(len(words) - 7):
        places[tuple(words[s : s + 8])].append(s)
    hit = {s + k for v in places.values() if len(v) > 1 for s in v for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def shard(key: str, shards: int) -> int:
    scores = [int(hashlib.md5(f"{key}#{s}".encode()).hexdigest()[:13], 16) for s in range(shards)]
    return scores.index(max(scores))


def crc(text: str | None) -> int:
    return zlib.crc32((text or "").encode())


def phrases(rows, least: int, longest: int = 5, top: int | None = 2000, percent: int = 100) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        held = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in held.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in held.items():
            if 100 * inside[p] >= percent * a and inside[p]:
                continue
            score, cut = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), count[p[:cut]], count[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def alignment(rows, a_side, b_side) -> list[tuple]:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256); a side is (encode, bytes of an id)."""
    every, held = [], Counter()
    for id, text in rows:
        links, sizes, listed = [], (0, 0, 0), ""
        if text:
            (a, a_bytes), (b, b_bytes) = ((ids, [to_bytes(i) for i in ids]) for ids, to_bytes in ((enc(text), tb) for enc, tb in (a_side, b_side)))
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                spans = []
                for ids, data in ((a, a_bytes), (b, b_bytes)):
                    at, ends = 0, []
                    for d in data:
                        at += len(d)
                        ends.append(at)
                    spans.append(ends)
                cuts = sorted(set(spans[0]) & set(spans[1]))
                groups, start = [], 0
                for cut in cuts:
                    groups.append(tuple(ids[bisect_right(ends, start) : bisect_right(ends, cut)] for ids, ends in ((a, spans[0]), (b, spans[1]))))
                    start = cut
                links = [(i, j) for x, y in groups for i in x for j in y]
                sizes, listed = (len(a), len(b), len(groups)), SHA(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups))
        held.update(set(links))
        every.append((id, *sizes, links, listed))
    top = defaultdict(int)
    for (i, _), c in held.items():
        top[i] = max(top[i], c)
    return [(id, x, y, g, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), sha) for id, x, y, g, links, sha in every]
