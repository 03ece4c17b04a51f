"""Plain versions of the corpus operators, row by row, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def crc(doc_id, buckets: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % buckets


def secrets(text: str | None) -> tuple[int, int, int, str]:
    """n_assign, n_access, n_hex and the base spans' digest."""
    text = text or ""
    spans = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 8:
            spans.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            spans.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            spans.append((m.start(), 2, "hex", m.end()))
    kinds = Counter(s[2] for s in spans)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    digest = hashlib.sha256(joined.encode()).hexdigest()
    return kinds["assign"], kinds["access"], kinds["hex"], digest


def normalised(text: str | None) -> str:
    return SPACE.sub(" ", text or "")


def copies(rows: list[tuple]) -> dict:
    """doc_id -> (keep_id, group_size, text_sha256) for unique ids."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normalised(text)].append(doc_id)
    return {
        d: (min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for d in ids
    }


def rules(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def ratios(rows: list[tuple], trusted: set, buckets: int) -> dict:
    def hashed(text):
        w = [x.encode() for x in WORD.findall(text or "")]
        first = [xxhash.xxh64(x, seed=42).intdigest() for x in w]
        hashes = first + [xxhash.xxh64(b, seed=h).intdigest() for h, b in zip(first, w[1:])]
        return [(h - (1 << 64) if h >> 63 else h) % buckets for h in hashes]

    raw, good = Counter(), Counter()
    for doc_id, text in rows:
        h = hashed(text)
        raw.update(h)
        if doc_id in trusted:
            good.update(h)
    n_raw, n_good = sum(raw.values()) + buckets, sum(good.values()) + buckets
    out = {}
    for doc_id, text in rows:
        h = hashed(text)
        each = [math.log((good[x] + 1) / n_good) - math.log((raw[x] + 1) / n_raw) for x in h]
        out[doc_id] = sum(each) / len(h) if h and sum(good.values()) else 0.0
    return out


def unigrams(rows: list[tuple]) -> dict:
    """doc_id -> (n_tokens, n_known, train_tokens, base_score)."""
    down = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def tokens(text):
        return [*WORD.findall((text or "").translate(down)), "\n"]

    counts = Counter()
    for doc_id, text in rows:
        if crc(doc_id, 10) != 0:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = {}
    for doc_id, text in rows:
        t = tokens(text)
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        out[doc_id] = (len(t), sum(counts[x] > 0 for x in t), n, base)
    return out


def suffix_scores(rows: list[tuple], depth: int, least: int, nats: float, back: float) -> dict:
    """doc_id -> log10 probability, by dictionaries of all contexts."""
    down = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

    def stream(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(down))
        return b"\n" * depth + b" ".join(words) + b"\n"

    counts = defaultdict(Counter)
    for doc_id, text in rows:
        if crc(doc_id, 10) != 0:
            s = stream(text)
            for i in range(depth, len(s)):
                for d in range(depth + 1):
                    counts[s[i - d : i]][s[i]] += 1
    often = {c for c, n in counts.items() if sum(n.values()) >= least}
    kept = {b""}
    for c in sorted(often, key=len, reverse=True):
        if not c:
            continue
        n, up = counts[c], counts[c[1:]]
        size, up_size = sum(n.values()), sum(up.values())
        kl = sum(k / size * math.log(k / size / (up[s] / up_size)) for s, k in n.items())
        if c in kept or size * kl >= nats:
            kept |= {c, c[1:]}

    cache = {}

    def chance(c, s):
        if (c, s) not in cache:
            n = counts[c]
            if c == b"":
                cache[c, s] = (n[s] + 1 / 256) / (sum(n.values()) + 1)
            else:
                cache[c, s] = (n[s] + back * chance(c[1:], s)) / (sum(n.values()) + back)
        return cache[c, s]

    out = {}
    for doc_id, text in rows:
        s, logs = stream(text), 0.0
        for i in range(depth, len(s)):
            d = 0
            while d < depth and s[i - d - 1 : i] in kept:
                d += 1
            logs += math.log10(chance(s[i - d : i], s[i]))
        out[doc_id] = logs
    return out


def runs(text: str | None, k: int = 5) -> list[tuple]:
    """Runs of k words, labelled with their number."""
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []
    seen = Counter()
    out = []
    for g in grams:
        out.append((*g, seen[g]))
        seen[g] += 1
    return out


def aligned(a: list, b: list) -> float:
    """Longest common subsequence over all runs, by the full table."""
    if not a or not b:
        return 0.0
    where = {x: j for j, x in enumerate(b)}
    row = np.zeros(len(b) + 1, int)
    for x in a:
        new = row.copy()
        if x in where:
            new[where[x] + 1] = row[where[x]] + 1
        row = np.maximum.accumulate(np.maximum(new, row))
    return row[-1] / (len(a) + len(b) - row[-1])


def near_classes(rows: list[tuple], least: float = 0.8) -> tuple[dict, set]:
    """doc_id -> smallest id of its class; links between different texts."""
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[" ".join(WORD.findall(text or ""))].append(doc_id)
    heads = {min(ids): runs(t) for t, ids in texts.items()}
    index = defaultdict(list)
    for d, r in heads.items():
        for x in set(g[:-1] for g in r):
            index[x].append(d)
    common = Counter()
    for ids in index.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                common[min(a, b), max(a, b)] += 1
    links = set()
    for a, b in common:
        if aligned(heads[a], heads[b]) >= least:
            links.add((a, b))
    up = {d: d for d in heads}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in sorted(links):
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {d: find(min(ids)) for ids in texts.values() for d in ids}, links


def url_parts(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    down = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return m[1].translate(down), m[2]


def longest_rule(host: str, path: str, rules) -> tuple[str | None, str | None]:
    fits = [
        r
        for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


def host_scores(pages: list[tuple], rules, link, damping: float, steps: int) -> dict:
    """host -> (trust, distrust)."""
    edges = Counter()
    total, good, bad = Counter(), Counter(), Counter()
    family = set()
    for _, url, html in pages:
        host, path = url_parts(url)
        if not host:
            continue
        total[host] += 1
        verdict = longest_rule(host, path, rules)[1]
        good[host] += verdict == "allow"
        bad[host] += verdict == "block"
        for to in {url_parts(x)[0] for x in re.findall(link, html or "")} - {"", host}:
            edges[host, to] += 1
        labels = host.split(".")
        for i in range(len(labels) - 2):
            a, b = ".".join(labels[i:]), ".".join(labels[i + 1 :])
            family |= {(a, b), (b, a)}
    for e in family:
        edges[e] += 1

    def spread(seeds, edges):
        out = Counter()
        for (a, _), w in edges.items():
            out[a] += w
        start = {h: (1 - damping) * s for h, s in seeds.items()}
        rank = dict(start)
        for _ in range(steps):
            new = Counter(start)
            for (a, b), w in edges.items():
                new[b] += damping * rank.get(a, 0) * w / out[a]
            rank = new
        return rank

    trust = spread({h: good[h] / total[h] for h in good if good[h]}, edges)
    back = {(b, a): w for (a, b), w in edges.items()}
    distrust = spread({h: bad[h] / total[h] for h in bad if bad[h]}, back)
    return {h: (trust.get(h, 0.0), distrust.get(h, 0.0)) for h in total}
