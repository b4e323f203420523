"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text: str | None) -> tuple:
    text = text or ""
    words = SPACED.findall(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def licence(text: str | None, phrases, templates, threshold: float) -> tuple:
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(pattern, text)
    places, labels, best = [], set(), {}
    for label, phrase in phrases:
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    for label, wording in templates:
        tokens, stretch = set(wording.split()), math.ceil(1.5 * len(wording.split()))
        for i, w in enumerate(words):
            share = len(tokens.intersection(words[i : i + stretch])) / len(tokens) if w in tokens else 0
            if share >= threshold:
                best[label] = max(share, best.get(label, 0.0))
    score = max([1.0 if places else 0.0, *best.values()])
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(best))), score


def jaccard(texts: dict[int, str | None], threshold: float = 0.8) -> dict[int, tuple[int, int]]:
    """Class and number of links of each document."""
    sets = {}
    for d, t in texts.items():
        w = SPACED.findall(t or "")
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    parent, links = {d: d for d in texts}, Counter()

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        shared = Counter(e for g in s for e in where[g] if e > d)
        for e, n in shared.items():
            if n >= threshold * (len(s) + len(sets[e]) - n) - 1e-9:
                links.update([d, e])
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (root(d), links[d]) for d in texts}


def suffixes(texts: list[str | None], length: int = 400) -> list[tuple[int, int, int, bytes]]:
    """Size, removed bytes, removed runs and what stays of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def unigrams(rows: list[tuple], words) -> dict[int, tuple]:
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter()
    for d, t in rows:
        if not held[d]:
            counts.update([*words(t), "end"])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for d, t in rows:
        tokens = [*words(t), "end"]
        out[d] = held[d], len(tokens), sum(counts[w] > 0 for w in tokens), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
    return out


def edit_distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
