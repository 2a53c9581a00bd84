"""The operators' results by plain Python, one document at a time."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text):
    words = ALNUM.findall((text or "").translate(LOWER))
    at = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in at]
    labels = ",".join(sorted({x for _, x in at}))
    return len(words), len(at), min(starts, default=None), max(starts, default=None), labels


def shingles(text, k=4):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    links = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(sets.items(), 2)
        if x and y and 100 * len(x & y) >= 85 * len(x | y)
    ]
    found = roots(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def secrets(text):
    text = text or ""
    found = []
    for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    for k, (kind, pattern, least) in enumerate((("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)), 1):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    kinds = Counter(x[3] for x in found)
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    n, again = len(words), len(covered)
    failed = n < 50 or 100 * again > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), again, failed


def duplicate_lines(docs):
    """(doc_id, line) of lines with an earlier match: their distinct words, A-Z lower-cased, have a Jaccard similarity of 0.8."""
    rows = [
        (i, n, frozenset(SPACED.findall(line.translate(LOWER))))
        for i, text in sorted(dict(docs).items())
        for n, line in enumerate((text or "").split("\n"))
    ]
    firsts, found = {}, set()
    for i, n, x in rows:
        if not x:
            continue
        # Equal lines match their first; others are compared with the first line of each set.
        if x in firsts or any(5 * len(x & y) >= 4 * len(x | y) for y in firsts if 4 * len(x) <= 5 * len(y) and 4 * len(y) <= 5 * len(x)):
            found.add((i, n))
        firsts.setdefault(x, (i, n))
    return found


def without_lines(docs):
    gone = duplicate_lines([d for d in docs if d[0] is not None])
    return {
        i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        for i, t in docs
    }


def hard_negatives(rows):
    """(anchor, positive, rank, negative, positive's score, negative's score) of rows (vec_id, label, vector)."""
    able = []
    for i, label, x in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        able.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * v) for v in x]))
    found = []
    for a, label, x in (r for r in able if r[0] % 100 == 0):
        scored = sorted(
            (-sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in able if i != a and len(y) == len(x)
        )
        same = [(i, -s) for s, i, other in scored if other == label][:5]
        for positive, p in same:
            hard = [(i, -s) for s, i, other in scored if other != label and 30 * p <= -100 * s <= 90 * p][:10]
            found += [(a, positive, k, i, p, s) for k, (i, s) in enumerate(hard, 1)]
    return found


def rebuilt(rows):
    """conv_id: turns (role, text) of rows (conv_id, turn, role, text), families mixed."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def prefix_trie(rows):
    """Rows of the trie's nodes: the operator's columns in order."""
    members, ends = {}, {}
    for c, ts in rebuilt(rows).items():
        ends.setdefault(tuple(ts), []).append(c)
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    leaves, saved, children = Counter(), Counter(), Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, cs in members.items():
        own = (len(cs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += own
    return [
        (
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, cs in members.items()
    ]
