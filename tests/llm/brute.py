"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def without_repeats(texts, window):
    """(n_words, n_removed, kept words) of each text."""
    all_words = [words(t) for t in texts]
    starts = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def unigram_scores(rows):
    """rows: (id, text). (held_out, n_tokens, n_known, N, base_score) of each."""
    fold = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in rows]
    tokens = [[*words(lowered(t)), None] for _, t in rows]
    counts = Counter(x for held, own in zip(fold, tokens) if not held for x in own)
    n, v = sum(counts.values()), len(counts)
    return [(held, len(own), sum(counts[x] > 0 for x in own), n, math.fsum(math.log10((counts[x] + 1) / (n + v + 1)) for x in own)) for held, own in zip(fold, tokens)]


def interpolated(rows, weights=(0.5, 0.6), discount=0.75, base=1.4):
    """log10 probability of each text by the interpolated model of up to three words, from exact counts. rows: (id, text)."""
    steps = sorted({math.ceil(base**i - 1e-9) for i in range(125)})
    level = lambda c: bisect.bisect_right(steps, c)
    q = lambda c: steps[level(c) - 1] if c else 0
    above = lambda c: steps[level(c)] - 1 if c else 0

    def gram(own, i, n):
        return (0, *own[: i + 1]) if i - n + 1 < 0 else tuple(own[i - n + 1 : i + 1])

    train = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2 for i, _ in rows]
    tokens = [[*words(lowered(t)), None] for _, t in rows]
    counts = [Counter(gram(own, i, n) for ok, own in zip(train, tokens) if ok for i in range(len(own))) for n in (1, 2, 3)]
    below = sum(map(q, counts[0].values())) + len(counts[0]) + 1
    out = []
    for own in tokens:
        total = 0.0
        for i in range(len(own)):
            p = (q(counts[0][gram(own, i, 1)]) + 1) / below
            for n in (2, 3):
                context = above(counts[n - 2][gram(own, i - 1, n - 1)]) if i else sum(train)
                if context:
                    w = weights[n - 2]
                    p = w * min(max(q(counts[n - 1][gram(own, i, n)]) - discount, 0) / context, 1) + (1 - w) * p
            total += math.log10(p)
        out.append(total)
    return out


def fingerprint(text):
    import xxhash

    w = words(lowered(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(ids, fps, distance=4):
    """The least id that each id reaches."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def shingle_set(text, size=5):
    w = [x for x in re.split(r"[^\w]|_", (text or "").lower()) if x]
    return w, lambda k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def contained(docs, items, share=0.8):
    """Pairs (doc id, item id, n, shared): docs and items are (id, text)."""
    out, bodies = [], [(doc, shingle_set(body)[1]) for doc, body in docs]
    cut = {k: [(doc, of(k)) for doc, of in bodies] for k in range(1, 6)}
    for item, text in set(items):
        w, of = shingle_set(text)
        if item is None or not w:
            continue
        k = min(5, len(w))
        own = of(k)
        for doc, theirs in cut[k]:
            n = len(own & theirs)
            if n and n >= math.ceil(share * len(own) - 1e-9):
                out.append((doc, item, len(own), n))
    return out
