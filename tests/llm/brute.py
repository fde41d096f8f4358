"""Plain versions of the corpus operators, one document after the other, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

BLANK = "[\x20\x09-\x0d]+"
UPPER = re.compile("[A-Z]")


def low(text):
    return UPPER.sub(lambda m: m[0].lower(), text)


def words(text):
    return [w for w in re.split(BLANK, text or "") if w]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def _before(first, i):
    return first is not None and i is not None and first < i


def byte_dedup(docs, length=50):
    """{row: (n_bytes, n_removed, n_spans, digest)} of [(id, text)]."""
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1 if i is not None else 0):
            own = b[k : k + length]
            first[own] = min(i, first.get(own, i))
    made = []
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if _before(first.get(b[k : k + length]), i):
                gone[k : k + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        made.append((i, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return made


def word_dedup(docs, window=13):
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1 if i is not None else 0):
            own = tuple(w[k : k + window])
            first[own] = min(i, first.get(own, i))
    made = []
    for i, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - window + 1):
            if _before(first.get(tuple(w[k : k + window])), i):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        made.append((i, len(w), len(gone), sha(kept.encode())))
    return made


def simhash(parts):
    counts = np.zeros(64, int)
    for part in parts:
        value = xxhash.xxh64_intdigest(part.encode(), 42)
        counts += np.array([value >> b & 1 for b in range(64)])
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts))


def shingles(text, width):
    w = words(low(text or ""))
    return [" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))] if w else []


def groups(n, links):
    """The smallest member of the connected group of each of n nodes."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def near_duplicates(docs, width=4, bits=4):
    """[(id, fingerprint, smallest id of the component)]."""
    prints = [simhash(shingles(t, width)) for _, t in docs]
    n = len(docs)
    links = [(a, b) for a in range(n) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= bits]
    of = groups(n, links)
    least = {}
    for g, (i, _) in zip(of, docs):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(docs, prints, of)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_lines(docs, bits=4, least=0.8, alike=None):
    """[(id, kept line numbers)] of [(id, text)] without null or repeated ids.

    ``alike(a, b)`` is a quicker test of the same similarity; it takes the place of the distance.
    """
    alike = alike or (lambda a, b: 1 - distance(a, b) / max(len(a), len(b)) >= least - 1e-12)
    docs = sorted(docs)
    found, first = [], {}
    for i, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            own = " ".join(words(re.sub("[0-9]", "0", low(line))))
            if own:
                found.append((i, k, own))
                first.setdefault(own, len(first))
    lines = list(first)
    prints = [simhash(sorted(set(x.split(" ")))) for x in lines]
    links = [
        (a, b)
        for a in range(len(lines))
        for b in range(a)
        if (prints[a] ^ prints[b]).bit_count() <= bits and alike(lines[a], lines[b])
    ]
    of, seen, kept = groups(len(lines), links), set(), collections.defaultdict(list)
    for i, k, own in found:
        if of[first[own]] not in seen:
            seen.add(of[first[own]])
            kept[i].append(k)
    return [(i, kept[i]) for i, _ in docs]


def katz(docs, k=5):
    """[(id, held_out, n_tokens, n_known, N, base, score)] and the model as (P, words, histories)."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    texts = [[*words(low(t or "")), "\n"] for _, t in docs]
    uni, bi, hist = collections.Counter(), collections.Counter(), collections.Counter()
    for out, t in zip(held, texts):
        if not out:
            uni.update(t)
            bi.update(zip(["^", *t[:-1]], t))
            hist.update(["^", *t[:-1]])
    n, v = sum(uni.values()), len(uni)

    def discount(counts):
        c = collections.Counter(counts.values())
        tail = (k + 1) * c[k + 1] / c[1] if c[1] else 1
        made = {}
        for r in range(1, k + 1):
            good = (r + 1) * c[r + 1] / (r * c[r]) if c[r] else 0
            f = (good - tail) / (1 - tail) if tail < 1 else 0
            made[r] = f if 0 < f < 1 else (r - 0.5) / r
        return made

    du, db = discount(uni), discount(bi)
    unknown = 1 - sum(du.get(c, 1) * c / (n + 1) for c in uni.values())
    after = collections.defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c

    def word(w):
        return du.get(uni[w], 1) * uni[w] / (n + 1) if w in uni else unknown

    def p(w, h):
        if w in after.get(h, {}):
            return db.get(after[h][w], 1) * after[h][w] / (hist[h] + 1)
        if h not in after:
            return word(w)
        left = 1 - sum(db.get(c, 1) * c / (hist[h] + 1) for c in after[h].values())
        return left / (1 - sum(word(x) for x in after[h])) * word(w)

    made = []
    for (i, _), out, t in zip(docs, held, texts):
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t)
        score = sum(math.log10(p(w, h)) for h, w in zip(["^", *t[:-1]], t))
        made.append((i, out, len(t), sum(w in uni for w in t), n, base, score))
    return made, (p, list(uni), list(after))


def contamination(docs, items, window=10):
    """[(id, n_words, hit words, item names)]."""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    known = collections.defaultdict(set)
    for name, t in items:
        w = cut.findall(low(t or ""))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            known[tuple(w[k : k + window])] |= {str(name)} if name is not None else set()
    sizes, made = {len(x) for x in known}, []
    for i, t in docs:
        w, hit, names = cut.findall(low(t or "")), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    names |= known[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        made.append((i, len(w), sorted(hit), sorted(names)))
    return made
