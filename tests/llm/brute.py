"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LAST = (1 << 63) - 1
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").encode().lower()


def remainder(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def order(doc_id):
    return LAST if doc_id is None else doc_id


def sha(data):
    return hashlib.sha256(data).hexdigest()


def without_repeats(rows, units, join, window=50):
    """(doc_id, n, removed, spans, sha of what is left) of every row, sorted."""
    least = {}
    cut = [(order(d), units(t)) for d, t, *_ in rows]
    for d, u in cut:
        for k in range(len(u) - window + 1):
            w = u[k:k + window]
            least[w] = min(least.get(w, LAST + 1), d)
    out = []
    for d, u in cut:
        gone = np.zeros(len(u), dtype=bool)
        for k in range(len(u) - window + 1):
            if least[u[k:k + window]] < d:
                gone[k:k + window] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int), [0]))) == 1))
        out.append((d, len(u), int(gone.sum()), spans, sha(join(u, gone))))
    return sorted(out)


def byte_repeats(rows):
    return without_repeats(rows, lambda t: (t or "").encode(), lambda u, g: bytes(c for c, x in zip(u, g, strict=True) if not x))


def word_repeats(rows):
    return without_repeats(rows, lambda t: tuple((t or "").encode().split()), lambda u, g: b" ".join(w for w, x in zip(u, g, strict=True) if not x))


def simhash(text):
    words = low(text).split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def linked(rows, bits=2):
    """(doc_id, fingerprint, component_id) of every row, and the least doc_id of every component."""
    codes = [simhash(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= bits:
                parent[find(a)] = find(b)
    least = defaultdict(lambda: LAST)
    for a, row in enumerate(rows):
        least[find(a)] = min(least[find(a)], order(row[0]))
    return [(order(r[0]), f"{codes[a]:016x}", least[find(a)]) for a, r in enumerate(rows)], sorted(least.values())


def contaminated(rows, items, size=10):
    """(doc_id, words, hit words, items, sha of item ids) of every row, sorted."""
    def words(t):
        return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(0, len(w) - size) + 1 if w else 0):
            windows[tuple(w[k:k + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for d, t, *_ in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                here = windows.get(tuple(w[k:k + n]))
                if here:
                    hit |= set(range(k, k + n))
                    found |= here
        out.append((order(d), len(w), len(hit), len(found), sha(",".join(sorted(found)).encode())))
    return sorted(out)


def unigram(rows, modulus=7, held=2):
    """(doc_id, tokens, known tokens, training tokens, log10 probability) of every row."""
    counts = Counter()
    for d, t, *_ in rows:
        if remainder(d, modulus) != held:
            counts.update([*low(t).split(), "end"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t, *_ in rows:
        tokens = [*low(t).split(), "end"]
        out.append((order(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    return out


def matching(rows, depth, discount=0.5, modulus=7, held=2):
    """log10 probability by prediction by partial matching of every row."""
    tables = [defaultdict(Counter) for _ in range(depth + 1)]
    for d, t, *_ in rows:
        if remainder(d, modulus) != held:
            line = b"\xff" * depth + low(t) + b"\xff"
            for p in range(depth, len(line)):
                tables[depth][line[p - depth:p]][line[p]] += 1
    for k in range(depth - 1, -1, -1):
        for context, symbols in tables[k + 1].items():
            for s in symbols:
                tables[k][context[1:]][s] += 1
    out = []
    for _, t, *_ in rows:
        line, total = b"\xff" * depth + low(t) + b"\xff", 0.0
        for p in range(depth, len(line)):
            gone = set()
            for k in range(depth, -1, -1):
                seen = {s: n for s, n in tables[k].get(line[p - k:p], {}).items() if s not in gone}
                if not seen:
                    continue
                room = sum(seen.values())
                if line[p] in seen:
                    total += math.log10((seen[line[p]] - discount) / room)
                    break
                total += math.log10(discount * len(seen) / room)
                gone |= set(seen)
            else:
                total -= math.log10(max(1, 256 - len(tables[0][b""])))
        out.append(total)
    return out


def shingles(text, size=5):
    words = low(text).split()
    return {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
