"""Plain single-process versions of the operators, for comparison."""
import re
from collections import Counter

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, n=3):
    words = SPACE.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else \
        ([" ".join(words)] if words else [])
    bits = Counter()
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(grams)) if grams else 0


def simhash_components(docs, bits=3):
    """{doc_id: (hex fingerprint, component)} by comparing all pairs of texts."""
    fp = {d: fingerprint(t) for d, t in docs}
    parent = {d: d for d in fp}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(fp)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (f"{fp[d]:016x}", find(d)) for d in fp}
