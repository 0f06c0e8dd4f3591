"""Plain versions of the operators for small tables."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def order(rows):
    return sorted(rows, key=str)


def ranked(rows):
    return [(LAST if i is None else i, t or "") for i, t in rows]


def byte_dedup(rows, length=50):
    texts, first, out = [(i, t.encode()) for i, t in ranked(rows)], {}, []
    for i, b in texts:
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            first[k] = min(first.get(k, LAST), i)
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((None if i == LAST else i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return order(out)


def window_dedup(rows, length=13):
    texts, first, out = [(i, WORD.findall(t)) for i, t in ranked(rows)], {}, []
    for i, w in texts:
        for p in range(len(w) - length + 1):
            k = tuple(w[p : p + length])
            first[k] = min(first.get(k, LAST), i)
    for i, w in texts:
        gone = [0] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < i:
                gone[p : p + length] = [1] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((None if i == LAST else i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return order(out)


def simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    h = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


class Union:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)


def near(rows):
    prints, u = [simhash(t) for _, t in rows], Union(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                u.join(i, j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[u.find(k)] = min(least.get(u.find(k), LAST), i)
    return order((i, f"{prints[k]:016x}", least[u.find(k)]) for k, (i, _) in enumerate(rows))


def kept_lines(rows, min_chars=1):
    """(doc_id, lines, lines that stay) of each row."""
    space, nodes = " \t\n\x0b\x0c\r", {}
    shingles = lambda s: {s[i : i + 5] for i in range(max(1, len(s) - 4))}
    for d, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            if d is not None and len(line.strip(space)) >= min_chars:
                nodes.setdefault(line.strip(space), []).append((d, k))
    names = list(nodes)
    sets, u, best = [shingles(n) for n in names], Union(len(names)), {}
    for i in range(len(names)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 10 >= 8 * len(sets[i] | sets[j]):
                u.join(i, j)
    for i, n in enumerate(names):
        best[u.find(i)] = min([best.get(u.find(i), (LAST, 0)), *nodes[n]])
    drop = {p for i, n in enumerate(names) for p in nodes[n] if p != best[u.find(i)]}
    split = [(d, (t or "").split("\n")) for d, t in rows]
    return [(d, x, [line for k, line in enumerate(x) if (d, k) not in drop]) for d, x in split]


def line_dedup(rows, min_chars=1):
    return order((d, len(x), len(x) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()) for d, x, kept in kept_lines(rows, min_chars))


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered, seen, again = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def plain_words(text):
    return "".join(" " if ord(c) < 128 and not c.isalnum() else (c.lower() if c.isascii() else c) for c in text or "").split(" ")


def item_distance(item, text):
    a, b = ([w for w in plain_words(x) if w] for x in (item, text))
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row), len(a)
