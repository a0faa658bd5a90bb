"""Plain restatements of the operators' results, for small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(text):
    return (text or "").translate(ASCII_LOWER)


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def learnt(doc_id) -> bool:
    return doc_id is not None and crc(str(doc_id).encode()) % 4 != 2


def license_base(text):
    phrases = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
    words, places = plain_words(text), []
    for label, phrase in phrases.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def labels_of(text, templates):
    words, found = plain_words(text), set()
    for t in templates:
        p = t.key.split()
        if any(words[i : i + len(p)] == p for i in range(len(words))):
            found.add(t.label)
    return ",".join(sorted(found))


def leaks(docs, bench, window=13, similarity=0.8):
    """Compares every document with every item at every shift."""
    out = {}
    for doc, text in docs:
        d = plain_words(text)
        for item, item_text in bench:
            w = plain_words(item_text)
            size = min(window, len(w))
            if len(w) < 4:
                continue
            best = 0.0
            for shift in range(-len(w) + 1, len(d)):
                same = [0 <= shift + j < len(d) and d[shift + j] == x for j, x in enumerate(w)]
                if sum(same) >= similarity * size:
                    windows = [sum(same[s : s + size]) / size for s in range(len(w) - size + 1)]
                    best = max(best, *windows, sum(same) / len(w))
            if best >= similarity:
                out[doc, item] = round(best, 6)
    return out


def line_counts(text):
    t, words = text or "", blank_words(text)
    lines = [x for x in t.split("\n") if blank_words(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside),
    )


def deleted_lines(docs, min_words=50):
    """docs: (id, text) in order of id. Line numbers to delete by id: windows of just enough words seen before."""
    seen, out = {}, defaultdict(set)
    for doc, text in docs:
        lines = [(i, x, len(blank_words(x))) for i, x in enumerate((text or "").split("\n")) if blank_words(x)]
        for a in range(len(lines)):
            total, b = 0, a
            while b < len(lines) and total < min_words:
                total += lines[b][2]
                b += 1
            if total < min_words:
                break
            key = tuple(x for _, x, _ in lines[a:b])
            if seen.setdefault(key, (doc, a)) != (doc, a):
                out[doc] |= set(range(lines[a][0], lines[b - 1][0] + 1))
    return {doc: sorted(x) for doc, x in out.items()}


def simhash(text, size=4):
    words = [w for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs, radius=4):
    prints = {doc: simhash(text) for doc, text in docs}
    root = {doc: doc for doc in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {doc: (f"{prints[doc]:016x}", find(doc)) for doc in ids}


def similar_groups(docs, size=5, similarity=0.8):
    """Smallest id of each document's group, linked by the Jaccard similarity of word shingle sets, pair by pair."""
    sets = {}
    for doc, text in docs:
        words = blank_words(low(text))
        sets[doc] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= similarity * (len(sets[a]) + len(sets[b]) - both):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {doc: find(doc) for doc in ids}
