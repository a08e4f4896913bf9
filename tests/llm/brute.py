"""The operators written out plainly, for small tables."""

from __future__ import annotations

import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def fingerprint(text, length=3):
    found = words(lower(text))
    if not found:
        return 0
    length = min(length, len(found))
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + length]).encode(), 42) for i in range(len(found) - length + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    """For each value the smallest place that links lead to."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def components(texts, max_bits=3):
    return groups([fingerprint(x) for x in texts], lambda a, b: bin(a ^ b).count("1") <= max_bits)


def removed_lines(rows, similarity=0.8):
    """rows: (doc_id, text) with distinct ids. For each the numbers of lines that go."""
    lines = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for no, line in enumerate((text or "").split("\n")):
            if own := set(words(line)):
                lines.append((doc_id, no, own))
    gone = {doc_id: [] for doc_id, _ in rows}
    for i, (doc_id, no, own) in enumerate(lines):
        if any(len(own & x) >= similarity * len(own | x) - 1e-12 for _, _, x in lines[:i]):
            gone[doc_id].append(no)
    return gone


def hit_words(text, items, window=10):
    """Places of hit words, and the items that hit."""
    own, places, found = plain_words(text), set(), set()
    for item_id, item in items:
        other = plain_words(item)
        width = min(window, len(other))
        windows = {tuple(other[i : i + width]) for i in range(len(other) - width + 1)} if width else set()
        for i in range(len(own) - width + 1):
            if width and tuple(own[i : i + width]) in windows:
                places.update(range(i, i + width))
                found.add(item_id)
    return places, found


def rule_counts(text):
    own = words(text)
    windows = {}
    for i in range(len(own) - 4):
        windows.setdefault(tuple(own[i : i + 5]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {
        "n_words": len(own),
        "word_chars": sum(map(len, own)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
