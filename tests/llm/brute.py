"""Plain, slow versions of the operators, on lists of rows."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256

import xxhash

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def contamination(text, items, window=13):
    """n_words, n_hit, n_items, items_sha256, contaminated."""
    words = WORD.findall((text or "").translate(CAPITALS))
    hit, found = set(), set()
    for item_id, item_text in items:
        own = WORD.findall((item_text or "").translate(CAPITALS))
        size = min(window, len(own))
        if not size or item_id is None:
            continue
        starts = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
        for at in range(len(words) - size + 1):
            if tuple(words[at : at + size]) in starts:
                hit.update(range(at, at + size))
                found.add(str(item_id))
    digest = sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words)


def fingerprint(text, shingle=3):
    words = BLANK_WORD.findall((text or "").translate(CAPITALS))
    if not words:
        return 0
    grams = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    counts = Counter(bit for g in grams for bit in range(64) if xxhash.xxh64_intdigest(g.encode(), 42) >> bit & 1)
    return sum(1 << bit for bit, n in counts.items() if 2 * n > len(grams))


def groups(nodes, linked):
    """Smallest reachable node of each, by plain search; linked(a, b) says whether two nodes link."""
    label = {}
    for node in sorted(nodes):
        if node in label:
            continue
        label[node], queue = node, [node]
        while queue:
            a = queue.pop()
            for b in nodes:
                if b not in label and linked(a, b):
                    label[b] = node
                    queue.append(b)
    return label
