"""Slow and plain versions of the operators' results, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORDS.findall(lower(text))


def decontaminated(docs, items):
    """{doc: (n_words, n_hit, n_items, sha256, contaminated)}."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if at := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= at
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


def base_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = PLAIN.findall(text)
    lines = [x for x in text.split("\n") if PLAIN.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 8)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
