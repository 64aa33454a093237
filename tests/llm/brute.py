"""Plain versions of the operators, one document at a time."""

import itertools
import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = ([" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]) if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(prints, radius=3):
    """{doc_id: (fingerprint, smallest id reachable)} for {doc_id: fingerprint}."""
    out, ids = {}, sorted(prints)
    for i in ids:
        if i in out:
            continue
        todo = [i]
        out[i] = (prints[i], i)
        while todo:
            a = todo.pop()
            for b in ids:
                if b not in out and (prints[a] ^ prints[b]).bit_count() <= radius:
                    out[b] = (prints[b], i)
                    todo.append(b)
    return out


def removals(docs, window=13):
    """{doc_id: (words kept, number removed)} of (doc_id, text) pairs with distinct ids."""
    seen, out = {}, {}
    for i, text in sorted(docs):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if seen.setdefault(tuple(words[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        out[i] = ([w for w, g in zip(words, gone) if not g], sum(gone))
    return out


def near_by_counting(texts):
    """{id: smallest id that pairs with 4/5 of their 5-word shingles in common reach}."""
    sets = {}
    for i, text in texts.items():
        w = (text or "").encode().lower().split()
        sets[i] = {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {b""}
    root = {i: i for i in sets}
    for i, j in itertools.combinations(sorted(sets), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
            low, high = sorted((root[i], root[j]))
            root = {k: low if r == high else r for k, r in root.items()}
    return root
