"""Plain versions of the contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def byte_repeats(docs, window=100):
    """{place in docs: (n_bytes, n_removed, n_spans, sha256)}; docs: (id, text), ids distinct."""
    first = {}
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0))
    out = {}
    for k in order:
        data = (docs[k][1] or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - window + 1):
            if data[at : at + window] in first:
                gone[at : at + window] = [True] * window
            else:
                first[data[at : at + window]] = k
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[k] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def word_repeats(docs, window=50):
    first = {}
    words = [WORD.findall(t or "") for _, t in docs]
    key = lambda i: (i is not None, i or 0)
    for (i, _), w in zip(docs, words, strict=True):
        for at in range(len(w) - window + 1):
            x = tuple(w[at : at + window])
            first[x] = min(first.get(x, key(i)), key(i))
    out = {}
    for k, ((i, _), w) in enumerate(zip(docs, words, strict=True)):
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < key(i):
                gone[at : at + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near(docs, percent=85):
    sets = []
    for _, t in docs:
        w = WORD.findall(lower(t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    by = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            by[x].add(k)
    tried = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        label[root(b)] = root(a)
    lowest = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            lowest[root(k)] = min(lowest.get(root(k), i), i)
    return {k: (len(sets[k]), lowest.get(root(k)), lowest.get(root(k)) == i) for k, (i, _) in enumerate(docs)}


def leaks(docs, items, window=10):
    out = {}
    shapes = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(lower(text or ""))
        for at in range(max(len(w) - window, 0) + 1) if w else ():
            shapes[tuple(w[at : at + window])].add(item)
    lengths = {len(x) for x in shapes}
    for k, (_, text) in enumerate(docs):
        w = ITEM_WORD.findall(lower(text or ""))
        hit, found = [False] * len(w), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                x = tuple(w[at : at + n])
                if x in shapes:
                    hit[at : at + n] = [True] * n
                    found |= shapes[x]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out[k] = (len(w), sum(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), any(hit))
    return out


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    times = defaultdict(list)
    for at in range(len(w) - 2):
        times[tuple(w[at : at + 3])].append(at)
    hit = {a + k for v in times.values() if len(v) > 1 for a in v for k in range(3)}
    n = len(w)
    return (
        n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def robust(rows, q):
    """{place in rows: squared distance}; rows: (group, vector of whole numbers or None). ``q`` holds the constants."""
    import numpy as np

    least = np.array(list(q.FEATURES.values()))
    groups = defaultdict(list)
    for group, x in rows:
        if x is not None:
            groups[group].append(x)

    def floored(cov):
        values, axes = np.linalg.eigh(cov / np.outer(least, least))
        return cov if values[0] >= 1 else (axes * np.maximum(values, 1)) @ axes.T * np.outer(least, least)

    def distances(x, mean, cov):
        gap = x / q.UNIT - mean
        return np.maximum(np.einsum("ni,ij,nj->n", gap, np.linalg.inv(cov), gap), 0)

    def weighted(x, w, share):
        mean = w @ x / w.sum()
        cov = (x * w[:, None]).T @ x / w.sum() - np.outer(mean, mean)
        return mean / q.UNIT, cov / q.UNIT**2 * q._consistency(share)

    def concentrate(x, mean, cov, share):
        last = np.inf
        while True:
            bins = np.floor(np.log2(np.maximum(distances(x, mean, cov), q.LEAST_DISTANCE)) * q.BINS)
            want, w = share * len(x), np.zeros(len(x))
            for b in np.unique(bins):
                here = bins == b
                w[here] = min(1, max(0, want / here.sum()))
                want -= min(want, here.sum())
            new_mean, new_cov = weighted(x, w, share)
            new_cov = floored(new_cov)
            new = np.linalg.slogdet(new_cov)[1]
            if not new < last - q.MIN_FALL:
                return last, mean, cov
            mean, cov, last = new_mean, new_cov, new if share == q.SHARE else np.inf
            share = q.SHARE

    ends, sums = {}, {}
    for group, vectors in groups.items():
        x = np.array(vectors, float)
        low, mid, high = (np.sort(x, axis=0)[max(0, int(np.ceil(len(x) * p)) - 1)] / q.UNIT for p in (0.25, 0.5, 0.75))
        wide = np.diag(np.maximum((high - low) / 1.349, least) ** 2)
        plain = weighted(x, np.ones(len(x)), 1.0)
        starts = [(mid, wide, q.SHARE), (mid, wide, 0.5), (plain[0], floored(plain[1]), q.SHARE)]
        _, mean, cov = min((concentrate(x, *s) for s in starts), key=lambda e: e[0])
        sums[group] = x[distances(x, mean, cov) <= q._quantile(1 - q.WITHIN)]
    held = np.concatenate(list(sums.values()))
    all_mean, all_cov = weighted(held, np.ones(len(held)), q.WITHIN)
    for group, x in sums.items():
        mean, cov = weighted(x, np.ones(len(x)), q.WITHIN)
        w = len(x) / (len(x) + q.PRIOR_ROWS)
        ends[group] = (w * mean + (1 - w) * all_mean, floored(w * cov + (1 - w) * all_cov))
    return {
        k: float(distances(np.array([x], float), *ends[group])[0]) for k, (group, x) in enumerate(rows) if x is not None}
