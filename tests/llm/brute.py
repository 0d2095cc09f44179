"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SOLID = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def solid_words(text):
    return SOLID.findall((text or "").translate(LOWER))


def contaminated(documents, benchmark, width=10):
    """(doc_id, n_words, n_hit, item ids) per row of (doc_id, text)."""
    windows = defaultdict(set)
    for item, text in benchmark:
        w = alnum_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    for doc, text in documents:
        w, hit, items = alnum_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        yield doc, len(w), len(hit), tuple(sorted(items))


def nearest(rows, queries, k):
    """{query id: [(vec_id, score)]} of the valid rows (vec_id, vector)."""
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q, v in queries:
        s = x @ np.array(v, float)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """{source: target} by sharing the excess again until none is above its limit."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in open_}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= full
    return out


def shingles(text, width=5):
    w = solid_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard_components(documents, percent=75, width=5):
    """{row number: (doc_id, set size, component)} of rows (doc_id, text)."""
    sets = [shingles(t, width) for _, t in documents]
    up = {d: d for d, _ in documents}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(documents[i][0]), root(documents[j][0])))
                up[b] = a
    return [(d, len(s), root(d)) for (d, _), s in zip(documents, sets, strict=True)]


def base_licenses(text, phrases):
    w = alnum_words(text)
    found = []
    for phrase, label in phrases.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    labels = ",".join(sorted({x for _, x in found}))
    return len(w), len(found), min(at, default=None), max(at, default=None), labels


def archived(pages, least=100):
    """(page_id, bytes, digest, type, refers_to) per row of (page_id, html)."""
    first = {}
    for page, html in pages:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            first[data] = min(page, first.get(data, page))
    for page, html in pages:
        data = (html or "").encode()
        revisit = len(data) >= least and first.get(data, page) != page
        yield page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[data] if revisit else None


def in_part(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    y = np.asarray(labels) == 1
    return (ranks[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


def secrets(text, reach):
    """(n_assign, n_access, n_hex, base spans, spans) by all pairs of parts."""
    base = []
    assign = re.compile(
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    base += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    weak = []
    for m in re.finditer("[A-Za-z0-9+/=_.-]+", text):
        key = re.fullmatch("([A-Za-z0-9+/]{40})(?:\\..*)?", m[0])
        if key and all(re.search(s, key[1]) for s in ("[0-9]", "[A-Z]", "[a-z]")):
            weak.append((m.start(), 3, m.start() + 40))
    names = "user|username|user_name|login|account|client_?id|access_?key_?id"
    weak += [
        (m.start(), 4, m.end())
        for m in re.finditer(f"(?a)(?i)(?<![a-z0-9])(?:{names})[\"']?\x20*[:=]\x20*[\"']?[a-z0-9+/_.@-]{{3,}}".replace("(?a)(?i)", "(?ai)"), text)
    ]
    address = "[a-z][a-z0-9+]{1,15}://[^\x00-\x20\"'<>]+|(?<![A-Za-z0-9.-])(?:[A-Za-z0-9-]+\\.)+[A-Za-z]{2,}:[0-9]{2,5}"
    weak += [(m.start(), 5, m.end()) for m in re.finditer(address, text)]
    weak = [p for p in weak if not any(b[0] < p[2] and p[0] < b[2] for b in base)]
    ends = [m.end() for m in re.finditer("\n[\x20\t\r]*\n", text)]
    block = lambda p: sum(e <= p[0] for e in ends)
    kept = set(base)
    for i in base + weak:
        if i[1] not in (1, 4):
            continue
        near = [
            p
            for p in base + weak
            if p[1] not in (1, 4) and block(p) == block(i) and i[0] - reach <= p[0] <= i[2] + reach
        ]
        if any(p[1] != 5 for p in near):
            kept |= {i, *near}
    names = ("assign", "access", "hex", "key", "login", "endpoint")
    spans = lambda parts: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(parts))
    return (*(sum(p[1] == k for p in base) for k in range(3)), spans(base), spans(kept))


def infilled(doc, text):
    """(units, form, prefix characters, middle characters, output)."""
    units = re.findall("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+", text)
    digits = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def runs(w, least=12):
    """(start, length, period) by trying every period."""
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            s, length = i, j - i + q
            if j > i and length >= max(least, 2 * q):
                if not any(all(w[k] == w[k + d] for k in range(s, s + length - d)) for d in range(1, q)):
                    out.append((s, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in dropped]
