"""Plain versions of the contracts, row by row, to hold the operators against."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text)


def reach(nodes, linked):
    """Smallest node reachable, by flooding."""
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = n
                todo += linked(x)
    return out


def simhash(docs, words=3, bits=2):
    """[(id, text)] -> [(id, hex, component id)]."""
    fps = []
    for _, text in docs:
        w = SPACE_WORD.findall(lower(text or ""))
        shingles = [" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0)
    distinct = sorted(set(fps))
    arr = np.array(distinct, dtype=np.uint64)
    near = {f: [distinct[j] for j in np.flatnonzero(np.bitwise_count(arr ^ np.uint64(f)) <= bits)] for f in distinct}
    root = reach(distinct, near.get)
    ids = {}
    for (i, _), f in zip(docs, fps):
        if i is not None:
            ids[root[f]] = min(i, ids.get(root[f], i))
    return [(i, f"{f:016x}", ids.get(root[f])) for (i, _), f in zip(docs, fps)]


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    """[(id, text)], [(id, text)] -> [(id, n_words, n_hit, n_items, sha256, contaminated)]."""
    windows = {}
    for i, text in items:
        w = BENCH_WORD.findall(lower(text or ""))
        for at in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[at:at + window]), set()).add(str(i) if i is not None else "null")
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        w, hit, found = BENCH_WORD.findall(lower(text or "")), set(), set()
        for n in lengths:
            for at in range(len(w) - n + 1):
                got = windows.get(tuple(w[at:at + n]))
                if got:
                    found |= got
                    hit |= set(range(at, at + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def pii_spans(text):
    """[(start, kind number, end)] of the base patterns."""
    out = []
    for k, (kind, pattern) in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                luhn = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
                if not 12 <= len(digits) <= 19 or luhn % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: size} -> {source: target}, by sharing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped, free = sum(sizes.values()), {}, set(order)
    while free:
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {**capped, **share}
        capped |= {s: float(most * sizes[s]) for s in over}
        free -= over
    return capped


def cosine(rows, threshold=0.9):
    """[(id, vector)] -> [(id, n_links, component id, kept)]."""
    fine = []
    for k, (_, v) in enumerate(rows):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        fine.append(k)
    links = {k: [] for k in range(len(rows))}
    for n in {len(rows[k][1]) for k in fine}:
        of = [k for k in fine if len(rows[k][1]) == n]
        x = np.array([rows[k][1] for k in of], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        close = x @ x.T >= threshold
        np.fill_diagonal(close, False)
        for i, k in enumerate(of):
            links[k] = [of[j] for j in np.flatnonzero(close[i])]
    root = reach(range(len(rows)), links.get)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[root[k]] = min(i, ids.get(root[k], i))
    return [(i, len(links[k]), ids.get(root[k]), i is not None and ids.get(root[k]) == i) for k, (i, _) in enumerate(rows)]


def spelling(docs):
    """[(id, text)] -> [(word, form, root, n, n_near, form_n)]."""
    import zlib
    n = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    less = {}
    for w in n:
        for k in range(len(w)) if len(w) < 1000 else range(1):
            less.setdefault((k, w[:k] + w[k + 1:]), []).append(w)
    near = {w: set() for w in n}
    for group in less.values():                       # replaced
        for w in group:
            near[w] |= {*group} - {w}
    for w in n:                                       # deleted, and so inserted
        for k in range(len(w)) if len(w) < 1000 else range(1):
            s = w[:k] + w[k + 1:]
            if s in n:
                near[w].add(s)
                near[s].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def codes(rows, parts=8, entries=16, rounds=6):
    """[(id, vector, label)] -> ([(id, codes, error, label error)], codebooks), in Python integers."""
    import math
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    kept, first = ([(i, v + [0] * (parts * width - len(v)), label) for i, v, label in r] for r in (kept, first))
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(p, cut(v, p))[0], []).append(cut(v, p))
            new.append([[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])])
        books = new
    done = [[nearest(p, cut(v, p)) for p in range(parts)] for _, v, _ in kept]
    total = {}
    for (_, _, label), d in zip(kept, done):
        total[label] = total.get(label, 0) + sum(e for _, e in d)
    return [(i, tuple(k for k, _ in d), sum(e for _, e in d), total[label]) for (i, _, label), d in zip(kept, done)], books


def toxic_score(text, model, s):
    """A text's probability from the trained logits of its subwords."""
    counts = {}
    for run in re.findall(r"\w+", (text or "").lower()):
        for at in range(0, len(run), 64):
            word = run[at:at + 64]
            counts[word] = counts.get(word, 0) + 1
    z = model.bias
    if counts:
        roots = {w: c ** 0.5 for w, c in counts.items()}
        total = 0.0
        for w, r in roots.items():
            marked = f"<{w}>"
            grams = [marked]
            for n in range(s.shortest, min(s.longest, len(marked) - 1) + 1):
                grams += [marked[i:i + n] for i in range(len(marked) - n + 1)]
            total += r * sum(model.logit.get(g, 0.0) for g in grams) / len(grams)
        z += s.scale * total / (sum(roots.values()) + s.blanks)
    return 1 / (1 + np.exp(-z))


def repeats(docs, place, weights=(1, 2, 3), most=3):
    """[(id, text, source)] and {id: place in the shuffle} -> how often each
    document's first word is taken: a source is read round and round in shuffled
    order until its target is used up."""
    sizes = [len(SPACE_WORD.findall(t or "")) for _, t, _ in docs]
    total = {}
    for (_, _, source), n in zip(docs, sizes):
        total[source] = total.get(source, 0) + n
    want = targets(total, weights, most)
    out = [0] * len(docs)
    for source, size in total.items():
        if not size:
            continue
        words = min(int(want[source] + 0.5), most * size)
        at = 0
        for k in sorted((k for k, d in enumerate(docs) if d[2] == source and sizes[k]), key=lambda k: place[docs[k][0]]):
            out[k] = words // size + (at < words % size)
            at += sizes[k]
    return out


def shards(docs, limit):
    """[(id, bytes)] -> prefixes of at most 60 hash bits: a bucket over the limit is cut
    on its next bit. Only equal ids are left together at 60."""
    bits = [f"{int(hashlib.md5(('' if i is None else str(i)).encode()).hexdigest()[:15], 16):060b}" for i, _ in docs]
    out = [""] * len(docs)
    todo = [("", list(range(len(docs))))]
    while todo:
        prefix, rows = todo.pop()
        if sum(docs[k][1] for k in rows) > limit and len(rows) > 1 and len(prefix) < 60:
            for bit in "01":
                half = [k for k in rows if bits[k][len(prefix)] == bit]
                if half:
                    todo.append((prefix + bit, half))
        else:
            for k in rows:
                out[k] = prefix
    return out
