"""Plain slow versions of the operators, for comparison."""

import hashlib
import re
import zlib


def decontaminate(docs, items):
    """docs: [(id, text)], items: [(id, text)] -> {id: (n_words, n_hit, items)}"""
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    windows = []
    for item, text in items:
        w = cut(text)
        n = min(10, len(w))
        windows += [(str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1)] if w else []
    by = {}
    for item, window in windows:
        by.setdefault(window, set()).add(item)
    lengths = {len(w) for w in by}
    out = {}
    for key, text in docs:
        w = cut(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in by:
                    hit.update(range(i, i + n))
                    found |= by[tuple(w[i : i + n])]
        out[key] = (len(w), len(hit), sorted(found))
    return out


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(docs, percent=85):
    """[(id, text)] -> {id: (n_shingles, component_id)}"""
    sets = {key: shingles(text) for key, text in docs}
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = [k for k in sorted(sets) if sets[k]]
    owners = {}
    for k in keys:
        for s in sets[k]:
            owners.setdefault(s, []).append(k)
    for i, a in enumerate(keys):
        common = {}
        for s in sets[a]:
            for b in owners[s]:
                if b > a:
                    common[b] = common.get(b, 0) + 1
        for b, n in common.items():
            if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def dedup_lines(docs, min_words=8):
    """[(id, text)] -> {id: (n_lines, n_exact, n_near, text)}; ids ascending and distinct"""
    first, order = {}, []
    norm = lambda line: tuple(re.sub(r"\s+", " ", line.lower()).split())
    for key, text in sorted(docs):
        for no, line in enumerate((text or "").split("\n")):
            w = norm(line)
            if w and w not in first:
                first[w] = (key, no)
                order.append(w)
    near, seen = set(), {}
    for w in order:
        if len(w) < min_words:
            continue
        cuts = {(len(w), i, w[:i] + w[i + 1 :]) for i in range(len(w))}
        if any(c in seen for c in cuts) or any(c[2] in seen and len(c[2]) >= min_words for c in cuts) or (len(w), w) in seen:
            near.add(w)
        for c in cuts:
            seen[c] = 1
            seen[(len(c[2]), c[2])] = 1  # a shorter line equal to this one without a word
        seen[w] = 1
    out = {}
    for key, text in docs:
        lines = (text or "").split("\n")
        exact = [i for i, x in enumerate(lines) if norm(x) and first[norm(x)] != (key, i)]
        gone = [i for i, x in enumerate(lines) if norm(x) in near and i not in exact]
        kept = [x for i, x in enumerate(lines) if i not in exact and i not in gone]
        out[key] = (0 if text is None else len(lines), len(exact), len(gone), None if text is None else "\n".join(kept))
    return out


def repeated_spans(docs, n=50):
    """[(id, text)] -> {id: (n_bytes, n_removed, n_spans, sha256)}"""
    least = {}
    data = {key: (text or "").encode() for key, text in docs}
    for key in sorted(data):
        b = data[key]
        for i in range(len(b) - n + 1):
            least.setdefault(b[i : i + n], key)
    out = {}
    for key, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if least[b[i : i + n]] < key:
                gone[i : i + n] = b"\1" * n
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[key] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shard_rows(docs, shards=16, whole_groups=32):
    """[(id, text)] -> [(id, size, crc, shard, slot)] in order; ids ascending, null first"""
    rows = []
    for key, text in docs:
        data = (text or "").encode()
        k1 = -1 if text is None else int(hashlib.md5(data).hexdigest()[:15], 16)
        rows.append((k1, key is not None, key or 0, len(data) + 1, zlib.crc32(data)))
    rows.sort()
    total = sum(r[3] for r in rows)
    starts, at = [], 0
    for r in rows:
        starts.append(at)
        at += r[3]
    limits = []
    for i in range(1, shards):
        cut = i * total // shards
        for k1 in {r[0] for r in rows}:
            own = [(s, s + r[3]) for s, r in zip(starts, rows) if r[0] == k1]
            low, high = own[0][0], own[-1][1]
            if low <= cut < high and (high - low) * shards * whole_groups <= total:
                cut = low if 2 * (cut - low) <= high - low else high
                break
        limits.append(cut)
    out, slots = [], {}
    for start, (_, known, key, size, crc) in zip(starts, rows):
        shard = sum(2 * cut <= 2 * start + size for cut in limits)
        slot = slots[shard] = slots.get(shard, -1) + 1
        out.append((key if known else None, size, crc, shard, slot))
    return out


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(nodes):
    """All levels of a tree, from the leaves to the single root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_digest(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return levels


def _climb(levels, at, own):
    """(folded root, siblings) of node ``at`` of the lowest level, if it were ``own``."""
    met = ""
    for level in levels[:-1]:
        first = at - at % 3
        run = level[first : first + 3]
        met += "".join(run[: at % 3] + run[at % 3 + 1 :])
        own, at = _digest(*run[: at % 3], own, *run[at % 3 + 1 :]), at // 3
    return own, met


def manifest(docs):
    """[(id, source, lang, n_chars, text)] -> sorted [(id, leaf, subroot, root, proof, folded, verified)]; ids not null"""
    by = {}
    for row in docs:
        by.setdefault(row[1], []).append((row[0], _leaf(row), row))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        by[name].sort(key=lambda r: r[:2])
        trees[name] = _tree([r[1] for r in by[name]])
    top = _tree([trees[name][-1][0] for name in names])
    out = []
    for no, name in enumerate(names):
        for at, (key, digest, row) in enumerate(by[name]):
            cut = row[:4] + (None if row[4] is None else row[4].replace("\n", ""),)
            shown = _leaf(cut) if zlib.crc32(str(key).encode()) % 2 == 0 else digest
            low, met = _climb(trees[name], at, shown)
            folded, more = _climb(top, no, low)
            out.append((key, digest, trees[name][-1][0], top[-1][0], _digest(met + more), folded, folded == top[-1][0]))
    return sorted(out)


def divergence(docs, top=200):
    """[(text, lang, source)] -> sorted [(lang, source, part, item, value, rank)]"""
    low = {c: c + 32 for c in range(65, 91)}
    by = {}
    for text, lang, source in docs:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        by.setdefault(lang or "", []).append((source or "", words))
    out = []
    for lang, rows in by.items():
        met = {}
        for _, words in rows:
            for word in set(words):
                met[word] = met.get(word, 0) + 1
        kept = sorted(w for w, n in met.items() if n >= 3)
        counts = {}
        for source, words in rows:
            mine = counts.setdefault(source, dict.fromkeys(kept, 0))
            for word in words:
                if word in mine:
                    mine[word] += 1
        every = {w: sum(c[w] for c in counts.values()) for w in kept}
        share = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(every)
        f = lambda a, b: (a - b) ** 2 // b
        for source, c in counts.items():
            pairs = [(t, sum(f(p[source][w], p[t][w]) for w in kept)) for t in counts if t != source]
            terms = [(w, f(p[source][w], q[w])) for w in kept if c[w] and p[source][w] > q[w]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)
