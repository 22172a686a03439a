"""Plain Python versions of the operators, over lists of (doc_id, text)."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
NORMAL_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def space_words(text):
    return SPACE_WORD.findall((text or "").translate(LOWER))


def normal_words(text):
    return NORMAL_WORD.findall((text or "").translate(LOWER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def _mix(x):
    m = (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return x ^ x >> 31


def fingerprint(text, k, sketch=0):
    words = space_words(text)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    if sketch:
        hashes = [_mix(h ^ sketch * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for h in hashes]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_groups(docs, k, distance, sketches=1):
    prints = [(d, [fingerprint(t, k, s) for s in range(sketches)]) for d, t in docs]
    linked = [(a, b) for n, (a, p) in enumerate(prints) for b, q in prints[:n] if any((x ^ y).bit_count() <= distance for x, y in zip(p, q, strict=True))]
    return {d: p[0] for d, p in prints}, components([d for d, _ in docs], linked)


def cut_strings(docs, length=100):
    """doc_id: (n_bytes, runs removed, sha of the rest)."""
    seen, out = set(), {}
    for d, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if data[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(data[i : i + length])
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[d] = (len(data), int(gone.sum()), int((edges == 1).sum()), sha(bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return out


def cut_lines(docs, min_words=10):
    """doc_id: text less the lines in runs of min_words words that also start earlier."""
    occurrences, runs_of = defaultdict(list), {}
    for d, text in sorted(docs):
        lines = [(p, line.strip(" \t\n\x0b\f\r"), len(SPACE_WORD.findall(line))) for p, line in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        runs = set()
        for i in range(len(lines)):
            for j in range(i, min(i + min_words, len(lines))):
                if sum(x[2] for x in lines[i : j + 1]) >= min_words:
                    runs.add((i, j))
        runs_of[d] = [(lines[i][0], lines[j][0], tuple(x[1] for x in lines[i : j + 1])) for i, j in sorted(runs)]
        for a, _, content in runs_of[d]:
            occurrences[content].append((d, a))
    out = {}
    for d, text in docs:
        gone = {p for a, b, content in runs_of[d] if min(occurrences[content]) != (d, a) for p in range(a, b + 1)}
        out[d] = "\n".join(x for p, x in enumerate((text or "").split("\n")) if p not in gone)
    return out


def contamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = normal_words(text)
        for i in range(max(len(w) - width + 1, 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    out = {}
    for d, text in docs:
        w, hit, found = normal_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))))
    return out


def kneser_ney(train, docs):
    """doc_id: (tokens, known, training tokens, add-one score, score)."""
    words = Counter()
    pairs = Counter()
    for _, text in train:
        w = [*space_words(text), None]
        words.update(w)
        pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
    total, types = sum(words.values()), len(words)

    def discounts(counts):
        n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] else k * 0.5 for k in (1, 2, 3)]
        return [0.0, *[min(max(x, 0), k) for k, x in zip((1, 2, 3), d, strict=True)]]

    endings, contexts = Counter(w for _, w in pairs), defaultdict(list)
    for (v, _), c in pairs.items():
        contexts[v].append(c)
    d, e = discounts(pairs.values()), discounts(endings.values())
    left = sum(e[min(c, 3)] for c in endings.values()) / len(pairs) if pairs else 1

    def p(v, w):
        m = endings[w]
        lower = (m - e[min(m, 3)]) / max(len(pairs), 1) + left / (len(endings) + 1)
        if v not in contexts:
            return lower
        n, c = sum(contexts[v]), pairs[v, w]
        return (c - d[min(c, 3)]) / n + sum(d[min(x, 3)] for x in contexts[v]) / n * lower

    out = {}
    for i, text in docs:
        w = [*space_words(text), None]
        base = sum(math.log10((words[x] + 1) / (total + types + 1)) for x in w)
        out[i] = (len(w), sum(words[x] > 0 for x in w), total, base, sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w[:-1]], w, strict=True)))
    return out, p, list(words)


def licenses(text, rules, base):
    """n_words, base places, labels of base and all detections that no stronger one contains, and the largest weight."""
    words = normal_words(text)
    joined = " " + " ".join(words) + " " if words else " "

    def found(some, first):
        out = []
        for n, r in enumerate(some):
            if r.keyword in joined:
                for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", joined):
                    at = joined[: m.start()].count(" ") - 1
                    out.append((at, at + m.group().count(" ") + 1, r.label, r.priority, first + n, r.weight))
        return out

    places = found(base, 0)
    every = places + found(rules, len(base))
    rank = lambda x: (x[3], x[1] - x[0], -x[4], -x[0])
    strong = [x for x in every if not any(y[0] <= x[0] and y[1] >= x[1] and rank(y) > rank(x) for y in every)]
    return len(words), sorted(x[0] for x in places), {x[2] for x in places}, {x[2] for x in places + strong}, max([x[5] for x in places + strong], default=0.0)


def mixture(rows, powers, sweeps, seed="mix"):
    """rows: (doc_id, cell values, tokens). doc_id: (weight, probability, sampled)."""
    cells = Counter()
    for _, cell, tokens in rows:
        cells[cell] += tokens
    cells = {c: n for c, n in cells.items() if n}
    total = sum(cells.values())
    targets = []
    for m, power in enumerate(powers):
        sums = Counter()
        for c, n in cells.items():
            sums[c[m]] += n
        raised = {v: n**power for v, n in sums.items()}
        targets.append({v: x / sum(raised.values()) for v, x in raised.items()})
    factors = [dict.fromkeys(t, 1.0) for t in targets]
    for _ in range(sweeps):
        for m, target in enumerate(targets):
            now = Counter()
            for c, n in cells.items():
                now[c[m]] += n * math.prod(factors[o][c[o]] for o in range(len(powers)) if o != m)
            factors[m] = {v: target[v] * total / now[v] for v in target}
    weight = {c: math.prod(f[v] for f, v in zip(factors, c, strict=True)) for c in cells}
    largest = max(weight.values(), default=1)
    out = {}
    for d, cell, _ in rows:
        w = weight.get(cell, 0.0)
        p = round(w / largest, 6)
        u = int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) / 2**52
        out[d] = (w, p, u < p)
    return out


def trigrams(text):
    """Bins of letter trigrams with one gap at most, by plain loops over bytes."""
    b = [c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()]
    b = [c if 97 <= c <= 122 or c >= 128 else 32 for c in b]
    for x, y, z in zip(b, b[1:], b[2:]):
        if [x, y, z].count(32) < 2:
            yield ((x * 0x9E3779B1 & 0xFFFFFFFF) ^ (y * 0x85EBCA6B & 0xFFFFFFFF) ^ (z * 0xC2B2AE35 & 0xFFFFFFFF)) >> 17


def languages(rows, names, strength=20.0, bins=1 << 15):
    """{id: (language, posterior, text language)} of (id, text, declared, host) rows, all of them labels too."""
    counts = {k: Counter(t for _, text, told, _ in rows if told == k for t in trigrams(text)) for k in names}
    total = {k: sum(c.values()) + 0.5 * bins for k, c in counts.items()}
    suffixes = {"de": "de", "at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es", "fr": "fr"}
    labels = Counter((host, told) for _, _, told, host in rows if told in names)
    by_domain, by_language = Counter(), Counter()
    for (host, told), c in labels.items():
        by_language[told] += c
        if host is not None:
            by_domain[".".join(host.split(".")[-2:]), told] += c
    seen, out = {h for h, _ in labels if h is not None}, {}
    for row, text, told, host in rows:
        n, grams = len(names), list(trigrams(text))
        prior = [1 / n] * n
        if host in seen:
            domain = ".".join(host.split(".")[-2:])
            for level, weight in ((by_language, n), ({k: by_domain[domain, k] for k in names}, strength), ({k: labels[host, k] for k in names}, strength)):
                own = [level[k] - (k == told) for k in names]
                prior = [(c + p * weight) / (sum(own) + weight) for c, p in zip(own, prior)]
        scale = 1 / (1 + len(grams) / 200)
        text_log = [scale * sum(math.log((counts[k][t] + 0.5) / total[k]) for t in grams) for k in names]
        log = [x + math.log(0.99 * p) for x, p in zip(text_log, prior)] + [-scale * len(grams) * math.log(bins) + math.log(0.01)]
        hints = [(told if told in names else None if told is None else "other", 0.05), (suffixes.get(host.split(".")[-1]) if host else None, 0.3)]
        for hint, error in hints:
            if hint is not None:
                log = [x + math.log(1 - error if k == hint else error / n) for x, k in zip(log, [*names, "other"])]
        weights = [math.exp(x - max(log)) for x in log]
        best = max(range(n + 1), key=lambda k: weights[k])
        sure = max(weights) / sum(weights)
        und = not grams or sure < 0.5 or best == n
        out[row] = ("und" if und else names[best], sure, "und" if not grams else names[max(range(n), key=lambda k: text_log[k])])
    return out
