"""Plain versions of the operators for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded_words(text):
    return WORD.findall((text or "").translate(FOLD))


def shingles(words, size=5):
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_copies(docs):
    sets = {d: frozenset(shingles(folded_words(x))) for d, x in docs}
    where, links = defaultdict(list), []
    for doc in sorted(sets):
        shared = Counter()
        for h in sets[doc]:
            shared.update(where[h])
            where[h].append(doc)
        links += [
            (doc, o) for o, k in shared.items() if 100 * k >= 75 * (len(sets[doc]) + len(sets[o]) - k)
        ]
    group = components(links, sets)
    return {d: (len(s), group[d]) for d, s in sets.items()}


def repeated_lines(docs):
    """(n_lines, n_removed, n_spans, kept text) by document."""
    first, out = {}, {}
    lines = {d: [] if x is None else x.split("\n") for d, x in docs}
    filled = {d: [i for i, line in enumerate(ls) if line.strip()] for d, ls in lines.items()}
    for d in sorted(lines):
        for p in range(len(filled[d]) - 2):
            first.setdefault(tuple(lines[d][filled[d][p + k]] for k in range(3)), (d, p))
    for d, x in docs:
        hit = set()
        for p in range(len(filled[d]) - 2):
            if first[tuple(lines[d][filled[d][p + k]] for k in range(3))] != (d, p):
                hit |= {p, p + 1, p + 2}
        gone = {filled[d][p] for p in hit}
        kept = None if x is None else "\n".join(v for i, v in enumerate(lines[d]) if i not in gone)
        out[d] = (len(lines[d]), len(hit), sum(p - 1 not in hit for p in hit), kept)
    return out


def contaminated(docs, items):
    found = set()
    bags = {}
    for i, x in items:
        words = folded_words(x)
        if words:
            bags[i] = (len(words), min(5, len(words)), Counter(shingles(words)))
    for d, x in docs:
        words = folded_words(x)
        for i, (n, k, bag) in bags.items():
            for start in range(max(1, len(words) - n + 1)):
                window = words[start : start + n]
                mine = Counter(tuple(window[j : j + k]) for j in range(len(window) - k + 1))
                shared = sum((mine & bag).values())
                if 100 * shared >= 75 * (sum(mine.values()) + sum(bag.values()) - shared):
                    found.add((d, i))
    return found


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    """Counts of the base kinds and their spans."""
    told, counts = [], []
    for kind, pattern in PII.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
        told += found
        counts.append(len(found))
    return (*counts, hashlib.sha256(",".join(told).encode()).hexdigest())


LICENSES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licensed(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    starts, labels = [], set()
    for phrase, label in LICENSES.items():
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += here
        labels |= {label} if here else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def cut_repeats(docs, length=50):
    """(n_bytes, n_removed, n_spans, kept bytes) by document."""
    first, out = {}, {}
    for d, x in sorted(docs):
        raw = (x or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], d)
    for d, x in docs:
        raw = (x or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), spans, bytes(c for c, g in zip(raw, gone) if not g))
    return out


def counted(text):
    """The counts of the base quality rules and whether they fail."""
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def _tree(nodes):
    """The top of a tree over nodes, and for each node its steps of (left, right)."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + 8, len(nodes))) for a in range(0, len(nodes), 8)]
        for run in runs:
            for i in run:
                step = ("".join(nodes[run[0] : i]), "".join(nodes[i + 1 : run[-1] + 1]))
                for one in owners[i]:
                    paths[one].append(step)
        owners = [[one for i in run for one in owners[i]] for run in runs]
        nodes = [_hash(*nodes[run[0] : run[-1] + 1]) for run in runs]
    return nodes[0], paths


def manifest(docs):
    """Rows (doc_id, source, lang, n_chars, text) to doc_id, leaf, subroot, root, proof, folded root
    and whether it is the root."""
    groups = defaultdict(list)
    for row in docs:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = _tree([trees[g][0] for g in order]) if order else (None, [])
    out = []
    for g, above in zip(order, upper):
        for (_, _, mine, row), path in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1]):
            path = path + above
            shown = mine
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                shown = leaf((*row[:4], None if row[4] is None else row[4].translate(FOLD)))
            for left, right in path:
                shown = _hash(left, shown, right)
            proof = _hash(*[a + b for a, b in path])
            out.append((row[0], mine, trees[g][0], root, proof, shown, shown == root))
    return out


def searched(docs, items, limit=20):
    """(item id, rank, doc id, score) of each item's best documents."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(d, Counter(term.findall((x or "").translate(FOLD)))) for d, x in docs]
    bags = [(d, bag) for d, bag in bags if bag]
    count, length = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item, text in items:
        mine = term.findall((text or "").translate(FOLD))
        found = []
        for d, bag in bags:
            m = 100 - 25 + 25 * sum(bag.values()) * count // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                * (1000000000 * bag[t] // (1000 * bag[t] + 12 * m))
                for t in mine
                if bag[t]
            )
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        out += [(item, k, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:limit], 1)]
    return out


def simhash(text):
    words = folded_words(text)
    hashes = [xxhash.xxh64_intdigest(" ".join(s), 42) for s in shingles(words, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def close_prints(prints, radius=4):
    """Component of each of some fingerprints."""
    known = sorted(set(prints))
    links = [(a, b) for i, a in enumerate(known) for b in known[:i] if (a ^ b).bit_count() <= radius]
    return components(links, known)
