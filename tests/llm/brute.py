"""Plain restatements that the operators are compared with."""

import collections
import html
import math
import re

import zstandard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]


def groups(rows, width, percent=80):
    """key -> (set size, smallest key of its component)."""
    sets = {k: frozenset(shingles(t, width)) for k, t in rows}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = collections.defaultdict(list)
    for k in sorted(sets):
        common = collections.Counter(o for s in sets[k] for o in having[s])
        for s in sets[k]:
            having[s].append(k)
        for o, n in common.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[o]) - n):
                a, b = root(k), root(o)
                parent[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), root(k)) for k in sets}


def edited(rows):
    """key -> the text whose last quarter is the beginning of the next one's."""
    rows = sorted(rows)
    out = {}
    for i, (k, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(t) // 4
        out[k] = t[:len(t) - n] + after[:n]
    return out


def article(page):
    page = page or ""
    start, end = page.find("<article>"), page.find("</article>")
    inside = re.sub(r"<[^>]*\Z", "", page[start + 9:end if end >= 0 else len(page)])
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def word_counts(text):
    """(words, their characters, symbols, repeated lines, words in repeated windows of eight)."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def band_verdict(data, bands, chunk, fifth):
    """Whether a whole and all but a fifth of its chunks compress as their length lets expect."""
    def outside(part):
        ratio = len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)
        low, high = [(b, c) for a, b, c in bands if len(part) >= a][-1]
        return not low <= ratio <= high
    if not data:
        return True
    parts = [data[i:i + chunk] for i in range(0, len(data), chunk)] if len(data) > chunk else []
    parts = [p for p in parts if 2 * len(p) >= chunk]
    return not outside(data) and fifth * sum(map(outside, parts)) <= len(parts)


def terms(text, digits):
    kept = "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F" if digits else "\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F"
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(f"[^{kept}]+", text or "")]


def divergence(rows, least=10, top=10):
    """The rows of the audit, by exact integers and every kept term of every pair."""
    docs = [(lang or "", source or "", terms(text, False)) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = collections.Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= least]
        counts = {s: collections.Counter() for a, s, _ in docs if a == lang}
        for a, s, found in docs:
            if a == lang:
                counts[s].update(t for t in found if held[t] >= least)
        whole = sum(counts.values(), collections.Counter())

        def share(own):
            size = sum(own.values())
            return {t: 1 + 10**9 * (own[t] + 2) // (size + 2 * len(kept)) for t in kept}

        shares, q = {s: share(own) for s, own in counts.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, p in shares.items():
            pair = [(sum(f(p[t], other[t]) for t in kept), o) for o, other in shares.items() if o != s]
            more = [(f(p[t], q[t]), t) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found, limit in (("pair", pair, len(pair)), ("term", more, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered)]
    return sorted(out)


def search(docs, items, k=20):
    """(item, rank, document, score) of every item's best documents."""
    found = [(key, collections.Counter(terms(text, True))) for key, text in docs]
    sizes = [n.total() for _, n in found]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, n in found for t in n)
    out = []
    for item, text in items:
        scores = []
        for (key, own), n in zip(found, sizes, strict=True):
            score = sum(int(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 12 * (75 + 25 * n * n_docs // n_terms)))
                        for t in terms(text, True) if own[t])
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if null else key, -score) for i, (score, null, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=lambda r: tuple((x is None, x or 0) for x in r))


def mixed(rows, weights, place, block_hashes):
    """(document, copy) of a mix: each source's whole passes, then its longest beginning of the permutation that fits the rest of its quota.

    A source's rows lie in ceil(sqrt(rows)) blocks by their key; blocks are in the order of ``block_hashes``, rows of a block in that of ``place``.
    """
    of = collections.defaultdict(list)
    for doc, source, key, n in rows:
        of[source].append((doc, key, n))
    total = sum(n for r in of.values() for _, _, n in r)
    share = {s: sum(n for _, _, n in r) / total for s, r in of.items()}
    least = min(weights[s] / share[s] for s in of if share[s])
    out = set()
    for source, own in of.items():
        ratio = weights[source] / share[source] / least if share[source] else 1.0
        passes = math.floor(ratio + 1e-9)
        rest = math.floor(max((ratio - passes) * sum(n for _, _, n in own), 0.0) + 1e-6)
        blocks = math.isqrt(len(own) - 1) + 1
        order = block_hashes(blocks)
        out |= {(doc, c) for doc, _, _ in own for c in range(passes)}
        held = 0
        for doc, _, n in sorted(own, key=lambda r: (order[r[1] % blocks], place[r[1]])):
            held += n
            if held > rest or not rest:
                break
            out.add((doc, passes))
    return out


def sketch(text, width, scale, hash_of):
    """Sorted hashes of the distinct shingles that lie below 1 / scale of the range, or the smallest one."""
    hashes = sorted({hash_of(s) for s in shingles(text, width)})
    return [h for h in hashes if h < 2 ** 64 // scale] or hashes[:1]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def mix64(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2 ** 64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % 2 ** 64
    return x ^ (x >> 31)


def shingle_hash(words, width):
    rolled = 0
    for word in words:
        data, base = word.encode(), 0x9E3779B97F4A7C15
        own = sum((c + 1) * pow(base, k, 2 ** 64) for k, c in enumerate(data)) + mix64(len(data))
        rolled = (rolled * 0xD6E8FEB86659FD93 + mix64(own % 2 ** 64)) % 2 ** 64
    return mix64(rolled if len(words) == width else (rolled + len(words)) % 2 ** 64)
