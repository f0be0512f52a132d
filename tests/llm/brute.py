"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows, size, percent):
    """Component of each (id, text): the smallest id reachable, by comparing all
    pairs that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(rows))]


def _rotated(h):
    return ((h << 1) | (h >> 63)) & (1 << 64) - 1


def chunks(text, one_in, long_line):
    """(text, lines, words) of each content-defined chunk."""
    def words(s):
        s = s.strip(" ")
        return s.count(" ") + 1 if s else 0

    lines = text.split("\n")
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in lines]

    def pair(i):
        before = _rotated(h[i - 1]) if i > 0 else 0
        x = before ^ h[i]
        x -= (1 << 64) * (x >> 63)
        return x % one_in == 0

    out, begin = [], 0
    for i, line in enumerate(lines):
        is_long = words(line) >= long_line
        next_long = i + 1 == len(lines) or words(lines[i + 1]) >= long_line
        if is_long or next_long or (i > 0 and pair(i) and not pair(i - 1)):
            part = "\n".join(lines[begin:i + 1])
            out.append((part, i + 1 - begin, words(part)))
            begin = i + 1
    return out


def dedup(rows, m):
    """New text of each (id, text): chunks that occur before, by bytes, go. The
    first is the smallest by id, then hash of id and text, then place; ``m`` is
    the operator's module, for its constants."""
    def key(d, t):
        seed = 42 if d is None else xxhash.xxh64_intdigest(d.to_bytes(8, "little", signed=True), seed=42)
        h = xxhash.xxh64_intdigest(t.encode(), seed=seed)
        return h - (1 << 64) * (h >> 63)

    first = {}
    for d, t in rows:
        for k, (part, lines, words) in enumerate(chunks(t, m.ONE_IN, m.LONG_LINE) if t is not None else []):
            if (lines >= m.MIN_LINES and words >= m.MIN_WORDS) or words >= m.LONG_LINE:
                place = (d is not None, d or 0, key(d, t), k)
                first[part] = min(first.get(part, place), place)
    out = []
    for d, t in rows:
        if t is None:
            out.append(None)
            continue
        stay = [part for k, (part, _, _) in enumerate(chunks(t, m.ONE_IN, m.LONG_LINE)) if first.get(part, (d is not None, d or 0, key(d, t), k)) == (d is not None, d or 0, key(d, t), k)]
        out.append("\n".join(stay))
    return out


def url_verdict(url, rules, default):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def contains_item(text, item, bag_of_words):
    """The item's words stand in the text one after the other."""
    a, b = bag_of_words(text), bag_of_words(item)
    return bool(b) and any(a[i:i + len(b)] == b for i in range(len(a) - len(b) + 1))
