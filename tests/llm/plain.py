"""Plain versions of operators, for small inputs."""

import re
import string
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text, width):
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_duplicates(texts, width, per_cent):
    """key -> (size of its set, least key of its component); links are found by shared shingles."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, own in sets.items():
        shared = Counter(j for s in own for j in holders[s] if j > i)
        for j, n in shared.items():
            if 100 * n >= per_cent * (len(own) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(own), root(i)) for i, own in sets.items()}


def base_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
    }


def site_lines(pages, most_share, least_pages, least_hits, most_lost=1.0):
    """key -> (host, text) without boilerplate lines, from key -> (host, text)."""
    once = {(host, text or "") for host, text in pages.values()}
    sizes = Counter(host for host, _ in once)
    solid = lambda line: line.strip(" \t\r\f\v")
    hits = Counter(
        (host, line) for host, text in once for line in set(text.split("\n")) if solid(line)
    )

    def bad(host, line):
        n, of = hits[host, line], sizes[host]
        return bool(solid(line)) and of >= least_pages and n >= least_hits and n > most_share * of

    def cut(host, text):
        lines = text.split("\n")
        kept = [x for x in lines if not bad(host, x)]
        spared = len(lines) - len(kept) > most_lost * sum(bool(solid(x)) for x in lines)
        return text if spared else "\n".join(kept)

    return {key: (host, None if text is None else cut(host, text)) for key, (host, text) in pages.items()}


def schedule(weights, periods=1):
    """Slots of a Pfair schedule: the released block with the earliest deadline, then the first
    source.
    """
    total = sum(weights)
    taken, out = [0] * len(weights), []
    for slot in range(total * periods):
        open_ = [
            (-(-(taken[i] + 1) * total // w), i) for i, w in enumerate(weights) if taken[i] * total // w <= slot
        ]
        _, i = min(open_)
        taken[i] += 1
        out.append(i)
    return out


def runs(symbols, least_length, least_periods):
    """(start, length, period) of all runs, by trying every period."""
    n, stretches = len(symbols), {}
    for q in range(1, n // 2 + 1):
        start = None
        for i in range(n - q + 1):
            same = i + q < n and symbols[i] == symbols[i + q]
            if same and start is None:
                start = i
            elif not same and start is not None:
                # Of stretches with the same ends, the first period found is the smallest.
                stretches.setdefault((start, i + q - start), q)
                start = None
    long = [(s, m, q) for (s, m), q in stretches.items() if m >= max(least_length, least_periods * q)]
    return sorted(long, key=lambda r: (r[0], r[2]))


CONTAMINATION_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(texts, items, window):
    """For each text: words, words inside a window of an item, and the items found."""
    words = lambda text: CONTAMINATION_WORDS.findall((text or "").translate(LOWER))
    holders = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1)):
            if own:
                holders[tuple(own[i : i + window])].add(item)
    sizes = {len(w) for w in holders}
    out = []
    for text in texts:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                got = holders.get(tuple(own[i : i + size]))
                if got:
                    hit.update(range(i, i + size))
                    found |= got
        out.append((len(own), len(hit), sorted(found)))
    return out
