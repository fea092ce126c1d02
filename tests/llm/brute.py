"""The contracts stated plainly, one document or all pairs at a time."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    words = WORD.findall(text or "")
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered),
        failed,
    )


def simhash(text, size=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [words[i : i + size] for i in range(max(len(words) - size + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, most=4):
    """The smallest index that each print reaches."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= most:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort()
    kinds = ("assign", "access", "hex")
    listed = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
    counts = [sum(k == n for _, k, _ in found) for n in range(3)]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest(), listed)
