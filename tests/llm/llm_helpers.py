"""Brute-force versions that the operators are held against."""
import re


LONG = " ".join(f"w{i % 977}" for i in range(20_000))
ASCII_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(ASCII_LOW))


def prose(seed, n):
    return " ".join(f"t{(seed * 7919 + i * 104729) % 100_003}" for i in range(n))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in texts}
