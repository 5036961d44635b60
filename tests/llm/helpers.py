"""Brute-force versions and fixtures."""

import random

WORDS = [f"w{k}" for k in range(400)]


def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    out, word = [], ""
    for char in low + " ":
        if char in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += char
    return out


def shingles(text):
    words = words_of(text)
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


class Groups:
    def __init__(self):
        self.of = {}

    def find(self, a):
        self.of.setdefault(a, a)
        while self.of[a] != a:
            a = self.of[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)


def near_copies(seed, documents=60, words=60):
    """Texts with exact and near copies, short ones, and a passage that many share."""
    draw = random.Random(seed)
    passage = " ".join(draw.choice(WORDS) for _ in range(30))
    texts = []
    for _ in range(documents):
        kind = draw.random()
        if kind < 0.5 and texts:
            copy = words_of(draw.choice(texts))
            for _ in range(draw.choice([0, 1, 1, 2, 4])):
                if copy:
                    copy[draw.randrange(len(copy))] = draw.choice(WORDS)
            texts.append(" ".join(copy))
        elif kind < 0.7:
            texts.append(passage + " " + " ".join(draw.choice(WORDS) for _ in range(draw.randrange(words))))
        else:
            texts.append(" ".join(draw.choice(WORDS) for _ in range(draw.randrange(words))))
    return texts


def jaccard_components(rows):
    sets = {k: shingles(t) for k, t in rows}
    groups = Groups()
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                groups.join(a, b)
    return {k: (len(sets[k]), groups.find(k)) for k in ids}
