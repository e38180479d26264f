"""Brute-force forms of the operators, in plain Python, to compare results with."""

import math
import re
from collections import Counter


def chunks(text, size=512, overlap=64, least=50, seps=("\n\n", "\n", ". ", "! ", "? ", "; ")):
    """[(text, start, end)] of an already cleaned text; buffers are slices [a, b) of it."""
    cuts = [0]
    sep = next((s for s in seps if s in text), None)
    if sep:
        for m in re.finditer(re.escape(sep), text):
            cuts.append(m.end())
    cuts = sorted({*cuts, len(text)})
    spans = [(a + i, min(a + i + size, b)) for a, b in zip(cuts, cuts[1:]) for i in range(0, b - a, size)]

    def keep(a, b, out, needed):
        piece = text[a:b].strip()
        if len(piece) >= needed:
            out.append((piece, a, b))

    out, a, b = [], None, None
    for lo, hi in spans:
        if a is None:
            a, b = lo, hi
        elif (b - a) + (hi - lo) > size:
            keep(a, b, out, least)
            if overlap <= 0:
                a = b
            elif b - a > overlap:
                space = text.find(" ", b - overlap, b)
                a = space + 1 if space >= 0 else b - overlap
            b = hi
        else:
            b = hi
    if a is not None:
        keep(a, b, out, max(least, 1))
    return out


def words(text):
    return re.findall(r"\w+", text.lower())


def bm25(corpus, question):
    """Score of every text of the corpus."""
    docs = [Counter(words(t)) for t in corpus]
    n, mean = len(docs), sum(sum(d.values()) for d in docs) / len(docs)
    df = Counter(t for d in docs for t in d)
    idf = {t: math.log((n - f + 0.5) / (f + 0.5)) for t, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    return [
        sum(
            idf.get(t, 0.0) * d[t] * 2.5 / (d[t] + 1.5 * (0.25 + 0.75 * sum(d.values()) / mean))
            for t in words(question)
        )
        for d in docs
    ]


def ranked(scores, k):
    """Positions of the best k, ties in order of position."""
    return sorted(range(len(scores)), key=lambda i: (-round(scores[i], 9), i))[:k]


def alike(a, b, threshold):
    a, b = set(a.lower().split()), set(b.lower().split())
    return bool(a and b) and len(a & b) / len(a | b) >= threshold
