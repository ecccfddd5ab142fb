"""Plain Python forms of what the operators compute, for small inputs."""

import math
import re
from collections import Counter, defaultdict
from itertools import permutations

WS = re.compile("[ \t\n\r\f]+")


def clean(piece):
    return re.sub(r"^[^a-z]+|[^a-z]+\Z", "", piece.lower())


def tokens(text):
    return [w for w in (clean(p) for p in WS.split(text)) if w]


def pmi(texts, min_count):
    single, pair = Counter(), Counter()
    for text in texts:
        ws = sorted(set(tokens(text)))
        single.update(ws)
        pair.update(permutations(ws, 2))
    n = float(len(texts))
    return {
        (a, b): math.log10((c / n) / ((single[a] / n) * (single[b] / n)))
        for (a, b), c in pair.items()
        if c >= min_count
    }


def bigrams(texts):
    out = Counter()
    for text in texts:
        ts = tokens(text)
        out.update(zip(ts, ts[1:]))
    return out


def pagerank(nodes, edges, source, iterations, alpha=0.15):
    out = defaultdict(list)
    for a, b in edges:
        out[a].append(b)
    mass = {n: float(n == source) for n in nodes}
    for _ in range(iterations):
        new = dict.fromkeys(nodes, 0.0)
        for n in nodes:
            for target in out[n]:
                if target in new:
                    new[target] += mass[n] / len(out[n])
        missing = 1.0 - sum(new.values())
        mass = {
            n: (1 - alpha) * (m + (missing if n == source else 0)) + alpha * (n == source)
            for n, m in new.items()
        }
    return mass


def roca(scored):
    spam = [s for label, s in scored if label == "spam"]
    ham = [s for label, s in scored if label != "spam"]
    won = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in spam for b in ham)
    return 100 * (1 - won / (len(spam) * len(ham)))
