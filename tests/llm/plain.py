"""Plain versions of the operators, for the tests to hold results against: loops and dictionaries, no arrays."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

from entwine.llm import decontaminate as D
from entwine.llm import quality, toxicity


def spelt(word):
    return word if isinstance(word, bytes) else word.encode()


class Plain:
    """The two Kneser-Ney models with dictionaries of byte strings."""

    def __init__(self, words):  # (word, class)
        self.top, grams = (Counter(), Counter()), set()
        for word, c in words:
            b = b"\1" + spelt(word) + b"\2"
            for p in range(1, len(b)):
                for n in range(1, toxicity.ORDER + 1):
                    if p - n + 1 >= 0:
                        g = b[p - n + 1 : p + 1]
                        grams.add(g)
                        if n == toxicity.ORDER or p - n + 1 == 0:
                            self.top[c][g] += 1
        self.times, self.total, self.types = Counter(), Counter(), Counter()
        for g in grams:
            if len(g) > 1:
                self.times[g[1:]] += 1
                self.total[g[1:-1]] += 1
            if not (len(g) == toxicity.ORDER or g[0] == 1):
                self.types[g[:-1]] += 1
        self.by = (defaultdict(list), defaultdict(list))
        for c in (0, 1):
            for g, k in self.top[c].items():
                self.by[c][g[:-1]].append(k)

    def ratio(self, word):
        b, out, d = b"\1" + spelt(word) + b"\2", 0.0, toxicity.DISCOUNT
        for p in range(1, len(b)):
            low = 1 / 256
            for n in range(1, toxicity.ORDER):
                if p - n + 1 >= 1 and (t := self.total[(ctx := b[p - n + 1 : p])]):
                    low = max((max(self.times[b[p - n + 1 : p + 1]] - d, 0) + d * self.types[ctx] * low) / t, 1e-9)
            g = b[max(0, p - toxicity.ORDER + 1) : p + 1]
            logs = []
            for c in (0, 1):
                ks = self.by[c][g[:-1]]
                logs.append(math.log((max(self.top[c][g] - d, 0) + d * len(ks) * low) / sum(ks) + 1e-9) if ks else math.log(low))
            out += logs[1] - logs[0]
        return out


def plain_statistics(t):
    words = [w for w in re.split("[\t-\r ]+", t) if w]
    if not words:
        return [0.0] * len(quality.STATISTICS)
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    letters = [c for c in t if c.isascii() and c.isalpha()]
    lines = [x for x in re.split("[\n\r]+", t) if x]
    n, size = len(words), len(t)
    bare = sum(not any(not c.isascii() or c.isalpha() for c in w) for w in words)
    return [
        math.log1p(n), math.log1p(size / n), math.sqrt(sum(c.isupper() for c in letters) / max(len(letters), 1)), math.sqrt(sum(c.isascii() and c > " " and c != "\x7f" and not c.isalnum() and c not in ".,'-" for c in t) / size),
        math.sqrt(bare / n), math.sqrt(sum(a == b for a, b in zip(low, low[1:], strict=False)) / n), math.log1p(len(set(low))) / math.log1p(n), math.sqrt((len(lines) - len(set(lines))) / max(len(lines), 1)),
        math.sqrt(sum("0" <= c <= "9" for c in t) / size), math.sqrt(sum(w.endswith(".") for w in words) / n), math.sqrt(max(Counter(low).values()) / n), sum(len(w) <= 3 for w in words) / n, math.log1p(size / max(len(lines), 1)),
    ]


def holds(text, item):
    """Whether a text holds a benchmark item."""
    ws = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    d, i = ws(text), ws(item)
    if not i:
        return False
    need = len(i) if len(i) < D.SHORT else math.ceil(min(D.OVERLAP, len(i)) * D.SHARE)
    for shift in range(-len(i), len(d)):
        same = [0 <= k + shift < len(d) and d[k + shift] == w for k, w in enumerate(i)]
        if any(sum(same[k : k + D.OVERLAP]) >= need for k in range(len(same))):
            return True
    return False


def base_secrets(t):
    """(kind, start, end) of the base secrets."""
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return out + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]


def groups(texts, width=5):
    """By id the smallest id reachable over links of a Jaccard similarity of 0.8 or more between sets of word shingles."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", low(t)) for i, t in texts.items()}
    sets = {i: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for i, w in words.items()}
    root = {i: i for i in texts}
    for i in sorted(texts):
        for j in sorted(texts):
            both = len(sets[i] & sets[j])
            if i < j and (5 * both >= 4 * len(sets[i] | sets[j])):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    return root


def redacted(t):
    """The text with its base secrets replaced by their kinds; the first, longest span stands."""
    out, at = "", 0
    for kind, a, b in sorted(base_secrets(t), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out, at = out + t[at:a] + f"<{kind}>", b
        else:
            at = max(at, b)
    return out + t[at:]


class PlainToxicity:
    """Both models and the logistic layer, from (text, toxic, fold) rows."""

    def __init__(self, rows):
        cut = lambda b: [b[k : k + toxicity.SPELLING] for k in range(0, len(b), toxicity.SPELLING)]
        self.words = lambda t: [b for w in re.split(r"[\x00-/:-@\[-`{-\x7f]+", (t or "").lower()) for b in cut(w.encode())]
        known = [(w, c, f) for t, c, f in rows for w in self.words(t)]
        self.models = {}
        for folds in ((0, 1), (0,), (1,)):
            model, own = Plain([(w, c) for w, c, _ in known]), Plain([(w, c) for w, c, f in known if f in folds])
            model.top, model.by = own.top, own.by
            self.models[folds] = model
        x = np.array([self.features(t, (1 - f,)) for t, _, f in rows])
        self.w = toxicity.fit_logistic(x, np.array([c for _, c, _ in rows], float))

    def features(self, t, folds):
        r = [min(max(self.models[folds].ratio(w), -6), 12) for w in self.words(t)]
        n = max(len(r), 1)
        strong = sum(max(x - 2, 0) for x in r)
        best = max((sum(r[max(0, k + 1 - toxicity.WINDOW) : k + 1]) / max(k + 1 - max(0, k + 1 - toxicity.WINDOW), 8) for k in range(len(r))), default=0)
        return [sum(r) / n, strong / n, best, math.log1p(strong), math.sqrt(sum(x > 4 for x in r) / n), math.log1p(len(r))]

    def score(self, t):
        z = self.w[0] + float(np.dot(self.w[1:], self.features(t, (0, 1)))) + math.log(toxicity.MISS_COST)
        return 1 / (1 + math.exp(-min(max(z, -40), 40)))
