"""The text operators said again, plainly and in one process, for tests on small tables."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict

from tidemark.llm import line_templates as lt

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    w = WORDS.findall(text or "")
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else frozenset()


def near_classes(texts, threshold=0.8):
    """(class of each text, links of each text) by comparing all pairs."""
    sets, top, links = list(map(shingle_set, texts)), list(range(len(texts))), Counter()
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
            links[i] += 1
            links[j] += 1
            old, new = top[j], top[i]
            top = [new if t == old else t for t in top]
    return top, links


def recurring_lines(texts, leading=lt.LEADING, constant=lt.CONSTANT, shortest=lt.SHORTEST, documents=lt.DOCUMENTS):
    """{text number: {line number: templates that recur}} of different texts."""
    enough = lambda n: min(documents, lt.LONG_DOCUMENTS) if n >= lt.LONG else documents
    may_vary = lambda n: int((1 - constant + 1e-9) * n)
    rows, leaf_texts, line_texts = [], defaultdict(set), defaultdict(set)
    for t, text in enumerate(texts):
        for no, line in enumerate((text or "").encode().split(b"\n")):
            if w := tuple(lt.tokens_of(line)):
                for tail in (False, True)[: 1 + (len(w) >= max(shortest, leading + 1))]:
                    leaf = (tail, len(w), w[-leading:] if tail else w[:leading])
                    rows.append((t, no, w, leaf))
                    leaf_texts[leaf].add(t)
                    line_texts[w].add(t)
    rows = [r for r in rows if len(leaf_texts[r[3]]) >= enough(len(r[2]))]
    lines = defaultdict(set)
    for _, _, w, leaf in rows:
        if len(w) >= max(shortest, leading + 1):
            lines[leaf].add(w)
    heads = {frozenset(s) for leaf, s in lines.items() if not leaf[0]}
    general = {}
    for leaf, found in lines.items():
        tail, n, _ = leaf
        if len(found) < 2 or (tail and frozenset(found) in heads):
            continue
        below = {w: w[:-leading] if tail else w[leading:] for w in found}
        parts = defaultdict(set)
        for w, b in below.items():
            for j in range(4):
                if part := b[len(b) * j // 4 : len(b) * (j + 1) // 4]:
                    parts[j, part].add(w)
        alike = {w for ws in parts.values() if len(ws) > 1 and sum(len(line_texts[w]) for w in ws) >= enough(n) for w in ws}
        total = Counter()
        for w in alike:
            for pos, token in enumerate(below[w]):
                total[pos, token] += len(line_texts[w])
        for w in alike:
            mine = {x: total[x] for x in enumerate(below[w]) if total[x] >= enough(n)}
            least = n - leading - may_vary(n)
            if mine and len(mine) >= least:
                last = sorted(mine.values(), reverse=True)[max(least, 1) - 1]
                general[w, leaf] = (leaf, tuple(sorted(x for x, c in mine.items() if c >= lt.AS_COMMON * last)))
    templates, places = defaultdict(set), []
    for t, no, w, leaf in rows:
        if not leaf[0] or (w, leaf) in general:
            template = general.get((w, leaf), w)
            templates[template].add(t)
            places.append((t, no, len(w), template))
    out = defaultdict(lambda: defaultdict(set))
    for t, no, n, template in places:
        if len(templates[template]) >= enough(n):
            out[t][no].add(template)
    return out


def capped_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} by raising the level until all is shared out."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    low, high = 0.0, float(sum(sizes.values()) * most + 1)
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(most * sizes[s], level * weight[s]) for s in names) < sum(sizes.values()) else (low, level)
    return {s: min(most * sizes[s], low * weight[s]) for s in names}
