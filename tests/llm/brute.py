"""Brute-force versions of what the operators compute."""

import re

from shelfline.llm.secrets import RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def find(pattern, text, keep, kind):
    return [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if keep(m)]


def secrets_of(text):
    out = find(ASSIGN, text, lambda m: len(m[2]) >= 6, "assign")
    out += find(r"AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 20, "access")
    out += find(r"[0-9a-f]+", text, lambda m: len(m[0]) >= 24, "hex")
    for rule in RULES[3:]:
        out += find(rule.pattern, text, lambda m: True, rule.kind)
    order = [r.kind for r in RULES]
    return sorted(out, key=lambda s: (s[1], order.index(s[0]), s[2]))


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def personal_of(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, lambda m: True, "email")
    out += find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, lambda m: all(int(p) <= 255 for p in m[0].split(".")), "ip")
    out += find(r"[0-9]([\x20-]?[0-9])+", text, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m)), "card")
    return out + find(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 8 <= len(digits(m)) <= 15, "phone")


def grams(text, n, lower=False):
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(text)
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components_of(rows, words, percent):
    sets = [(i, grams(t or "", words, lower=True)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    smallest = {}
    for a, (i, _) in enumerate(sets):
        smallest[root(a)] = min(smallest.get(root(a), i), i)
    return sorted((i, len(s), smallest[root(a)]) for a, (i, s) in enumerate(sets))
