"""Plain Python versions of what the operators define, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = r"[^\x20\x09-\x0D]+"


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(WORD, text)


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, ws = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    often, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            inside.update(range(i, i + 8))
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if ((kind == "ip" and any(int(p) > 255 for p in m.group().split(".")))
                    or (kind == "card" and not (16 <= len(d) <= 19 and luhn(d))) or (kind == "phone" and not 8 <= len(d) <= 15)):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_components(rows):
    """{id: (set size, smallest id reachable)} for (id, text) with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sorted(sets) if sets[i]]
    where, seen = defaultdict(list), {}
    for i in ids:
        twin = seen.setdefault(frozenset(sets[i]), i)
        found = {twin} if twin != i else {j for j, c in Counter(j for s in sets[i] for j in where[s]).items()
                                           if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c)}
        for j in found:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
        if twin == i:
            for s in sets[i]:
                where[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def removed_lines(rows, min_words=3):
    """{id: [numbers of removed lines]} by comparing all lines."""
    out, earlier = defaultdict(list), []
    for i, t in sorted(rows):
        for k, line in enumerate((t or "").split("\n")):
            s = frozenset(words(line, lower=True))
            if len(s) < min_words:
                continue
            if any(4 * len(s & e) >= 3 * len(s | e) for e in earlier if 4 * min(len(s), len(e)) >= 3 * max(len(s), len(e))):
                out[i].append(k)
            earlier.append(s)
    return out
