"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", (text or "")) if w]


def shingle_set(text, width):
    found = words((text or "").translate(UPPER))
    if len(found) < width:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def groups(rows, width, percent=80):
    """Smallest reachable id of each (id, text) row, and the size of its set."""
    sets = [shingle_set(text, width) for _, text in rows]
    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for element in own:
            holders[element].append(i)
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        for j, common in Counter(j for e in own for j in holders[e] if j > i).items():
            if 100 * common >= percent * (len(own) + len(sets[j]) - common):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(rows[i][0])
    smallest = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return [(len(sets[i]), smallest[top(i)]) for i in range(len(rows))]


def drop_lines(texts, min_docs, min_chars=1, distinct_texts=False):
    def key(line):
        return line.strip("\t\n\x0b\x0c\r ").translate(UPPER)

    counted = set(t or "" for t in texts) if distinct_texts else [t or "" for t in texts]
    often = Counter(k for t in counted for k in {key(x) for x in t.split("\n")})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or often[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def item_words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER)) if w]


def contaminated(text, items, width):
    """Words, hit words and sorted item names of a text."""
    own, hit, names = item_words(text), set(), set()
    for name, item in items:
        of = item_words(item)
        for k in range(max(len(of) - width, 0) + 1 if of else 0):
            window = of[k : k + width]
            for at in range(len(own) - len(window) + 1):
                if own[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    names.add(str(name))
    return len(own), len(hit), sorted(names)
