"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def groups(count, links):
    parent = list(range(count))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[top(a)] = top(b)
    return [top(i) for i in range(count)]


def linked_rows(texts, words, percent):
    """The group number of each text, by comparing all pairs that share a shingle."""
    sets, holders = [shingles(t, words) for t in texts], defaultdict(list)
    links = []
    for i, own in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= percent * (len(own) + len(sets[j]) - n)]
    return sets, groups(len(texts), links)


def components(rows, words, percent):
    """{(doc_id, n_shingles, component_id)} of (doc_id, text) rows."""
    sets, group = linked_rows([t for _, t in rows], words, percent)
    smallest = defaultdict(list)
    for (key, _), g in zip(rows, group):
        if key is not None:
            smallest[g].append(key)
    return sorted(
        ((key, len(s), (min(smallest[g]) if smallest[g] else None) if s else key)
         for (key, _), s, g in zip(rows, sets, group)), key=str)
