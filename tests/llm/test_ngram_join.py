from __future__ import annotations

from itertools import combinations

from cairn.llm import ngram_join as n
from cairn.llm.common import words


def grams(text):
    w = words(text or "")
    size = min(5, len(w))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()


def brute(pairs):
    texts = sorted({t for _, t in pairs if t is not None})
    sets = {t: grams(t) for t in texts}
    links = {t: set() for t in texts}
    for a, b in combinations(texts, 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    root = {t: t for t in texts}
    for t in texts:
        todo, found = [t], {t}
        while todo:
            new = links[todo.pop()] - found
            found |= new
            todo += new
        root[t] = min(found)
    least = {}
    for i, t in pairs:
        if t is not None:
            least[root[t]] = min(least.get(root[t], i), i)
    return {i: (least[root[t]], len(links[t]), sum(u == t for _, u in pairs)) if t is not None else (i, 0, 1) for i, t in pairs}


def edited(w, *places):
    return [f"edit{k}" if k in places else x for k, x in enumerate(w)]


def test_against_brute_force(documents, prose):
    a, b = prose(200, 1), prose(120, 2)
    texts = [
        " ".join(a), " ".join(edited(a, 50)), " ".join(edited(a, 50, 90)), " ".join(edited(a, *range(0, 200, 9))), " ".join(b), " ".join(b).upper() + "!", " ".join(b), None, None, "", "", "...",
        "one", "One", "one two three four", "one two three four five six", "the same words", " ".join(a + b),
    ] + [" ".join(prose(80, 100 + k)) for k in range(40)]
    pairs = list(enumerate(texts)) + [(0, texts[0])]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in n.jaccard_join(documents(pairs)).collect()}
    assert got == brute(pairs)


def test_large_group_of_near_copies(documents, prose):
    base = prose(150, 7)
    pairs = [(k, " ".join(edited(base, k))) for k in range(150)] + [(1000 + k, " ".join(prose(60, k))) for k in range(20)]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in n.jaccard_join(documents(pairs)).collect()}
    assert got == brute(pairs)


def test_one_of_each(documents, prose):
    a = prose(100, 1)
    docs = documents([(5, " ".join(a)), (2, " ".join(edited(a, 3))), (9, " ".join(a)), (2, " ".join(edited(a, 3))), (7, None), (8, "alone")])
    got = n.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 7, 8]


def test_empty(documents):
    assert n.jaccard_join(documents(["x"]).limit(0)).count() == 0
