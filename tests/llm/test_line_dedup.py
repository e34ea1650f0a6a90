from __future__ import annotations

from cairn.llm import line_dedup as l  # noqa: E741


def brute(pairs):
    seen, out = set(), {}
    for i, t in sorted({p for p in pairs if p[1] is not None}, key=lambda p: (p[0] is None, p[0], l_key(p[1]))):
        lines, gone = t.split("\n"), set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def l_key(text):
    import hashlib

    return hashlib.sha256(text.encode()).digest()[:16]


def test_against_brute_force(documents):
    body = [f"line {k}" for k in range(8)]
    pairs = [
        (3, "\n".join(body)), (1, "\n".join(["x", *body[2:6], "y"])), (2, "\n".join(body[:2])), (5, "a\na\na\na\na\na"), (6, ""), (7, None), (8, "\n\n\n\n"), (9, "one\ntwo\nthree"),
        (9, "one\ntwo\nthree"), (10, "one\ntwo\nthree"), (4, "\n".join(body[::-1] + body)),
    ]
    docs = documents(pairs).withColumnRenamed("source", "n_removed_lines")
    want = brute(pairs)
    rows = l.dedup_lines(docs).collect()
    assert len(rows) == len(pairs)
    texts = dict(pairs)
    for r in rows:
        assert r.text == (None if texts[r.doc_id] is None else want[r.doc_id, texts[r.doc_id]] or "")


def test_stage_drops_what_is_wholly_repeated(documents):
    docs = documents(["one\ntwo\nthree", "one\ntwo\nthree", None, "", "one\ntwo\nthree\nfour"])
    got = {r.doc_id: (r.text, r.n_chars) for r in l.drop_repeated_lines(docs).collect()}
    assert got == {0: ("one\ntwo\nthree", 13), 2: (None, 0), 3: ("", 0), 4: ("four", 4)}


def test_empty(documents):
    assert l.dedup_lines(documents(["x"]).limit(0)).count() == 0


def test_no_python_in_the_plan(documents):
    plan = l.dedup_lines(documents(["x"])).toDF(*documents(["x"]).columns, "n")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
