from __future__ import annotations

import re

from pyspark.sql import functions as F

from cairn.llm import pii


def luhn(number: str) -> bool:
    ds = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(ds)) % 10 == 0


def changed(documents, texts):
    return {r.doc_id: r for r in pii.pseudonymise(documents(texts), "corpus").collect()}


def test_formats_stay_valid_and_values_stay_linked(documents):
    texts = [
        "mail a.b-c@mail.example.com now", "card 4111 1111 1111 1111.", "again 4111 1111 1111 1111", "ip 10.20.30.40", "call +1 (555) 010-2345", "born 1984-02-29 or 31/12/1999 or 12/25/2001",
        "ssn 123-45-6789", None, "", "not 4111111111111112, 300.1.1.1, 2001-02-30, 666-12-1234, version 3.14 or 12345", 'token = "0123456789abcdef0123"',
    ]
    got = changed(documents, texts)
    assert got[7].text is None and got[8].text == "" and got[9].text == texts[9] and got[9].private == {}
    for k in (0, 1, 2, 3, 4, 5, 6, 10):
        assert got[k].text != texts[k]
        assert re.sub(r"\d", "9", re.sub("[a-z]", "a", got[k].text))[:4] == re.sub(r"\d", "9", re.sub("[a-z]", "a", texts[k]))[:4]
    assert luhn(got[1].text) and got[1].text[5:24] == got[2].text[6:]
    assert all(int(x) < 256 for x in got[3].text[3:].split("."))
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}", got[4].text)
    assert re.fullmatch(r"born \d{4}-02-29 or 31/(?:0[13578]|1[02])/\d{4} or \d{2}/(?:1[3-9]|2[0-8])/\d{4}", got[5].text)
    assert got[0].text.endswith("@mail.example.com now")
    assert got[5].private == {"date": 3}


def test_permutation_has_no_two_equal_results(spark):
    values = spark.range(144).select(F.array((F.col("id") / 12).cast("long"), F.col("id") % 12).alias("v"))
    got = values.select(pii.permute(F.col("v"), pii.longs(12, 12), "t", "k").alias("p"))
    assert got.distinct().count() == 144
    assert got.where(F.forall("p", lambda x: (x >= 0) & (x < 12))).count() == 144
    other = values.select(pii.permute(F.col("v"), pii.longs(12, 12), "t", "another").alias("p"))
    assert other.collect() != got.collect()


def test_all_dates_of_a_year_stay_apart(spark):
    days = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("d"))
    got = days.select(pii.date(F.col("d"), "k").alias("p"))
    assert got.distinct().count() == 366
    assert got.where(F.try_to_date("p").isNull()).count() == 0


def test_clashing_column_and_empty_table(documents):
    docs = documents(["x 10.0.0.1"]).withColumnRenamed("source", "private")
    assert pii.pseudonymise(docs, "corpus").columns == ["doc_id", "text", "lang", "n_chars", "private"]
    assert pii.pseudonymise(docs.limit(0), "corpus").count() == 0


def test_equal_values_stay_linked_in_every_format(documents):
    """One pseudonym for a number whatever stands between its digits, for a day in every notation, for a mailbox whatever its case."""
    groups = [
        ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"], ["+1 (555) 010-2345", "+1 555 010 2345", "+1-555-010-2345"],
        ["1984-02-27", "27/02/1984", "27.02.1984", "2/27/1984"], ["Jo.Smith-7@mail.example.com", "jo.smith-7@mail.example.com"],
    ]
    texts = [f"x {v} y" for g in groups for v in g]
    got = changed(documents, texts)
    at = 0
    for g in groups:
        own = [got[at + k].text[2:-2] for k in range(len(g))]
        at += len(g)
        assert all(a != b for a, b in zip(own, g, strict=True))
        if "-02-" in g[0]:
            days = {tuple(map(int, re.split("[-/.]", own[0]))), *(tuple(reversed([int(x) for x in re.split("[/.]", o)])) for o in own[1:3])}
            month, day, year = map(int, own[3].split("/"))
            assert days == {(year, month, day)}
        else:
            assert len({re.sub("[^0-9a-z@]", "", o.lower()) for o in own}) == 1


def test_key_is_required_and_matters(documents):
    import pytest

    docs = documents(["card 4111 1111 1111 1111"])
    with pytest.raises(TypeError):
        pii.pseudonymise(docs)
    one, two = (pii.pseudonymise(docs, key).first().text for key in ("a", "b"))
    assert one != two


def found_by_definition(text):
    """Which kinds of values a text holds, found without the operator: by plain scans of each kind, for texts where these don't overlap."""
    from datetime import date
    from ipaddress import AddressValueError, IPv4Address

    def valid(kind, v):
        if kind == "ipv4":
            try:
                return bool(IPv4Address(v)) or v == "0.0.0.0"
            except AddressValueError:
                return False
        if kind == "date":
            try:
                return 1900 <= date.fromisoformat(v).year <= 2099
            except ValueError:
                return False
        return luhn(v)

    scans = {"ipv4": r"(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])", "date": r"(?<!\S)\d{4}-\d{2}-\d{2}(?!\S)", "card": r"(?<!\S)\d{4} \d{4} \d{4} \d{4}(?!\S)"}
    counts = {k: sum(valid(k, v) for v in re.findall(p, text)) for k, p in scans.items()}
    return {k: n for k, n in counts.items() if n}


def test_against_another_detector(documents):
    import random

    rng = random.Random(3)
    makers = [
        lambda: ".".join(str(rng.randrange(300)) for _ in range(4)), lambda: f"{rng.randrange(1880, 2110)}-{rng.randrange(1, 14):02d}-{rng.randrange(1, 33):02d}",
        lambda: " ".join(f"{rng.randrange(10000):04d}" for _ in range(4)), lambda: "word", lambda: "4111 1111 1111 1111",
    ]
    texts = [" and ".join(rng.choice(makers)() for _ in range(6)) for _ in range(150)]
    got = changed(documents, texts)
    for k, t in enumerate(texts):
        assert got[k].private == found_by_definition(t), t


def test_long_texts_repeated_rows_and_clashing_names(documents):
    card = "4111 1111 1111 1111"
    texts = [(1, "word " * 200_000 + card), (2, card), (2, card), (None, card)]
    docs = documents(texts).withColumnRenamed("lang", "hits").withColumnRenamed("source", "Private")
    rows = pii.pseudonymise(docs, "k").collect()
    assert len(rows) == 4 and len({r.text[-19:] for r in rows}) == 1
    assert all(r.hits == "en" for r in rows)


def test_cards_with_digits_beside_them(documents):
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "3782 822463 10005", "4111111111111111"]
    texts = [f"pay {c}{behind}" for c in cards for behind in ("", " 123", " 12/27", " 999")] + [f"{before} {c}" for c in cards for before in ("12", "987")]
    texts += ["two 4111 1111 1111 1111 5500 0000 0000 0004", "not 4111 1111 1111 1112 123", "numbers 12 34 56 78 90 12 34"]
    got = changed(documents, texts)
    alone = {c: got[4 * n].text[4:] for n, c in enumerate(cards)}
    clear = [k for k, t in enumerate(texts[:24]) if any(c in got[k].text for c in cards)]
    print(f"cards with digits beside them: {24 - len(clear)} of 24 hidden")
    assert not clear
    for k, t in enumerate(texts[:24]):
        c = next(c for c in cards if c in t)
        assert got[k].private == {"card": 1}
        whole = re.sub(r"\D", "", t)  # a whole run may hold a sum of its own
        if not (len(whole) <= 19 and luhn(whole)) or whole == re.sub(r"\D", "", c):
            assert got[k].text == t.replace(c, alone[c])
    assert got[24].private == {"card": 2}
    assert got[25].text == texts[25] and got[26].text == texts[26]
