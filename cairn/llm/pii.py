"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

Candidates are found by one pattern and validated by kind: payment cards by their Luhn sum (that of a usual grouping within, if the whole run of digits fails), dates by the calendar,
social security numbers and addresses by their ranges, phone numbers by their count of digits. A valid value is put
through a keyed Feistel network over its own positions: half of the positions are shifted, each modulo the number of
symbols that may stand there, by a keyed hash of the other half, and then the halves change places. The result has
the same format, equal values get equal pseudonyms in every document, and no two values share one. Numbers are equal if
their digits are, whatever stands between these, dates if they are the same day, names of mailboxes if they differ in case alone.

Kinds: email (letters and digits of the local part), ipv4 (octets), card (all but the first digit; the check digit
is computed anew), phone (all but the first digit after a plus sign), ssn, date (ISO, or two fields and a four-digit year, 1900 to 2099;
day first where both readings are possible), credential (hex after password or token, and access keys).

Null texts stay null and empty ones empty. Values that fail validation stay. Repeated rows get equal results, an empty table an empty one.
Very long texts are treated whole. Where candidates overlap, the one that begins first counts, and of these the kind named
first in ``PATTERNS``. Further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import free_name, table

ROUNDS = 10
#: Patterns of candidates by kind, in order of precedence. Fixed values.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "credential": r"(?i:(?<=password=)|(?<=token = \")|(?<=token=)|(?<=token=\"))[0-9a-f]{16,128}(?![0-9A-Za-z])|(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])",
    "ipv4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\d|[/.-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[.-]\d{4}(?!\d|-\d)",
    "card": r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?!\d|-\d)",
}
#: Usual groupings of a card's digits, tried within a longer run of digits whose Luhn sum fails. Fixed values.
GROUPINGS = (r"\d{4}([ -])\d{4}\2\d{4}\2\d{4}\2\d{1,3}", r"\d{4}([ -])\d{4}\2\d{4}\2\d{4}", r"\d{4}([ -])\d{6}\2\d{4,5}", r"\d{13,19}")
ANY = "|".join(PATTERNS.values())
MONTHS_30 = (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)
MONTHS_31 = (1, 3, 5, 7, 8, 10, 12)


def longs(*values: int | Column) -> Column:
    return F.array(*(F.lit(v).cast("long") if isinstance(v, int) else v.cast("long") for v in values))


#: Hexadecimal digits of a hash that make one shift, and how many shifts one hash gives.
SHIFT_DIGITS, SHIFTS = 12, 10


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def permute(values: Column, radices: Column, kind: str, key: str) -> Column:
    """A keyed permutation of vectors whose i-th entry is below ``radices[i]``: in each round one half is shifted by a hash of the other."""
    half = F.floor(F.size(values) / 2)
    blocks = F.sequence(F.lit(0), F.floor(F.size(values) / SHIFTS).cast("int"))

    def hashed(v: Column, r: Column) -> Column:
        low = F.pmod(r, F.lit(2)) == 0
        other = F.array_join(F.filter(v, lambda _, j: (j < half) != low).cast("array<string>"), ",")
        stem = F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), other)
        return let(stem, lambda s: F.array_join(F.transform(blocks, lambda b: F.substring(F.sha2(F.concat_ws("|", s, b.cast("string")), 512), 1, SHIFT_DIGITS * SHIFTS)), ""))

    def step(v: Column, r: Column) -> Column:
        low = F.pmod(r, F.lit(2)) == 0

        def shifted(digest: Column) -> Column:
            by = lambda i: F.conv(F.substr(digest, (i * SHIFT_DIGITS + 1).cast("int"), F.lit(SHIFT_DIGITS)), 16, 10).cast("long")
            return F.transform(v, lambda x, i: F.when((i < half) == low, F.pmod(x + by(i), F.get(radices, i))).otherwise(x))

        return let(hashed(v, r), shifted)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, step)


def alike(text: Column, kind: str, key: str, alphabet: str) -> Column:
    """A text over one alphabet, permuted."""
    values = F.transform(F.split(text, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("long"))
    mixed = permute(values, F.transform(values, lambda _: F.lit(len(alphabet)).cast("long")), kind, key)
    return F.array_join(F.transform(mixed, lambda v: F.substring(F.lit(alphabet), v.cast("int") + 1, F.lit(1))), "")


def characters(text: Column, kind: str, key: str) -> Column:
    """Digits and letters permuted at their places, small letters and capitals in one way, so that case doesn't part equal values; other characters stay."""
    chars = F.split(F.lower(text), "")
    base = lambda c: F.when(c.rlike("^[0-9]$"), 48).when(c.rlike("^[a-z]$"), 97).otherwise(F.ascii(c)).cast("long")
    radix = lambda c: F.when(c.rlike("^[0-9]$"), 10).when(c.rlike("^[a-z]$"), 26).otherwise(1).cast("long")
    mixed = permute(F.transform(chars, lambda c: F.ascii(c).cast("long") - base(c)), F.transform(chars, radix), kind, key)
    small = F.zip_with(mixed, chars, lambda v, c: F.char(v + base(c)))
    return F.array_join(F.zip_with(small, F.split(text, ""), lambda s, c: F.when(c.rlike("^[A-Z]$"), F.upper(s)).otherwise(s)), "")


def refilled(text: Column, numbers: Column) -> Column:
    """The text with other digits in the places of its own, so that equal numbers stay equal however they are written."""
    place = lambda i: F.length(F.regexp_replace(F.substring(text, 1, i + 1), "[^0-9]", "")) - 1
    return let(numbers, lambda ds: F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.get(ds, place(i)).cast("string")).otherwise(c)), ""))


def permuted_digits(ds: Column, kind: str, key: str) -> Column:
    return permute(ds, F.transform(ds, lambda _: F.lit(10).cast("long")), kind, key)


def digits(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c.rlike("^[0-9]$")).cast("array<long>")


def luhn_sum(ds: Column, doubled_from: int) -> Column:
    """Luhn sum of digits, read from the right; places whose number has the parity ``doubled_from`` count double."""
    twice = F.transform(F.reverse(ds), lambda d, i: F.when(F.pmod(i, F.lit(2)) == doubled_from, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(twice, F.lit(0).cast("long"), lambda a, d: a + d)


def card_within(text: Column) -> Column:
    """The candidate if its Luhn sum holds, or else the first usual grouping in it whose sum holds, as where a code or an expiry date stands beside a card."""
    holds = lambda c: F.pmod(luhn_sum(digits(c), 1), F.lit(10)) == 0
    parts = F.concat(*(F.regexp_extract_all(text, F.lit(rf"(?<!\d)(?=({g})(?!\d))"), F.lit(1)) for g in GROUPINGS))
    return F.get(F.filter(F.concat(F.array(text), parts), holds), 0)


def card(text: Column, key: str) -> Column:
    def shown(number: Column) -> Column:
        at = F.instr(text, number)
        return F.concat(F.substr(text, F.lit(1), at - 1), card_number(number, key), F.substr(text, at + F.length(number)))

    return F.get(F.transform(F.array(card_within(text)), shown), 0)


def card_number(text: Column, key: str) -> Column:
    """All digits but the first are permuted, and the last is what the Luhn sum asks for."""
    ds = digits(text)
    head = F.concat(F.slice(ds, 1, 1), permuted_digits(F.slice(ds, F.lit(2), F.size(ds) - 2), "card", key))
    return refilled(text, let(head, lambda h: F.concat(h, F.array(F.pmod(10 - F.pmod(luhn_sum(h, 0), F.lit(10)), F.lit(10))))))


def ipv4(text: Column, key: str) -> Column:
    octets = F.split(text, r"\.").cast("array<long>")
    mixed = permute(octets, longs(256, 256, 256, 256), "ipv4", key)
    return F.when(F.forall(octets, lambda x: x < 256), F.array_join(mixed.cast("array<string>"), "."))


def ssn(text: Column, key: str) -> Column:
    part = F.split(text, "-").cast("array<long>")
    area, group, serial = (F.get(part, i) for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    mixed = permute(longs(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1), longs(898, 99, 9999), "ssn", key)
    shown = F.transform(F.array(mixed), lambda v: F.format_string("%03d-%02d-%04d", F.when(v[0] >= 665, v[0] + 2).otherwise(v[0] + 1), v[1] + 1, v[2] + 1))
    return F.when(valid, F.get(shown, 0))


def phone(text: Column, key: str) -> Column:
    """All digits are permuted but the first after a plus sign."""
    ds, kept = digits(text), F.when(text.startswith("+"), 1).otherwise(0)
    mixed = F.concat(F.slice(ds, F.lit(1), kept), permuted_digits(F.slice(ds, kept + 1, F.size(ds)), "phone", key))
    return F.when(F.size(ds).between(8, 15), refilled(text, mixed))


def date(text: Column, key: str) -> Column:
    """Dates are permuted among those whose day of the month has the same possible months, so that all results are dates."""
    iso = text.rlike("^[0-9]{4}-")
    mark = F.when(iso, "-").when(text.contains("/"), "/").otherwise(".")
    part = F.split(text, "[-/.]")
    number = part.cast("array<long>")
    month_first = ~iso & (F.get(number, 1) > 12)
    year = F.when(iso, F.get(number, 0)).otherwise(F.get(number, 2))
    month = F.when(iso, F.get(number, 1)).when(month_first, F.get(number, 0)).otherwise(F.get(number, 1))
    day = F.when(iso, F.get(number, 2)).when(month_first, F.get(number, 1)).otherwise(F.get(number, 0))
    real = F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd").isNotNull() & year.between(1900, 2099)
    of30, of31 = (F.array(*map(F.lit, m)) for m in (MONTHS_30, MONTHS_31))
    y = year - 1900

    def place(months: Column, m: Column) -> Column:
        return F.array_position(months, m.cast("int")) - 1

    kinds = [
        (day <= 12, longs(y, month - 1, day - 1), (200, 12, 12), lambda v: (v[0] + 1900, v[1] + 1, v[2] + 1)),
        (day <= 28, longs(y, month - 1, day - 13), (200, 12, 16), lambda v: (v[0] + 1900, v[1] + 1, v[2] + 13)),
        (month == 2, longs(F.floor((year - 1904) / 4)), (49,), lambda v: (v[0] * 4 + 1904, F.lit(2), F.lit(29))),
        (day <= 30, longs(y, place(of30, month), day - 29), (200, 11, 2), lambda v: (v[0] + 1900, F.get(of30, v[1].cast("int")), v[2] + 29)),
        (day == 31, longs(y, place(of31, month)), (200, 7), lambda v: (v[0] + 1900, F.get(of31, v[1].cast("int")), F.lit(31))),
    ]

    def shown(ymd: tuple[Column, Column, Column]) -> Column:
        yy, mm, dd = (c.cast("int") for c in ymd)
        full = F.length(F.get(part, 0)) + F.length(F.get(part, 1)) == 4
        pair = lambda a, b: F.when(full, F.format_string("%02d%s%02d%s%04d", a, mark, b, mark, yy)).otherwise(F.format_string("%d%s%d%s%04d", a, mark, b, mark, yy))
        return F.when(iso, F.format_string("%04d-%02d-%02d", yy, mm, dd)).when(month_first, pair(mm, dd)).otherwise(pair(dd, mm))

    def rendered(back: Callable[[Column], tuple]) -> Callable[[Column], Column]:
        return lambda v: shown(back(v))

    out = None
    for n, (fits, values, radices, back) in enumerate(kinds):
        got = F.get(F.transform(F.array(permute(values, longs(*radices), f"date{n}", key)), rendered(back)), 0)
        out = F.when(fits, got) if out is None else out.when(fits, got)
    return F.when(real, out)


def credential(text: Column, key: str) -> Column:
    upper = F.concat(F.left(text, F.lit(4)), characters(F.substr(text, F.lit(5)), "credential", key))
    return F.when(text.startswith("AKIA"), upper).when(text == F.lower(text), alike(text, "credential", key, "0123456789abcdef")).otherwise(characters(text, "credential", key))


def email(text: Column, key: str) -> Column:
    at = F.instr(text, "@")
    return F.concat(characters(F.left(text, at - 1), "email", key), F.substr(text, at))


KINDS = {"email": email, "credential": credential, "ipv4": ipv4, "date": date, "ssn": ssn, "phone": phone, "card": card}


def pseudonym(text: Column, key: str) -> Column:
    """(kind, value) of one candidate; kind is null where it isn't valid."""
    each = []
    for kind, make in KINDS.items():
        whole = text.rlike(f"^(?:{PATTERNS[kind]})$")
        if kind == "credential":  # its pattern looks at what stands before the candidate
            whole = text.rlike("^(?:[0-9A-Fa-f]{16,128}|AKIA[A-Z0-9]{16})$") & ~text.rlike(f"^(?:{PATTERNS['card']})$")
        each.append(F.struct(F.lit(kind).alias("kind"), F.when(whole, make(text, key)).alias("value")))
    return F.get(F.filter(F.array(*each), lambda x: x["value"].isNotNull()), 0)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found: str = "private") -> DataFrame:
    """The documents with pseudonyms in the text, and a map of how many values of each kind it held. A column of that name in the input gives way.

    ``key`` is a secret: who knows it can undo the pseudonyms. It has no default, and belongs in the job's configuration.
    """
    own = docs.select(*(docs[c] for c in docs.columns if c.lower() != found.lower()))
    at = free_name([*own.columns, found], "hits")
    text = own[text_col]
    some = text.rlike("[0-9@]") & text.rlike(ANY)
    hits = own.withColumn(at, F.when(some, F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))))
    gaps = F.split(F.col(text_col), ANY, -1)
    new = F.concat(F.transform(at, lambda h: F.coalesce(h["new"]["value"], h["old"])), F.array(F.lit("")))
    text = F.when(F.col(at).isNull(), F.col(text_col)).otherwise(F.array_join(F.zip_with(gaps, new, lambda a, b: F.concat(a, b)), ""))
    kinds = F.filter(F.transform(F.coalesce(at, F.array().cast("array<struct<old:string,new:struct<kind:string,value:string>>>")), lambda h: h["new"]["kind"]), F.isnotnull)
    counted = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)).cast("long"))))
    return hits.select(*(text.alias(c) if c == text_col else F.col(c) for c in own.columns), counted.alias(found))


#: The query's key, which is public and protects nothing: it stands in for a secret of the job's configuration.
TEST_KEY = "key of the test query"


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.aggregate(F.map_values("private"), F.lit(0).cast("long"), lambda a, x: a + x)
    return pseudonymise(docs, TEST_KEY).select("doc_id", "text", n.alias("n_private"), F.to_json("private").alias("kinds"))
