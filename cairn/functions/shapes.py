"""Small rules on the shape of values: codes, labels, keys, parties, dates, boxes, ordered categories and statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import public_host, slug

#: Statuses that a standards claim may have.
STATUSES = ("aligned", "partial", "not-evaluated", "not-applicable")
#: Keys of a standards map that aren't claims.
NOT_CLAIMS = ("schema", "claims_are_alignment_not_certification")


def declared_codes(native_id: Column, title: Column) -> Column:
    """Sorted table codes: the record's own id, if it is one, and a code that the title begins with."""
    own = F.when(F.upper(native_id).rlike(r"^[A-Z]{2}\d{3}$"), F.upper(native_id))
    begun = F.nullif(F.upper(F.regexp_extract(title, r"(?i)^\s*([A-Z]{2}\d{3}[A-Z]*)\s*(?:[-:–—]|$)", 1)), F.lit(""))
    return F.array_sort(F.array_distinct(F.array_compact(F.array(own, begun))))


def human_label(name: Column) -> Column:
    """A field's name in words, each with a capital."""
    parted = F.regexp_replace(F.regexp_replace(name, "[_-]", " "), "([a-z])([A-Z])", "$1 $2")
    return F.array_join(F.transform(F.split(parted, " "), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), " ")


def plain_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def under_key(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


def shown(value: Column, fallback: str = "Not evidenced in this snapshot") -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(fallback))


def parties(values: Column) -> Column:
    """Organisations (name, url) once each by name without regard to case and by address, with the last spelling, sorted; nameless ones go."""
    named = F.filter(F.transform(values, lambda p: F.struct(F.lower(F.trim(p["name"])).alias("k"), F.coalesce(p["url"], F.lit("")).alias("url"), F.trim(p["name"]).alias("name"))), lambda p: F.coalesce(p["name"] != "", F.lit(False)))
    keys = F.transform(named, lambda p: F.struct(p["k"], p["url"]))
    last = F.filter(named, lambda p, i: ~F.exists(F.slice(keys, i + 2, F.size(keys)), lambda x: (x["k"] == p["k"]) & (x["url"] == p["url"])))
    return F.transform(F.array_sort(last), lambda p: F.struct(slug(p["name"], markup=False).alias("id"), p["name"].alias("name"), p["url"].alias("url")))


def own_link(links: Column, native_id: Column) -> Column:
    """The one public self link whose path ends in the record's id; null where there is none or more than one. links: (rel, href)."""
    end = lambda u: F.element_at(F.split(F.rtrim(F.try_parse_url(u, F.lit("PATH")), F.lit("/")), "/"), -1)
    fit = F.filter(links, lambda x: (F.lower(F.trim(x["rel"])) == "self") & public_host(x["href"]).isNotNull() & (end(x["href"]) == native_id))
    urls = F.array_distinct(F.transform(fit, lambda x: x["href"]))
    return F.when(F.size(urls) == 1, F.get(urls, 0))


def usage_window(start: Column, end: Column) -> Column:
    """Both dates of a window if they are dates in order; null otherwise."""
    a, b = F.try_to_date(start, "yyyy-MM-dd"), F.try_to_date(end, "yyyy-MM-dd")
    return F.when(a <= b, F.struct(a.alias("start"), b.alias("end")))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two times with offsets; null unless both have one and the second isn't before the first."""
    whole = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"
    a, b = (F.when(x.rlike(whole), F.unix_seconds(F.try_to_timestamp(x))) for x in (start, end))
    return F.when(b >= a, b - a)


def finite_share(value: Column) -> Column:
    """A number from 0 to 1; null for anything else."""
    return F.when(value.isNotNull() & ~F.isnan(value) & value.between(0.0, 1.0), value)


def clamped(value: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def first_box(*candidates: Column) -> Column:
    """Of several lists of texts the first with four finite numbers at least, as its first four."""
    out = F.lit(None).cast("array<double>")
    for c in reversed(candidates):
        numbers = F.filter(F.transform(c, lambda x: x.try_cast("double")), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        out = F.when(F.size(numbers) >= 4, F.slice(numbers, 1, 4)).otherwise(out)
    return out


def dimension_names(dimensions: Column) -> Column:
    """A name for each dimension: the first of its id, name, label and concept that there is, or its number from one."""
    some = lambda x: F.nullif(x, F.lit(""))
    return F.transform(dimensions, lambda d, i: F.coalesce(some(d["id"]), some(d["name"]), some(d["label"]), some(d["concept"]), F.concat(F.lit("dimension-"), (i + 1).cast("string"))))


def ordered_categories(positions: Column) -> Column:
    """Categories in the order of their positions, which must be 0 to n - 1; null otherwise. positions: a map."""
    ordered = F.array_sort(F.transform(F.map_entries(positions), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("k"))))
    whole = F.transform(ordered, lambda x: x["at"].cast("int")) == F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(whole, F.transform(ordered, lambda x: x["k"]))


def claim_statuses(claims: Column) -> Column:
    """(standard, status) of a map of claims; a status that isn't known counts as not evaluated."""
    own = F.map_filter(claims, lambda k, _: ~k.isin(*NOT_CLAIMS))
    return F.transform(F.array_sort(F.map_entries(own)), lambda e: F.struct(e["key"].alias("standard"), F.when(F.lower(e["value"]).isin(*STATUSES), F.lower(e["value"])).otherwise("not-evaluated").alias("status")))
