"""Evidence read from titles and descriptions, conservatively: a value only where the text says it plainly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import safe_public_url

#: Cadences, in order of precedence, and the phrases that state them.
CADENCES = {"quarterly": r"(?i)\bquarterly\b", "every 6 weeks": r"(?i)\bevery 6 weeks\b", "every 12 weeks": r"(?i)\bissued every 12 weeks\b", "annually": r"(?i)\bannually\b"}
#: Keywords and country codes that name an area.
AREAS = {
    "united kingdom": "United Kingdom", "uk": "United Kingdom", "great britain": "Great Britain", "gb": "Great Britain", "england": "England", "en": "England",
    "england and wales": "England and Wales", "ew": "England and Wales", "wales": "Wales", "wa": "Wales", "scotland": "Scotland", "sc": "Scotland", "northern ireland": "Northern Ireland", "ni": "Northern Ireland",
}
COUNTRIES = {"E": "England", "N": "Northern Ireland", "S": "Scotland", "W": "Wales"}
#: Categories that hold everything.
CONTAINERS = ("/categories/latest", "/categories/ons geography open data")
#: Phrases that point to quality notes and to methods, and a date that a resource stands at.
QUALITY_NOTE = r"(?i)\b(?:data quality and limitations|quality assurance checks?|known limitations?/caveats?|known caveats and limitations)\b"
METHOD_WORD = r"(?i)\bmethodolog(?:y|ies|ical)\b"
REVISION_NOTE = (
    r"(?i)(?:\b(?:this|the)\s+(?:file|dataset|product|guide|boundary set|documents? folder)\s+(?:(?:has|have) been\s+|(?:was|were|is|are)\s+)?(?:updated|corrected|amended|revised)\b|"
    r"\b(?:file|dataset|product)\s+(?:has been\s+)?(?:updated|corrected|amended|revised)\b|"
    r"\b(?:V(?:ersion)?\s*\d+(?:\.\d+)?)\s+(?:corrects?|updates?|amends?|revises?)\b|"
    r"\b(?:note|n\.?b\.?)\s*[:.-]?\s*(?:updated|corrected|amended|revised)\b|"
    r"\[(?:updated|corrected|amended|revised)\b|"
    r"\b(?:amended|updated|corrected|revised)\s+\d{1,2}/\d{1,2}/\d{2,4}\b)"
)
QUALITY_LINK = r"(?i)(?:\bquality\b|\bqmi\b|\buncertaint(?:y|ies)\b|\brobustness\b)"
AS_AT = (
    r"(?i)\bas at\s+((?:(?:\d{1,2}(?:st|nd|rd|th)?\s+)?"
    r"(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\s+)?((?:18|19|20)\d{2}))\b"
)
URL = r"(?i)https?://[^\s<>\"'\[\]()]+"


def crosswalk(values: Column, names: dict[str, str], fold: bool = True) -> Column:
    """Sorted distinct areas that the values name."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    found = F.transform(values, lambda v: F.try_element_at(table, F.lower(F.trim(v)) if fold else F.upper(F.trim(v))))
    return F.array_sort(F.array_distinct(F.filter(found, lambda v: v.isNotNull())))


def area_served(keywords: Column) -> Column:
    return crosswalk(keywords, AREAS)


def countries(codes: Column) -> Column:
    return crosswalk(codes, COUNTRIES, fold=False)


def title_year(title: Column) -> Column:
    """The year in a title that names exactly one."""
    years = F.array_distinct(F.regexp_extract_all(title, F.lit(r"(?<!\d)((?:18|19|20)\d{2})(?!\d)"), F.lit(1)))
    return F.when(F.size(years) == 1, F.get(years, 0).cast("int"))


def cadence(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, phrase in reversed(CADENCES.items()):
        out = F.when(text.rlike(phrase), name).otherwise(out)
    return out


def informative(categories: Column) -> Column:
    return F.filter(categories, lambda c: ~F.rtrim(F.lower(c), F.lit("/")).isin(*CONTAINERS))


def subtopics(categories: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(categories, lambda c: F.regexp_replace(c, "^/Categories/", ""))))


def version_label(title: Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(title, r"(?i)\((V\d+(?:\.\d+)?)\)", 1)), F.lit(""))


def reference_date(title: Column, text: Column) -> Column:
    """The one date that a description says it stands at, early on, if its year is the title's."""
    dates = F.regexp_extract_all(text, F.lit(AS_AT), F.lit(1))
    years = F.regexp_extract_all(text, F.lit(AS_AT), F.lit(2))
    early = F.regexp_instr(text, F.lit(AS_AT)).between(1, 301)
    return F.when((F.size(dates) == 1) & early & (F.get(years, 0).cast("int") == title_year(title)), F.get(dates, 0))


def excerpt(text: Column, phrase: str, limit: int = 500) -> Column:
    """The sentence around the first match of a phrase; of a longer one what stands near the match."""
    match = F.regexp_extract(text, phrase, 0)
    start = F.regexp_instr(text, F.lit(phrase))
    before, after = F.left(text, start - 1), F.substr(text, start + F.length(match))
    lead = F.regexp_extract(before, r"(?s)(?:.*\. )?(.*)\z", 1)
    stop = F.instr(after, ". ")
    tail = F.when(stop > 0, F.left(after, stop)).otherwise(after)
    sentence = F.concat(lead, match, tail)
    near = F.concat(F.right(before, F.lit(180)), match, F.left(after, F.lit(300)))
    return F.when(start > 0, F.trim(F.when(F.length(sentence) > limit, near).otherwise(sentence)))


def quality_note(text: Column) -> Column:
    return excerpt(text, QUALITY_NOTE)


def revision_note(text: Column) -> Column:
    return excerpt(text, REVISION_NOTE)


def labelled_links(text: Column, label: str = METHOD_WORD, reach: int = 180) -> Column:
    """Sorted public URLs with a label in the characters before them; a URL's own characters count as text before the next."""
    links = F.regexp_extract_all(text, F.lit(URL), F.lit(0))
    gaps = F.split(text, URL, -1)
    before = F.transform(links, lambda _, i: F.right(F.array_join(F.flatten(F.zip_with(F.slice(gaps, 1, i + 1), F.slice(links, 1, i), lambda g, u: F.array(g, F.coalesce(u, F.lit(""))))), ""), F.lit(reach)))
    both = F.zip_with(links, before, lambda u, b: F.when(b.rlike(label), F.rtrim(u, F.lit(".,;:!?"))))
    return F.array_sort(F.array_distinct(F.filter(both, lambda u: u.isNotNull() & safe_public_url(u))))


def markdown_links(text: Column, wanted: str) -> Column:
    """Sorted URLs of Markdown links whose label or URL matches a pattern."""
    pattern = r"(?i)\[([^\]]+)\]\((https?://[^)\s]+)\)"
    labels, urls = (F.regexp_extract_all(text, F.lit(pattern), F.lit(n)) for n in (1, 2))
    found = F.zip_with(labels, urls, lambda a, u: F.when(F.concat_ws(" ", a, u).rlike(wanted), u))
    return F.array_sort(F.array_distinct(F.filter(found, lambda u: u.isNotNull())))


def utc_expiry(text: Column) -> Column:
    """An RFC 3339 time with an offset as UTC; null for anything else."""
    whole = text.rlike(r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$")
    return F.when(whole, F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def period_extent(periods: Column, latest: Column) -> Column:
    """(start, end) of periods that are all years or all months, each once and none after ``latest``, a month; else null."""
    years, months = (F.forall(periods, lambda p: p.rlike(r"^\d{4}$")), F.forall(periods, lambda p: p.rlike(r"^\d{4}-(?:0[1-9]|1[0-2])$")))
    fit = (F.size(periods) > 0) & (years | months) & (F.size(F.array_distinct(periods)) == F.size(periods)) & F.forall(periods, lambda p: p <= F.left(latest, F.length(p)))
    return F.when(fit, F.struct(F.array_min(periods).alias("start"), F.array_max(periods).alias("end")))
