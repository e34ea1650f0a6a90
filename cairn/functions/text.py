"""Text functions as Column expressions: folding, the three tokenizers, plain text, slugs, shards and URLs."""

from __future__ import annotations

import json
import unicodedata
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that the search tokenizer leaves out.
SEARCH_STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "into", "is", "it", "of", "on", "or", "the", "to", "with")
#: Words that the similarity tokenizer leaves out.
SIMILARITY_STOP_WORDS = (
    "a", "an", "and", "as", "at", "by", "data", "dataset", "for", "from", "in", "of", "on", "statistics", "the", "to", "uk", "united", "kingdom", "with",
)
#: Patterns of the three tokenizers.
SEARCH_PATTERN, SIMILARITY_PATTERN, BROWSER_PATTERN = "[a-z0-9][a-z0-9._-]*", "[a-z0-9][a-z0-9'-]+", "[a-z0-9][a-z0-9'-]*"


def _base_letters() -> tuple[str, str]:
    """Latin letters with one mark, and the letters below it."""
    pairs = [(chr(c), "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x))) for c in range(0xC0, 0x180)]
    kept = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept)


MARKED, BASE = _base_letters()


def fold(text: Column) -> Column:
    """Lower case without accents, for text in Latin-1 and Latin Extended-A."""
    return F.replace(F.lower(F.translate(text, MARKED, BASE)), F.lit("ß"), F.lit("ss"))


@F.pandas_udf(T.StringType())
def fold_any(text: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks, case-folded, for any script."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).casefold())


#: The search tokens of a text are the longest runs of its pattern without points, lines and hyphens at their ends, of two characters at least.
SEARCH_TOKEN = "[a-z0-9][a-z0-9._-]*[a-z0-9]"
#: Keys of a URL's query that name a secret.
SECRET_KEYS = (
    "access_token", "apikey", "api_key", "authorization", "client_secret", "credential", "key", "password", "secret", "sig", "signature", "token", "uid", "x-api-key",
)


def _words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def search_tokens(text: Column, folded: Column | None = None) -> Column:
    """Distinct tokens in order of appearance, two characters or more, without stop words."""
    return F.array_except(_words(fold(text) if folded is None else folded, SEARCH_TOKEN), F.array(*map(F.lit, SEARCH_STOP_WORDS)))


def similarity_tokens(text: Column) -> Column:
    """Tokens with repetitions, accents kept, by the stop words for similarity."""
    stop = F.array(*map(F.lit, SIMILARITY_STOP_WORDS))
    return F.filter(_words(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), SIMILARITY_PATTERN), lambda t: ~F.array_contains(stop, t))


def browser_tokens(text: Column) -> Column:
    """Distinct tokens of any length, no stop words."""
    return F.array_distinct(_words(F.lower(text), BROWSER_PATTERN))


def unescape(text: Column) -> Column:
    """HTML entities by name and number, in one pass."""
    names = F.from_json(F.lit(json.dumps({name: chr(code) for name, code in sorted(name2codepoint.items())})), "map<string,string>")

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^&(#?[0-9A-Za-z]+);", 1)
        number = F.when(name.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.rlike("^#[0-9]{1,7}$"), F.substring(name, 2, 7)).try_cast("int")
        by_number = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        sign = F.coalesce(F.try_element_at(names, name), by_number)
        return F.when(sign.isNotNull(), F.concat(sign, F.substr(piece, F.length(name) + 3))).otherwise(piece)

    return F.when(text.contains("&"), F.array_join(F.transform(F.split(text, "(?=&)"), one), "")).otherwise(text)


def bounded(text: Column, limit: int) -> Column:
    """Text cut to ``limit`` characters, the last of which is then an ellipsis."""
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.left(text, F.lit(limit - 1))), F.lit("…"))).otherwise(text)


def plain_text(html: Column, limit: int = 10_000) -> Column:
    """Entities resolved, scripts, styles and tags out, white space collapsed, cut to a limit. Text with nothing of the kind is only cut."""
    marked = html.contains("&") | html.contains("<") | html.contains("\\") | html.rlike(r"\s")
    text = F.regexp_replace(unescape(html), "(?is)<script.*?</script>|<style.*?</style>", " ")
    text = F.regexp_replace(text, "(?s)<[^>]+>", " ")
    text = F.replace(F.replace(text, F.lit("\\r\\n"), F.lit(" ")), F.lit("\\n"), F.lit(" "))
    return bounded(F.when(marked, F.trim(F.regexp_replace(text, r"[\s]+", " "))).otherwise(html), limit)


def slug(text: Column, fallback: str = "record", markup: bool = True) -> Column:
    """Letters and digits with hyphens between, at most 180; text known to hold no markup is taken as it is."""
    words = F.btrim(F.regexp_replace(F.replace(F.lower(plain_text(text, 500) if markup else text), F.lit("ß"), F.lit("ss")), "[^a-z0-9]+", "-"), F.lit("-"))
    return F.rtrim(F.left(F.coalesce(F.nullif(words, F.lit("")), F.lit(fallback)), F.lit(180)), F.lit("-"))


def shard(token: Column, length: int = 2) -> Column:
    return F.coalesce(F.nullif(F.left(F.regexp_replace(F.lower(token), "[^a-z0-9]", ""), F.lit(length)), F.lit("")), F.lit("_"))


def public_host(url: Column) -> Column:
    """Lower-case host of an http or https URL without credentials; else null."""
    ok = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & F.try_parse_url(url, F.lit("USERINFO")).isNull()
    return F.when(ok, F.lower(F.try_parse_url(url, F.lit("HOST"))))


def safe_public_url(url: Column) -> Column:
    """Whether a URL has a public host and no query key that names a secret."""
    secret = F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit("")).rlike(f"(?i)(^|&)({'|'.join(SECRET_KEYS)})(=|&|$)")
    return F.coalesce(public_host(url).isNotNull(), F.lit(False)) & ~secret


def evidence_band(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.55, "medium").otherwise("low")


def table_title(title: Column) -> Column:
    """Title without a leading code, words only, for comparing tables across sources."""
    bare = F.regexp_replace(title, r"(?i)^\s*[A-Z]{2}\d{3}[A-Z]*\s*(?:[-:–—]|$)", "")
    return F.trim(F.regexp_replace(F.replace(F.lower(bare), F.lit("&"), F.lit("and")), "[^a-z0-9]+", " "))


def canonical_standard(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"[-_\s]+", "-")
