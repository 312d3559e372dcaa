"""Column functions over text: cleaning, tokens, PII, licenses. All stay inside the JVM but for Unicode normalisation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.schema import LICENSE_NAMES

# The patterns of personal data and credentials.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
API_KEY = r"\b(?:sk|pk|api|token|secret)[-_]?[A-Za-z0-9]{16,}\b|\bAKIA[0-9A-Z]{16}\b|\bghp_[A-Za-z0-9]{20,}\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
IPV4 = r"\b(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\b"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
SPACE = r"[ \t\r\n\f\x0B]"


@F.pandas_udf(T.StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode normal form C; Spark has no built-in for it. A null stays null."""
    for t in texts:
        yield t.str.normalize("NFC")


def clean_text(c: Column, normalize: bool = False) -> Column:
    """Drops control characters, squeezes blanks in lines, trims lines and the whole; null becomes empty."""
    c = F.coalesce(nfc(c) if normalize else c, F.lit(""))
    c = F.regexp_replace(c, CONTROL, "")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"\n[ \t\r]+", "\n"), r"[ \t\r]+\n", "\n")
    return strip(c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$", "")


def slug(c: Column) -> Column:
    """Lower case; other characters than letters and digits become single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def words(c: Column) -> Column:
    """Whitespace-delimited words."""
    return F.regexp_extract_all(c, F.lit(r"[^ \t\r\n\f\x0B]+"), F.lit(0))


def once(value: Column, use) -> Column:
    """use(value), with the value computed once however often `use` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[^ \t\r\n\f\x0B]+"))


def sentences(c: Column) -> Column:
    """Non-blank parts between white space that follows a full stop, exclamation or question mark."""
    marked = F.regexp_replace(c, r"([.!?])[ \t\r\n\f\x0B]+", "$1\x01")
    return F.filter(F.split(marked, "\x01"), lambda s: strip(s) != "")


def tokens(c: Column) -> Column:
    """Runs of ASCII letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def shingles(toks: Column, k: int = 4) -> Column:
    """Distinct k-grams of tokens; fewer tokens give one short shingle, none give none."""
    # Shifted copies are zipped, so that no lambda holds the tokens: what a lambda holds is computed for each element.
    every = toks
    for j in range(1, k):
        every = F.zip_with(every, F.slice(toks, F.lit(j + 1), F.greatest(F.size(toks), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    every = F.filter(every, lambda g: g.isNotNull())
    short = F.array(F.array_join(toks, " "))
    return F.when(F.size(toks) == 0, F.array().cast("array<string>")).when(F.size(toks) < k, short).otherwise(F.array_distinct(every))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; 0 where either is empty."""
    same = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(same / (F.size(a) + F.size(b) - same))


def pii_flags(c: Column) -> Column:
    """Array of email, api_key, ssn, ipv4, in that order, as found."""
    return F.array_compact(F.array(*(F.when(c.rlike(p), F.lit(n)) for n, p in (("email", EMAIL), ("api_key", API_KEY), ("ssn", SSN), ("ipv4", IPV4)))))


def redact(c: Column) -> Column:
    for pattern, mark in ((EMAIL, "[REDACTED_EMAIL]"), (API_KEY, "[REDACTED_SECRET]"), (SSN, "[REDACTED_SSN]")):
        c = F.regexp_replace(c, pattern, mark)
    return c


def license_name(c: Column) -> Column:
    """Canonical name; null and empty are `unknown`, other names stay as they are, trimmed."""
    names = F.create_map(*(F.lit(x) for kv in LICENSE_NAMES.items() for x in kv))
    text = strip(c)
    return F.when(F.coalesce(c, F.lit("")) == "", "unknown").otherwise(F.coalesce(F.element_at(names, F.lower(text)), text))


def license_denied(c: Column) -> Column:
    """Null is denied, empty is allowed."""
    return F.coalesce(F.lower(strip(c)).rlike("cc-by-nc|cc-by-nd|proprietary|all-rights-reserved|unknown"), F.lit(True))


def share_alike(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).contains("cc-by-sa"), F.lit(False))


def attribution_required(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.coalesce(~low.startswith("cc0") & low.rlike(r"cc-by-|apache-2\.0|bsd|mit|odc-by|attribution"), F.lit(False))


def license_class(c: Column) -> Column:
    """First of: DENIED, use-restricted, share-alike, permissive, review."""
    low = F.lower(strip(c))
    return (
        F.when(license_denied(c), "DENIED")
        .when(low.rlike("rail"), "use-restricted")
        .when(share_alike(c), "share-alike")
        .when(low.rlike(r"mit|apache|bsd|cc0|cc-by|public domain|isc"), "permissive")
        .otherwise("review")
    )


def statement_license(c: Column) -> Column:
    """The license that a text names in a statement of its own; `unknown` where it names none."""
    return F.when(c.rlike("MIT License"), "MIT").when(c.rlike("Apache License"), "Apache-2.0").when(c.rlike("GNU General Public License"), "GPL-3.0").otherwise("unknown")


def band(c: Column) -> Column:
    return F.when(c >= 0.8, "strong").when(c >= 0.6, "adequate").when(c >= 0.4, "weak").otherwise("poor")


def stable_id(source: Column, raw: Column, content: Column) -> Column:
    """slug(source)_slug(raw)_12 hex digits of the content."""
    return F.concat_ws("_", slug(source), F.substring(slug(raw), 1, 48), F.substring(F.sha2(F.concat_ws("\x1f", source, raw, content), 256), 1, 12))


def human_bytes(c: Column) -> Column:
    n = c.cast("double")
    return F.when(n < 1024, F.concat(c.cast("long").cast("string"), F.lit(" B"))).when(n < 1 << 20, F.format_string("%.1f KB", n / 1024)).when(n < 1 << 30, F.format_string("%.1f MB", n / (1 << 20))).otherwise(F.format_string("%.1f GB", n / (1 << 30)))


def source_of_id(c: Column) -> Column:
    """The first underscore-separated part of an id that is letters and then digits."""
    return F.get(F.filter(F.split(c, "_"), lambda p: p.rlike("^[A-Za-z]+[0-9]+$")), 0)
