"""Column functions over text: normalization, hashing, feed cleaning, dates.

Everything is a built-in expression except two small Arrow UDFs (canonical composition
and HTML unescaping). Both receive NULL for the rows that cannot need them, so ordinary
text never crosses into Python.
"""

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = r"\p{IsWhite_Space}"
_DROPPED_CONTROL = rf"[\p{{Cc}}&&[^{_SPACE}]]"
# Below U+0300 every string is already in composed form.
_MAY_COMPOSE = r"[^\x{0}-\x{2FF}]"


@F.pandas_udf(T.StringType())
def _compose(text: pd.Series) -> pd.Series:
    return text.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


@F.pandas_udf(T.StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def nfc(text: Column) -> Column:
    return F.coalesce(_compose(F.when(text.rlike(_MAY_COMPOSE), text)), text)


def unescape_html(text: Column) -> Column:
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def trim_space(text: Column) -> Column:
    """Trim every Unicode whitespace character, not only the plain space."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{_SPACE}+", " "))


def lower_simple(text: Column) -> Column:
    """Lowercase character by character: dotted I and final sigma get no special form."""
    for special, plain in (("İ", "i"), ("Σ", "σ")):
        text = F.replace(text, F.lit(special), F.lit(plain))
    return F.lower(text)


def normalize_text(text: Column) -> Column:
    """Compose, drop control characters, collapse whitespace, lowercase, trim."""
    no_control = F.regexp_replace(nfc(text), _DROPPED_CONTROL, "")
    return lower_simple(collapse_space(no_control))


def content_hash(title: Column, body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat(title, F.lit("\n"), body), 256))


def hash_id(prefix: str, unique: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha1(unique), 1, 16))


def normalize_lang(lang: Column) -> Column:
    """Language spelling to a short lowercase code; '' when unspecified."""
    code = lower_simple(trim_space(F.coalesce(lang, F.lit(""))))
    return (
        F.when(code.isin("", "und", "unknown"), F.lit(""))
        .when(code == "english", F.lit("en"))
        .otherwise(F.regexp_replace(code, r"(?s)^([^-_]+)[-_].*$", "$1"))
    )


def clean_text(markup: Column) -> Column:
    """Feed description to plain text: strip tags, then unescape, then collapse."""
    return collapse_space(unescape_html(F.regexp_replace(markup, "<[^>]*>", " ")))


def first_non_empty(*values: Column) -> Column:
    """First value that is not blank, trimmed; '' when all are."""
    return F.coalesce(*[F.nullif(trim_space(v), F.lit("")) for v in values], F.lit(""))


def model_text(title: Column, body: Column) -> Column:
    """Text handed to the sentiment model."""
    blank = F.lit(WHITE_SPACE + "\x1c\x1d\x1e\x1f")
    t, b = (F.btrim(F.coalesce(c, F.lit("")), blank) for c in (title, body))
    return F.when((t != "") & (b != ""), F.concat(t, F.lit(". "), b)).otherwise(
        F.concat(t, b)
    )


# The date layouts feeds use, as patterns.
_WEEKDAY = r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"
_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
           "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
_MONTH = "(" + "|".join(_MONTHS) + ")"
_CLOCK = r"(\d{1,2}):(\d{2}):(\d{2})(?:[.,](\d+))?"
_ABBREVIATION = r"(?-i:GMT[+-]\d{1,2}|[A-Z]{3,4})"
_LONG_NUMERIC = rf"(?i)^{_WEEKDAY}, (\d{{1,2}}) {_MONTH} (\d{{4}}) {_CLOCK} ([+-]\d{{4}})$"
_LONG_NAMED = rf"(?i)^{_WEEKDAY}, (\d{{2}}) {_MONTH} (\d{{4}}) {_CLOCK} ({_ABBREVIATION})$"
_SHORT = rf"(?i)^(\d{{2}}) {_MONTH} (\d{{2}}) (\d{{1,2}}):(\d{{2}})() ?()([+-]\d{{4}}|{_ABBREVIATION})$"
RFC3339_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}T\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:\d{2})$"
)
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:\d{2})?$"
)


def _zone_offset(zone: Column) -> Column:
    """Numeric offsets as they are, GMT±h in hours, any other abbreviation as UTC."""
    hours = F.regexp_extract(zone, r"^GMT([+-])(\d{1,2})$", 2)
    sign = F.regexp_extract(zone, r"^GMT([+-])(\d{1,2})$", 1)
    return (
        F.when(zone.rlike(r"^[+-]\d{4}$"),
               F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)))
        .when(hours != "", F.concat(sign, F.lpad(hours, 2, "0"), F.lit(":00")))
        .otherwise(F.lit("Z"))
    )


def _dated(text: Column, pattern: str) -> Column:
    def part(i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    year = F.when(F.length(part(3)) == 4, part(3)).otherwise(
        F.concat(F.when(part(3) >= "69", F.lit("19")).otherwise(F.lit("20")), part(3))
    )
    names = F.array(*[F.lit(m.lower()) for m in _MONTHS])
    month = F.array_position(names, F.lower(part(2))).cast("string")
    iso = F.concat(
        year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0"),
        F.lit("T"), F.lpad(part(4), 2, "0"), F.lit(":"), part(5), F.lit(":"),
        F.lpad(part(6), 2, "0"), F.lit("."), F.rpad(F.substring(part(7), 1, 6), 6, "0"),
        _zone_offset(part(8)),
    )
    return F.when(text.rlike(pattern), F.try_to_timestamp(iso))


def parse_iso(text: Column, pattern: str = ISO_PATTERN) -> Column:
    """ISO time to timestamp; without an offset it is UTC. NULL when it does not match."""
    t = F.regexp_replace(text, r"[.,](\d{1,6})\d*", ".$1")
    t = F.regexp_replace(t, r"([T ])(\d:)", "$10$2")
    return F.when(text.rlike(pattern), F.try_to_timestamp(t))


def parse_feed_date(text: Column) -> Column:
    """RFC 1123, RFC 822 (either zone form) or RFC 3339 time; NULL when unparseable."""
    t = trim_space(text)
    return F.coalesce(
        _dated(t, _LONG_NUMERIC),
        _dated(t, _LONG_NAMED),
        _dated(t, _SHORT),
        parse_iso(t, RFC3339_PATTERN),
    )


def parse_compact_date(text: Column) -> Column:
    """``20260720T120000Z`` style time; NULL when unparseable."""
    t = trim_space(text)
    iso = F.regexp_replace(
        t, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$", "$1-$2-$3T$4:$5:$6Z"
    )
    return F.when(t.rlike(r"^\d{8}T\d{6}Z$"), F.try_to_timestamp(iso))


def format_rfc3339(ts: Column) -> Column:
    """UTC time as RFC 3339 text, fraction without trailing zeros."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(whole, r"\.?0{1,6}$", ""), F.lit("Z"))
