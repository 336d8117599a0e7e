"""Name and text normalisation as built-in column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V

# Runs of Unicode whitespace that are not already one plain space; in ordinary text that
# leaves almost nothing to replace.
WHITESPACE = r" *[\t\n\f\r\p{Z}&&[^ ]][\t\n\f\r\p{Z}]*| {2,}"
NOT_ALNUM = "[^a-z0-9]+"
# One word for title casing: letters, digits and underscores, joined across an apostrophe,
# full stop or colon only when letters stand on both sides ("O'Brien", "L.C.").
WORD = (
    r"[\p{L}\p{N}_]*\p{L}(?:['’.:]\p{L}(?:[\p{L}\p{N}_]*\p{L})?)+[\p{N}_]*"
    r"|[\p{L}\p{N}_]+"
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(_c(x), F.lit(""))


def squish(x: Column | str) -> Column:
    """Trim, and collapse every run of whitespace to one space."""
    return F.trim(F.regexp_replace(_c(x), WHITESPACE, " "))


def remove(x: Column | str, pattern: str | Column) -> Column:
    return F.regexp_replace(_c(x), pattern, "")


def title_case(x: Column | str) -> Column:
    """Capitalise the first character of every word and lower the rest of it."""
    tokens = F.regexp_extract_all(_c(x), F.lit(rf"({WORD}|[^\p{{L}}\p{{N}}_]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))
        ),
        "",
    )


def zip5(x: Column | str) -> Column:
    return blank_to_null(F.regexp_extract(_c(x), r"^([0-9]{5})", 1))


def display_name(x: Column | str) -> Column:
    """Drop a leading jurisdiction code. For display only, never a key."""
    codes = "|".join(V.DISPLAY_CITY_CODES)
    return squish(remove(x, rf"^({codes})\s*-\s*"))


def venue_of(x: Column | str) -> Column:
    """Parent operator of a name: text before a slash, without a trailing unit number."""
    words = "|".join(V.VENUE_SUFFIX_WORDS)
    v = squish(remove(x, "/.*$"))
    v = remove(v, rf"(?i)\s+({words})\s*[0-9]+\s*$")
    return remove(v, r"\s+[0-9]+\s*$")


def alnum_key(x: Column | str) -> Column:
    return remove(F.lower(_c(x)), NOT_ALNUM)


def norm_name(x: Column | str, prefixes: tuple[str, ...] = V.MATCH_PREFIXES) -> Column:
    """Match key of a name; a jurisdiction prefix goes only when its hyphen is there."""
    return remove(remove(F.lower(_c(x)), rf"^({'|'.join(prefixes)})\s*-\s*"), NOT_ALNUM)


def loose_name(x: Column | str, prefixes: tuple[str, ...] = V.MATCH_PREFIXES) -> Column:
    """Looser name for containment tests: the hyphen is optional, store numbers go too."""
    bare = remove(F.lower(_c(x)), rf"^({'|'.join(prefixes)})\s*-?\s*")
    return remove(remove(bare, r"#\s*[0-9]+"), NOT_ALNUM)


def norm_street(x: Column | str) -> Column:
    """Match key of a street: unit words go, their numbers stay."""
    words = "|".join(V.UNIT_WORDS_MATCH)
    return remove(F.regexp_replace(F.lower(_c(x)), rf"\b({words})\b", " "), NOT_ALNUM)


def house_num(x: Column | str) -> Column:
    return blank_to_null(F.regexp_extract(squish(x), "^([0-9]+)", 1))


def either_contains(a: Column | str, b: Column | str, min_len: int = 1) -> Column:
    """True when one text holds the other. Texts shorter than ``min_len`` never match."""
    a, b = _c(a), _c(b)
    long_enough = (F.length(a) >= min_len) & (F.length(b) >= min_len)
    return long_enough & (F.contains(a, b) | F.contains(b, a))


def truncate(x: Column | str, width: int) -> Column:
    x = _c(x)
    return F.when(
        F.length(x) > width, F.concat(F.substring(x, 1, width - 3), F.lit("..."))
    ).otherwise(x)


def thousands(x: Column | str) -> Column:
    return F.format_number(_c(x), 0)


def to_int(x: Column | str) -> Column:
    """Whole part of a number held as text; NULL when it is not a number."""
    return _c(x).try_cast("double").try_cast("int")


def haystack(*fields: Column | str) -> Column:
    return F.lower(F.concat_ws(" ", *[_c(f) for f in fields]))
