"""City, street and geocode-key rules for single-line addresses."""

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as V
from .text import _c, blank_to_null, remove, squish, title_case

CITY_PATTERN = "(" + "|".join(V.CITIES) + ")"
CLEAN_CITY = {city.lower(): V.CITY_SPELLING.get(city, city) for city in V.CITIES}
# A city at the end, and a line break that may stand behind it, lie in this many last characters.
TAIL_LENGTH = max(map(len, V.CITIES)) + 2


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])[key]


def clean_city(city: Column | str) -> Column:
    """Title-cased city with its one canonical spelling."""
    c = title_case(squish(city))
    return F.coalesce(_lookup(V.CITY_SPELLING, c), c)


def derive_city(address: Column | str, name: Column | str, default: str = V.DEFAULT_CITY) -> Column:
    """City at the end of the address, else the jurisdiction code on the name, else a default."""
    tail = F.regexp_extract(F.right(squish(address), F.lit(TAIL_LENGTH)), f"(?i){CITY_PATTERN}$", 1)
    code = F.regexp_extract(_c(name), "^([A-Z]{2,4}) - ", 1)
    # What is not found is an empty text, which no mapping holds; so each pattern is looked for once.
    return F.coalesce(_lookup(CLEAN_CITY, F.lower(tail)), _lookup(V.NAME_PREFIX_CITY, code), F.lit(default))


def street_only(address: Column | str) -> Column:
    """Address without its city. The bare city is stripped once only."""
    return squish(remove(remove(squish(address), V.FULL_CITY_TAIL), rf"(?i)[,\s]+{CITY_PATTERN}$"))


def display_street(street: Column | str) -> Column:
    """Reader-facing street: unit numbers stay, shouting and export artefacts go."""
    a = squish(street)
    for pattern, replacement in V.SHOWN_UNIT_RULES:
        a = F.regexp_replace(a, pattern, replacement)

    # Regex callbacks do not exist here: cut the text into capital runs and the rest, calm
    # the runs that are ordinary words, and join again.
    tokens = F.regexp_extract_all(a, F.lit("([A-Z]{2,}|[A-Z]|[^A-Z]+)"), F.lit(1))
    shouted = lambda t: F.rlike(t, F.lit("^[A-Z]{2,}$")) & ~t.isin(*V.KEEP_UPPER)
    a = F.array_join(F.transform(tokens, lambda t: F.when(shouted(t), F.initcap(t)).otherwise(t)), "")

    a = F.regexp_replace(a, r"(?i)\bSvrd\b", "Service Rd")
    for word in V.ROAD_DESIGNATORS:
        a = F.regexp_replace(a, rf"(?i)\b{word}(?=\s*[0-9])", word)
    for word in V.BOUND_SUFFIXES:
        a = F.regexp_replace(a, rf"(?i)\b{word}\b", word)
    for letter in "nsew":
        a = F.regexp_replace(a, rf"\b{letter}\b", letter.upper())
    return squish(a)


def normalize_street(street: Column | str) -> Column:
    """Street in the form geocoders match: no unit, no shouting, plain highway notation."""
    a = squish(street)
    a = F.when(~F.rlike(a, F.lit("[a-z]")), title_case(a)).otherwise(a)
    for pattern, replacement in V.GEOCODE_STREET_RULES:
        a = F.regexp_replace(a, pattern, replacement)
    return squish(a)


def geocode_query(
    street: Column | str,
    city: Column | str,
    zip_code: Column | str,
    address: Column | str | None = None,
    state: str = V.STATE,
) -> Column:
    """Cache key of a location.

    With a ZIP the key never changes. Without one, a ZIP hidden in the text is recovered (and
    taken out of the street); failing that the key is built without a ZIP.
    """
    given = blank_to_null(zip_code)
    text = _c(street) if address is None else F.coalesce(_c(address), _c(street))
    recovered = F.when(given.isNull(), blank_to_null(F.regexp_extract(text, V.HIDDEN_ZIP, 1)))
    zipped = F.coalesce(given, recovered)

    # The long rules stand in the expression once: a pattern that never matches leaves the street as it is.
    hidden = F.coalesce(F.concat(F.lit(r",?\s*\b"), recovered, F.lit(r"\b\s*$")), F.lit("(?!)"))
    norm = squish(F.regexp_replace(normalize_street(street), hidden, F.lit("")))
    ending = F.coalesce(F.concat(F.lit(", "), zipped), F.lit(""))
    return squish(F.concat(norm, F.lit(", "), _c(city), F.lit(f", {state}"), ending))


def legacy_key(
    address: Column | str, zip_code: Column | str, city: str = V.DEFAULT_CITY, state: str = V.STATE
) -> Column:
    """Key of the first geocoding pass, which took one fixed city for every address."""
    return squish(F.concat(_c(address), F.lit(f", {city}, {state}, "), _c(zip_code)))
