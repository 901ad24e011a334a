"""Places and closeness: province tables, distances and trigram similarity, in columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The provinces and territories.
PROVINCES = ["ON", "QC", "BC", "AB", "SK", "MB", "NS", "NB", "NL", "PE", "NT", "YT", "NU"]
#: The province that the first letter of a postal code gives. A, C and Y stand as in the data source, not as in the postal system
#: (Newfoundland, Prince Edward Island, Yukon), which ``llm.golden.POSTAL_PROVINCES`` follows.
POSTAL_LETTERS = {"A": "NS", "B": "NS", "C": "SK", "E": "NB", "G": "QC", "H": "QC", "J": "QC", "K": "ON", "L": "ON", "M": "ON", "N": "ON", "P": "ON", "R": "MB", "S": "SK", "T": "AB", "V": "BC", "Y": "NT"}
#: Codes by spelled-out name; codes themselves are taken in any capitals.
PROVINCE_NAMES = {
    "alberta": "AB",
    "british columbia": "BC",
    "manitoba": "MB",
    "new brunswick": "NB",
    "newfoundland and labrador": "NL",
    "newfoundland": "NL",
    "northwest territories": "NT",
    "nova scotia": "NS",
    "nunavut": "NU",
    "ontario": "ON",
    "prince edward island": "PE",
    "quebec": "QC",
    "saskatchewan": "SK",
    "yukon": "YT",
}


def lookup(table: dict[str, str], key: Column) -> Column:
    """A value of a short fixed table; null for other keys."""
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def province_from_postal(postal: Column, table: dict[str, str] = POSTAL_LETTERS) -> Column:
    return lookup(table, F.substring(F.upper(F.trim(postal)), 1, 1))


def province_code(raw: Column) -> Column:
    """The code of a typed province: a code in any capitals, or a name; null for others."""
    t = F.trim(raw)
    return F.when(F.upper(t).isin(PROVINCES), F.upper(t)).otherwise(lookup(PROVINCE_NAMES, F.lower(t)))


def region_code(region: Column) -> Column:
    """The code of a region named by its code in any capitals, with or without its country before it; null for others."""
    code = F.upper(F.regexp_replace(F.trim(region), r"^[A-Za-z]{2}-", ""))
    return F.when(code.isin(PROVINCES), code)


def derived_province(own: Column, by_postal: Column, by_city: Column) -> Column:
    """``struct<province, how, conflict, unresolved>``: an own valid code, else by the postal code, else by the city; the postal code wins over the city, which is a conflict."""
    code = F.upper(own)
    valid, derived = F.coalesce(code.isin(PROVINCES), F.lit(False)), F.coalesce(by_postal, by_city)
    best = F.when(valid, code).otherwise(derived)
    how = F.when(valid, "own").when(by_postal.isNotNull(), "postal").when(by_city.isNotNull(), "city")
    return F.struct(best.alias("province"), how.alias("how"), F.coalesce(by_postal != by_city, F.lit(False)).alias("conflict"), best.isNull().alias("unresolved"))


def flat_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Kilometres on a plane that touches the second point; good for short distances."""
    return 111.32 * F.sqrt(F.pow(lat_a - lat_b, 2) + F.pow((lng_a - lng_b) * F.cos(F.radians(lat_b)), 2))


def trigrams(text: Column, of: Callable[[Column], Column] = lambda piece: piece) -> Column:
    """The set of three-letter pieces of a text's words, each with two spaces before and one behind, or of what ``of`` makes of a piece."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))  # once for a word, not for each piece
    pieces = lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: of(F.substring(p, i, 3)))
    return F.array_distinct(F.flatten(F.transform(padded, pieces)))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared pieces by all pieces of two ``trigrams`` sets; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared.cast("double"), (F.size(a) + F.size(b) - shared).cast("double")), F.lit(0.0))
