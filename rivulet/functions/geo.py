"""Location texts and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.numbers import to_double
from rivulet.functions.text import strip


def _words(words: list[str]) -> str:
    return r"(?iU)\b(" + "|".join(words) + r")\b"


def geocode_simplify(location: Column) -> Column:
    """Station name reduced to the words a gazetteer may know."""
    text = F.lower(strip(F.coalesce(location.cast("string"), F.lit(""))))
    text = F.regexp_replace(text, r"(?iU)^(" + "|".join(R.GEO_LEADING_WORDS) + r")\s+", "")
    text = F.regexp_replace(text, _words(R.GEO_POSITION_WORDS), "")
    text = F.regexp_replace(text, _words(R.GEO_DESCRIPTOR_WORDS), "")
    text = F.regexp_replace(text, r"[,\-\(\)]+", " ")
    text = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    for old, new in R.GEO_SPELLINGS.items():
        text = F.regexp_replace(text, rf"(?iU)\b{old}\b", new)
    return text


def geocode_candidates(location: Column, state: Column, simplified: Column) -> Column:
    """Distinct search texts, best first.

    The simplified name, the full name, then the last three, two and one longer words.
    """
    place = F.concat(F.lit(", "), state, F.lit(f", {R.COUNTRY}"))
    words = F.filter(F.split(simplified, " "), lambda w: F.length(w) > 3)
    texts = [
        F.when(simplified != "", F.concat(simplified, place)),
        F.concat(strip(location), place),
    ]
    for count in (3, 2, 1):
        tail = F.array_join(F.slice(words, -count, count), " ")
        texts.append(F.when(F.size(words) >= count, F.concat(tail, place)))
    return F.array_distinct(F.filter(F.array(*texts), lambda t: t.isNotNull()))


def valid_coordinate(lat: Column, lon: Column) -> Column:
    """True for a finite position on the globe."""
    return F.coalesce(
        to_double(lat).between(-90, 90) & to_double(lon).between(-180, 180), F.lit(False)
    )
