"""String helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# White space removed at both ends of a text: all that Unicode counts as such.
BLANKS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
          + "\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column | str) -> Column:
    """Text without white space at its ends."""
    return F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(BLANKS))


def collapse_ws(text: Column) -> Column:
    """Every run of white space becomes one space; NULL becomes ''."""
    return strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere ('R.d.24b' -> 'R.D.24B')."""
    # initcap works on words between spaces: a marked space after every other character makes the
    # letters behind it a word, and is taken out again. A mark that the text itself holds stays, as
    # another mark follows it before any space.
    lowered = F.lower(strip(F.coalesce(text, F.lit(""))))
    marked = F.regexp_replace(lowered, r"([^\p{L}])", "$1\x01 ")
    return F.replace(F.initcap(marked), F.lit("\x01 "), F.lit(""))


def normalize_alpha(text: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), "[^A-Z0-9]", "")


def stn_code(code: Column, location: Column) -> Column:
    """Station code as text; a missing code is derived from the location's hash."""
    generated = F.concat(
        F.lit("GEN-"),
        F.upper(F.substring(F.md5(strip(F.coalesce(location, F.lit("")))), 1, 6)),
    )
    return F.coalesce(F.regexp_replace(code.cast("string"), r"\.0$", ""), generated)


def state_slug(state: Column) -> Column:
    return F.replace(
        F.replace(F.lower(state), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")
    )


def slug_from_stem(stem: Column) -> Column:
    """'andhra_pradesh_2020_clean' -> 'andhra_pradesh'."""
    return F.regexp_replace(F.regexp_replace(stem, "_?clean$", ""), r"(^|_)\d+$", "")


def year_from_stem(stem: Column) -> Column:
    """Year at the end of a file stem, before an optional '_clean'; NULL when there is none."""
    return F.regexp_extract(stem, r"_(\d+)(_clean)?$", 1).try_cast("int")


def state_name(slug: Column) -> Column:
    return title_case(F.replace(slug, F.lit("_"), F.lit(" ")))


def truncate_text(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when one of a fixed list of words occurs in the text."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def first_type(text: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Label of the first rule one of whose words occurs in the lower-cased text."""
    lowered = F.lower(text)
    result = F.lit(None).cast("string")
    for label, words in reversed(rules):
        result = F.when(contains_any(lowered, words), F.lit(label)).otherwise(result)
    return result


def split_list(text: Column) -> Column:
    """Items of a comma-separated text, trimmed, without empty ones; NULL gives []."""
    items = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda item: strip(item))
    return F.filter(items, lambda item: item != "")


def ordered_distinct(items: Column) -> Column:
    """Duplicates removed, first occurrence kept in place."""
    return F.array_distinct(items)


def clean_items(items: Column) -> Column:
    """Items trimmed, empty and missing ones dropped; NULL gives []."""
    trimmed = F.transform(items, lambda item: strip(item))
    kept = F.filter(trimmed, lambda item: item.isNotNull() & (item != ""))
    return F.coalesce(kept, F.array().cast("array<string>"))


def json_list(items: Column) -> Column:
    return F.coalesce(F.to_json(items), F.lit("[]"))
