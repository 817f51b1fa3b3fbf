"""Small scalar functions as column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_id(reference: Column) -> Column:
    """What follows a reference's last slash; null if nothing does."""
    return F.nullif(F.substring_index(reference, "/", -1), F.lit(""))


def round7(value: Column) -> Column:
    """Rounded to 7 decimals, halves away from zero."""
    return F.round(value * 1e7) / F.lit(1e7)


@cache
def _folds() -> tuple[str, str, str]:
    """By compatibility decomposition, what is ASCII in it: characters that become one, those in order, and the others as a text of `\\0` + character + its ASCII."""
    one, plain, more = [], [], []
    for code in range(0x80, 0x20000):
        char = chr(code)
        found = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode() if not 0xD800 <= code < 0xE000 else ""
        if len(found) == 1:
            one.append(char)
            plain.append(found)
        elif found:
            more.append(f"\0{char}{found}")
    return "".join(one), "".join(plain), "".join(more) + "\0"


def slugify(text: Column) -> Column:
    """Compatibility forms and accents folded to ASCII, what has no ASCII dropped, lower case, other runs as single hyphens, none at the ends."""
    one, plain, more = _folds()

    def several(char: Column) -> Column:
        found = F.call_function("regexp_extract", F.lit(more), F.concat(F.lit("\\x00\\Q"), char, F.lit("\\E([^\\x00]*)")), F.lit(1))
        return F.when(char.rlike("^[\\x00-\\x7F]*$"), char).otherwise(found)

    folded = F.translate(text, one, plain)
    folded = F.when(folded.rlike("[^\\x00-\\x7F]"), F.array_join(F.transform(F.split(folded, "(?!^)"), several), "")).otherwise(folded)
    return F.regexp_replace(F.regexp_replace(F.lower(folded), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def alias_list(text: Column) -> Column:
    """Parts between semicolons, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x != "")


def first_value(items: Column, system: str, key: str = "system", value: str = "value") -> Column:
    """The value of the first item of a system in an array of structs."""
    return F.get(F.filter(items, lambda i: i[key] == system), F.lit(0))[value]


def in_preference(items: Column, systems: list[str]) -> Column:
    """The value of the first system, in order of preference, whose first item has one."""
    return F.coalesce(*[first_value(items, s) for s in systems])


def whole_number(text: Column) -> tuple[Column, Column]:
    """(count, issue): rounded half away from zero; bad_number if not numeric or too large, fractional_count if rounding changed it."""
    value = text.try_cast("double")
    rounded = F.round(value)
    bad = value.isNull() | F.isnan(value) | (F.abs(rounded) > 2147483647.0)
    return F.when(~bad, rounded.cast("int")), F.when(text.isNull(), None).when(bad, "bad_number").when(F.abs(value - rounded) > 1e-6, "fractional_count")


def score(value: Column, factor: Column) -> Column:
    """value / factor, rounded at 1e-10; null for a factor of 0."""
    return F.round(F.try_divide(value, factor) * 1e10) / F.lit(1e10)


def scoring(denominator: Column, factor: Column) -> Column:
    """cohort if the denominator is the text 1, proportion at factor 100, ratio otherwise."""
    return F.when(denominator == "1", "cohort").when(factor == 100, "proportion").otherwise("ratio")


def is_fhir_id(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[A-Za-z0-9.\-]{1,64}$"), F.lit(False))


def if_match(version: Column) -> Column:
    """The entity tag under which a version is replaced."""
    return F.concat(F.lit('W/"'), version, F.lit('"'))


INSTANT = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])T([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)(\.[0-9]+)?(Z|[+\-]([01][0-9]|2[0-3]):[0-5][0-9])$"


def instant_key(text: Column) -> Column:
    """(seconds, nanoseconds) of a strict instant, comparable across offsets; second 60 is the next minute's start; null if malformed."""
    leap = F.substring(text, 18, 2) == "60"
    base = F.concat(F.substring(text, 1, 17), F.when(leap, "59").otherwise(F.substring(text, 18, 2)), F.regexp_extract(text, "(Z|[+\\-][0-9:]{5})$", 1))
    seconds = F.unix_seconds(F.try_to_timestamp(base)) + F.when(leap, 1).otherwise(0)
    digits = F.rpad(F.substring(F.regexp_extract(text, r"\.([0-9]+)", 1), 1, 9), 9, "0")
    nanos = F.when(text.contains("."), digits.cast("int")).otherwise(0)
    return F.when(text.rlike(INSTANT) & seconds.isNotNull(), F.struct(seconds.alias("seconds"), nanos.alias("nanos")))


def format_utc(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def path_segment(value: Column) -> Column:
    """A partition value as a directory name: characters that file systems refuse become _, trailing dots and spaces go."""
    text = F.regexp_replace(F.coalesce(value, F.lit("null")), r"\x00", "")
    text = F.regexp_replace(text, r'[/\\<>:"|?*\x01-\x1F\x7F]', "_")
    text = F.regexp_replace(text, r"[. ]+$", "")
    reserved = F.upper(F.regexp_extract(text, r"^([^.]*)", 1)).rlike("^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$")
    return F.when(text == "", "empty").when(reserved, F.concat(text, F.lit("_"))).otherwise(text)
