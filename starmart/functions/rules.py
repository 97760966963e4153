"""Conforming rules as native Column expressions.

A rule names its input as few times as it can: filters on a conformed column are pushed to the
scan with the whole expression inlined, so every extra mention is evaluated again for every row.

Two trims are kept apart on purpose: rules that come from SQL remove spaces only,
rules that come from files remove every kind of surrounding whitespace.

Most texts are already as a rule wants them. A comparison finds that out, or a trim does the work;
a regular expression, which costs several times as much per row, sees only what is left.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions import fixed_values as fixed


WHITESPACE = " \t\n\x0b\f\r"  # what \s stands for
DIGITS = "0123456789"


def _trimmed(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def strip(c: Column) -> Column:
    c = c.cast("string")
    begins_and_ends_visibly = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(begins_and_ends_visibly, c).otherwise(F.regexp_replace(c, r"^\s+|\s+$", ""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_match(c: Column, pattern: str) -> Column:
    """The first match of a pattern, NULL when there is none."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), F.lit(0))


def stripped_or_null(c: Column) -> Column:
    return F.nullif(_trimmed(c), F.lit(""))


def has_text(c: Column) -> Column:
    """True for text with any non-whitespace character, False for blank text and NULL."""
    return F.coalesce(_trimmed(c) != "", F.lit(False))


def has_length(c: Column, least: int) -> Column:
    """True for text of at least so many characters without the whitespace around it."""
    return F.length(_trimmed(c)) >= least


def not_blank(c: Column) -> Column:
    """True for text with any character but spaces; a filter on it drops blank text and NULL."""
    return F.trim(c) != ""


def blank_default(c: Column, default: str | Column) -> Column:
    return F.coalesce(blank_to_null(c), default if isinstance(default, Column) else F.lit(default))


def digits_only(c: Column) -> Column:
    c = c.cast("string")
    return F.when(F.ltrim(c, F.lit(DIGITS)) == "", c).otherwise(F.regexp_replace(c, "[^0-9]", ""))


def _without_leading_zeros(c: Column) -> Column:
    """Leading zeros go, an empty text is '0'; the input is never NULL."""
    return F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), F.lit("0"))


def establishment_id(c: Column) -> Column:
    """SQL rule: spaces and leading zeros go; nothing left, or NULL, is '0'."""
    return _without_leading_zeros(F.coalesce(F.trim(c.cast("string")), F.lit("")))


def establishment_id_from_file(c: Column, no_digit_as_zero: bool = False) -> Column:
    """File rule: digits without leading zeros.

    A text without digits is NULL, or '0' when ``no_digit_as_zero``; blank text is always NULL.
    """
    usable = _trimmed(c) != "" if no_digit_as_zero else c.rlike("[0-9]")
    return F.when(usable, _without_leading_zeros(digits_only(c)))


def department_key(place: Column) -> Column:
    """The department of a place code: three digits where such a code exists, else two, else ''."""
    overseas = [code for code in fixed.DEPARTMENT_REGION if len(code) == 3]
    place = place.cast("string")
    start = F.substring(place, 1, 3)
    plain = F.when(start.isin(overseas), start).otherwise(F.substring(place, 1, 2))
    any_other = F.regexp_extract(F.regexp_replace(place, "[^0-9]", ""), f"^({'|'.join(overseas)}|[0-9]{{2}})", 1)
    key = F.when((F.length(start) == 3) & (F.ltrim(start, F.lit(DIGITS)) == ""), plain).otherwise(any_other)
    # Never NULL, so a join on it adds no IS NOT NULL filter that would evaluate the key again.
    return F.coalesce(key, F.lit(""))


def region_name_key(name: Column) -> Column:
    """A region name with accents folded, lower-cased and reduced to letters."""
    return F.regexp_replace(
        F.lower(F.translate(name, fixed.ACCENTED, fixed.UNACCENTED)), "[^a-z]", "")


def two_digit_code(c: Column) -> Column:
    return first_match(digits_only(c), "^[0-9]{2}")


def decimal_comma(c: Column, strict: bool = False) -> Column:
    """Number with a decimal comma or point; blank is NULL, any other text is NULL or, strictly, an error."""
    if strict:
        return F.replace(stripped_or_null(c), F.lit(","), F.lit(".")).cast("decimal(10,4)")
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(10,4)")


def date_text(c: Column) -> Column:
    """The first ten characters of the stripped text; NULL for blank text."""
    return F.substring(stripped_or_null(c), 1, 10)


def text_date(c: Column) -> Column:
    """The day a text begins with; NULL for anything that is no calendar day."""
    c = c.cast("string")
    day = c.try_cast("date")
    return F.when((F.length(c) == 10) & (day.cast("string") == c), day).otherwise(
        F.regexp_extract(c, r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).try_cast("date"))


def day_first_date(c: Column) -> Column:
    return F.try_to_date(F.trim(c), "dd-MM-yyyy")


def calendar_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_columns(day: Column) -> list[Column]:
    """Key and attributes of a day. The year is the calendar year, the week is the ISO week."""
    return [
        calendar_key(day).alias("id_temps"),
        day.alias("date_complete"),
        F.year(day).alias("annee"),
        F.quarter(day).alias("trimestre"),
        F.month(day).alias("mois"),
        F.weekofyear(day).alias("semaine"),
    ]


def full_name(last: Column, first: Column) -> Column:
    return F.trim(F.concat(F.coalesce(last, F.lit("")), F.lit(" "), F.coalesce(first, F.lit(""))))


def sex_code(c: Column) -> Column:
    text = F.lower(F.trim(c))
    return F.when(text.startswith("m"), "M").when(text.startswith("f"), "F")


def blank_safe_int(c: Column) -> Column:
    return blank_to_null(c).try_cast("int")


def age_band(age: Column) -> Column:
    band = F.when(age.isNull(), fixed.NOT_STATED)
    for bound, label in fixed.AGE_BANDS:
        band = band.when(age < bound, label)
    return band.otherwise(fixed.OPEN_AGE_BAND)


def prefix_mask(c: Column) -> Column:
    return F.concat(F.lit(fixed.PATIENT_PREFIX), c)


def keyed_pseudonym(c: Column, key: bytes) -> Column:
    """HMAC-SHA256 of a text column, as lower-case hexadecimal.

    The padded keys are literals of the plan: keep plans and event logs as private as the key.
    """
    block = 64
    padded = key.ljust(block, b"\0")
    if len(key) > block:
        import hashlib

        padded = hashlib.sha256(key).digest().ljust(block, b"\0")
    inner = F.lit(bytearray(byte ^ 0x36 for byte in padded))
    outer = F.lit(bytearray(byte ^ 0x5C for byte in padded))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(c, "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def establishment_label(name: Column, establishment: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit(fixed.ESTABLISHMENT_PREFIX), establishment))


def region_label(label: Column) -> Column:
    return F.coalesce(label, F.lit(fixed.UNKNOWN_REGION))


def generated_region_label(code: Column) -> Column:
    return F.concat(F.lit(fixed.REGION_PREFIX), code)
