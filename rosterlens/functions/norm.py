"""Normalizing and validating column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Toll-free area codes, area codes that no call reaches, and texts that stand for no address.
TOLL_FREE = ("800", "888", "877", "866", "855", "844", "833")
NO_AREA = ("999", "000", "555")
NO_ADDRESS = ("", "null", "n/a", "na", "unknown")
PLACEHOLDER_ZIPS = ("99999", "00000")


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def one_digit_repeated(d: Column) -> Column:
    return d.rlike(r"^(\d)\1*\z")


def bad_phone(c: Column) -> Column:
    d = digits(c)
    return (F.length(d) < 10) | one_digit_repeated(d)


def bad_zip(c: Column) -> Column:
    d = digits(c)
    return d.isin(*PLACEHOLDER_ZIPS) | ~F.length(d).isin(5, 9)


def bad_address(c: Column) -> Column:
    return F.lower(F.coalesce(c, F.lit(""))).isin(*NO_ADDRESS)


def well_formed_npi(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{10}\z"), F.lit(False))


def luhn_npi(c: Column) -> Column:
    """Whether a well-formed NPI has the check digit of its card-issuer form."""
    return F.call_function("luhn_check", F.concat(F.lit("80840"), c))


def scid(plan_id: Column) -> Column:
    """The standard component id of a plan id; null if it is malformed."""
    head = F.substring(plan_id, 1, 14)
    return F.when(head.rlike(r"^\d{5}[A-Z]{2}\d{7}\z"), head)


def days_before(date: str, days: int) -> Column:
    """The text of midnight that many days before: compared as text, a record of exactly that age is older."""
    return F.concat(F.date_sub(F.lit(date).cast("date"), days).cast("string"), F.lit(" 00:00:00"))


def dialable(d: Column) -> Column:
    return (F.length(d) == 10) & ~one_digit_repeated(d) & ~F.substring(d, 1, 3).isin(*NO_AREA)


def formatted_phone(c: Column) -> Column:
    """(212) 555-0100 for ten digits; other texts stay."""
    d = digits(c)
    return F.when(F.length(d) == 10, F.regexp_replace(d, r"^(\d{3})(\d{3})(\d{4})\z", "($1) $2-$3")).otherwise(c)


def toll_free(d: Column) -> Column:
    return F.substring(d, 1, 3).isin(*TOLL_FREE)


def grade(score: Column, n: Column | None = None) -> Column:
    out = F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 55, "D").otherwise("F")
    return out if n is None else F.when(n >= 10, out)


def json_of(**columns: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]), {"ignoreNullFields": "false"})


def rounded(c: Column | str, places: int) -> Column:
    """Rounded half up. Nine places come first, so that the order of a sum does not decide a tie."""
    return F.round(F.round(c, 9), places)
