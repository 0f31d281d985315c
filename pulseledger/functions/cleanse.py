"""Cleansing rules for single values, as ``Column -> Column`` expressions.

A null input stays null unless a rule says otherwise. (The data was first
cleaned by code that turned nulls into the text "nan" and back at the end; where
that detour changes a result the rule says so.)
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pulseledger.functions import vocabulary as words
from pulseledger.functions.text import (
    alphanumerics,
    digits,
    first_match,
    keyword_name,
    keyword_set_name,
    recode,
    single_spaced,
    titled,
    trimmed,
)

# Characters removed from names and addresses. In the last two
# sets ".-/" is a range from "." to "/", so a hyphen is removed as well.
PERSON_NAME_DROPS = r"(?U)[^a-zA-Z\s.-]"
MIDDLE_NAME_DROPS = r"(?U)[^a-zA-Z-\s]"
CITY_DROPS = r"[^a-zA-Z-]"
STREET_DROPS = r"(?U)[^a-zA-Z0-9\s#.-/]"
CONTACT_NAME_DROPS = r"(?U)[^a-zA-Z\s.-/()]"

# Patterns looked for in identifiers.
EMAIL = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
BENEFICIARY_ID = r"[A-Z0-9]{11}"
INSURANCE_ID = r"[A-Z]*\d+[A-Z]*\d+[A-Z]*\d+[A-Z]*\d*"
DIAGNOSIS = r"(?U)[E|I|R]\d+(\.\d+)?"
HEIGHT = r"(?U)^(\d+)[\D]*?(\d+)?[\D]*?$"
CALL_TIME = r"^(?:(\d+) days?,? ?)?(?:(\d+):(\d{2}):(\d{2}(?:\.\d+)?))?$"
TAG = r"<[^\n>]*>"

# Texts that stand for "no value" after cleansing.
NAN_TEXT = r"(?i)^nan$"
NA_TEXT = r"(?i)^na(n)?$"

MEDICARE_PAYER = "Medicare Part B"


def name(col: Column, drops: str) -> Column:
    """Trim, title case, single spaces, then remove the characters in ``drops``."""
    return F.regexp_replace(single_spaced(titled(trimmed(col))), drops, "")


def full_name(first: Column, last: Column) -> Column:
    """First and last name; a missing part shows as "Nan" beside the other one."""
    return F.concat_ws(" ", F.coalesce(first, F.lit("Nan")), F.coalesce(last, F.lit("Nan")))


def short_title(col: Column) -> Column:
    """Trim and title case (nickname, suffix)."""
    return titled(trimmed(col))


def email(col: Column) -> Column:
    """Lower-case address, null when the whole value is not one."""
    return first_match(F.lower(trimmed(col)), EMAIL)


def state(col: Column) -> Column:
    """Abbreviation of the state named in the text; else the text in upper case."""
    return F.upper(keyword_name(trimmed(col), words.STATES, keep_original=True))


def beneficiary_id(col: Column) -> Column:
    """First run of eleven letters and digits; else all letters and digits."""
    return first_match(alphanumerics(col), BENEFICIARY_ID, keep_original=True)


def diagnosis_codes(col: Column) -> Column:
    """All diagnosis codes without dots, comma-joined; empty text when there is none."""
    found = F.regexp_extract_all(F.upper(col), F.lit(DIAGNOSIS), F.lit(0))
    joined = F.array_join(F.transform(found, lambda code: F.replace(code, F.lit("."), F.lit(""))), ",")
    return F.coalesce(joined, F.lit(""))


def insurer(col: Column) -> Column:
    """Standard name of a known insurer; else the text in title case."""
    text = trimmed(col)
    return F.coalesce(keyword_set_name(text, words.INSURERS), titled(text))


def insurance_id(col: Column) -> Column:
    """Letters and digits of the id, cut after its last recognised digit group."""
    return first_match(alphanumerics(col), INSURANCE_ID, keep_original=True)


def primary_payer(payer: Column, payer_id: Column, beneficiary: Column) -> Column:
    """Medicare pays when a beneficiary id is the only insurance on file."""
    medicare = payer.isNull() & payer_id.isNull() & beneficiary.isNotNull()
    return F.when(medicare, MEDICARE_PAYER).otherwise(payer)


def primary_payer_id(payer: Column, payer_id: Column, beneficiary: Column) -> Column:
    """The beneficiary id stands in for a missing Medicare payer id."""
    medicare = (payer == MEDICARE_PAYER) & payer_id.isNull()
    return F.when(medicare, beneficiary).otherwise(payer_id)


def call_seconds(col: Column) -> Column:
    """Seconds of a duration such as "0:12:30" or "1 days 02:30:00"; 0 for none.

    A text that is not a duration gives null.
    """

    def part(group: int) -> Column:
        text = F.regexp_extract(col, CALL_TIME, group)
        return F.coalesce(F.nullif(text, F.lit("")).try_cast("double"), F.lit(0.0))

    seconds = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(col.isNull() | (col == ""), F.lit(0.0)).when(col.rlike(CALL_TIME), seconds)


def note_type(col: Column) -> Column:
    """The first of the comma-separated types."""
    first = F.split_part(col, F.lit(","), F.lit(1))
    return F.when(col == "Initial Evaluation with APRN", "Initial Evaluation").otherwise(first)


def vendor(vendor_col: Column, device_name: Column) -> Column:
    """The vendor if the device name mentions it; else the one the name does mention."""
    named = F.coalesce(F.contains(device_name, vendor_col), F.lit(False))
    other = F.when(device_name.contains("Tenovi"), "Tenovi").otherwise("Omron")
    return F.when(named, vendor_col).otherwise(other)


def relationship(contact_name: Column) -> Column:
    """Relationship word in the contact's name, null when there is none."""
    return keyword_name(contact_name, words.RELATIONSHIPS)


def race(col: Column) -> Column:
    """Standard name of a known race; else the text in title case."""
    text = trimmed(col)
    return F.coalesce(keyword_set_name(text, words.RACES), titled(text))


def weight_lbs(col: Column) -> Column:
    """First three digits; null when the text reads like a height; 0 without digits.

    A missing weight is 0 too.
    """
    weight = F.coalesce(_number(F.substr(digits(col), F.lit(1), F.lit(3))), F.lit(0))
    looks_like_height = F.coalesce(F.lower(col).rlike("'|\"|ft|in"), F.lit(False))
    return F.when(~looks_like_height, weight)


def _number(digit_text: Column) -> Column:
    """Digits as a number; nothing for no digits (kept from the cast, where it is an error)."""
    return F.nullif(digit_text, F.lit("")).try_cast("bigint")


def height_in(col: Column) -> Column:
    """Feet and inches as inches; a bare number counts as feet."""
    text = trimmed(col)
    feet = _number(F.regexp_extract(text, HEIGHT, 1))
    inches = F.coalesce(_number(F.regexp_extract(text, HEIGHT, 2)), F.lit(0))
    return F.when(~F.lower(text).rlike("lbs|kg"), feet * 12 + inches)


def digits_only(col: Column) -> Column:
    """Digits of a phone or social-security number; empty text for a missing one."""
    return F.coalesce(digits(col), F.lit(""))


def sex(col: Column) -> Column:
    return recode(col, words.SEXES)


def member_status(col: Column) -> Column:
    return recode(col, words.MEMBER_STATUSES)


def zip_base(col: Column) -> Column:
    return F.split_part(col, F.lit("-"), F.lit(1))


@F.pandas_udf(StringType())
def _html_unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def plain_text(col: Column) -> Column:
    """Resolve HTML character references, then remove tags.

    Spark has no function for the references. Only texts with an ampersand
    travel to the Python worker; the others cross as nulls.
    """
    coded = F.when(col.contains("&"), col)
    return F.regexp_replace(F.coalesce(_html_unescaped(coded), col), TAG, "")


def staff_call_seconds(author: Column, seconds: Column) -> Column:
    """Practitioners book a fixed time."""
    fixed = F.lit(float(words.PRACTITIONER_SECONDS))
    return F.when(author.isin(*words.PRACTITIONERS), fixed).otherwise(seconds)


def staff_note_type(author: Column, kind: Column) -> Column:
    """Evaluators and the alert team write one kind of note."""
    return (
        F.when(author.isin(*words.ALERT_TEAM), "Alert")
        .when(author.isin(*words.EVALUATORS), "Initial Evaluation")
        .otherwise(kind)
    )


def whole_number(col: Column) -> Column:
    """Numeric coercion: null where the text is not a number."""
    return col.try_cast("double").try_cast("bigint")


def flag(col: Column, inverted: bool = False) -> Column:
    """A boolean as 1/0; ``inverted`` gives 0/1."""
    truth = col.cast("boolean")
    return (~truth if inverted else truth).cast("int")


def two_decimals(col: Column) -> Column:
    """Round half to even on the scaled value, as NumPy does."""
    return F.rint(col.try_cast("double") * 100) / 100


def device_code(col: Column) -> Column:
    return F.replace(col, F.lit("-"), F.lit(""))
