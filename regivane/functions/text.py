"""Scalar functions as Column expressions; none leaves the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's strip() sees it.
_SPACES = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())

# Whole words that the aggressive form writes out.
ABBREVIATIONS = {
    "dr": "doctor",
    "gral": "general",
    "cd": "ciudad",
    "sta": "santa",
    "sto": "santo",
    "mto": "maestro",
    "prof": "profesor",
    "ing": "ingeniero",
    "lic": "licenciado",
}


@cache
def fold_table() -> tuple[str, str]:
    """Characters whose canonical decomposition less its marks is one ASCII letter or digit, and all marks, deleted."""
    kept, plain, marks = [], [], []
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        if unicodedata.category(c) == "Mn":
            marks.append(c)
        elif cp < 0x10000:
            base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if len(base) == 1 and base.isascii() and base.isalnum():
                kept.append(c)
                plain.append(base)
    return "".join(kept + marks), "".join(plain)


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(_SPACES))


def normalize_text(x: Column) -> Column:
    """Lower-case ASCII words with single blanks between; empty and ``nan`` give the empty text, null stays null."""
    plain = x.cast("string")
    folded = F.lower(F.translate(plain, *fold_table()))
    words = F.trim(F.regexp_replace(F.regexp_replace(folded, "[^a-z0-9 ]", " "), " +", " "))
    # the text as written is looked at only where its words are such
    return F.when((words == "nan") & (F.lower(strip(plain)) == "nan"), F.lit("")).otherwise(words)


def normalize_aggressive(x: Column) -> Column:
    """The normal form with abbreviations written out and the word ``de`` left out."""
    words = normalize_text(x)
    for short, full in ABBREVIATIONS.items():
        words = F.regexp_replace(words, rf"\b{short}\b", full)
    return F.trim(F.regexp_replace(F.regexp_replace(words, r"\bde\b", ""), " +", " "))


def zfill(x: Column, width: int) -> Column:
    """Zeros on the left up to ``width``; longer texts stay whole."""
    x = x.cast("string")
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, "0"))


def pad_code(x: Column, width: int) -> Column:
    return zfill(strip(x.cast("string")), width)


@cache
def digit_tables() -> tuple[str, str, str]:
    """Decimal digits beyond ASCII, what they stand for, and digits that are no decimal ones."""
    decimals, plain, others = [], [], []
    for cp in range(0x80, 0x110000):
        c = chr(cp)
        if c.isdecimal():
            decimals.append(c)
            plain.append(str(int(c)))
        elif c.isdigit():
            others.append(c)
    return "".join(decimals), "".join(plain), "".join(others)


def _digits(x: Column) -> Column:
    """Without white space around and thousands commas, decimal digits of any script as ASCII ones."""
    decimals, plain, _ = digit_tables()
    bare = F.replace(strip(x), F.lit(","), F.lit(""))
    return F.when(bare.rlike(r"^\p{ASCII}*$"), bare).otherwise(F.translate(bare, decimals, plain))


def is_odd_int(x: Column) -> Column:
    """Whether a count is in digits of which one at least is no decimal one."""
    others = digit_tables()[2]
    return F.coalesce(_digits(x).rlike(f"^[0-9{others}]*[{others}][0-9{others}]*$"), F.lit(False))


def to_int(x: Column) -> Column:
    """Digits with thousands commas as a number; anything else, null too, is 0."""
    digits = _digits(x)
    return F.when(digits.rlike("^[0-9]+$"), F.coalesce(digits.try_cast("bigint"), F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def safe_int(x: Column) -> Column:
    """The number in a text, cut to an integer; null where there is none."""
    return x.cast("string").try_cast("double").try_cast("bigint")


def code_repair(x: Column, width: int) -> Column:
    """A code that was read as a number (``1001.0``) back in its padded form; null and empty give the empty text."""
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("")).otherwise(zfill(safe_int(x).cast("string"), width))


def list_text(values: Column) -> Column:
    """A sorted list of texts as ``['a', 'b']``."""
    quoted = F.transform(F.sort_array(values), lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def title(x: Column) -> Column:
    """Each run of letters that have a case begins with a capital and goes on in small ones."""
    runs = F.regexp_extract_all(x, F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def thousands(x: Column) -> Column:
    return F.format_number(x, 0)


def first_of_month(year: Column, month: Column) -> Column:
    return F.date_format(F.make_date(year, month, F.lit(1)), "yyyy-MM-dd")


def last_of_month(year: Column, month: Column) -> Column:
    return F.date_format(F.last_day(F.make_date(year, month, F.lit(1))), "yyyy-MM-dd")


def mid_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(15))


def round_half_even(x: Column, digits: int = 2) -> Column:
    """A double rounded by its exact value, exact halves to the even digit; at most three digits.

    A double is a 53-bit integer times a power of two, so the digits wanted are an integer quotient
    by a power of two, whose rest decides; nothing is rounded on the way.
    """
    if not 0 < digits <= 3:
        raise ValueError("between one and three digits")
    parts = F.format_string("%a", F.abs(x))  # 0x1.8p-3: leading bit, fraction in base 16, exponent
    form = r"^0x([01])\.([0-9a-f]+)p(-?[0-9]+)$"
    whole = F.conv(F.concat(F.regexp_extract(parts, form, 1), F.rpad(F.regexp_extract(parts, form, 2), 13, "0")), 16, 10).try_cast("bigint")
    shift = F.lit(52) - F.regexp_extract(parts, form, 3).try_cast("int")
    number, by = whole * 10**digits, F.least(shift, F.lit(63))
    quotient = F.call_function("shiftright", number, by)
    rest, half = number - F.call_function("shiftleft", quotient, by), F.call_function("shiftleft", F.lit(1).cast("bigint"), by - 1)
    up = (rest > half) | ((rest == half) & (quotient % 2 == 1))
    rounded = quotient + up.cast("bigint")
    last = rounded % 10**digits
    digits_text = F.concat(F.call_function("div", rounded, F.lit(10**digits)).cast("string"), F.lit("."), F.lpad(last.cast("string"), digits, "0"))
    value = F.when(shift >= 64, F.lit(0.0)).otherwise(digits_text.try_cast("double"))
    return F.when(x.isNull() | ~parts.rlike(form) | (shift <= 0), x).otherwise(F.when(x < 0, -value).otherwise(value))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in per cent, as :func:`round_half_even` has it; null where ``whole`` is 0."""
    return round_half_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100, digits)
