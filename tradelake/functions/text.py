"""Text of responses and references: numbers, codes, labels, damage."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURES = ["export_usd", "export_weight_kg", "import_usd", "import_weight_kg", "trade_balance_usd"]
LEVELS = (8, 6, 4, 2)


#: Characters that Unicode calls white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """Without white space at the ends, of any Unicode kind."""
    return F.btrim(text, F.lit(SPACES))


#: The grammar of whole numbers and of fractions, in ASCII: digits may be parted by single underscores.
DIGITS = "[0-9]+(?:_[0-9]+)*"
WHOLE = f"^[+-]?{DIGITS}$"
FRACTION = f"^[+-]?(?:{DIGITS}\\.?(?:{DIGITS})?|\\.{DIGITS})(?:[eE][+-]?{DIGITS})?$"
#: The first double beyond a bigint.
BEYOND = float(1 << 63)


def bare_number(text: Column) -> Column:
    return F.replace(strip(text), F.lit(","), F.lit(""))


def as_int(text: Column) -> Column:
    """Integer text, commas allowed; a fraction is cut off; empty, ``-`` and anything that is no number are null.

    A number beyond a bigint is null too, never its nearest bigint; ``as_wide_int`` has it.  Plain digits, by far
    the most, are one cast, and so are those of a short plain fraction, whose double (15 digits) is never cut off elsewhere;
    only what that leaves is stripped and tried by the grammar.
    """
    bare = bare_number(text)
    digits = F.replace(bare, F.lit("_"), F.lit(""))
    real = digits.try_cast("double")
    rest = F.when(bare.rlike(WHOLE), digits.try_cast("bigint")).when(bare.rlike(FRACTION) & (real >= -BEYOND) & (real < BEYOND), real.try_cast("bigint"))
    return F.when(text.rlike("^-?[0-9]{1,18}$"), text.try_cast("bigint")).when(text.rlike("^-?[0-9]{1,9}[.][0-9]{1,6}$"), F.substring_index(text, ".", 1).try_cast("bigint")).otherwise(rest)


def as_wide_int(text: Column) -> Column:
    """As ``as_int``, for numbers of up to 38 digits: a whole number exactly, a fraction as the double that stands for it."""
    bare = bare_number(text)
    digits = F.replace(bare, F.lit("_"), F.lit(""))
    real, wide = digits.try_cast("double"), "decimal(38,0)"
    size = F.abs(real)
    high = F.floor(size / 2.0**64)  # a double of over 2^63 is cut into parts that are exact
    middle = F.floor((size - high.cast("double") * 2.0**64) / 2.0**32)
    low = size - high.cast("double") * 2.0**64 - middle.cast("double") * 2.0**32
    place = lambda part, power: part.cast("bigint").cast("decimal(19,0)") * F.lit(Decimal(1 << power))
    parts = (place(high, 64) + place(middle, 32) + low.cast("bigint").cast("decimal(19,0)")).try_cast(wide)
    far = F.when(size < 1e38, F.when(real < 0, -parts).otherwise(parts).try_cast(wide))
    near = (real > -BEYOND) & (real < BEYOND)
    return F.when(bare.rlike(WHOLE), digits.try_cast(wide)).when(bare.rlike(FRACTION), F.when(near, real.try_cast("bigint").cast(wide)).otherwise(far))


def is_full_code(code: Column) -> Column:
    return code.rlike("^[0-9]{10}$")


def level_of(code: Column, level: int) -> Column:
    return F.substring(code, 1, level)


def reaches_level(code: Column, level: int) -> Column:
    """Whether a short code's digits identify its group at a level."""
    return code.rlike("^[0-9]+$") & F.length(code).between(level, 9)


def has_hangul(text: Column) -> Column:
    return text.rlike("[ᄀ-ᇿ㄰-㆏가-힣]")


def bad_unicode_reason(text: Column) -> Column:
    """The gravest damage of a text: replacement characters, NUL, other control characters; else null."""
    return F.when(F.contains(text, F.lit("�")), "replacement_character").when(F.contains(text, F.lit("\x00")), "nul_character").when(text.rlike(r"[\x01-\x08\x0b\x0c\x0e-\x1f]"), "control_character")


def redact_key(text: Column) -> Column:
    return F.regexp_replace(text, r"(?i)(serviceKey=)[^&\s]+", "$1[REDACTED]")


def decode_key(key: Column) -> Column:
    """URL-decoded, a plus sign kept as it is."""
    return F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))


def label_or(label: Column, code: Column) -> Column:
    """A label, or the code where it is missing or blank."""
    return F.coalesce(F.nullif(F.trim(label), F.lit("")), code)


def short_label(text: Column, length: int = 58) -> Column:
    return F.substring(text, 1, length)
