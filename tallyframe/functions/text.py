"""Text clean-up and composite text keys."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator for content hashes, and the characters a phone may carry.
HASH_SEPARATOR = "\u0001"
PHONE_PUNCTUATION = r"[-(). ]"


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from Unicode decomposition."""
    accented, plain = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


def fold_accents(c: Column) -> Column:
    """Replace accented Latin letters by their base letter and drop loose accent marks.

    Texts of one byte per character have none and pass untouched.
    """
    accented, plain = _accent_table()
    folded = F.regexp_replace(F.translate(c, accented, plain), r"[\u0300-\u036f]", "")
    return F.when(F.octet_length(c) > F.length(c), folded).otherwise(c)


def fold_name(name: str) -> str:
    """Driver-side twin of ``fold_accents`` + lower, for column names."""
    text = unicodedata.normalize("NFKD", name)
    return "".join(ch for ch in text if not unicodedata.combining(ch)).lower()


def trim_upper(c: Column) -> Column:
    return F.upper(F.trim(c))


def replace_chain(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply literal replacements in the given order."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def clean_address(c: Column, limit: int) -> Column:
    """Drop ``;`` and ``|``, halve double blanks, trim, drop line feeds, cut to ``limit``."""
    c = replace_chain(c, [(";", ""), ("|", ""), ("  ", " ")])
    return F.substring(replace_chain(F.trim(c), [("\n", "")]), 1, limit)


def clean_control_chars(c: Column) -> Column:
    """Turn each line feed, carriage return and tab into a blank."""
    return replace_chain(c, [("\n", " "), ("\r", " "), ("\t", " ")])


def strip_non_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def phone_digits(c: Column) -> Column:
    """The number without punctuation, or null when anything but digits remains."""
    bare = F.trim(F.regexp_replace(c, PHONE_PUNCTUATION, ""))
    return F.when(bare.rlike("^[0-9]+$"), bare)


def is_mobile(digits: Column) -> Column:
    return digits.startswith("3")


def mobile_number(c: Column) -> Column:
    digits = phone_digits(c)
    return F.when(is_mobile(digits), digits)


def landline_number(c: Column, min_digits: int = 7) -> Column:
    digits = phone_digits(c)
    return F.when(~is_mobile(digits) & (F.length(digits) >= min_digits), digits)


def first_token_int(c: Column) -> Column:
    """The text before the first blank, tabs removed, as int; null when it is none."""
    token = F.trim(F.substring_index(c, " ", 1))
    return F.replace(token, F.lit("\t"), F.lit("")).try_cast("int")


def guarded_substring(c: Column, min_length: int, start: int, size: int) -> Column:
    """A fixed slice of texts of at least ``min_length`` characters, else null."""
    return F.when(F.length(c) >= min_length, F.substring(c, start, size))


def concat_strict(*cols: Column) -> Column:
    """Null as soon as one part is null."""
    return F.concat(*cols)


def concat_blank(*cols: Column) -> Column:
    """A null part counts as the empty text."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def fixed_width_key(parts: Sequence[tuple[Column, int]], null_as: str | None = None) -> Column:
    """Zero-padded parts of fixed width, joined to one identifier."""
    padded = []
    for c, width in parts:
        text = c.cast("string")
        if null_as is not None:
            text = F.coalesce(text, F.lit(null_as))
        padded.append(F.lpad(text, width, "0"))
    return F.concat(*padded)


def content_hash(*cols: Column) -> Column:
    """md5 over the parts; nulls count as empty, a separator keeps part borders apart."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *texts))


def strip_trailing_zero_decimal(c: Column) -> Column:
    """``12.0`` to ``12``; other texts stay."""
    return F.when(c.rlike(r"^-?[0-9]+\.0+$"), F.regexp_replace(c, r"\.0+$", "")).otherwise(c)


def blank_empty_list(c: Column, blank: str = "") -> Column:
    """The text of an empty list becomes ``blank``."""
    return F.when(F.trim(c).rlike(r"^\[\s*\]$"), F.lit(blank)).otherwise(c)


def tidy(c: Column) -> Column:
    """Text without brackets, without quotes around it, and with one blank behind each comma."""
    bare = F.regexp_replace(c, r"[\[\]]", "")
    bare = F.regexp_replace(F.trim(bare), r"""^["']+|["']+$""", "")
    return F.regexp_replace(bare, r"\s*,\s*", ", ")


def list_like(text: Column) -> Column:
    return F.trim(text).rlike(r"(?s)^\[.*\]$")


def loose_items(text: Column) -> Column:
    """The items of text that looks like a list but is not JSON: cut at its commas, without quotes around an item."""
    bare = F.trim(text)
    inner = F.substring(bare, F.lit(2), F.greatest(F.length(bare) - 2, F.lit(0)))
    return F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"""^["']+|["']+$""", ""))


def list_items_normalize(items: Column, first_only: Column | bool = False) -> Column:
    """The texts of a list as one: ``a, b``, or ``a`` alone; null for a list without any."""
    known = F.filter(items, lambda x: x.isNotNull() & (F.trim(x) != ""))
    only = first_only if isinstance(first_only, Column) else F.lit(first_only)
    return F.get(F.transform(F.array(known), lambda k: F.when(F.size(k) > 0, tidy(F.when(only, F.get(k, F.lit(0))).otherwise(F.array_join(k, ", "))))), F.lit(0))


def list_text_normalize(c: Column, first_only: bool = False) -> Column:
    """``["a","b"]`` to ``a, b`` (or ``a``); an empty list to null; plain text is tidied.

    Text that looks like a list but is not JSON is split at its commas.
    """
    items = F.coalesce(F.from_json(F.trim(c), "array<string>"), loose_items(c))
    return F.when(list_like(c), list_items_normalize(items, first_only)).otherwise(tidy(F.trim(c)))
