"""Column functions over text: counts, normalisation, scripts, numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: So many texts at a time are Python objects in a worker.
TEXTS = 128


def text_udf(one: Callable):
    """A UDF of ``one``, from a value to a text, null to null; a worker gives its free memory back after each batch."""

    @F.arrow_udf(StringType())
    def run(values: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.string())]
        for start in range(0, len(values), TEXTS):
            few = values.slice(start, TEXTS).to_pylist()
            parts.append(pa.array([None if x is None else one(x) for x in few], pa.string()))
        out = pa.concat_arrays(parts)
        del parts
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)
        return out

    return run


#: White space as Unicode-aware splitting sees it.
SPACE_CLASS = r"[\t-\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: Unicode blocks expected for a locale.
LOCALE_BLOCKS = {
    "ar": [(0x0600, 0x06FF), (0x0750, 0x077F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "fa": [(0x0600, 0x06FF), (0x0750, 0x077F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "ur": [(0x0600, 0x06FF), (0x0750, 0x077F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "he": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "el": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "hi": [(0x0900, 0x097F)],
    "ja": [(0x3040, 0x309F), (0x30A0, 0x30FF), (0x4E00, 0x9FFF), (0x3000, 0x303F)],
    "ko": [(0xAC00, 0xD7AF), (0x1100, 0x11FF), (0x3130, 0x318F)],
    "ru": [(0x0400, 0x04FF), (0x0500, 0x052F)],
    "th": [(0x0E00, 0x0E7F)],
    "vi": [(0x0080, 0x024F), (0x1E00, 0x1EFF)],
    "zh-Hans": [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x3000, 0x303F)],
    "chr": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)],
}


def block_class(blocks: list[tuple[int, int]]) -> str:
    """A regex class of code point ranges."""
    return "[" + "".join(f"\\x{{{lo:04X}}}-\\x{{{hi:04X}}}" for lo, hi in blocks) + "]"


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def token_count(text: Column) -> Column:
    """Tokens between Unicode white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")).cast("long")


def script_count(text: Column, blocks: list[tuple[int, int]]) -> Column:
    return count_matches(text, block_class(blocks))


def year_number(text: Column) -> Column:
    """First run of one to four digits, negative before the common era; null without digits."""
    digits = F.regexp_extract(text, "([0-9]{1,4})", 1)
    sign = F.when(text.contains("BCE") | F.ltrim(text).startswith("-"), -1).otherwise(1)
    return F.when(digits != "", digits.cast("int") * sign)


def normalize_newlines(text: Column) -> Column:
    """LF line ends, no trailing blanks, at most one blank line, one final LF."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(out, "[ \t]+\n", "\n")
    out = F.regexp_replace(out, "\n{3,}", "\n\n")
    return F.concat(F.rtrim(out, F.lit(" \t\n")), F.lit("\n"))


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, "[ \t\n\r]", "")


def width_at(lengths: Column, share: float = 0.85, default: int = 60) -> Column:
    """The sorted length at index int(n * share); ``default`` without lines."""
    at = F.floor(F.size(lengths) * share).cast("int")
    return F.coalesce(F.get(F.sort_array(lengths), at), F.lit(default))


def yaml_scalar(value: Column) -> Column:
    """A value quoted if it holds a colon or newline."""
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(value.rlike("[:\n]"), F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(value)


#: Ends of lines as Unicode-aware splitting sees them.
LINE_ENDS = r"\r\n|[\n\r\x{0B}\x{0C}\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
#: Digits of scripts with digits of their own, and consonants that the Hawaiian alphabet lacks.
DIGITS = {"bn": "০১২৩৪৫৬৭৮৯", "pa": "੦੧੨੩੪੫੬੭੮੯", "gu": "૦૧૨૩૪૫૬૭૮૯"}
FOREIGN = "bcdfgjqrstvxyz"


def clean_lines(text: Column) -> Column:
    """The lines of a text, white space collapsed and trimmed, without empty ones."""
    lines = F.transform(F.split(text, LINE_ENDS), lambda x: F.trim(F.regexp_replace(x, SPACE_CLASS + "+", " ")))
    return F.filter(lines, lambda x: x != "")


def left_trim_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"(?md)^[ \t]+", "")


def tidy_spaces(text: Column) -> Column:
    """LF ends, runs of spaces as one but for two that end a line, at most one blank line, one final LF."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(out, "(?<=[^ \n]) {2}(?=\n)", "\x00")
    out = F.regexp_replace(F.regexp_replace(out, " {2,}", " "), "[ \t]+(?=\n)", "")
    out = F.regexp_replace(F.replace(out, F.lit("\x00"), F.lit("  ")), "\n{3,}", "\n\n")
    return F.concat(F.regexp_replace(out, r"^\s+|\s+$", ""), F.lit("\n"))


def upper_share(text: Column) -> Column:
    """Share of upper-case letters among the letters; null without any."""
    return count_matches(text, r"\p{Lu}") / F.nullif(count_matches(text, r"\p{L}"), F.lit(0))


def caps_heading(line: Column) -> Column:
    """A line of three letters or more, 55 characters at most, nearly all of them in upper case."""
    short = F.rtrim(F.trim(line), F.lit("."))
    return (count_matches(short, r"\p{L}") >= 3) & (F.length(short) <= 55) & F.coalesce(upper_share(short) >= 0.8, F.lit(False))


def foreign_share(text: Column, consonants: str = FOREIGN) -> Column:
    """Share of the consonants that an alphabet lacks among the letters; null without any."""
    low = F.lower(text)
    return count_matches(low, f"[{consonants}]") / F.nullif(count_matches(low, r"\p{L}"), F.lit(0))


def replace_all(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def replace_once(text: Column, old: str, new: str) -> Column:
    """A literal replacement that must have exactly one place."""
    n = (F.length(text) - F.length(F.replace(text, F.lit(old)))) / len(old)
    return F.when(n == 1, F.replace(text, F.lit(old), F.lit(new))).otherwise(F.raise_error(F.concat(n.cast("string"), F.lit(f" places for {old!r}"))))


def digit_slips(text: Column, digit: str, letter: str) -> tuple[Column, Column]:
    """A text with a digit that touches a letter or mark, but no digit, as the letter it stands for; and how many there are."""
    near = r"[\p{L}\p{M}]"
    pattern = rf"(?<!\p{{Nd}})(?:(?<={near}){digit}|{digit}(?={near}))(?!\p{{Nd}})"
    return F.regexp_replace(text, pattern, letter), count_matches(text, pattern)


def roman_number(text: Column) -> Column:
    """A Roman number with its misread strokes put right; other texts as they are."""
    return F.when(text.rlike(r"^[IVXLCDMl|]+\.?$"), F.translate(text, "l|", "II")).otherwise(text)


def syllables(text: Column, delimiters: str) -> Column:
    """Parts between delimiters; what stands in square brackets counts as one."""
    plain = F.regexp_replace(text, r"\[[^\]]*\]", " X ")
    return F.size(F.filter(F.split(plain, f"[{delimiters}]+"), lambda x: x != ""))


def chunks(items: Column, size: int) -> Column:
    """An array in runs of ``size``, the last one shorter."""
    n = F.ceil(F.size(items) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(items, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))


def title_case(text: Column) -> Column:
    return F.initcap(F.lower(text))


def dotted_number(text: Column) -> Column:
    """The numbers of a heading with dots between them."""
    return F.array_join(F.regexp_extract_all(text, F.lit("[0-9]+"), 0), ".")


def page_name(url: Column) -> Column:
    """The last part of a page's address, decoded; a plus sign stays."""
    return F.element_at(F.split(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), "/"), -1)


def from_native_digits(text: Column, locale: str) -> Column:
    return F.translate(text, DIGITS[locale], "0123456789")


def to_native_digits(text: Column, locale: str) -> Column:
    return F.translate(text, "0123456789", DIGITS[locale])


def percent(share: Column) -> Column:
    return F.format_string("%.0f%%", F.bround(share * 100, 0))
