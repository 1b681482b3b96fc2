r"""Text functions.

White space and word characters follow the Unicode rules of the data's producer. In Java patterns
``\s`` does so only under the ``(?U)`` flag; ``\w`` and ``\b`` differ in detail even then, so word
characters are spelled out.
"""

from __future__ import annotations

import re
from functools import reduce
from html.entities import name2codepoint
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, for trimming and inside a character class.
WHITE = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
WS = r"\s\x1C-\x1F"  # inside a character class of a pattern with the (?U) flag
WORD = r"\p{L}\p{N}_"
WORD_START = rf"(?<![{WORD}])"
WORD_END = rf"(?![{WORD}])"

# Placeholders.
UNTITLED = "Untitled Record"
NO_CONTENT = "No content available."
NO_OVERVIEW = "No overview available."
NO_TEXT = "No text available."
UNKNOWN = "unknown"

# Words that mean "no value".
NA_TOKENS = ["", "None", "none", "null", "NULL", "N/A", "n/a", "NaN", "nan"]
NULL_LABELS = ["", "nan", "none", "null", "n/a"]

# The topic and crime vocabularies.
TOPIC_TERMS = [
    "election", "politics", "government", "ai", "technology", "market", "business", "economy",
    "climate", "sports", "crime", "police", "war", "health", "education", "inflation", "banking",
    "cyber", "security", "startup", "media", "court", "policy", "finance",
]
CRIME_TERMS = [
    "murder", "kill", "killer", "crime", "criminal", "detective", "investigation", "investigate",
    "police", "case",
]

# Characters that file systems refuse.
ILLEGAL_IN_FILE_NAMES = '<>:"/\\|?*'


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def non_blank(c: Column) -> Column:
    """The value, or NULL where it is blank."""
    return F.when(strip(c) != "", c)


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)[{WS}]+", " ")


def fill(c: Column, default: str) -> Column:
    """Trimmed text; NULL and blank become ``default``."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(default))


def match_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """First match, NULL where there is none (Spark itself gives an empty string)."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def normalise_space(c: Column) -> Column:
    """Runs of blanks and tabs to one blank, runs of line ends to one empty line, no outer space."""
    spaced = F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \t]+", " ")
    return strip(F.regexp_replace(spaced, r"\n{2,}", "\n\n"))


def clean_title(c: Column) -> Column:
    """The bracketed year goes after the white space is collapsed, so an inner gap may stay."""
    tidy = collapse(strip(F.coalesce(c, F.lit(UNTITLED))))
    return fill(F.regexp_replace(tidy, r"\(\p{Nd}{4}\)", ""), UNTITLED)


def clean_language(c: Column) -> Column:
    code = F.lower(strip(F.coalesce(c, F.lit(UNKNOWN))))
    return F.when(code.rlike("^[a-z]{2}$"), code).otherwise(UNKNOWN)


def clean_body(c: Column) -> Column:
    no_tags = F.regexp_replace(strip(F.coalesce(c, F.lit(NO_CONTENT))), "<[^>]+>", " ")
    return fill(collapse(no_tags), NO_CONTENT)


def clean_label(c: Column) -> Column:
    label = collapse(F.lower(strip(F.coalesce(c, F.lit(UNKNOWN)))))
    spaced = F.regexp_replace(label, f"(?U)[{WS}]*,[{WS}]*", ", ")
    return F.when(spaced.isin(NULL_LABELS), UNKNOWN).otherwise(spaced)


def plain_label(c: Column, null_words: list[str]) -> Column:
    """Trimmed lower-case label; the given words become unknown."""
    label = F.lower(strip(F.coalesce(c, F.lit(UNKNOWN))))
    return F.when(label.isin(null_words), UNKNOWN).otherwise(label)


def bracketed_year(c: Column) -> Column:
    return match_or_null(c, r"\((\p{Nd}{4})\)")


def any_year(c: Column) -> Column:
    return match_or_null(c, rf"{WORD_START}((?:19|20)\p{{Nd}}{{2}}){WORD_END}")


def first_digits(c: Column) -> Column:
    return match_or_null(c, r"(\p{Nd}+)")


def first_number(c: Column) -> Column:
    return match_or_null(c, r"([-+]?\p{Nd}*\.?\p{Nd}+)")


def has_any_word(c: Column, words: list[str]) -> Column:
    """Whole-word, case-insensitive test against a vocabulary; NULL is false.

    The pattern looks at every character, so it runs only on texts that hold one of the words at all.
    (The long s counts as an s in the pattern, but is no s in lower case.)
    """
    pattern = rf"(?iu){WORD_START}(?:{'|'.join(re.escape(w) for w in words)}){WORD_END}"
    text = F.coalesce(c, F.lit(""))
    low = F.lower(text)
    maybe = reduce(or_, [F.contains(low, F.lit(w.lower())) for w in words], F.contains(text, F.lit("\u017f")))
    return F.when(maybe, text.rlike(pattern)).otherwise(F.lit(False))


def starts_with_word(c: Column, prefix: str) -> Column:
    """Case-insensitive literal prefix that ends at a word boundary; NULL is false."""
    ends_in_word = bool(prefix) and (prefix[-1].isalnum() or prefix[-1] == "_")
    edge = WORD_END if ends_in_word else f"(?=[{WORD}])"
    return F.coalesce(c, F.lit("")).rlike(rf"(?iu)\A\Q{prefix}\E{edge}")


def is_short(c: Column, limit: int) -> Column:
    return F.char_length(F.coalesce(c, F.lit(""))) < limit


def valid_id(c: Column) -> Column:
    """One to twelve digits must be above zero; any other text needs three characters."""
    value = strip(c.cast("string"))
    digits = value.rlike("^[0-9]{1,12}$")
    ok = F.when(digits, value.try_cast("bigint") > 0).otherwise(F.char_length(value) >= 3)
    return F.coalesce(ok, F.lit(False))


def valid_url(c: Column) -> Column:
    pattern = rf"(?iU)^https?://[^{WS}/$.?#][^\n][^{WS}]*$"
    return F.coalesce(strip(c.cast("string")).rlike(pattern), F.lit(False))


def file_name_from_url(url: Column, fallback: str | Column = "image.jpg") -> Column:
    """Base name of the path, with a default extension and only portable characters."""
    default = F.lit(fallback) if isinstance(fallback, str) else fallback
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    base = F.substring_index(F.substring_index(path, "/", -1), ";", 1)
    named = F.when(F.contains(base, F.lit(".")), base).otherwise(F.concat(base, F.lit(".jpg")))
    safe = strip(F.translate(named, ILLEGAL_IN_FILE_NAMES, "_" * len(ILLEGAL_IN_FILE_NAMES)))
    return F.when(base == "", default).otherwise(safe)


def shorten(c: Column, length: int, mark: str = "...") -> Column:
    return F.when(F.char_length(c) > length, F.concat(F.left(c, F.lit(length)), F.lit(mark))).otherwise(c)


def cue_time(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; milliseconds are cut off, not rounded."""
    whole = F.floor(seconds).cast("bigint")
    millis = F.floor(F.pmod(seconds, F.lit(1.0)) * 1000).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d,%03d", (whole / 3600).cast("bigint"), ((whole % 3600) / 60).cast("bigint"), whole % 60, millis
    )


def parse_labels(c: Column) -> Column:
    """Label text to an array: JSON ``"name"`` values, else comma parts, else alphabetic runs,
    else the whole text. Blank and NULL give an empty array."""
    value = strip(c.cast("string"))

    def kept(parts: Column) -> Column:
        return F.filter(parts, lambda p: p != "")

    names = F.regexp_extract_all(value, F.lit(rf'(?U)"name"[{WS}]*:[{WS}]*"([^"]+)"'), F.lit(1))
    pieces = F.transform(F.split(value, ","), lambda p: F.btrim(p, F.lit(" []'\"")))
    runs = kept(F.transform(F.regexp_extract_all(value, F.lit(rf"(?U)[A-Za-z][A-Za-z{WS}&\-]+"), F.lit(0)), strip))
    none = F.array().cast("array<string>")
    return (
        F.when(is_blank(value), none)
        .when(F.size(names) > 0, kept(F.transform(names, strip)))
        .when(F.contains(value, F.lit(",")), kept(pieces))
        .when(F.size(runs) > 0, runs)
        .otherwise(F.array(value))
    )


def search_text(parts: dict[str, Column]) -> Column:
    """One searchable line: labelled non-blank parts, the first body that has text, and genres
    only where they differ from the category. Absent parts are left out of ``parts``."""
    tidy = {name: F.coalesce(strip(c), F.lit("")) for name, c in parts.items()}
    blank = F.lit("")

    def labelled(label: str, name: str) -> Column:
        value = tidy.get(name, blank)
        return F.when(value != "", F.concat(F.lit(label), value))

    body = F.coalesce(labelled("Content: ", "content_text"), labelled("Content: ", "overview"), labelled("Description: ", "description"))
    genres = F.when(tidy.get("genres", blank) != tidy.get("category", blank), labelled("Genres: ", "genres"))
    line = F.concat_ws(
        " | ",
        labelled("Title: ", "title"),
        body,
        labelled("Category: ", "category"),
        genres,
        labelled("Document type: ", "document_type"),
        labelled("Source: ", "source_name"),
        labelled("Language: ", "language"),
    )
    return F.when(line == "", F.lit("Unknown news document")).otherwise(line)


# Charsets that Spark decodes itself.
JVM_CHARSETS = ["us-ascii", "iso-8859-1", "utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32"]


def decode_as(content: Column, charset: str) -> Column:
    """Bytes in a known charset; charsets that Spark lacks go through an Arrow-batched function,
    where bad bytes become the replacement character."""
    if charset.lower() in JVM_CHARSETS:
        return F.decode(content, charset)

    @F.pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return decoded(content)


def decode_bytes(content: Column, fallback: str = "iso-8859-1") -> Column:
    """Bytes to text: a byte-order mark decides, then valid UTF-8, then the given charset.
    Bad UTF-8 sequences after a mark become the replacement character, a cut last unit is left out."""
    head = F.hex(F.substring(content, 1, 3))
    as_text = content.cast("string")
    units = F.substring(content, F.lit(3), (F.octet_length(content) / 2).cast("int") * 2 - 2)
    return (
        F.when(head == "EFBBBF", F.make_valid_utf8(F.substring(content, 4, 2**31 - 1).cast("string")))
        .when(head.startswith("FFFE"), F.decode(units, "UTF-16LE"))
        .when(head.startswith("FEFF"), F.decode(units, "UTF-16BE"))
        .when(F.is_valid_utf8(as_text), as_text)
        .otherwise(decode_as(content, fallback))
    )


_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def decode_entities(c: Column) -> Column:
    """Character references as the characters that they stand for, each decoded once. Names are those of
    the standard library's table; unknown ones stay, numbers that name no character become U+FFFD."""
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))], F.lit("apos"), F.lit("'"))

    def character(found: Column) -> Column:
        hexadecimal = F.conv(F.substr(found, F.lit(3)), 16, 10)
        code = F.when(F.rlike(found, F.lit("^#[xX]")), hexadecimal).otherwise(F.substr(found, F.lit(2))).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        named = F.coalesce(F.element_at(names, found), F.concat(F.lit("&"), found, F.lit(";")))
        return F.when(F.startswith(found, F.lit("#")), numbered).otherwise(named)

    between = F.split(c, _ENTITY, -1)
    found = F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(1))
    parts = F.zip_with(between, found, lambda b, f: F.concat(b, F.coalesce(character(f), F.lit(""))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(parts, "")).otherwise(c)


def with_class(name: str) -> str:
    """A pattern for a class attribute that lists ``name``, quoted in either way or not at all; no groups."""
    quoted = [rf"{q}(?:[^{q}]*\s)?{name}(?:\s[^{q}]*)?{q}" for q in "\"'"]
    return rf"\bclass\s*=\s*(?:{'|'.join(quoted)}|{name}(?=[\s>]))"


def attribute_value(name: str) -> str:
    """A pattern whose only group is the value of an attribute, quoted in either way or not at all."""
    return rf"""\b{name}\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<!["'])[^\s"'>]+)"""
