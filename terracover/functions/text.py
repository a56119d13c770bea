"""Text, number and address expressions. Every function maps columns to a column and stays in codegen."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables


@cache
def _fold_table() -> tuple[str, str]:
    """Letters whose compatibility decomposition is one base character and marks; then the marks, which go."""
    source, target = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            source.append(chr(code))
            target.append(base)
    return "".join(source) + "".join(map(chr, range(0x300, 0x370))), "".join(target)


# Transliterations of letters that do not decompose.
_TRANSLITERATE = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}
_SINGLE = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i", "–": "-", "—": "-", "‘": "'", "’": "'", "“": '"', "”": '"'}


def squeeze(x: Column) -> Column:
    """Runs of (Unicode) white space become one space, none at the ends; null stays."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def fold(x: Column) -> Column:
    """Upper case without accents; null stays."""
    source, target = _fold_table()
    return F.upper(F.translate(x, source, target))


def transliterate(x: Column) -> Column:
    """Trimmed upper-case ASCII spelling; letters without decomposition are spelt out."""
    for letter, by in _TRANSLITERATE.items():
        x = F.replace(x, F.lit(letter), F.lit(by))
    return F.upper(F.trim(F.regexp_replace(fold(F.translate(x, "".join(_SINGLE), "".join(_SINGLE.values()))), r"[^\x00-\x7F]", "")))


def digits(x: Column) -> Column:
    """E5: digits only; null becomes empty."""
    return F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"\D", "")


def id_root(x: Column) -> Column:
    """The first eight digits, null if there are fewer."""
    d = digits(x)
    return F.when(F.length(d) >= 8, F.substring(d, 1, 8))


def zero_fill(x: Column, width: int = 7) -> Column:
    """Left zero fill that keeps longer values."""
    return F.when(F.length(x) < width, F.lpad(x, width, "0")).otherwise(x)


def unit_code(x: Column, width: int = 7) -> Column:
    """Trimmed, without a trailing .0 and without non-digits, zero-filled; empty becomes null."""
    d = F.regexp_replace(F.regexp_replace(F.trim(x.cast("string")), r"\.0$", ""), r"\D", "")
    return zero_fill(F.nullif(d, F.lit("")), width)


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(v) for pair in table.items() for v in pair))


def lookup(x: Column, table: dict) -> Column:
    """A closed map as an expression; null where the key is absent."""
    return F.try_element_at(_map(table), x)


def street_key(x: Column) -> Column:
    """Canonical street name: expanded Roman numbers and abbreviations, no leading type, no articles."""
    text = F.trim(F.regexp_replace(transliterate(F.coalesce(x, F.lit(""))), "[^A-Z0-9]+", " "))
    romans, short = _map(tables.ROMANS), _map(tables.ABBREVIATIONS)

    def expand(t: Column) -> Column:
        number = F.coalesce(F.try_element_at(romans, t), t)
        return F.coalesce(F.try_element_at(short, number), number)

    # expansion word by word is slow, so only texts that hold a short form go through it; the array keeps the text from being made twice
    short_form = rf"(?<![^ ])(?:{'|'.join([*tables.ROMANS, *tables.ABBREVIATIONS])})(?![^ ])"
    expanded = F.transform(F.array(text), lambda t: F.when(t.rlike(short_form), F.array_join(F.transform(F.split(t, " "), expand), " ")).otherwise(t))
    words = F.get(expanded, F.lit(0))
    named = F.regexp_replace(words, rf"^(?:(?:{'|'.join(tables.STREET_TYPES)})(?: |$))+", "")
    return F.trim(F.regexp_replace(named, rf"(?<![^ ])(?:{'|'.join(tables.ARTICLES)})(?: |$)", ""))


def is_postcode(d: Column) -> Column:
    """eight digits that are not all zero."""
    return d.rlike(r"^\d{8}$") & (d != "00000000")


def has_kilometre(x: Column) -> Column:
    """F8."""
    return F.coalesce(x, F.lit("")).rlike(r"(?i)\bKM\b")


def series_value(x: Column) -> Column:
    """Digits as a number, any marker of absence as null."""
    t = F.trim(x)
    return F.when(t.rlike("^[0-9]+$"), F.try_to_number(t, F.lit("999999999999999999")).cast("long"))


def number_br(x: Column) -> Column:
    """Whole number with points between thousands."""
    return F.replace(F.format_number(x.cast("long"), 0), F.lit(","), F.lit("."))


def compact_br(x: Column) -> Column:
    """Millions with one decimal, thousands from ten thousand on, else the number.

    The decimal is rounded from the exact value of the double, a tie to the even digit; format_string would round its shortest
    decimal text, which makes 1.45 (a little less in binary) 1.5.
    """
    one = F.replace(F.format_number(x.cast("double") / 1_000_000, 1), F.lit(","))
    millions = F.concat(F.replace(one, F.lit("."), F.lit(",")), F.lit(" mi"))
    thousands = F.concat(number_br(F.floor(x.cast("double") / 1000 + 0.5)), F.lit(" mil"))
    return F.when(x >= 1_000_000, millions).when(x >= 10_000, thousands).otherwise(number_br(x))


def html_escape(x: Column) -> Column:
    """E19."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def regex_escape(x: Column) -> Column:
    """A literal as a pattern."""
    return F.regexp_replace(x, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def population_text(n: Column, year: Column) -> Column:
    """E20."""
    shown = F.concat(number_br(n), F.lit(" hab."), F.when(F.trim(F.coalesce(year, F.lit(""))) == "", F.lit("")).otherwise(F.concat(F.lit(" ("), year, F.lit(")"))))
    return F.when(n.isNull(), F.lit("dado indisponível")).otherwise(shown)


def brand_lines(counts: dict[str, Column], bucket: str = tables.OTHER_COOPERATIVE, detail: Column | None = None, shown_as: Callable[[Column], Column] = number_br) -> Column:
    """E21: "brand: n" for every brand that has points, the bucket with its detail; none: "nenhum ponto". shown_as: how n is written."""
    rows = []
    for brand, n in counts.items():
        line = F.concat(F.lit(f"{brand}: "), shown_as(n))
        if brand == bucket and detail is not None:
            line = F.when(F.coalesce(detail, F.lit("")) != "", F.concat(line, F.lit(" ("), detail, F.lit(")"))).otherwise(line)
        rows.append(F.when(F.coalesce(n, F.lit(0)) > 0, line))
    shown = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return F.when(F.size(shown) == 0, F.lit("nenhum ponto")).otherwise(F.array_join(shown, "\n"))


def blank_to_null(x: Column) -> Column:
    return F.when(F.trim(x) != "", x)


def display_address(address: Column, number: Column, district: Column, postcode: Column) -> Column:
    """The number is added unless the address already ends with it or has it behind a comma."""
    n = F.trim(number)
    wanted = regex_escape(n)
    pattern = F.concat(F.lit(r",[^,]*\b"), wanted, F.lit(r"\b|\b"), wanted, F.lit(r"\b\s*$"))
    shown = F.coalesce(address, F.lit(""))
    head = F.when(blank_to_null(number).isNotNull() & ~F.regexp_like(shown, pattern), F.concat(html_escape(shown), F.lit(", "), html_escape(n))).otherwise(html_escape(shown))
    tail = F.array_compact(F.array(html_escape(blank_to_null(district)), html_escape(blank_to_null(postcode))))
    return F.when(F.size(tail) > 0, F.concat(head, F.lit(" — "), F.array_join(tail, ", "))).otherwise(head)


def display_mark(mark: Column, brand: Column) -> Column:
    """The mark shown; the brand where it is blank."""
    return F.coalesce(blank_to_null(mark), brand)


def precision_text(level: Column) -> Column:
    """What a precision level says to the reader."""
    return F.coalesce(lookup(level, tables.PRECISION_TEXT), level)


def is_loose(level: Column) -> Column:
    """The two levels that deserve a warning."""
    return level.isin(tables.LOCALITY, tables.UNIT)


def tooltip(mark: Column, brand: Column, kind: Column, name: Column) -> Column:
    """One line on a point."""
    shown = display_mark(mark, brand)
    suffix = F.when(shown != brand, F.concat(F.lit(" ("), html_escape(brand), F.lit(")"))).otherwise(F.lit(""))
    return F.concat(html_escape(shown), suffix, F.lit(" · "), html_escape(kind), F.lit("\n"), html_escape(name))


def search_key(x: Column) -> Column:
    """Lower case without accents or outer spaces."""
    source, target = _fold_table()
    return F.trim(F.lower(F.translate(x, source, target)))


def resource_name(url: Column) -> Column:
    """File name under which a fetched resource is kept."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://", ""), r"[^A-Za-z0-9._@-]+", "_")


def plain_fold(text: str) -> str:
    """E2 for names on the driver (column names, search terms)."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


def snake_case(name: str) -> str:
    """A column name in snake case without accents."""
    return re.sub(r"[^a-z0-9]+", "_", plain_fold(name).lower()).strip("_")
