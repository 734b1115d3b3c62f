"""Letters and character entities. The tables come from the Unicode and HTML tables of Python's library; the work is built-in expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _decomposed() -> tuple[dict[str, str], dict[str, str]]:
    """Characters beyond ASCII whose compatibility decomposition has ASCII characters: those with one, those with several."""
    one, several = {}, {}
    for code in (*range(0xA0, 0xD800), *range(0xF900, 0x20000)):
        base = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if base:
            (one if len(base) == 1 else several)[chr(code)] = base
    return one, several


def _map(pairs: dict[str, str]) -> Column:
    """A map as one literal; keys and values must not hold the two separators."""
    return F.str_to_map(F.lit("\x02".join(f"{k}\x01{v}" for k, v in pairs.items())), F.lit("\x02"), F.lit("\x01"))


_CAPITALS = "".join(c for c in map(chr, (*range(0x41, 0x5B), *range(0xC0, 0xDF))) if c != "×")


def lowered(text: Column) -> Column:
    """lower(), without its tables of all letters where text is in Latin-1: they take each executor seconds to load."""
    return F.when(text.rlike(r"[^\x00-\xFF]"), F.lower(text)).otherwise(F.translate(text, _CAPITALS, _CAPITALS.lower()))


def ascii_letters(text: Column) -> Column:
    """Text in ASCII: letters without their accents, ligatures and other compatible forms spelled out; what has no such form goes."""
    one, several = _decomposed()
    # each sign once: what is left of a text without letters that are spelled by one
    others = F.array_distinct(F.split(F.translate(F.regexp_replace(text, r"[\x00-\x7F]+", ""), "".join(one), ""), ""))
    spelled = F.aggregate(others, text, lambda t, c: F.when(c == "", t).otherwise(F.replace(t, c, F.coalesce(F.try_element_at(_map(several), c), F.lit("")))))
    plain = F.translate(spelled, "".join(one), "".join(one.values()))
    return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)


#: Numbers of HTML that do not mean their code point: those of the 8-bit table of Windows, and null.
_MOVED = {0: "�", 13: "\r"} | {k: bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(0x80, 0xA0)}
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


#: Parts of the table of names by their digests: a map is searched from its begin to its end, so each is a few names.
_PARTS = 4096


def _part(name: str) -> int:
    return crc32(name.encode()) % _PARTS


@cache
def _named() -> str:
    """The names of HTML in parts, each the text of a map."""
    parts: list[list[str]] = [[] for _ in range(_PARTS)]
    for k, v in html5.items():
        parts[_part(k)].append(f"{k}\x01{v}")
    return "\x03".join("\x02".join(p) for p in parts)


def _character(name: Column) -> Column:
    """What a name of HTML stands for, else null."""
    part = F.get(F.split(F.lit(_named()), "\x03", -1), (F.crc32(name) % _PARTS).cast("int"))
    return F.try_element_at(F.str_to_map(part, F.lit("\x02"), F.lit("\x01")), name)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _numbered(name: Column) -> Column:
    """The character of `#243` or `#xF3`."""

    def character(n: Column) -> Column:
        moved = F.try_element_at(_map({str(k): v for k, v in _MOVED.items()}), n.cast("string"))
        none = n.between(1, 8) | n.between(14, 31) | n.between(127, 159) | (n == 11) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        char = F.decode(F.unhex(F.format_string("%08X", n)), "UTF-32")
        return F.when((n < 160) & moved.isNotNull(), moved).when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(none, "").otherwise(char)

    def number(digits: Column) -> Column:
        sixteen = F.conv(F.substring(digits, 1, 9), 16, 10).try_cast("long")  # longer numbers are no characters either
        ten = F.substring(digits, 1, 12).try_cast("long")
        return F.when(name.rlike("^#[xX]"), sixteen).otherwise(ten)

    return _let(F.regexp_replace(name, "^#[xX]?0*(?=[0-9a-fA-F])|;$", ""), lambda digits: _let(number(digits), character))


def unescaped(text: Column) -> Column:
    """Character entities as characters, once: numbers, all names, and names without a semicolon where HTML allows it (the longest that fits). What is no entity stays."""
    lengths = sorted({len(k) for k in html5 if not k.endswith(";")}, reverse=True)

    def begun(name: Column) -> Column:
        fits = F.filter(F.transform(F.lit(lengths), lambda n: F.substring(name, F.lit(1), n)), lambda s: _character(s).isNotNull())
        return _let(F.get(fits, 0), lambda s: F.concat(_character(s), F.substr(name, F.length(s) + 1)))

    def told(name: Column) -> Column:
        return F.when(name.startswith("#"), _numbered(name)).when(name != "", F.coalesce(_character(name), begun(name)))

    def head(piece: Column) -> Column:
        return _let(F.regexp_extract(piece, _REFERENCE, 1), lambda name: F.coalesce(F.concat(told(name), F.substr(piece, F.length(name) + 1)), F.concat(F.lit("&"), piece)))

    pieces = F.split(text, "&", -1)
    own = F.concat(F.get(pieces, 0), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), head), ""))
    return F.when(text.contains("&"), own).otherwise(text)
