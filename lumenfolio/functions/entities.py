"""HTML character references as Column expressions (T24): named ones with and without semicolon, and numeric ones.

Names come from the standard's table, which Python ships as data. They are kept
as a trie of two levels, first letter and rest, so that a look-up compares with
the few names of one letter; of an unknown name the longest known beginning
without a semicolon counts.
"""

from __future__ import annotations

import json
from collections import defaultdict
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A reference as a browser reads it.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Lengths of names that may stand without a semicolon.
OPEN_SIZES = sorted({len(n) for n in html5 if not n.endswith(";")}, reverse=True)
UNKNOWN = "�"
#: White space of any script.
SPACES = r"[\t-\r\x1c-\x20\x85\xa0  -     　]+"


def windows_letter(code: int) -> str:
    """What a number from 0x80 to 0x9f stands for: the Windows letter, or itself where there is none."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


#: Numbers that stand for another character.
REPLACED = {0x00: UNKNOWN, 0x0D: "\r"} | {n: windows_letter(n) for n in range(0x80, 0xA0)}


def _constant(value: object, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)


def names() -> Column:
    """First letter -> rest of the name -> characters."""
    trie: dict[str, dict[str, str]] = defaultdict(dict)
    for name, value in html5.items():
        trie[name[0]][name[1:]] = value
    return _constant(trie, "map<string, map<string, string>>")


def _named(body: Column) -> Column:
    find = lambda name: F.try_element_at(F.try_element_at(names(), F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name)))
    shorter = [F.when(F.length(body) > n, F.concat(find(F.substring(body, 1, n)), F.substring(body, F.lit(n + 1), F.length(body)))) for n in OPEN_SIZES]
    return F.coalesce(find(body), *shorter, F.concat(F.lit("&"), body))


def _numeric(body: Column) -> Column:
    hexadecimal = F.lower(F.substring(body, 2, 1)) == "x"
    digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
    plain = F.when(digits == "", "0").otherwise(digits)
    number = F.when(F.length(plain) > 8, F.lit(0x110000)).when(hexadecimal, F.conv(plain, 16, 10).cast("long")).otherwise(F.when(hexadecimal, F.lit(0)).otherwise(plain.try_cast("long")))
    replaced = F.try_element_at(_constant({str(k): v for k, v in REPLACED.items()}, "map<string, string>"), number.cast("string"))
    never = number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | number.between(0x7F, 0x9F) | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(replaced, F.when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), UNKNOWN).when(never, "").otherwise(letter))


def unescape(text: Column) -> Column:
    """A text with all its character references resolved, once and from left to right."""

    def resolved(reference: Column) -> Column:
        body = F.substring(reference, F.lit(2), F.length(reference))
        return F.when(F.startswith(body, F.lit("#")), _numeric(body)).otherwise(_named(body))

    found, between = F.regexp_extract_all(text, F.lit(REFERENCE), 0), F.split(text, REFERENCE)
    joined = F.zip_with(between, F.transform(found, resolved), lambda t, r: F.concat(t, F.coalesce(r, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)
