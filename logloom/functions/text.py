"""Text helpers: charset decoding, host names, line splitting."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


# Names that Python's codecs know otherwise.
_ALIASES = {"WINDOWS-31J": "cp932", "X-WINDOWS-949": "cp949", "X-EUC-TW": "big5"}

# One well-formed character of each charset at the place where the last one ended, and one unit that is not. Bytes are matched as
# the characters U+0000 to U+00FF. A dot stands for any of them, as all patterns begin with ``(?s)``: Java tests a class of all characters
# ten times as long.
_ANY = "."
_CHARACTERS = {
    "utf-16-le": (rf"{_ANY}[^\xD8-\xDF]|{_ANY}[\xD8-\xDB]{_ANY}[\xDC-\xDF]", rf"{_ANY}[\xD8-\xDB]{_ANY}\z|{_ANY}{{2}}|{_ANY}\z"),
    "utf-16-be": (rf"[^\xD8-\xDF]{_ANY}|[\xD8-\xDB]{_ANY}[\xDC-\xDF]{_ANY}", rf"[\xD8-\xDB]{_ANY}{{2}}\z|{_ANY}{{2}}|{_ANY}\z"),
    "utf-32-le": (rf"{_ANY}[^\xD8-\xDF]\x00\x00|{_ANY}{{2}}[\x01-\x10]\x00", rf"{_ANY}{{4}}|{_ANY}{{1,3}}\z"),
    "utf-32-be": (rf"\x00\x00[^\xD8-\xDF]{_ANY}|\x00[\x01-\x10]{_ANY}{{2}}", rf"{_ANY}{{4}}|{_ANY}{{1,3}}\z"),
}
# Texts of well-formed units of equal size, the usual ones: a loop that Java's regular expressions run without a step back.
_UNIFORM = {"utf-16-le": rf"{_ANY}[^\xD8-\xDF]", "utf-16-be": rf"[^\xD8-\xDF]{_ANY}", "utf-32-le": rf"{_ANY}[^\xD8-\xDF]\x00\x00", "utf-32-be": rf"\x00\x00[^\xD8-\xDF]{_ANY}"}
_REPLACEMENT = {"utf-16-le": "\xfd\xff", "utf-16-be": "\xff\xfd", "utf-32-le": "\xfd\xff\x00\x00", "utf-32-be": "\x00\x00\xff\xfd"}
# Byte order marks of the charsets that have one, and the charset each names.
_MARKS = {"utf-16": (("\xff\xfe", "utf-16-le"), ("\xfe\xff", "utf-16-be")),
          "utf-32": (("\xff\xfe\x00\x00", "utf-32-le"), ("\x00\x00\xfe\xff", "utf-32-be"))}
_GOOD, _BAD = "\u0100", "\u0101"


def charset_name(charset: str) -> str:
    """One name for all the ways to write a charset's."""
    return codecs.lookup(_ALIASES.get(charset.upper(), charset)).name


def decode_bytes(value: Column, charset: str = "UTF-8") -> Column:
    """Bytes to string. Malformed input becomes U+FFFD instead of failing the job.

    UTF-8, UTF-16, UTF-32 and all single-byte charsets are plain expressions; only charsets of mixed width
    (such as Shift JIS) go through Python.
    """
    name = charset_name(charset)
    if name == "utf-8":
        return F.make_valid_utf8(value.cast("string"))
    latin = F.decode(value.cast("binary"), "ISO-8859-1")
    if name == "iso8859-1":
        return latin
    if name in _MARKS:
        return _by_mark(latin, name)
    if name in _CHARACTERS:
        return _units(latin, name, value.cast("binary"))
    table = _single_bytes(name)
    if table is None:
        return _decoder(name)(value.cast("binary"))
    changed = [(chr(i), char) for i, char in enumerate(table) if chr(i) != char]
    return F.translate(latin, "".join(a for a, _ in changed), "".join(b for _, b in changed)) if changed else latin


def _single_bytes(name: str) -> str | None:
    """The characters of the 256 bytes, or None for a charset in which bytes belong together."""
    each = [bytes([i]).decode(name, "replace") for i in range(256)]
    whole = bytes(range(256)).decode(name, "replace")
    return whole if all(len(char) == 1 for char in each) and whole == "".join(each) else None


def _by_mark(latin: Column, name: str) -> Column:
    (little, first), (big, second) = _MARKS[name]
    rest = F.substr(latin, F.lit(len(little) + 1))
    # Without a mark: little-endian.
    return F.when(latin.startswith(little), _units(rest, first)).when(latin.startswith(big), _units(rest, second)).otherwise(_units(latin, first))


def _units(latin: Column, name: str, value: Column | None = None) -> Column:
    """Decode bytes, given as characters up to U+00FF, of a charset with units of two or four bytes; ``value`` has them as bytes."""
    good, bad = _CHARACTERS[name]
    well_formed = latin.rlike(rf"(?s)\A(?:{_UNIFORM[name]})*+\z") | (F.regexp_replace(latin, rf"(?s)\G(?:{good})", "") == "")
    # Characters are followed by both marks, other units stand between them.
    marked = F.regexp_replace(latin, rf"(?s)\G({good})|\G({bad})", f"$1{_GOOD}$2{_BAD}")
    mended = F.translate(F.regexp_replace(marked, f"{_GOOD}[^{_GOOD}{_BAD}]+{_BAD}", _REPLACEMENT[name]), _GOOD + _BAD, "")
    if value is None:
        value = F.encode(latin, "ISO-8859-1")
    whole = F.when(well_formed, value).otherwise(F.encode(mended, "ISO-8859-1"))
    if name.startswith("utf-32"):
        # With a byte order mark, which is not part of the text and names the order.
        mark = b"\xff\xfe\x00\x00" if name == "utf-32-le" else b"\x00\x00\xfe\xff"
        return F.decode(F.concat(F.lit(bytearray(mark)), whole), "UTF-32")
    return F.decode(whole, name.upper().replace("-LE", "LE").replace("-BE", "BE"))


def _decoder(codec: str):
    """Decoding by Python's codecs, column by column, for charsets that Spark has not."""

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda data: None if data is None else bytes(data).decode(codec, "replace"))

    return decode


def short_host(host: Column) -> Column:
    """Host name up to its first dot, in lower case."""
    return F.lower(F.substring_index(host, ".", 1))


def trim_controls(value: Column) -> Column:
    """Strip spaces and control characters (U+0000 to U+0020) at both ends."""
    return F.regexp_replace(value, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def split_lines(content: Column) -> Column:
    r"""Whole text to an array of lines; ``\n``, ``\r`` and ``\r\n`` end a line."""
    parts = F.split(content, r"\r\n|\n|\r", -1)
    # A line end at the very end closes the last line, it does not open another one.
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
