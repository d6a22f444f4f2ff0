"""Text handling as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed

#: Every white-space character: the ASCII ones and the Unicode blanks and line ends.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

#: The same as a character class, spelled so that any regex engine agrees.
WS = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in BLANKS) + "]"

#: Every named character reference of HTML, without its ``&``, as a map in the expression.
_NAMED = json.dumps({name: char for name, char in sorted(html5.items()) if name.endswith(";")})


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blanked(text: Column) -> Column:
    """Every white-space character as a blank, one for one; cheaper than matching a character class."""
    return F.translate(text, BLANKS, " " * len(BLANKS))


def strip(text: Column) -> Column:
    """Drop white space at both ends (plain ``trim`` drops blanks only)."""
    return F.btrim(text, F.lit(BLANKS))


def squeeze(text: Column) -> Column:
    """Collapse white-space runs to one blank and strip the ends."""
    return F.trim(F.regexp_replace(blanked(text), "  +", " "))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Matched group, or NULL where nothing (or an empty string) matched."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def words(text: Column) -> Column:
    """Non-empty pieces between white space."""
    return F.filter(F.split(blanked(text), " "), lambda w: w != "")


def pieces(text: Column) -> Column:
    """Pieces between white space and hyphens, empty ones too.

    Mapping every separator to a blank and splitting at blanks is much cheaper
    than splitting by a character class.
    """
    separators = BLANKS + "-"
    return F.split(F.translate(text, separators, " " * len(separators)), " ")


def tokens(text: Column) -> Column:
    """Lower-case words longer than one character."""
    return F.transform(F.filter(pieces(text), lambda w: F.length(w) > 1), F.lower)


def number_in(text: Column) -> Column:
    """First number in the text; a dot groups thousands and a comma marks decimals."""
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return first_match(plain, r"(\d+(?:[.,]\d+)?)").try_cast("double")


def absolute_url(href: Column, base: Column | str) -> Column:
    """``href`` itself when it starts with http, else put below ``base`` with one slash."""
    base = F.lit(base) if isinstance(base, str) else base
    below = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(href, "^/+", ""))
    return F.when(href.startswith("http"), href).otherwise(below)


def id_in_url(url: Column) -> Column:
    """Digits after the last hyphen at the end of the address."""
    return first_match(url, r"-(\d+)/?$")


def brand_or_first_word(brand: Column, name: Column) -> Column:
    """Brand text, else the first word of the name."""
    return F.coalesce(F.nullif(strip(brand), F.lit("")), F.get(words(name), 0))


def normal_brand(brand: Column) -> Column:
    """Stripped and upper-cased; only texts whose ends may be white space pay for stripping."""
    ends = [F.ascii(brand), F.ascii(F.right(brand, F.lit(1)))]
    suspect = F.lit(False)
    for code in ends:
        suspect = suspect | (code <= 32) | (code > 126)
    return F.upper(F.when(suspect, strip(brand)).otherwise(brand))


def first_present(specs: Column, keys: Sequence[str]) -> Column:
    """Value of the first of ``keys`` that the map holds."""
    return F.coalesce(*[F.element_at(specs, F.lit(k)) for k in keys])


def class_token(text: Column, allowed: Sequence[str] = fixed.ENERGY_CLASSES) -> Column:
    """First word, upper-cased, if it is an allowed class."""
    token = F.upper(F.get(words(text), 0))
    return F.when(token.isin(*[a.upper() for a in allowed]), token)


def stock_flag(css_class: Column, positive: str = "available") -> Column:
    """Whether the class list has the token; NULL when there is no class list."""
    return F.array_contains(words(css_class), positive)


def availability(specs: Column, key: str = fixed.AVAILABILITY_SPEC,
                 default: str = fixed.AVAILABILITY_DEFAULT) -> Column:
    value = F.coalesce(F.element_at(specs, F.lit(key)), F.lit(default))
    return F.lower(value).isin(*fixed.AVAILABILITY_YES)


def text_attributes(text: Column, patterns: dict[str, str] = fixed.TEXT_PATTERNS,
                    grade: str = "energetska_klasa") -> dict[str, Column]:
    """One column per pattern: the grade as an upper-case class, the others as numbers."""
    plain = blanked(text)
    found = {k: first_match(plain, "(?iu)" + p) for k, p in patterns.items()}
    return {k: class_token(v) if k == grade else number_in(v) for k, v in found.items()}


def unescape(text: Column) -> Column:
    """Resolve character references, each once: every name of HTML and every decimal or hex number.

    Numbers that are no character become the replacement character, unknown names stay.
    """
    names = F.from_json(F.lit(_NAMED), "map<string,string>")

    def code_point(digits: Column, base: int) -> Column:
        plain = F.regexp_replace(digits, "^0+(?=.)", "")
        code = F.when(F.length(plain) <= 8, F.conv(plain, base, 10).cast("long"))
        known = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def resolved(piece: Column) -> Column:
        inside = F.substring(piece, 2, 1 << 30)
        return (F.when(~piece.startswith("&") | ~piece.endswith(";"), piece)
                .when(piece.rlike("^&#[0-9]+;$"), code_point(F.regexp_extract(piece, "[0-9]+", 0), 10))
                .when(piece.rlike("^&#[xX]"), code_point(F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+)", 1), 16))
                .otherwise(F.coalesce(F.try_element_at(names, inside), piece)))

    parts = F.regexp_extract_all(text, F.lit("&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);|[^&]+|&"), 0)
    return F.when(text.contains("&"), F.array_join(F.transform(parts, resolved), "")).otherwise(text)


#: How a number is written: digits with at most one point, a sign, an exponent; no letters behind it.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(text: Column) -> Column:
    """The number that a text consists of, blanks around it aside; anything else is NULL."""
    plain = strip(text.cast("string"))
    # The kind is known before the query runs, so only one of the branches is left then.
    return F.when(F.typeof(text) == "string", F.when(plain.rlike(NUMBER), plain.try_cast("double"))).otherwise(text.try_cast("double"))


def visible_text(html: Column) -> Column:
    """Text a reader sees: no scripts, styles, templates, comments or tags."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>|<!doctype[^>]*>", " ")
    return squeeze(unescape(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")))
