"""Text cleaning as native expressions."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from trendlake.constants import DOMAIN_STOP_WORDS
from trendlake.functions.lookup import constant_lookup, let

WORD = r"\p{L}\p{N}_"
DIGIT = r"0-9\p{Nd}\x{B2}\x{B3}\x{B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
_ENTITY = r"^&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LEGACY_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_NODE_BREAK = "\u0001"


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _windows_1252() -> tuple[str, str]:
    """Code points 128..159 and the Windows-1252 characters HTML reads them as."""
    shown = {}
    for n in range(0x80, 0xA0):
        try:
            shown[chr(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return "".join(shown), "".join(shown.values())


def _numeric_entity(body: Column) -> Column:
    digits = F.regexp_replace(F.regexp_extract(body, r"^#[xX]?([0-9a-fA-F]+)", 1), "^0+(?=.)", "")
    number = F.when(
        F.length(digits) <= 9,
        F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10).cast("bigint")).otherwise(digits.try_cast("bigint")),
    ).otherwise(F.lit(0x110000).cast("bigint"))

    def character(n: Column) -> Column:
        unusable = (
            n.between(1, 8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
            | ((n % 0x10000) >= 0xFFFE)
        )
        return (
            F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
            .when(unusable, "")
            .otherwise(F.translate(_code_point(n), *_windows_1252()))
        )

    return let(number, character)


def unescape_html(text: Column) -> Column:
    """Decode named and numeric HTML entities once, with HTML5's rules."""
    named = constant_lookup(html5, "string")
    legacy = "^(" + "|".join(_LEGACY_NAMES) + ")"

    def decode(piece: Column, body: Column) -> Column:
        """A piece starts at an ampersand; ``body`` is the entity behind it, if there is one."""
        names = F.array(body, F.regexp_extract(body, legacy, 1))
        known = F.filter(
            F.transform(names, lambda n: F.struct(n.alias("name"), named(n).alias("value"))), lambda n: n["value"].isNotNull()
        )

        def after(used: Column) -> Column:
            return F.substring(piece, F.length(used) + 2, F.length(piece))

        return F.when(F.startswith(body, F.lit("#")), F.concat(_numeric_entity(body), after(body))).otherwise(
            let(F.get(known, 0), lambda n: F.coalesce(F.concat(n["value"], after(n["name"])), piece))
        )

    def read(piece: Column) -> Column:
        return F.when(
            piece.rlike("^&[#a-zA-Z]"), let(F.regexp_extract(piece, _ENTITY, 1), lambda body: decode(piece, body))
        ).otherwise(piece)

    decoded = F.array_join(F.transform(F.split(text, "(?=&)"), read), "")
    return F.when(text.rlike("&[#a-zA-Z]"), decoded).otherwise(text)


# A tag ends at the first > outside quotes; without a closing quote, at the first > of all.
_TAG = r"""(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[a-zA-Z][^>]*+>|<[!?][^>]*+>"""


def strip_html(text: Column) -> Column:
    """Visible text of an HTML fragment: text nodes trimmed and joined by a space."""
    visible = F.regexp_replace(unescape_html(text), r"(?is)<(script|style|template)\b.*?</\1\s*>", _NODE_BREAK)
    visible = F.regexp_replace(visible, r"(?s)<!--.*?-->", _NODE_BREAK)
    visible = F.regexp_replace(visible, _TAG, _NODE_BREAK)
    nodes = F.transform(
        F.split(visible, _NODE_BREAK),
        lambda node: F.regexp_replace(unescape_html(node), r"(?U)^\s+|\s+$", ""),
    )
    return F.when(text.isNull(), "").otherwise(F.array_join(F.filter(nodes, lambda node: node != ""), " "))


def strip_tags_simple(text: Column) -> Column:
    """Drop ``<...>`` runs within a line, collapse white space, trim."""
    bare = F.regexp_replace(text, "<.*?>", "")
    return F.coalesce(F.regexp_replace(F.regexp_replace(bare, r"(?U)\s+", " "), r"^ | $", ""), F.lit(""))


def remove_photo_credit(text: Column) -> Column:
    """Drop a caption and a ``| One To Three`` credit that open the text."""
    return F.regexp_replace(text, r"^.{0,300}? \| \S+(?:\s\S+){0,2} (?=[A-Z])", "")


def plain_text(text: Column) -> Column:
    """Entities decoded, URLs to a space, lower case."""

    def remove_urls(decoded: Column) -> Column:
        bare = F.regexp_replace(decoded, r"https?://\S+|www\.\S+", " ")
        return F.when(F.contains(decoded, F.lit("://")) | F.contains(decoded, F.lit("www.")), bare).otherwise(decoded)

    return F.lower(let(unescape_html(text), remove_urls))


def normalise(text: Column) -> Column:
    """Plain text with punctuation and white space as one space."""
    return F.trim(F.regexp_replace(plain_text(text), f"[^{WORD}]+", " "))


def is_number(token: Column) -> Column:
    """Digits only. A word that starts with an ASCII letter skips the pattern."""
    return ((token < ":") | (token > "\x7f")) & token.rlike(f"^[{DIGIT}]+$")


def clean_tokens(text: Column, stop_words: Iterable[str]) -> Column:
    """Content words of a raw text, in order: two characters or more, no number, no stop word."""
    stop = sorted({w for w in stop_words if " " not in w})
    # The common case first: a word that starts with a letter cannot be a number.
    pattern = rf"[\p{{L}}_][{WORD}]+|(?![{DIGIT}]++(?![{WORD}]))[{WORD}]{{2,}}"
    words = F.regexp_extract_all(plain_text(text), F.lit(pattern), F.lit(0))
    return F.filter(words, lambda token: ~token.isin(stop)) if stop else words


def clean_text(text: Column, stop_words: Iterable[str]) -> Column:
    """Content words of a raw text joined by spaces; null stays null."""
    return F.array_join(clean_tokens(text, stop_words), " ")


def tokens_of(clean: Column) -> Column:
    """Words of an already cleaned text; null or blank text has none."""
    bare = F.trim(F.coalesce(clean, F.lit("")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s+"))


def word_tokens(text: Column) -> Column:
    """Runs of two or more word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def bigrams_of(tokens: Column) -> Column:
    """Neighbouring word pairs as an array of (left, right) structs."""
    size = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), size).alias("left"), F.slice(tokens, F.lit(2), size).alias("right")
    )


def non_ascii_count(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))


def slug(text: Column) -> Column:
    """Lower-case name safe for a path."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def search_name(ingredient: Column, diet: Column, intolerances: Column) -> Column:
    """Name of an ingredient search with its restrictions."""
    return F.concat_ws(
        "_",
        F.replace(ingredient, F.lit(" "), F.lit("_")),
        F.when(diet != "", F.concat(F.lit("diet_"), F.replace(F.replace(diet, F.lit("|"), F.lit("OR")), F.lit(","), F.lit("AND")))),
        F.when(intolerances != "", F.concat(F.lit("intol_"), F.replace(intolerances, F.lit(","), F.lit("AND")))),
    )


def stop_words(spark: SparkSession, language: str = "english") -> list[str]:
    """Spark's stop words for the language plus the domain list."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted(set(StopWordsRemover.loadDefaultStopWords(language)) | set(DOMAIN_STOP_WORDS))
