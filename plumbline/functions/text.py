"""Text functions: normal form, strict JSON, caption screens, paths, markup."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The 29 code points that count as white space (fixed values).
SPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Leading words of translators' notes and control marks (fixed values).
NOTES = rf"(?i)</?think>|```|<\||(?:^|\n){SPACE}*(?:translation|english translation|note|explanation){SPACE}*:"
CONTROL = r"<\||\|>|<think>|</think>|```"


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256 of UTF-8 text or bytes."""
    return F.sha2(value, 256)


def squeezed(value: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(value, SPACE + "+", " "))


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Compatibility composition; the JVM has no SQL function for it."""
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def normalized(value: Column) -> Column:
    """NFKC with squeezed white space; null and empty give the empty text.

    Spark runs the Python part over all rows; callers that know their texts to be ASCII use
    ``squeezed``, which gives the same there.
    """
    return F.coalesce(squeezed(nfkc(value)), F.lit(""))


#: What full case folding leaves as it is or turns into capitals, unlike lower case of upper case (fixed values):
#: the dotless i, and letters of Cherokee. A code point that is no character stands in for the first.
DOTLESS, ASIDE = chr(0x131), chr(0xFDD0)
CHEROKEE = "".join(map(chr, [*range(0xAB70, 0xABC0), *range(0x13F8, 0x13FE)])), "".join(map(chr, range(0x13A0, 0x13F6)))


def casefolded(value: Column) -> Column:
    """Full case folding: texts that differ in case only become equal, sharp s and ligatures too."""
    # lower case straight of upper case is simplified to lower case, which is not the same
    low = F.lower(F.translate(F.upper(F.translate(value, DOTLESS + chr(0x1E9E), ASIDE + chr(0xDF))), ASIDE, ASIDE))
    small, capital = CHEROKEE
    return F.translate(low, chr(0x3C2) + ASIDE + small, chr(0x3C3) + DOTLESS + capital)


def duplicate_keys(document: Column) -> Column:
    """Whether a JSON object names a key twice on its top level."""
    keys = F.json_object_keys(document)
    return F.size(keys) != F.size(F.array_distinct(keys))


def strict_object(document: Column) -> Column:
    """Whether a text is a JSON object without repeated keys at any depth and without NaN or Infinity."""
    return F.coalesce(F.try_parse_json(document).isNotNull() & F.json_object_keys(document).isNotNull(), F.lit(False))


def exact_keys(document: Column, *keys: str) -> Column:
    """Whether a JSON object has exactly these keys."""
    want = F.array(*[F.lit(k) for k in sorted(keys)])
    return F.coalesce(F.array_sort(F.json_object_keys(document)) == want, F.lit(False))


def english_issues(caption: Column) -> Column:
    """Reasons against a caption (fixed values), several may hold; a null or blank caption has just the first.

    Letters are told apart by script, which differs from Unicode names on some 160 rare letters.
    """
    reasons = F.array(
        F.when(~caption.rlike(r"\p{IsLatin}"), "caption_has_no_latin_letters"),
        F.when(caption.rlike(r"[\p{L}&&[^\p{IsLatin}]]"), "caption_contains_non_latin_script"),
        F.when(caption.rlike(NOTES), "caption_contains_translation_metadata"),
        F.when(F.regexp_replace(caption, "^" + SPACE + "+", "").rlike(r"^[{\[]"), "caption_contains_nested_structure"),
    )
    blank = caption.isNull() | (squeezed(caption) == "")
    return F.when(blank, F.array(F.lit("caption_not_nonempty_string"))).otherwise(F.array_compact(reasons))


def cache_screen(caption: Column) -> Column:
    """Whether a prepared row's caption may be cached: a letter A-Z and no Hangul."""
    return F.coalesce(caption.rlike("[A-Za-z]") & ~caption.rlike(r"[\x{1100}-\x{11FF}\x{3130}-\x{318F}\x{AC00}-\x{D7AF}]"), F.lit(False))


def prompt_screen(caption: Column) -> Column:
    """Whether a prompt may be rendered: not blank, a letter A-Z, no Hangul, Kana or Han, no control marks."""
    east = r"[\x{1100}-\x{11FF}\x{3040}-\x{30FF}\x{3130}-\x{318F}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]"
    return F.coalesce((squeezed(caption) != "") & caption.rlike("[A-Za-z]") & ~caption.rlike(east) & ~caption.rlike(CONTROL), F.lit(False))


def safe_id(value: Column) -> Column:
    """Whether an id may name a file: letters, digits, _ and -, 151 at most, first a letter or digit."""
    return F.coalesce(value.rlike(r"^[A-Za-z0-9][A-Za-z0-9_-]{0,150}\z"), F.lit(False))


def source_stem(path: Column) -> Column:
    """File name without its last suffix, of a Windows path if there is a backslash, else of a POSIX one."""
    name = F.when(path.contains("\\"), F.regexp_extract(path, r"([^\\/]*)[\\/]*$", 1)).otherwise(F.regexp_extract(path, r"([^/]*)/*$", 1))
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def basename(path: Column) -> Column:
    """Last part of a path; backslashes count as slashes."""
    return F.regexp_extract(F.replace(path, F.lit("\\"), F.lit("/")), r"([^/]*)$", 1)


def resolved(path: Column) -> Column:
    """An absolute path without empty, ``.`` and ``..`` parts; nothing lies above the root."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    keep = F.aggregate(parts, F.array().cast("array<string>"), lambda a, p: F.when(p == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, p)))
    return F.concat(F.lit("/"), F.array_join(keep, "/"))


def contained(path: Column, root: Column) -> Column:
    """Whether a path, once resolved, lies in a root."""
    path, root = resolved(path), resolved(root)
    return (path == root) | path.startswith(F.concat(F.rtrim(root, F.lit("/")), F.lit("/")))


def rooted(path: Column, root: Column) -> Column:
    """An absolute path as it is, another below the root."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), path))


def html_escape(value: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        value = F.replace(value, F.lit(sign), F.lit(name))
    return value


def prompt_text(prefix: str, caption: Column) -> Column:
    """What is sent to an encoder: prefix and caption, lower-cased and squeezed at the ends."""
    return F.regexp_replace(F.lower(F.concat(F.lit(prefix), caption)), f"^{SPACE}+|{SPACE}+$", "")


def proxy_tokens(value: Column) -> Column:
    """Words between white space: a stand-in for a tokenizer's count."""
    return F.when(squeezed(value) == "", 0).otherwise(F.size(F.split(squeezed(value), " ")))
