"""Name keys and small validators, as columns."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F



def once(function):
    """A column function whose Column arguments are computed once, however often it uses them: nested calls stay small plans."""

    @functools.wraps(function)
    def bound(*args, **more):
        own = [k for k, a in enumerate(args) if isinstance(a, Column)]
        held = F.struct(*[args[k].alias(f"a{k}") for k in own])
        return F.element_at(F.transform(F.array(held), lambda s: function(*[s[f"a{k}"] if k in own else a for k, a in enumerate(args)], **more)), 1)

    return bound


# Tokens that tell of picture quality, and values that switch a rule off.
QUALITY_TOKENS = ("uhd", "fhd", "hd", "sd", "4k", "8k", "hdr", "hevc", "h265")
OFF = ("0", "false", "no", "off")


def filled(c: Column) -> Column:
    """Trimmed text; null as empty."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def one_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def name_tokens(c: Column) -> Column:
    low = F.replace(F.replace(F.lower(filled(c)), F.lit("ё"), F.lit("е")), F.lit("h.265"), F.lit(" "))
    return F.filter(F.split(low, r"[^\p{L}\p{N}_]+"), lambda t: (t != "") & ~t.isin(*QUALITY_TOKENS))


def normalize_name(c: Column) -> Column:
    """Lower case, ё as е, without quality tokens and punctuation: the key by which names are equal."""
    return F.array_join(name_tokens(c), " ")


def is_real_id(c: Column) -> Column:
    """An id that isn't blank and isn't one of the `no epg` placeholders."""
    low = F.lower(filled(c))
    return (low != "") & ~F.startswith(F.regexp_replace(low, "[^a-z0-9]+", ""), F.lit("noepg"))


def is_enabled(c: Column, blank: bool = True) -> Column:
    low = F.lower(filled(c))
    return F.when(low == "", F.lit(blank)).otherwise(~low.isin(*OFF))


def is_placeholder_id(c: Column) -> Column:
    return F.rlike(F.lower(filled(c)), F.lit("^no_epg(_|$)"))


def imdb_id(c: Column) -> Column:
    low = F.lower(filled(c))
    return F.when(F.rlike(low, F.lit(r"^tt\d{5,12}$")), low).otherwise("")


def year_text(c: Column) -> Column:
    text = filled(c)
    return F.when(F.rlike(text, F.lit(r"^(19|20)\d{2}$")), text).otherwise("")


def votes(c: Column) -> Column:
    """Number of votes from text with separators; null where there is no digit."""
    return F.regexp_replace(filled(c), r"[\s,. ]", "").try_cast("bigint")


def title_key(title: Column, year: Column, media: Column, language: Column) -> Column:
    return F.concat_ws("|", normalize_name(title), filled(year), filled(media), filled(language))


def nonempty(c: Column) -> Column:
    """null where a text is empty: blank is a value in keys, but never wins a merge."""
    return F.when(F.trim(c) != "", c)


# The transliteration of the Russian letters.
TRANSLIT = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}


def transliterate(c: Column) -> Column:
    """Russian letters in Latin ones; a capital gives a capital first letter."""
    pairs = [F.lit(x) for k, v in TRANSLIT.items() for x in (k, v)] + [F.lit(x) for k, v in TRANSLIT.items() for x in (k.upper(), v[:1].upper() + v[1:])]
    table = F.create_map(*pairs)
    return one_space(F.array_join(F.transform(F.split(filled(c), ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), ""))


def categories_key(c: Column) -> Column:
    """Distinct normalised categories of an array."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), normalize_name), lambda x: x != ""))
