"""Regions of channel groups, ids and feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import filled, name_tokens, normalize_name, once

# The region of each provider group.
GROUP_REGION = {
    "Россия": "RU", "Украинские": "UA", "Беларусь": "BY", "Германия": "DE", "UK": "GB", "Великобритания": "GB",
    "Канада": "CA", "США": "US", "Италия": "IT", "Румыния": "RO", "Болгария": "BG", "Израиль": "IL",
    "BE & NL": "BE/NL", "BE/NL": "BE/NL", "Польша": "PL", "Венгрия": "HU", "Чехия": "CZ", "Словакия": "SK",
    "SkyLink": "CZ/SK", "Греция": "GR", "Турция": "TR", "Хорватия": "HR", "Литва": "LT", "Латвия": "LV",
    "Молдова": "MD", "Грузия": "GE", "Армения": "AM", "Азербайджан": "AZ",
}
# Brands whose schedules differ by country.
SENSITIVE_BRANDS = (
    "discovery", "tlc", "animal planet", "national geographic", "nat geo", "ngc", "eurosport", "viasat", "hbo",
    "nickelodeon", "nick jr", "disney", "mtv", "fox", "star", "bbc", "itv", "rai", "rtl", "bein", "cinemax",
    "paramount", "history", "travel channel", "food network", "cartoon network", "cnn", "tv1000", "canal+", "sky",
    "digi", "nova", "sport tv", "dazn",
)
# Id suffixes of countries beside the lower-case code itself.
ID_COUNTRIES = ("RU", "UA", "IL", "PL", "RO", "BG", "DE", "GB", "US", "CA", "IT", "GR", "TR", "PT", "HR", "HU", "CZ", "SK", "LT", "LV", "MD")
ID_SYNONYMS = {"UA": ("ukr",), "GB": ("uk",), "US": ("usa",)}
# Words that name a region at the edge of a channel's name.
REGION_WORDS = {
    "RU": ("ru", "rus", "russia", "russian", "россия"),
    "UA": ("ua", "ukraine", "ukr", "украина", "україна"),
    "BY": ("by", "belarus", "bel", "беларусь"),
    "GB": ("uk", "gb", "britain", "british", "united kingdom"),
    "US": ("us", "usa", "united states"),
    "CA": ("ca", "canada", "canadian"),
    "DE": ("de", "deu", "germany", "deutsch", "deutschland"),
    "AT": ("at", "austria", "osterreich", "oesterreich"),
    "IT": ("it", "italy", "italia"),
    "RO": ("ro", "romania", "romanian", "românia"),
    "BG": ("bg", "bulgaria", "bulgarian"),
    "PL": ("pl", "poland", "polska", "polish"),
    "HU": ("hu", "hungary", "magyar"),
    "CZ": ("cz", "czech", "cesko", "česko"),
    "SK": ("sk", "slovakia", "slovensko"),
    "GR": ("gr", "greece", "greek"),
    "TR": ("tr", "turkey", "turkiye", "türkiye", "tur"),
    "HR": ("hr", "croatia", "croatian"),
    "LT": ("lt", "lithuania", "lithuanian"),
    "LV": ("lv", "latvia", "latvian"),
    "IL": ("il", "israel", "israeli"),
    "MD": ("md", "moldova", "moldavian"),
    "GE": ("ge", "georgia", "georgian"),
    "AM": ("am", "armenia", "armenian"),
    "AZ": ("az", "azerbaijan", "azerbaijani"),
}
EVERYWHERE_WORDS = ("europe", "europa", "euro", "international", "intl", "global")


def group_region(group: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in GROUP_REGION.items() for x in pair])
    return F.coalesce(F.try_element_at(table, filled(group)), F.lit(""))


@once
def is_sensitive(name: Column) -> Column:
    low = F.regexp_replace(F.lower(filled(name)), r"(?U)\s+", " ")
    return F.exists(F.array(*[F.lit(b) for b in SENSITIVE_BRANDS]), lambda b: F.contains(low, b))


@once
def compatible(region: Column, regions: Column) -> Column:
    """A feed's regions hold the channel's; a composite region only matches itself; blank matches nothing."""
    own = F.transform(F.coalesce(regions, F.array().cast("array<string>")), lambda r: F.upper(F.trim(r)))
    return (filled(region) != "") & F.array_contains(own, F.upper(filled(region)))


@once
def id_region(c: Column) -> Column:
    """The one country whose token an id has; empty for none or several."""
    low = F.lower(filled(c))
    hits = F.array_compact(F.array(*[F.when(F.rlike(low, F.lit(rf"(?:^|[._-])(?:{'|'.join((k.lower(), *ID_SYNONYMS.get(k, ())))})(?:$|[._-])")), F.lit(k)) for k in ID_COUNTRIES]))
    return F.when(F.size(hits) == 1, F.element_at(hits, 1)).otherwise("")


@once
def family_keys(name: Column, region: Column) -> Column:
    """Keys of a channel in order: its name; without region words at both edges; without a two-word region at one edge."""
    words = F.create_map(*[x for k, v in REGION_WORDS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    none = F.array().cast("array<string>")
    drop = F.array_union(F.array(*[F.lit(w) for w in EVERYWHERE_WORDS]), F.flatten(F.transform(F.split(F.upper(filled(region)), "/"), lambda r: F.coalesce(F.try_element_at(words, r), none))))
    tokens = name_tokens(name)
    kept = F.filter(F.transform(tokens, lambda t, i: F.when(~F.array_contains(drop, t), i)), lambda i: i.isNotNull())
    inner = F.when(F.size(kept) > 0, F.array_join(F.slice(tokens, F.array_min(kept) + 1, F.greatest(F.array_max(kept) - F.array_min(kept) + 1, F.lit(0))), " ")).otherwise("")
    whole = normalize_name(name)
    pairs = F.filter(drop, lambda w: F.contains(w, F.lit(" ")))
    ends = F.transform(F.filter(pairs, lambda w: F.endswith(whole, F.concat(F.lit(" "), w))), lambda w: F.trim(F.substr(whole, F.lit(1), F.length(whole) - F.length(w) - 1)))
    begins = F.transform(F.filter(pairs, lambda w: F.startswith(whole, F.concat(w, F.lit(" ")))), lambda w: F.trim(F.substr(whole, F.length(w) + 2)))
    return F.array_distinct(F.filter(F.concat(F.array(whole, inner), ends, begins), lambda x: x != ""))
