"""Locales: normal form, description, and the names that follow from them."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

#: Aliases, language names and region names.
ALIASES = {"en-uk": "en-GB", "en-gb": "en-GB", "en-us": "en-US", "es-es": "es-ES", "es-ar": "es-AR", "es-mx": "es-MX"}
LANGUAGES = {"en": "English", "es": "Spanish", "pt": "Portuguese", "fr": "French", "it": "Italian", "de": "German"}
REGIONS = {"US": "United States", "GB": "United Kingdom", "ES": "Spain", "AR": "Argentina", "MX": "Mexico"}


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def normal_locale(c: Column) -> Column:
    """ll-RR, or null for what has not exactly two parts."""
    given = strip(c)
    parts = F.split(F.translate(given, "_", "-"), "-")
    made = F.when(F.size(parts) == 2, F.concat(F.lower(parts[0]), F.lit("-"), F.upper(F.get(parts, F.lit(1)))))
    return F.coalesce(F.try_element_at(_map(ALIASES), F.lower(given)), F.when(given != "", made))


def checked_locale(c: Column) -> Column:
    """The same, raising for what is no locale."""
    return F.coalesce(normal_locale(c), F.raise_error(F.concat(F.lit("no locale: "), F.coalesce(c, F.lit("null")))).cast("string"))


def described(locale: str) -> tuple[str, str]:
    """A locale's normal form and its description, for prompts and names on the driver."""
    parts = locale.strip().replace("_", "-").split("-")
    if len(parts) != 2 or not all(parts):
        raise ValueError(f"no locale: {locale}")
    normal = ALIASES.get(locale.strip().lower(), f"{parts[0].lower()}-{parts[1].upper()}")
    language, region = normal.split("-")
    return normal, f"{LANGUAGES.get(language, language)} as used in {REGIONS.get(region, region)} ({normal})"


def locale_details(locale: Column) -> Column:
    """struct of locale, language_code, region_code, language_name, locale_description for a normal locale."""
    language, region = F.substring_index(locale, "-", 1), F.substring_index(locale, "-", -1)
    name = F.coalesce(F.try_element_at(_map(LANGUAGES), language), language)
    place = F.coalesce(F.try_element_at(_map(REGIONS), region), region)
    told = F.concat(name, F.lit(" as used in "), place, F.lit(" ("), locale, F.lit(")"))
    return F.when(locale.isNotNull(), F.struct(locale.alias("locale"), language.alias("language_code"), region.alias("region_code"), name.alias("language_name"), told.alias("locale_description")))


def translated_column(locale: Column) -> Column:
    return F.concat(F.lit("statement_"), F.lower(F.translate(locale, "-", "_")))


def output_name(locale: str, source: str = "Combined Data") -> str:
    """<folder>/<stem> <locale>.csv beside the source; second passes, which have no source, use the default's stem."""
    path = PurePosixPath(source)
    return str(path.with_name(f"{path.stem} {locale}.csv"))
