"""Text normalization as column expressions: no Python runs for a row."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siteweave import config


#: Fills the cells of what folds to several characters. No code point folds to it and others, and plans show it as it is.
BLANK = "~"


@lru_cache(1)
def _folds() -> tuple[str, str, str, dict[str, str]]:
    """Code points that fold to one ASCII character, those characters, the white space that is stripped, and what folds to several."""
    one, to, white, several = [], [], [], {}
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isspace():
            white.append(c)
        if code > 127 and not 0xD800 <= code < 0xE000:
            folded = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
            if len(folded) == 1:
                one.append(c)
                to.append(folded)
            elif folded:
                several[c] = folded
    return "".join(one), "".join(to), "".join(white), several


def ascii_text(value: Column) -> Column:
    """Text without accents and other non-ASCII characters, stripped; null is empty. Integral numbers lose their ``.0``.

    Compatibility decomposition is done character by character, so three steps are exact: characters that become several,
    looked up only in texts that have one; characters that become one; and the rest, which vanishes. ASCII takes none of them.
    """
    one, to, white, several = _folds()
    text = F.btrim(F.coalesce(value.cast("string"), F.lit("")), F.lit(white))
    width = max(map(len, several.values()))
    cells = F.lit("".join(folded.ljust(width, BLANK) for folded in several.values()))

    def part(c: Column) -> Column:
        at = F.instr(F.lit("".join(several)), c)
        return F.when(at > 0, F.replace(F.substring(cells, (at - 1) * width + 1, F.lit(width)), F.lit(BLANK), F.lit(""))).otherwise(c)

    parts = F.array_join(F.transform(F.split(text, ""), part), "")
    spelt = F.when(F.translate(text, "".join(several), "") != text, parts).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(spelt, one, to), r"[^\x00-\x7F]", "")).otherwise(text)


def number_text(value: Column) -> Column:
    """A double as text: integral ones without fraction."""
    whole = (value == F.rint(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("decimal(20,0)").cast("string")).otherwise(value.cast("string"))


def fold_exact(value: Column) -> Column:
    """``ascii_text`` for every code point, by the Unicode tables of Python."""

    @F.pandas_udf("string")
    def folded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: "" if t is None else unicodedata.normalize("NFKD", t.strip()).encode("ascii", "ignore").decode())

    return folded(value.cast("string"))


#: What a value is already: an ascii_text, or a compact one.
FOLDED, COMPACT = 1, 2


def _base(value: Column, folded: int) -> Column:
    return value if folded else ascii_text(value)


def compact(value: Column, folded: int = False) -> Column:
    """Lower-case words of a-z and 0-9, parted by single spaces; ``&`` is the word and. ``folded``: what value is already."""
    if folded == COMPACT:
        return value
    text = F.replace(F.lower(_base(value, folded)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def words(compacted: Column) -> Column:
    return F.filter(F.split(compacted, " "), lambda t: t != "")


def _literals(values: tuple[str, ...] | list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")


def _map(table: dict[str, str]) -> Column:
    """A literal map, by SQL text: one call to the JVM instead of one for each entry."""
    return F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in table.items()) + ")")


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(table), key), key)


def _without(compacted: Column, gone: tuple[str, ...]) -> Column:
    return F.array_join(F.filter(words(compacted), lambda t: ~F.array_contains(_literals(gone), t)), " ")


def country(value: Column, folded: int = False) -> Column:
    """The country's standard name for its aliases, with or without ``the``; other names as they are."""
    return F.when(_without(compact(value, folded), ("the",)).isin(*config.COUNTRY_ALIASES), F.lit(config.COUNTRY)).otherwise(_base(value, folded))


def state(value: Column, folded: int = False) -> Column:
    """The code of a state's name; anything else compacted."""
    return _lookup(config.STATES, compact(value, folded))


def company(value: Column, folded: int = False) -> Column:
    return _without(compact(value, folded), config.COMPANY_WORDS)


def address(value: Column, folded: int = False) -> Column:
    return F.array_join(F.transform(words(compact(value, folded)), lambda t: _lookup(config.STREET_WORDS, t)), " ")


def postal(value: Column, folded: int = False) -> Column:
    """The first five-digit run, with its four-digit extension; empty if there is none."""
    return F.regexp_extract(_base(value, folded), config.POSTAL, 0)


def state_patterns() -> tuple[str, str, str]:
    """Code before a postal code or country, code after a comma, and full name; group 1 is what was found."""
    codes = "|".join(sorted(config.STATES.values()))
    before = rf"(?i)(?:,|\s)\s*({codes})\s+(?:\d{{5}}(?:-\d{{4}})?|usa|united states)\b"
    return before, rf"(?i),\s*({codes})\s*(?:,|$)", f"(?:^| )({'|'.join(config.STATES)})(?: |$)"


def state_in_address(value: Column, folded: int = False) -> Column:
    text = _base(value, folded)
    before, comma, name = state_patterns()
    codes = [F.nullif(F.lower(F.regexp_extract(text, p, 1)), F.lit("")) for p in (before, comma)]
    named = F.nullif(F.regexp_extract(compact(value, folded), name, 1), F.lit(""))
    return F.coalesce(*codes, _lookup(config.STATES, named), F.lit(""))


def street_number(normalized: Column) -> Column:
    """The first word of digits only, or empty."""
    return F.coalesce(F.get(F.filter(words(normalized), lambda t: t.rlike("^[0-9]+$")), F.lit(0)), F.lit(""))


def street_core(address_norm: Column, city_norm: Column, state_norm: Column, postal_norm: Column) -> Column:
    """Words of the address before the first unit word, without those of city, state, postal code and country."""
    all_words = words(address_norm)
    units = F.transform(all_words, lambda t: F.array_contains(_literals(config.UNIT_WORDS), t))
    first = F.array_position(units, True)
    before = F.when(first > 0, F.slice(all_words, 1, F.greatest(first - 1, F.lit(0)).cast("int"))).otherwise(all_words)
    names = F.try_element_at(_map({code: name for name, code in config.STATES.items()}), state_norm)
    gone = F.concat(words(city_norm), F.array(state_norm, postal_norm), words(F.coalesce(names, F.lit(""))), _literals(config.COUNTRY_WORDS))
    return F.array_join(F.filter(before, lambda t: ~F.array_contains(gone, t)), " ")


def is_yes(value: Column, folded: int = False) -> Column:
    return compact(value, folded).isin(*config.YES_WORDS)
