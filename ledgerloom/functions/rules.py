"""Keyword and range rules as ``when`` chains built from plain rule lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_spaces, contains_any, locale_number


def first_match(text: Column, rules, default) -> Column:
    """Value of the first rule ``(keyword, value)`` whose keyword occurs in the text."""
    chain = None
    for word, value in rules:
        test = F.contains(text, F.lit(word))
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def first_regex(text: Column, rules, default) -> Column:
    """Value of the first rule ``(pattern, value)`` whose pattern is found in the text."""
    chain = None
    for pattern, value in rules:
        test = F.coalesce(text.rlike(pattern), F.lit(False))
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def asset_masks(text: Column, land: str, structure: str, mixed: str) -> dict[str, Column]:
    """Disjoint masks from three pattern families.

    A row is mixed when the explicit pattern or both plain ones are found.
    """
    is_land, is_structure, explicit = (F.coalesce(text.rlike("(?U)" + p), F.lit(False)) for p in (land, structure, mixed))
    return {
        "land_only": is_land & ~is_structure & ~explicit,
        "object_only": is_structure & ~is_land & ~explicit,
        "mixed": explicit | (is_land & is_structure),
    }


def masks_to_label(masks: dict[str, Column], names: dict[str, str], default: str) -> Column:
    chain = None
    for key, label in names.items():
        chain = F.when(masks[key], label) if chain is None else chain.when(masks[key], label)
    return chain.otherwise(default)


def place_kind(address, municipality, marker: str, yes: str, no: str) -> Column:
    """``yes`` when the marker occurs in address or municipality."""
    text = F.lower(F.concat_ws(" ", clean_spaces(address), clean_spaces(municipality)))
    return F.when(F.contains(text, F.lit(marker)), yes).otherwise(no)


def return_years(category, table, default: int) -> Column:
    """Years of return by first keyword found in the category."""
    return first_match(F.lower(clean_spaces(category)), table, default)


def annual_amount(value, period, factors) -> Column:
    """Amount per year from the first billing-period keyword ``(keyword, factor)``."""
    amount = value if isinstance(value, Column) else locale_number(value)
    return amount * first_match(F.lower(clean_spaces(period)), factors, 1)


def route_area(category, area: Column, land_words, object_words) -> tuple[Column, Column]:
    """(object area, land area): land when only land words occur, else object."""
    text = F.lower(clean_spaces(category))
    land_only = contains_any(text, land_words) & ~contains_any(text, object_words)
    return F.when(~land_only, area), F.when(land_only, area)


def money(c: Column) -> Column:
    return F.bround(c, 2)


def entity_group(kind, name, kind_rules, name_tokens, company: str = "company", other: str = "other") -> Column:
    """Group from the registered kind, else from legal-form tokens in the name."""
    kind_text = F.lower(F.trim(F.coalesce(kind.cast("string"), F.lit(""))))
    name_text = F.lower(F.trim(F.coalesce(name.cast("string"), F.lit(""))))
    by_name = F.when(contains_any(name_text, name_tokens), company).otherwise(other)
    chain = None
    for words, value in kind_rules:
        test = contains_any(kind_text, words)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return by_name if chain is None else chain.otherwise(by_name)


def range_bucket(code: Column, ranges, default: str) -> Column:
    """Label of the closed integer range ``(low, high, label)`` holding the truncated code."""
    whole = code.cast("double").try_cast("long")
    chain = None
    for low, high, label in ranges:
        test = whole.between(low, high)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return F.lit(default) if chain is None else chain.otherwise(default)


def roll_up(label: Column, groups: dict[str, list[str]], default: str) -> Column:
    chain = None
    for target, members in groups.items():
        test = label.isin(members)
        chain = F.when(test, target) if chain is None else chain.when(test, target)
    return chain.otherwise(default)


def profile_label(group: Column, macro: Column) -> Column:
    return F.concat_ws("__", group, macro)
