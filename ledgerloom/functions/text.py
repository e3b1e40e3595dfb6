"""Column expressions that clean, normalise, split and parse text.

Every function takes and returns Columns; nothing leaves the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing cell.
MISSING_WORDS = ["", "nan", "None", "<NA>"]

# Legal-form spellings, folded in this order.
LEGAL_FORMS = [
    ("sh.p.k.", "shpk"),
    ("sh.p.k", "shpk"),
    ("sh.a.", "sha"),
    ("sh.a", "sha"),
    ("l.l.c.", "llc"),
    ("l.l.c", "llc"),
]

# The word an ampersand stands for, and what separates names.
AMPERSAND_WORD = " dhe "
NAME_SEPARATOR = "(?i),|/|;| dhe | and "

# Whitespace as scripting languages see it: Unicode space plus the C0 separators.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def clean_spaces(c) -> Column:
    """NULL to '', newlines and runs of white space to one space, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(_as_text(c), F.lit("")), _SPACE, " "))


def rule_text(c) -> Column:
    """Lower-case, trimmed, single-spaced text for keyword rules."""
    return clean_spaces(F.lower(_as_text(c)))


def joined_text(cols) -> Column:
    """All given text columns in one rule text, NULL counting as ''."""
    parts = [F.coalesce(_as_text(c), F.lit("")) for c in cols]
    return rule_text(F.concat_ws(" ", *parts)) if parts else F.lit("")


def null_if_missing(c) -> Column:
    """Trimmed text, or NULL when it is blank or a missing-value word."""
    text = F.trim(_as_text(c))
    return F.when(text.isin(MISSING_WORDS), None).otherwise(text)


def lowered_or_null(c) -> Column:
    """Trimmed lower-case text with 'nan', 'none' and '' as NULL (serving input)."""
    text = F.lower(F.trim(_as_text(c)))
    return F.when(text.isin("", "nan", "none"), None).otherwise(text)


def parse_float(c) -> Column:
    """Plain or exponent decimal text to double, anything else NULL."""
    text = F.trim(_as_text(c))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def clean_numeric(c) -> Column:
    """Keep digits, dot and minus of a text cell and read it as a double.

    A comma is dropped, never read as a decimal mark; see ``locale_number``.
    """
    return parse_float(F.regexp_replace(null_if_missing(c), r"[^0-9.\-]", ""))


def locale_number(c) -> Column:
    """Number in either decimal style.

    With both marks present the last one is the decimal mark. With commas only,
    a final group of one or two characters makes them decimal marks.
    """
    text = F.trim(F.replace(F.replace(clean_spaces(c), F.lit("€"), F.lit("")), F.lit("EUR"), F.lit("")))
    no_commas = F.replace(text, F.lit(","), F.lit(""))
    comma_as_dot = F.replace(text, F.lit(","), F.lit("."))
    dots_dropped = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    last_comma = F.instr(F.reverse(text), ",")
    last_dot = F.instr(F.reverse(text), ".")
    chosen = (
        F.when((last_comma > 0) & (last_dot > 0), F.when(last_dot < last_comma, no_commas).otherwise(dots_dropped))
        .when(last_comma.between(2, 3), comma_as_dot)
        .otherwise(no_commas)
    )
    return parse_float(chosen)


@lru_cache(maxsize=1)
def _folding():
    """Single-letter and multi-letter compatibility foldings, derived from Unicode data."""
    singles, multis = {}, {}
    for code in range(0x80, 0x10000):
        char = chr(code)
        category = unicodedata.category(char)
        if category[0] not in "LN" or char != char.lower():
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", char) if not unicodedata.combining(x))
        if base == char or not re.fullmatch(r"[A-Za-z0-9]+", base):
            continue
        if len(base) == 1:
            singles[char] = base
        elif category[0] == "L":
            multis[char] = base
    return singles, multis


def strip_accents(c) -> Column:
    """Compatibility-decompose letters to their ASCII base and drop combining marks."""
    singles, multis = _folding()
    plain = F.translate(c, "".join(singles), "".join(singles.values()))
    expanded = plain
    for char, base in multis.items():
        expanded = F.replace(expanded, F.lit(char), F.lit(base))
    folded = F.when(plain.rlike("[" + "".join(multis) + "]"), expanded).otherwise(plain)
    return F.regexp_replace(folded, r"\p{M}+", "")


def entity_name(c) -> Column:
    """Comparable form of a business or person name."""
    raw = F.lower(F.trim(F.coalesce(_as_text(c), F.lit(""))))
    text = F.when(raw.rlike(r"[^\x00-\x7F]"), strip_accents(raw)).otherwise(raw)
    for spelled, folded in LEGAL_FORMS:
        text = F.replace(text, F.lit(spelled), F.lit(folded))
    text = F.replace(text, F.lit("&"), F.lit(AMPERSAND_WORD))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def spelled_names(c) -> Column:
    """The whole cell, each name in it, then the names joined: array of text, in lookup order."""
    raw = F.trim(F.coalesce(_as_text(c), F.lit("")))
    parts = F.filter(F.transform(F.split(raw, NAME_SEPARATOR), lambda p: F.trim(p)), lambda p: p != "")
    return _bind(parts, lambda ps: F.concat(
        F.array(raw), ps, F.when(F.size(ps) > 1, F.array(F.array_join(ps, " "))).otherwise(F.array())
    ))


def name_candidates(c) -> Column:
    """Spellings to look up for a cell that may hold several names.

    A spelling whose comparable form was seen before, or is empty, is left out.
    Result: array of struct(name, norm).
    """
    pairs = F.transform(spelled_names(c), lambda s: F.struct(s.alias("name"), entity_name(s).alias("norm")))
    return first_by_norm(F.filter(pairs, lambda p: p["norm"] != ""))


def first_by_norm(pairs: Column) -> Column:
    """Keep the first struct of each ``norm`` in an array, in order."""
    return _bind(pairs, lambda ps: F.filter(
        ps, lambda p, i: F.array_position(F.transform(ps, lambda q: q["norm"]), p["norm"]) == i + 1
    ))


def _bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.transform(F.array(value), use)[0]


def contains_all(c, words) -> Column:
    """True when every word occurs in the lower-cased cleaned text."""
    text = F.lower(clean_spaces(c))
    return F.forall(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(text, w)) if words else F.lit(True)


def contains_any(c, words) -> Column:
    """True when at least one word occurs in the text."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(c, F.lit(word))
    return hit


def owner_fields(c) -> Column:
    """``owner;capital;percent`` to struct(owner, capital, percent), '' where absent."""
    parts = F.split(F.trim(F.coalesce(_as_text(c), F.lit(""))), ";")
    return F.struct(*[_item(parts, i + 1).alias(n) for i, n in enumerate(["owner", "capital", "percent"])])


def activity_fields(c, count: int = 5) -> Column:
    """``codes;descriptions;types`` to ``count`` structs(code, description, type), '' padded."""
    parts = F.split(F.trim(F.coalesce(_as_text(c), F.lit(""))), ";")
    names = ["code", "description", "type"]
    lists = [F.split(F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")), ",") for i in range(3)]
    # Spelled out, not a function over positions: where few fields are taken, only those are split and trimmed.
    return F.array(*[F.struct(*[_item(items, i + 1).alias(n) for items, n in zip(lists, names)]) for i in range(count)])


def _item(items: Column, position) -> Column:
    where = F.lit(position) if isinstance(position, int) else position
    return F.coalesce(F.trim(F.try_element_at(items, where)), F.lit(""))


def _as_text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")
