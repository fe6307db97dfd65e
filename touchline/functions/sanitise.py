"""Cleaning of odds markets, before their contract: column expressions on
``choices ARRAY<STRUCT>`` whose ``winning`` is text.  Order: flag corrupted
markets, rename, make names unique, then the winning flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import let

# The names by position in the market kinds that are renamed.
NAMES_1X2 = ("1", "X", "2")
NAMES_FIRST_TEAM = ("Home", "No goal", "Away")
ROLES_ASIAN = ("Home", "Away")
TRUE_WORDS = ("true", "1", "t", "y", "yes")


def duplicate_flag(choices: Column) -> Column:
    """Two choices share a name as sent; a missing name is ''."""
    return F.size(F.array_distinct(F.transform(choices, lambda c: F.coalesce(c["name"], F.lit(""))))) < F.size(choices)


def _named(choices: Column, names: tuple[str, ...]) -> Column:
    return F.transform(choices, lambda c, i: c.withField("name", F.element_at(F.array(*map(F.lit, names)), i + 1)))


def names_1x2(group: Column, choices: Column) -> Column:
    return F.when((group == "1X2") & (F.size(choices) == 3), _named(choices, NAMES_1X2)).otherwise(choices)


def names_first_team(market: Column, choices: Column) -> Column:
    return F.when((market == "First team to score") & (F.size(choices) == 3), _named(choices, NAMES_FIRST_TEAM)).otherwise(choices)


def renamed(market: Column, group: Column, choices: Column) -> Column:
    """The one renaming that fits, in this order: 1X2, first team, Asian."""
    three, kind = F.size(choices) == 3, F.lower(market) == "asian handicap"
    first = F.when((market == "First team to score") & three, names_first_team(market, choices)).when(kind, names_asian(market, choices)).otherwise(choices)
    return F.when((group == "1X2") & three, names_1x2(group, choices)).otherwise(first)


def names_asian(market: Column, choices: Column) -> Column:
    """The line in brackets stays, the rest becomes the role."""
    roles = F.array(*map(F.lit, ROLES_ASIAN))
    named = F.transform(choices, lambda c, i: c.withField("name", F.concat(F.regexp_extract(F.coalesce(c["name"], F.lit("")), r"^(\([+-]?\d+\.?\d*\)\s*)", 1), F.element_at(roles, i + 1))))
    return F.when((F.lower(market) == "asian handicap") & (F.size(choices) == 2), named).otherwise(choices)


def dedupe_names(choices: Column) -> Column:
    """Repeated names get ``_dup_k`` with the smallest k that is free."""

    def step(seen: Column, c: Column) -> Column:
        name = F.coalesce(c["name"], F.lit(""))
        free = lambda: F.filter(F.transform(F.sequence(F.lit(1), F.size(seen)), lambda k: F.concat(name, F.lit("_dup_"), k.cast("string"))), lambda n: ~F.array_contains(seen, n))[0]
        return F.concat(seen, F.array(F.when(F.array_contains(seen, name), free()).otherwise(name)))

    names = F.aggregate(choices, F.array().cast("array<string>"), step)
    return F.zip_with(choices, names, lambda c, n: c.withField("name", n))


def winning_bool(winning: Column) -> Column:
    """Text to boolean; missing is false."""
    return F.coalesce(F.lower(F.trim(winning)).isin(*TRUE_WORDS), F.lit(False))


def single_winner(flags: Column) -> Column:
    """Only the first true stays."""
    return F.transform(flags, lambda f, i: f & (F.array_position(flags, True) == i + 1))


def winning_flags(choices: Column, corrupted: Column, keep_all: Column | None = None) -> Column:
    """array<boolean>: null in corrupted markets, else at most one true.

    ``keep_all`` marks markets that may have several winners (none by default).
    """
    flags = F.transform(choices, lambda c: winning_bool(c["winning"]))
    one = single_winner(flags) if keep_all is None else F.when(keep_all, flags).otherwise(single_winner(flags))
    return F.when(corrupted, F.transform(flags, lambda f: F.lit(None).cast("boolean"))).otherwise(one)


def sanitise_choices(market: Column, group: Column, choices: Column) -> Column:
    """All steps in order; ``winning`` comes out as 'true', 'false' or null."""
    named = let(renamed(market, group, choices), dedupe_names)
    flags = let(F.transform(choices, lambda c: winning_bool(c["winning"])), single_winner)
    flags = F.when(duplicate_flag(choices), F.transform(choices, lambda c: F.lit(None).cast("boolean"))).otherwise(flags)
    return F.zip_with(named, flags, lambda c, w: c.withField("winning", w.cast("string")))
