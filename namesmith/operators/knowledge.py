"""The knowledge tables in the forms that expressions need: key lists for hash-set tests, constant maps, vocabularies."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import rules
from ..functions import text as T
from ..functions.rules import SETTINGS


class Knowledge:
    """A catalogue and a gazetteer (defaults, or rows given by the user) and what follows from them."""

    def __init__(self, catalogue=None, gazetteer=None):
        self.catalogue, self.gazetteer = rules.catalogue_rows(catalogue), rules.gazetteer_rows(gazetteer)
        self.words = {r.key: r for r in self.catalogue if " " not in r.key}
        self.phrases = sorted((r for r in self.catalogue if " " in r.key), key=lambda r: -len(r.key))
        self.employers = {r.key: r for r in self.gazetteer}
        single = lambda *lists: {m for x in lists for m in x if " " not in m}
        markers = single(rules.INACTIVE, rules.ANNOTATIONS, rules.INDEPENDENT, rules.OCCUPATIONS)
        strong = {k for k, r in self.words.items() if r.weight >= SETTINGS.typo_weight}
        self.typo_targets = sorted(t for t in strong | markers if len(t) >= SETTINGS.typo_length)
        known = set(rules.GIVEN_NAMES) | set(rules.SURNAMES) | set(rules.PLACE_TOKENS) | set(rules.STOPWORDS) | markers
        texts = [*(r.key for r in self.catalogue), *(r.key for r in self.gazetteer), *rules.INACTIVE, *rules.ANNOTATIONS, *rules.WAITING, *rules.INDEPENDENT, *rules.NULL_MARKERS, *rules.PLACES, *rules.ABBREVIATIONS, *rules.ABBREVIATIONS.values(), *rules.CORRECTIONS, *rules.CORRECTIONS.values(), *rules.STRONG_ADDRESS, *rules.WEAK_ADDRESS, *rules.LEGAL_SUFFIXES, *rules.PUBLIC_HEADS]
        self.known = sorted({w for t in texts for w in t.split()} | known)
        self.approximate_words = sorted(k for k, r in self.words.items() if len(k) >= SETTINGS.approximate_length and r.weight >= SETTINGS.approximate_weight)
        self.proper_nouns = sorted(set(rules.GIVEN_NAMES) | set(rules.SURNAMES) | set(rules.PLACE_TOKENS))
        self.never_approximate = sorted(set(self.proper_nouns) | set(rules.NOT_APPROXIMATE))

    def field(self, key: Column, name: str) -> Column:
        """A catalogue field of a key that is in the catalogue."""
        return F.element_at(T.constant_map({r.key: getattr(r, name) for r in self.catalogue}), key)

    def employer(self, key: Column, name: str) -> Column:
        return F.element_at(T.constant_map({r.key: getattr(r, name) for r in self.gazetteer}), key)


@lru_cache(1)
def default() -> Knowledge:
    return Knowledge()


def mapped(key: Column, table: dict[str, str]) -> Column:
    """A constant mapping; null for other keys."""
    return F.element_at(T.constant_map(table), key)


def division_label(section: Column, division: Column) -> Column:
    """Label of a (section, division) pair, or else the section's name; null without a section."""
    pair = F.concat(section, division)
    return F.coalesce(F.when(T.one_of(pair, *rules.DIVISIONS), mapped(pair, rules.DIVISIONS)), F.when(T.one_of(section, *rules.SECTIONS), mapped(section, rules.SECTIONS)))


def macrosector(section: Column, kind: Column, name: Column) -> Column:
    """The section's name, or why there is none; never null."""
    return (
        F.when(F.coalesce(section, F.lit("")) != "", mapped(section, rules.SECTIONS))
        .when(T.one_of(kind, *rules.EMPLOYER_TYPES), F.lit(rules.PENDING_LABEL))
        .when(name.startswith(rules.UNIDENTIFIED), F.lit(rules.UNIDENTIFIED))
        .otherwise(F.lit(rules.NO_CORPORATE_LINK))
    )


def executive_view(section: Column) -> Column:
    return F.when(T.one_of(section, *rules.EXECUTIVE), mapped(section, rules.EXECUTIVE)).otherwise(F.lit("Sin clasificar"))
