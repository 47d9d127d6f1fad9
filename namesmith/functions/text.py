"""Cleaning and tokenising names: functions from columns to columns, all inside the JVM.

Texts are ASCII capitals, digits and single spaces after ``clean_base``; token columns are arrays of strings in order.
Null text counts as empty.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .rules import SETTINGS

#: Letters that DuckDB twins fold, and what they become; ``decompositions`` has them all.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def one_of(c: Column, *values: str) -> Column:
    """``c.isin(*values)``, with the literals of a list made once a session: making them is most of a plan's building."""
    if not hasattr(c, "_jc") or not values:
        return c.isin(*values)
    from pyspark import SparkContext
    from pyspark.sql.classic.column import Column as Classic
    from pyspark.sql.classic.column import _to_seq

    context = SparkContext._active_spark_context
    made = context.__dict__.setdefault("_namesmith_literals", {})
    if values not in made:
        made[values] = _to_seq(context, [F.lit(v)._jc for v in values])
    return Classic(c._jc.isin(made[values]))


def quoted(x) -> str:
    """A value as a SQL literal."""
    return str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_map(table: dict) -> Column:
    """A constant map, made by one call."""
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items()) + ")")


def strip_export_prefix(c: Column) -> Column:
    """Trim, drop one leading apostrophe, trim again."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "^'", ""))


@lru_cache
def decompositions() -> tuple[str, str, dict[str, str]]:
    """(characters, the ASCII ones that they become, those that become several): what Unicode's compatibility decomposition leaves without its marks.

    Combining marks stand last among the characters and become nothing. Characters that leave no ASCII letter or digit aren't there.
    """
    from_, to, marks, several = [], [], [], {}
    for code in range(0x80, 0x2FA20):
        c = chr(code)
        if unicodedata.combining(c):
            marks.append(c)
        elif unicodedata.decomposition(c):
            parts = [x if x.isascii() else x.upper() for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)]
            left = "".join(x if x.isascii() else " " for x in parts)
            if len(left) > 1 and any(x.isalnum() for x in left):
                several[c] = left
            elif left.isalnum():
                from_.append(c)
                to.append(left)
    return "".join(from_ + marks), "".join(to), several


def fold_accents(c: Column) -> Column:
    """Capitals of the compatibility decomposition without its marks (sharp s becomes SS); characters with none stay."""
    from_, to, several = decompositions()
    plain = F.translate(F.replace(c, F.lit("ß"), F.lit("ss")), from_, to)
    letters = F.transform(F.sequence(F.lit(1), F.length(plain)), lambda i: F.substring(plain, i, 1))
    spread = F.array_join(F.transform(letters, lambda x: lookup(x, several, x)), "")
    return F.upper(F.when(plain.rlike(f"[{''.join(several)}]"), spread).otherwise(plain))


def keep_charset(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Z0-9 ]", " ")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " +", " "))


def clean_base(c: Column) -> Column:
    return collapse_spaces(keep_charset(fold_accents(strip_export_prefix(c))))


def repair_split_words(c: Column) -> Column:
    """Join words that lost a letter at a blank, by the enumerated list, in its order."""
    return reduce(lambda x, w: F.regexp_replace(x, f"\\b{w[0]} +{w[1]}\\b", w[2]), rules.SPLIT_WORDS, c)


def join_spelled_acronyms(c: Column) -> Column:
    return reduce(lambda x, w: F.regexp_replace(x, *w), rules.SPELLED_ACRONYMS, c)


def tokens_of(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def text_of(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def split_glued_suffix(tokens: Column, bases: list[str]) -> Column:
    """``base`` + legal form in one token, where the base is a catalogue word: two tokens."""

    def cut(t):
        out = None
        for s in rules.GLUED_SUFFIXES:
            base = F.substring(t, F.lit(1), F.length(t) - len(s))
            hit = t.endswith(s) & (F.length(t) >= len(s) + SETTINGS.glued_base) & base.isin(bases)
            pair = F.array(base, F.lit(s))
            out = F.when(hit, pair) if out is None else out.when(hit, pair)
        return out.otherwise(F.array(t))

    return F.flatten(F.transform(tokens, cut))


def complete_truncated_stem(tokens: Column) -> Column:
    def whole(t):
        out = None
        for stem, word in rules.TRUNCATED_STEMS:
            hit = t.startswith(stem) & (t != word)
            out = F.when(hit, F.lit(word)) if out is None else out.when(hit, F.lit(word))
        return out.otherwise(t)

    return F.transform(tokens, whole)


def split_number(c: Column) -> tuple[Column, Column]:
    """(rest, number): a trailing number of up to four digits, unless it belongs to the name."""
    base = F.regexp_extract(c, "^(.*?) +([0-9]{1,4})$", 1)
    number = F.regexp_extract(c, "^(.*?) +([0-9]{1,4})$", 2)
    able = (number != "") & ~one_of(c, *rules.NUMBER_BRANDS) & (F.length(base) >= 4) & base.rlike("[A-Z]") & (F.contains(base, F.lit(" ")) | (F.length(base) > 4))
    return F.when(able, base).otherwise(c), F.when(able, number).otherwise(F.lit(""))


def _suffix_pattern() -> str:
    ordered = sorted(rules.LEGAL_SUFFIXES, key=lambda s: (-len(s.split()), s))
    return "^(.+?) (" + "|".join(ordered) + ")$"


SUFFIX_PATTERN = _suffix_pattern()


def split_legal_suffix(c: Column) -> tuple[Column, Column]:
    """(core, legal form): the longest trailing legal form, never the whole name."""
    core, form = F.regexp_extract(c, SUFFIX_PATTERN, 1), F.regexp_extract(c, SUFFIX_PATTERN, 2)
    return F.when(form != "", core).otherwise(c), form


def lookup(t: Column, table: dict[str, str], default: Column) -> Column:
    """A constant mapping of a token: hash-set test first, so that most tokens skip the map."""
    return F.when(one_of(t, *table), F.element_at(constant_map(table), t)).otherwise(default)


def expand_tokens(tokens: Column) -> Column:
    """Known misspellings, then abbreviations (one token may become several)."""
    fixed = F.transform(tokens, lambda t: lookup(t, rules.CORRECTIONS, t))
    return F.flatten(F.transform(fixed, lambda t: F.split(lookup(t, rules.ABBREVIATIONS, t), " ")))


def without(tokens: Column, words) -> Column:
    return F.filter(tokens, lambda t: ~one_of(t, *words))


def unless_empty(candidate: Column, fallback: Column) -> Column:
    return F.when(F.size(candidate) > 0, candidate).otherwise(fallback)


def comparison_key(tokens: Column, number: Column, generic: Column) -> Column:
    """Sorted tokens without stopwords (duplicates stay); a generic name keeps its number."""
    kept = unless_empty(without(tokens, rules.STOPWORDS), tokens)
    key = text_of(F.array_sort(kept))
    return F.when((number != "") & generic, F.concat(key, F.lit(" #"), number)).otherwise(key)


def remove_qualifiers(tokens: Column) -> Column:
    """The name without payroll words, job titles and trailing places; never empty."""
    core = unless_empty(without(tokens, rules.PAYROLL_WORDS), tokens)
    core = unless_empty(without(core, rules.OCCUPATIONS), core)
    text = F.regexp_replace(text_of(core), "( (" + "|".join(rules.PLACE_TOKENS) + "))+$", "")
    text = F.regexp_replace(text, "((^| )(" + "|".join(rules.STOPWORDS) + "))+$", "")
    return unless_empty(tokens_of(text), tokens)


def is_truncated(c: Column) -> Column:
    return F.length(c).isin(*SETTINGS.field_limits)


def title_case_es(c: Column) -> Column:
    """Spanish capitalisation: acronyms and short vowelless words stay, connectors are small except at the start."""

    def one(t, i):
        stays = one_of(t, *rules.ACRONYMS) | t.rlike("^[BCDFGHJKLMNPQRSTVWXYZ]{1,4}$") | t.rlike("^[0-9]+$")
        return F.when(stays, t).when((i > 0) & one_of(t, *rules.CONNECTORS), F.lower(t)).otherwise(F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, F.lit(2), F.length(t)))))

    return text_of(F.transform(tokens_of(c), one))


def merge_bigrams(tokens: Column, merges: Column) -> Column:
    """Greedy left-to-right joining of neighbouring tokens ``a b`` to aNb where ``merges`` (array of 'a b') has them."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("last"))

    def step(acc, t):
        hit = (acc["last"] != "") & F.array_contains(merges, F.concat(acc["last"], F.lit(" "), t))
        joined = F.struct(F.concat(acc["done"], F.array(F.concat(acc["last"], F.lit("N"), t))).alias("done"), F.lit("").alias("last"))
        moved = F.struct(F.when(acc["last"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["last"]))).alias("done"), t.alias("last"))
        return F.when(hit, joined).otherwise(moved)

    end = F.aggregate(tokens, start, step)
    return F.when(end["last"] == "", end["done"]).otherwise(F.concat(end["done"], F.array(end["last"])))
