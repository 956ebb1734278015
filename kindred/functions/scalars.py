"""Scalar text functions, each ``Column -> Column``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred import constants as K

# Everything Python's str.split() treats as a space.
SPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_array(values: Iterable[str]) -> Column:
    """A constant array, parsed as one expression instead of one call per entry."""
    return F.expr(f"cast(array({', '.join(map(_sql_string, values))}) as array<string>)")


def collapse_spaces(text: Column) -> Column:
    """Runs of white space become one blank; both ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def first_category(text: Column, names: Sequence[str]) -> Column:
    """First vocabulary entry contained in ``text``, else the string ``None``."""
    return F.coalesce(
        *[F.when(F.contains(text, F.lit(n)), F.lit(n)) for n in names], F.lit("None")
    )


def contains_flag(text: Column, part: str) -> Column:
    return F.contains(text, F.lit(part)).cast("int")


def split_lines(text: Column, separator: str = ",  ") -> Column:
    """Ingredient lines: a comma and two blanks separate them."""
    return F.split(text, separator, -1)


def time_to_minutes(text: Column, strict: bool = False, lenient: bool = False) -> Column:
    """``"1 hr 30 mins"`` -> 90.

    Both parts are needed, hours 0-23 and minutes 0-59. Anything else gives NULL,
    an error when ``strict``, and is read part by part when ``lenient``.
    """
    hours, minutes = r"([01]?[0-9]|2[0-3])(?: hrs?|[Hh])", r"([0-5]?[0-9])(?: mins?|[Mm])"

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("int")

    both = rf"^{hours}{SPACE}+{minutes}\z"
    parsed = part(both, 1) * 60 + part(both, 2)
    if lenient:
        parsed = F.coalesce(parsed, part(rf"^{hours}\z", 1) * 60, part(rf"^{minutes}\z", 1))
    if strict:
        failed = F.raise_error(F.concat(F.lit("not a duration: "), F.coalesce(text, F.lit("NULL"))))
        parsed = F.coalesce(parsed, failed.cast("int"))
    return parsed


def unreadable_time(text: Column) -> Column:
    """Whether a duration is there but gives no minutes; its sum counts the rows lost to that."""
    return F.coalesce(text.isNotNull() & time_to_minutes(text).isNull(), F.lit(False))


def max_minutes(hours: Column | int, minutes: Column | int) -> Column | int:
    """Time limit in minutes from an hour and a minute field."""
    return hours * 60 + minutes


def set_to_text(tokens: Column) -> Column:
    return F.array_join(F.sort_array(tokens), ",")


def text_to_set(text: Column) -> Column:
    """Inverse of :func:`set_to_text`; NULL and ``""`` are the empty set."""
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (text == ""), empty).otherwise(F.split(text, ",", -1))


def singular(word: Column, exceptions: Mapping[str, str] | None = None) -> Column:
    """Singular form of one word by ordered suffix rules, letter case kept."""
    table = K.NOUN_EXCEPTIONS if exceptions is None else exceptions

    def drop(pattern: str, instead: str = "") -> Column:
        return F.regexp_replace(word, pattern, instead)

    def ends(pattern: str) -> Column:
        return F.rlike(word, F.lit(pattern))

    lower = F.lower(word)
    rules = (
        F.when(ends("(?i)[^aeiou]ies$"), drop("(?i)ies$", "y"))
        .when(ends("(?i)(ch|sh|ss|x|zz|o)es$"), drop("(?i)es$"))
        .when(ends("(?i)(ss|us|is)$"), word)
        .when(ends("(?i)..s$"), drop("(?i)s$"))
        .otherwise(word)
    )
    out = F.when(F.endswith(lower, F.lit("s")), rules).otherwise(word)
    if not table:
        return out
    pairs = ", ".join(_sql_string(x) for pair in table.items() for x in pair)
    known = F.try_element_at(F.expr(f"map({pairs})"), lower)
    # The exception keeps its own letters, whole; only the case of the first one follows the word.
    raised = F.concat(F.upper(F.substring(known, 1, 1)), F.substr(known, F.lit(2)))
    exception = F.when(F.substring(word, 1, 1) != F.substring(lower, 1, 1), raised).otherwise(known)
    return F.when(lower.isin(*table), exception).otherwise(out)


# ---------------------------------------------------------------- categories


def normalize_categories(text: Column, exceptions: Mapping[str, str] | None = None) -> Column:
    """Split on commas and ``and``, drop the text ``Recipes``, make words singular."""
    parts = F.split(collapse_spaces(text), " *, *| +and +", -1)
    cleaned = F.transform(parts, lambda p: F.trim(F.replace(p, F.lit("Recipes"), F.lit(""))))
    kept = F.filter(cleaned, lambda p: p != "")

    def singular_words(part: Column) -> Column:
        words = F.transform(F.split(part, " +", -1), lambda w: singular(w, exceptions))
        return F.array_join(words, " ")

    return F.array_distinct(F.transform(kept, singular_words))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v)).getItem(0)


def drop_combined(categories: Column) -> Column:
    """Drop ``"a b"`` when ``a`` and ``b`` are other members of the same set.

    Each element is cut at each of its blanks, so the work grows with the words
    and not with the pairs of the set.
    """

    def is_combined(element: Column, members: Column) -> Column:
        blanks = F.length(element) - F.length(F.replace(element, F.lit(" "), F.lit("")))

        def cut_matches(i: Column) -> Column:
            left = F.call_function("substring_index", element, F.lit(" "), i)
            right = F.call_function("substring_index", element, F.lit(" "), i - blanks - 1)
            both = F.array_contains(members, left) & F.array_contains(members, right)
            return both & (left != right)

        return F.when(blanks > 0, F.exists(F.sequence(F.lit(1), blanks), cut_matches)).otherwise(F.lit(False))

    def kept(members: Column) -> Column:
        return F.filter(members, lambda e: ~is_combined(e, members))

    return _let(categories, kept)


def split_by_vocabulary(categories: Column, vocabulary: Sequence[str] = K.CATEGORIES) -> Column:
    """Cut elements at vocabulary entries, keep matches and remainders, join sorted."""
    escaped = [reduce(lambda s, ch: s.replace(ch, "\\" + ch), r".^$*+?()[]{}|", v.replace("\\", r"\\"))
               for v in vocabulary]
    pattern = r"(?U)\b(?:" + "|".join(escaped) + r")\b"

    def pieces(element: Column) -> Column:
        found = F.regexp_extract_all(element, F.lit(pattern), F.lit(0))
        rest = F.transform(F.split(element, pattern, -1), lambda p: F.trim(p))
        return F.when(F.size(found) == 0, F.array(element)).otherwise(
            F.concat(found, F.filter(rest, lambda p: p != ""))
        )

    parts = F.array_distinct(F.flatten(F.transform(categories, pieces)))
    return F.array_join(F.sort_array(parts), ", ")


def clean_categories(text: Column, vocabulary: Sequence[str] = K.CATEGORIES) -> Column:
    """The whole clean-up: normalise, drop combined names, cut by the vocabulary."""
    return split_by_vocabulary(drop_combined(normalize_categories(text)), vocabulary)
