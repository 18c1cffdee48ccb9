"""Term extraction and chunk text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WORD = r"[\p{L}\p{N}_]"
# --- Fixed values: the non-ASCII characters that fold to an ASCII letter ------
# dotted capital I, dotless i, long s, Kelvin sign
ASCII_LIKE = "\u0130\u0131\u017f\u212a"
ASCII_MEANT = "iisk"
# ------------------------------------------------------------------------------


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def term_pattern(term: str) -> str:
    """Case-insensitive pattern for ``term`` as a whole word.

    A word boundary lies where a word character meets a non-word one, so which
    neighbour is allowed depends on the term's own first and last character.
    Letters and digits of every script count as word characters.
    """
    before = rf"(?<!{_WORD})" if _is_word(term[0]) else rf"(?<={_WORD})"
    after = rf"(?!{_WORD})" if _is_word(term[-1]) else rf"(?={_WORD})"
    return rf"(?iu){before}\Q{term}\E{after}"


def folded(text: Column) -> Column:
    """Text in lower case, with every character that case-insensitive matching
    takes for an ASCII letter replaced by that letter."""
    odd = reduce(lambda a, b: a | b, [text.contains(F.lit(char)) for char in ASCII_LIKE])
    return F.lower(F.when(odd, F.translate(text, ASCII_LIKE, ASCII_MEANT)).otherwise(text))


def _ends(term: str) -> str:
    return rf"(?!{_WORD})" if _is_word(term[-1]) else rf"(?={_WORD})"


def _trie(terms: Sequence[str], depth: int = 0) -> str:
    """Pattern of the longest of some terms with a common beginning of ``depth`` characters."""
    by_next: dict[str, list[str]] = {}
    for term in terms:
        if len(term) > depth:
            by_next.setdefault(term[depth], []).append(term)
    ways = [rf"\Q{char}\E{_trie(own, depth + 1)}" for char, own in sorted(by_next.items())]
    ways += [_ends(term) for term in terms if len(term) == depth]
    return f"(?:{'|'.join(ways)})" if len(ways) > 1 else ways[0]


def terms_pattern(terms: Sequence[str]) -> str:
    """Pattern that captures, wherever one of the lower-case ``terms`` begins as a whole
    word, the longest one that ends as one there. It consumes nothing, so terms that
    lap over each other are all found; a trie makes a place cost one look, however
    many terms there are."""
    ways = []
    for word in (True, False):
        own = sorted({term for term in terms if _is_word(term[0]) is word})
        if own:
            first = "".join(sorted({rf"\Q{term[0]}\E" for term in own}))
            ways.append(rf"(?=[{first}]){'(?<!' if word else '(?<='}{_WORD})({_trie(own)})")
    return rf"(?=(?:{'|'.join(ways)}))"


def _choose(found: Column, terms: Sequence[str], others: Sequence[str]) -> Column:
    """First of ``terms`` that is found; ``others`` are all terms that were looked for."""
    cases = []
    for term in terms:
        low = term.lower()
        # A longer term that begins with this one as a whole word was captured in its place.
        longer = [o for o in others if o.startswith(low) and o != low and _is_word(o[len(low)]) != _is_word(low[-1])]
        cases.append(F.when(F.arrays_overlap(found, F.array(*map(F.lit, [low, *longer]))), F.lit(term)))
    return F.coalesce(*cases)


def _found(text: Column, terms: Sequence[str]) -> Column:
    """The terms, in lower case, that a text holds, but for those that :func:`_choose` adds."""
    plain = sorted({term.lower() for term in terms if term.isascii()})
    parts = []
    if plain:
        whole = folded(text)
        for group in (1, 2)[: 1 + (len({_is_word(term[0]) for term in plain}) > 1)]:
            parts.append(F.array_distinct(F.regexp_extract_all(whole, F.lit(terms_pattern(plain)), F.lit(group))))
    # Lower case alone does not say which other letters are the same.
    rest = [F.when(text.rlike(term_pattern(term)), F.lit(term.lower())) for term in terms if not term.isascii()]
    if rest:
        parts.append(F.array_compact(F.array(*rest)))
    return F.coalesce(F.concat(*parts), F.array().cast("array<string>"))


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """First term of the list, in list order, found as a whole word; else null."""
    plain = [term.lower() for term in terms if term.isascii()]
    return F.transform(F.array(_found(text, terms)), lambda found: _choose(found, terms, plain))[0]


def extract_terms(text: Column, vocabulary: Mapping[str, Sequence[str]]) -> Column:
    """Map of field to found term; fields without one are absent.

    The text is folded once and looked through once for the terms of all fields;
    bound to a name in an array of one, what was found is not computed again for
    every term.
    """
    terms = [term for own in vocabulary.values() for term in own]
    plain = [term.lower() for term in terms if term.isascii()]

    def chosen(found: Column) -> Column:
        entries = [
            F.struct(F.lit(field).alias("key"), _choose(found, own, plain).alias("value"))
            for field, own in vocabulary.items()
            if own
        ]
        return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))

    if not terms:
        return F.create_map().cast("map<string,string>")
    return F.transform(F.array(_found(text, terms)), chosen)[0]


def _with_exponent(text: Column) -> Column:
    """``-1.25E-5`` as ``-1.25e-05``; plain digits from 1e-4 up to below 1e16."""
    sign = F.when(text.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(text, "E", 1), "[-.]", ""), "0+$", "")
    power = F.substring_index(text, "E", -1).cast("int")
    rest = F.substr(digits, F.lit(2))
    large = F.concat(
        F.rpad(F.substr(digits, F.lit(1), power + 1), power + 1, F.lit("0")),
        F.lit("."),
        F.when(F.length(digits) > power + 1, F.substr(digits, power + 2)).otherwise("0"),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    size = F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0"))
    scientific = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""),
        F.when(power < 0, "e-").otherwise("e+"),
        size,
    )
    plain = F.when(power.between(0, 15), large).when(power.between(-4, -1), small)
    return F.concat(sign, F.coalesce(plain, scientific))


def number_text(column: Column) -> Column:
    """A double's digits: ``0.0005``, ``12345678.0``, ``1e-05``, ``nan``, ``inf``."""
    printed = column.cast("double").cast("string")
    rare = F.transform(
        # Bound to a name, so that the number is printed once.
        F.array(printed),
        lambda text: F.when(text.contains("E"), _with_exponent(text))
        .when(text == "NaN", "nan")
        .otherwise(F.replace(text, F.lit("Infinity"), F.lit("inf"))),
    )[0]
    # Plain digits, as most numbers are, need none of these steps.
    return F.when(printed.contains("E") | printed.contains("N") | printed.contains("I"), rare).otherwise(printed)


def display(column: Column, kind: T.DataType) -> Column:
    """Text of a value in a chunk: ``None``, ``True``/``False``, digits, ``[a, b]``.

    Single-precision numbers print the digits of the same number as a double.
    """
    if isinstance(kind, T.BooleanType):
        text = F.when(column, "True").when(~column, "False")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        text = number_text(column)
    elif isinstance(kind, T.ArrayType):
        items = F.transform(column, lambda v: display(v, kind.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("None"))


def quoted(text: Column) -> Column:
    """Text in quotes with backslashes and control characters escaped.

    Single quotes, unless the text holds one and no double quote.
    """
    plain = text
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(raw), F.lit(shown))
    has_single, has_double = text.contains("'"), text.contains('"')
    return F.when(
        has_single & ~has_double, F.concat(F.lit('"'), plain, F.lit('"'))
    ).otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))
