"""Scalar text functions of the normaliser as Columns.

Built-in expressions wherever they say the same; Arrow functions for NFKC with full
case folding, accent folding, script names and the six-place phonetic key, which no
built-in gives.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import rules as R


def _mapped(series: pd.Series, fn) -> pd.Series:
    """fn over the distinct values of a batch."""
    codes, values = pd.factorize(series)
    out = pd.Series([fn(v) for v in values], dtype=object)
    return pd.Series([None if c < 0 else out[c] for c in codes], dtype=object)


@F.pandas_udf(StringType())
def _nfkc(series: pd.Series) -> pd.Series:
    return _mapped(series, lambda v: unicodedata.normalize("NFKC", v).casefold())


@F.pandas_udf(StringType())
def _unaccent(series: pd.Series) -> pd.Series:
    return _mapped(series, lambda v: "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


def _script(text: str) -> str:
    return " ".join(sorted({unicodedata.name(c, "").split(" ")[0].lower() for c in set(text) if c.isalpha()} - {""}))


@F.pandas_udf(StringType())
def _scripts(series: pd.Series) -> pd.Series:
    return _mapped(series, _script)


_SOUND = {c: d for d, letters in zip("123456", ("bfpv", "cgjkqsxz", "dt", "l", "mn", "r")) for c in letters}


def phonetic(text: str) -> str:
    """A sound key of four to six places: first letter, then sound groups; vowels part
    equal groups, h and w do not."""
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold())
    letters = [c for c in plain if c.isalpha() and not unicodedata.combining(c)]
    if not letters:
        return ""
    out, last = letters[0].upper(), _SOUND.get(letters[0])
    for c in letters[1:]:
        group = _SOUND.get(c)
        if group and group != last:
            out += group
        if c not in "hw":
            last = group
    return out.ljust(4, "0")[:6]


@F.pandas_udf(StringType())
def _phonetic(series: pd.Series) -> pd.Series:
    return _mapped(series, phonetic)


def nfkc_casefold(c: Column) -> Column:
    return _nfkc(F.coalesce(c, F.lit("")))


def fold_ascii(c: Column) -> Column:
    return _unaccent(F.coalesce(c, F.lit("")))


def scripts(c: Column) -> Column:
    """Names of the scripts of its letters, parted by spaces."""
    return _scripts(F.coalesce(c, F.lit("")))


def script_flag(c: Column) -> Column:
    return script_of(scripts(c))


def script_of(*found: Column) -> Column:
    """none, latin, mixed (latin and others) or the first of the others; found: scripts() of the parts of a record."""
    names = tokens(F.concat_ws(" ", *found))
    latin = F.array_contains(names, "latin")
    others = F.array_min(F.filter(names, lambda n: n != "latin"))
    return F.when(latin & others.isNotNull(), "mixed").when(latin, "latin").otherwise(F.coalesce(others, F.lit("none")))


def phonetic_key(c: Column) -> Column:
    return _phonetic(F.coalesce(c, F.lit("")))


def has_non_ascii(c: Column) -> Column:
    return c.rlike(r"[^\x00-\x7F]")


def one_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def plain(c: Column) -> Column:
    """What follows case folding: punctuation made ASCII, ampersands spelled out, commas
    and full stops and all else but letters, digits, marks, ' / # - made spaces."""
    t = F.translate(c, R.PUNCT_FROM, R.PUNCT_TO)
    t = F.regexp_replace(t, r"(?U)\s*&\s*", " and ")
    t = F.translate(t, R.ZERO_WIDTH, "")
    return one_space(F.regexp_replace(t, r"[^\p{L}\p{N}\p{Mn}\p{Mc}\s'/#-]", " "))


def normalise_name(folded: Column) -> Column:
    return plain(folded)


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def _replaced(array: Column, mapping: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.transform(array, lambda t: F.coalesce(F.try_element_at(m, t), t))


def normalise_address(folded: Column) -> Column:
    return F.array_join(_replaced(tokens(plain(folded)), R.STREETS), " ")


def name_tokens(core: Column) -> Column:
    return _replaced(tokens(core), R.VARIANTS)


def _loose(suffix: str) -> str:
    return r"\.?[\s\-]+".join(re.escape(w) for w in suffix.split(" "))


SUFFIX_PATTERN = r"(?:^|[\s\-])(" + "|".join(_loose(s) for s in R.ALL_SUFFIXES) + r")\.?(?=[\s\-]|$)"


def legal_suffixes(name: Column) -> Column:
    """Sorted distinct suffixes in a normalised name."""
    found = F.regexp_extract_all(name, F.lit(SUFFIX_PATTERN), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.regexp_replace(s, r"[\s\-.]+", " "))))


def strip_suffixes(name: Column, suffixes: Column) -> Column:
    """The name without a leading m/s and without the suffixes, longest first; a removal
    that would leave nothing is not made."""
    start = F.regexp_replace(name, rf"^{R.PREFIX}\s+", "")
    order = F.array_sort(F.transform(suffixes, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s"))))

    def drop(acc, x):
        words = F.replace(x["s"], F.lit(" "), F.lit(r"\.?[\s\-]+"))
        gone = one_space(F.regexp_replace(acc, F.concat(F.lit(r"(?:^|[\s\-])"), words, F.lit(r"\.?(?=[\s\-]|$)")), F.lit(" ")))
        return F.when(gone == "", acc).otherwise(gone)

    return F.aggregate(order, start, drop)


def suffix_countries(suffixes: Column) -> Column:
    m = F.create_map(*[x for s, c in R.SUFFIX_COUNTRIES.items() for x in (F.lit(s), F.array(*map(F.lit, c)))])
    return F.array_sort(F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(m, s), F.array().cast("array<string>"))))))


def _first(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def postcode(addr: Column, country: Column) -> Column:
    """First digits of a postcode's shape; the country label says which shape is tried first."""
    india, usa, france = _first(addr, r"(?U)\b(\d{6})\b"), _first(addr, r"(?U)\b(\d{5})(?:-\d{4})?\b"), _first(addr, r"(?iU)\b(\d{5})\b(?:\s*cedex\b)?")
    label = F.lower(F.trim(F.coalesce(country, F.lit(""))))
    return F.when(label.isin(R.USA), F.coalesce(usa, india, france)).when(label.isin(R.FRANCE), F.coalesce(france, usa, india)).otherwise(F.coalesce(india, usa, france))


def numbers(addr: Column) -> Column:
    """struct(house_number, units, all_numbers, has_cedex)."""
    words = "|".join(R.UNIT_WORDS)
    units = F.concat(
        F.regexp_extract_all(addr, F.lit(rf"(?iU)\b(?:{words})\b\.?\s*([0-9]+[a-z]?|[a-z]-?[0-9]+)"), F.lit(1)),
        F.regexp_extract_all(addr, F.lit(r"#\s*([0-9]+[a-z]?)"), F.lit(1)),
    )
    found = F.regexp_extract_all(addr, F.lit(r"(?U)\b(\d+[a-z]?(?:/\d+[a-z]?)?)\b"), F.lit(1))
    house = F.get(F.filter(found, lambda n: ~F.array_contains(units, n)), F.lit(0))
    return F.struct(house.alias("house_number"), units.alias("units"), found.alias("all_numbers"), addr.rlike(r"(?iU)\bcedex\b").alias("has_cedex"))


def landmark(addr: Column) -> Column:
    padded = F.concat(F.lit(" "), addr, F.lit(" "))
    out = F.lit(False)
    for phrase in R.LANDMARKS:
        out = out | padded.contains(f" {phrase} ")
    return out


def placeholder(folded: Column, extra: list[str] | None = None) -> Column:
    """folded: NFKC and case-folded.  Also texts without a letter or digit, and zeros only."""
    v = one_space(folded)
    return v.isin(R.PLACEHOLDERS + list(extra or [])) | ~v.rlike(r"[\p{L}\p{N}]") | v.rlike("^0+$")


def edge_trimmed_tokens(c: Column) -> Column:
    """Words without marks at their edges, lower-cased."""
    marks = ".,;:!?()[]{}\"'"
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda t: F.lower(F.btrim(t, F.lit(marks)))), lambda t: t != "")


def char_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """For each word between single spaces: all grams of low to high characters, a word
    no longer than a gram once."""
    def of_word(word):
        w = F.concat(F.lit(" "), word, F.lit(" "))
        n = F.length(w)
        parts = []
        for k in range(low, high + 1):
            own = _grams(w, n, k)
            # a word no longer than k was given whole by the first k that reached its length
            parts.append(F.when(n > k, own).when((n <= k) & ((n > k - 1) | F.lit(k == low)), F.array(w)).otherwise(F.array().cast("array<string>")))
        return F.concat(*parts)

    return F.flatten(F.transform(tokens(one_space(c)), of_word))


def _grams(w: Column, n: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.substring(w, i, F.lit(k)))
