"""Text rules as column expressions: brands, titles, identifiers, keys, model codes."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerweave.functions import lexicon as lx

#: Patterns see Unicode words, digits, white space and case.
U = "(?iuU)"
GREEK = r"[Ͱ-Ͽἀ-῿]"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` where ``value`` is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def replace_each(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Replace every match by what ``new`` makes of it."""
    def run(t: Column) -> Column:
        between, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        pairs = F.zip_with(between, F.transform(found, new), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.array_join(pairs, "")

    return once(text, run)


@cache
def _marks(categories: str) -> tuple[str, str]:
    """Characters that lose their marks, and what is left of them; deleted ones come last."""
    gone, old, new = [], [], []
    for code in range(0x80, 0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or 0xAC00 <= code < 0xD7A4:
            continue
        kept = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.category(x).startswith(categories)))
        if kept == "":
            gone.append(c)
        elif kept != c and len(kept) == 1:
            old.append(c)
            new.append(kept)
    return "".join(old + gone), "".join(new)


def strip_accents(text: Column) -> Column:
    """Without marks, final sigma as sigma; case is kept."""
    old, new = _marks("M")
    return F.translate(F.translate(text, old, new), "ς", "σ")


def lookup_key(text: Column) -> Column:
    """Upper case, Greek look-alikes as Latin, then only A-Z and 0-9."""
    return F.regexp_replace(_latin_capitals(text), "[^A-Z0-9]", "")


def _latin_capitals(text: Column) -> Column:
    return F.translate(F.upper(text), lx.GREEK_CAPITALS, lx.LATIN_CAPITALS)


def has_greek_left(text: Column) -> Column:
    """Whether Greek letters stay after look-alikes became Latin."""
    return _latin_capitals(text).rlike(GREEK)


def _aliases() -> Column:
    return F.create_map(*[F.lit(x) for pair in lx.BRAND_ALIASES.items() for x in pair])


def squeeze(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, rf"{U}\s+", " "), "^ | $", "")


def normalize_brand(vendor: Column) -> Column:
    """The known brand of a vendor's lookup key, else the key; empty if there is none."""
    return once(lookup_key(F.coalesce(vendor, F.lit(""))), lambda k: F.coalesce(F.try_element_at(_aliases(), k), k))


def normalize_units(text: Column) -> Column:
    """Storage as whole gb, screens as in, volumes as l or ml, decimal points."""
    storage = rf"{U}(\d+)\s*(tb|gb)"

    def in_gb(m: Column) -> Column:
        n = F.regexp_extract(m, storage, 1).try_cast("decimal(34,0)")
        big = F.lower(F.regexp_extract(m, storage, 2)) == "tb"
        return F.coalesce(F.concat(F.when(big, n * 1024).otherwise(n).cast("decimal(38,0)").cast("string"), F.lit("gb")), m)

    inch = r"""\s*(?:"|'{2}|″|inches|inch|in\b|ίντσες|ιντσών|ιντσες|ιντσων|ιντσεσ|ίντσεσ)"""
    # the beginnings of all that follows a number below
    begun = rf"""{U}\d\s*(?:"|'{{2}}|″|in|ίν|ιν|ml|l)"""

    def others(t: Column) -> Column:
        out = F.regexp_replace(t, rf"{U}(\d+)[.,](\d+){inch}", "$1.$2in")
        out = F.regexp_replace(out, rf"{U}(\d+){inch}", "$1in")
        out = replace_each(out, rf"{U}\d+(?:[.,]\d+)?\s*(?:ml|l)\b", lambda m: F.lower(F.regexp_replace(F.translate(m, ",", "."), rf"{U}\s+", "")))
        return F.when(t.rlike(begun), out).otherwise(t)

    return once(replace_each(text, storage, in_gb), others)


def _any_of(phrases: list[str]) -> str:
    """A pattern of any of the phrases, the first ones first; those of one first letter together, so that others are passed over at once."""
    by_first: dict[str, list[str]] = {}
    for p in phrases:
        by_first.setdefault(p[0], []).append(rf"\Q{p[1:]}\E")
    return "|".join(rf"\Q{first}\E(?:{'|'.join(rest)})" for first, rest in by_first.items())


def _without(text: Column, phrases: tuple[str, ...]) -> Column:
    """Without whole phrases: the longest first, equal lengths in order of their text."""
    ordered = sorted(set(phrases), key=lambda p: (-len(p), p))
    joined = [p for p in ordered if not p.isalnum()]
    whole = lambda some: rf"(?U)(?<!\w)(?:{_any_of(some)})(?!\w)"

    def run(t: Column) -> Column:
        out = t
        for _, same in groupby(ordered, key=len):
            out = F.regexp_replace(out, whole(list(same)), "")
        # most texts hold none; single words cannot overlap, so their order does not matter
        once_over = F.regexp_replace(t, whole(ordered), "")
        return F.when(~t.rlike(whole(ordered)), t).when(~t.rlike(_any_of(joined)), once_over).otherwise(out)

    return once(text, run)


def strip_color(text: Column) -> Column:
    return _without(text, lx.COLOURS)


def strip_noise(text: Column) -> Column:
    return _without(text, lx.NOISE)


def _aliases_by_brand() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for key, brand in lx.BRAND_ALIASES.items():
        if key not in lx.PRODUCT_LINES:
            out.setdefault(brand, []).append(key.lower())
    return out


def remove_brand(text: Column, brand: Column) -> Column:
    """Without the brand, its other spellings, and runs of words that spell its lookup key.

    Patterns that depend on the row are compiled for each one, so plain searches go first.
    """
    name, key = strip_accents(F.lower(brand)), lookup_key(brand)
    by_brand = _aliases_by_brand()
    spellings = F.try_element_at(F.create_map(*[x for b, keys in by_brand.items() for x in (F.lit(b), F.array(*map(F.lit, keys)))]), brand)
    whole = r"(?U)(?<!\w)(?:"
    pattern = F.concat(F.lit(whole), F.array_join(spellings, "|"), F.lit(r")(?!\w)"))
    run = r"(?U)(?<!\w)\w+(?:[-\s]\w+)*(?!\w)"
    spelled = lambda m: F.upper(F.regexp_replace(m, "[^A-Za-z0-9]", ""))

    def plain(t: Column) -> Column:
        return F.when(F.contains(t, name), F.regexp_replace(t, F.concat(F.lit(r"(?U)(?<!\w)\Q"), name, F.lit(r"\E(?!\w)")), F.lit(""))).otherwise(t)

    def aliases(t: Column) -> Column:
        return F.when(F.exists(spellings, lambda a: F.contains(t, a)), F.regexp_replace(t, pattern, F.lit(""))).otherwise(t)

    def runs(t: Column) -> Column:
        return once(key, lambda k: F.when(F.contains(spelled(t), k), replace_each(t, run, lambda m: F.when(spelled(m) == k, F.lit("")).otherwise(m))).otherwise(t))

    return once(once(once(text, plain), aliases), runs)


def normalize_title(title: Column, brand: Column | None = None) -> Column:
    """Lower case without accents, brand, colours, shop words and marks; units made alike."""
    text = normalize_units(strip_accents(F.lower(F.coalesce(title, F.lit("")))))
    if brand is not None:
        plain = text
        text = F.when(F.coalesce(brand, F.lit("")) == "", plain).otherwise(once(plain, lambda t: remove_brand(t, brand)))
    text = strip_noise(strip_color(text))
    return squeeze(F.regexp_replace(text, r"(?U)[^\w\s.]", " "))


def normalize_identifier(value: Column) -> Column:
    return F.upper(squeeze(F.coalesce(value, F.lit(""))))


def clean_ean(value: Column) -> Column:
    """The digits, if there are 8 or 13."""
    digits = F.regexp_replace(value, r"(?U)\D", "")
    return F.when(F.length(digits).isin(8, 13), digits)


def title_hash(title: Column) -> Column:
    return F.substring(F.sha1(F.encode(title, "UTF-8")), 1, 12)


def _filled(value: Column) -> Column:
    return F.when(value != "", value)


def ean_key(ean: Column) -> Column:
    return F.concat(F.lit("ean:"), clean_ean(ean))


def brand_key(kind: str, brand: Column, identifier: Column) -> Column:
    """``kind:brand:identifier``; null if either is missing."""
    return F.concat(F.lit(kind + ":"), once(F.lower(normalize_brand(brand)), _filled), F.lit(":"), once(normalize_identifier(identifier), _filled))


def title_key(brand: Column, category: Column, title_norm: Column) -> Column:
    """``title:brand:category:hash``; null if any is missing."""
    return F.concat(F.lit("title:"), _filled(F.lower(brand)), F.lit(":"), _filled(category), F.lit(":"), title_hash(_filled(title_norm)))


def model_codes(text: Column) -> Column:
    """Tokens that look like model codes: letters and digits, four or more, no Greek, no quantity."""
    joined = F.regexp_replace(strip_accents(F.lower(F.coalesce(text, F.lit("")))), "([a-z0-9])[-/]([a-z0-9])", "$1$2")
    unit = rf"^\d+({'|'.join(lx.UNIT_SUFFIXES)})$"
    good = lambda t: t.rlike(r"\p{Nd}") & t.rlike(r"^[\p{L}\p{N}]{4,}$") & ~t.rlike(r"[Ͱ-Ͽ]") & t.rlike(r"\p{L}") & ~t.rlike(unit)
    return F.array_distinct(F.filter(F.split(joined, r"(?U)\s+"), good))


def is_spec_code(code: Column) -> Column:
    return code.rlike("(?i)^(?:" + "|".join(lx.SPEC_PATTERNS) + ")")


def is_series_suffix(code: Column) -> Column:
    return code.rlike(lx.SERIES_SUFFIX)


def is_eligible_code(code: Column) -> Column:
    return ~is_spec_code(code) & ~is_series_suffix(code)


def brand_from_title(title: Column) -> Column:
    """The brand of the first word that spells a known one."""
    def first(text: Column) -> Column:
        words = F.split(text, r"(?U)\s+")
        latin = F.when(has_greek_left(text), F.filter(words, lambda w: ~has_greek_left(w))).otherwise(words)
        brands = F.filter(F.transform(F.transform(latin, lookup_key), lambda k: F.try_element_at(_aliases(), k)), lambda b: b.isNotNull())
        return F.get(brands, F.lit(0))

    return once(strip_accents(F.lower(title)), first)


def suspicious_brand(brand: Column, from_title: Column) -> Column:
    """No brand, or an unknown one while the title names another."""
    known = F.lower(brand).isin(sorted({b.lower() for b in lx.BRAND_ALIASES.values()}))
    empty = F.trim(F.coalesce(brand, F.lit(""))) == ""
    return empty | (~known & F.coalesce(F.lower(from_title) != F.lower(brand), F.lit(False)))


def fingerprint(label: Column) -> Column:
    """Letters and digits only, without accents, Greek as Latin."""
    old, new = _marks("Mn")
    text = F.lower(F.translate(label, old, new))
    for greek, latin in lx.GREEK_PAIRS.items():
        text = F.replace(text, F.lit(greek), F.lit(latin))
    return F.regexp_replace(F.translate(text, lx.GREEK_LETTERS, lx.LATIN_LETTERS), r"[^\p{L}\p{N}]", "")


def language(title: Column) -> Column:
    return F.when(title.rlike(GREEK), "EL").otherwise("EN")


def percent(part: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit("0.0%")).otherwise(F.format_string("%.1f%%", part * 100.0 / F.when(total != 0, total)))


def spaced_codes(title: Column, codes: Column) -> Column:
    """Letter groups followed by a code part after a space, joined, that are not among ``codes``."""
    pattern = r"\b([A-Za-z]{2,5})\s+([A-Za-z0-9]{3,})\b"
    a, b = (F.regexp_extract_all(title, F.lit(pattern), F.lit(i)) for i in (1, 2))
    pairs = F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["b"].rlike("[0-9]"))
    return F.filter(F.transform(pairs, lambda p: F.lower(F.concat(p["a"], p["b"]))), lambda c: ~F.array_contains(codes, c))
