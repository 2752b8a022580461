"""Text parsing and normalising as Catalyst expressions.

Case folding is by A-Z where SQLite's is, patterns are case-insensitive in
Unicode where Python's are, and unreadable numbers are null, never an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions import fixed


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def first_hit(text: Column, table: Sequence[tuple[str, str]], otherwise: Column) -> Column:
    """The value of the first entry whose key is in the text."""
    return reduce(lambda rest, kv: F.when(F.contains(text, F.lit(kv[0])), F.lit(kv[1])).otherwise(rest), reversed(table), otherwise)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def falsy(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def _md5_16(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, 16)


def name_builder(name: Column) -> Column:
    low = strip(F.lower(name))
    return first_hit(low, fixed.BUILDER_NAMES, F.replace(low, F.lit(" "), F.lit("_")))


def name_dedup(name: Column) -> Column:
    low = strip(F.lower(name))
    for key, value in fixed.DEDUP_NAMES:
        low = F.replace(low, F.lit(key), F.lit(value))
    return strip(F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}\s]", ""), r"\s+", " "))


def name_matched(name: Column) -> Column:
    """The first known word in place of the whole name, without punctuation."""
    low = F.lower(name)
    plain = first_hit(low, fixed.DEDUP_NAMES, low)
    return strip(F.regexp_replace(F.regexp_replace(plain, r"[^\p{L}\p{N}\s]", ""), r"\s+", " "))


def name_simple(name: Column) -> Column:
    low = strip(F.lower(name))
    return first_hit(low, fixed.SIMPLE_NAMES, low)


def is_fruit(name: Column) -> Column:
    return contains_any(name_simple(name), fixed.FRUITS)


def weight_norm(weight: Column) -> Column:
    low = F.replace(F.lower(weight), F.lit(" "), F.lit(""))
    n = F.regexp_extract(low, r"(\d+)", 1)
    return (
        F.when(F.contains(low, F.lit("stk")), F.concat(F.when(n == "", "1").otherwise(n), F.lit("pcs")))
        .when(F.contains(low, F.lit("kg")), F.replace(low, F.lit("ikg"), F.lit("1kg")))
        .otherwise(low)
    )


def signature_builder(brand: Column, name: Column, weight: Column) -> Column:
    return _md5_16(strip(F.lower(F.coalesce(brand, F.lit("")))), name_builder(name), weight_norm(F.coalesce(weight, F.lit(""))))


def signature_simple(brand: Column, name: Column, weight: Column) -> Column:
    return _md5_16(*[strip(F.lower(F.coalesce(c, F.lit("")))) for c in (brand, name, weight)])


def signature_dedup(brand: Column, name: Column, weight: Column) -> Column:
    """Unhashed; a null reads "none"."""
    low = lambda c: strip(F.lower(F.coalesce(c, F.lit("None"))))
    return F.concat_ws("_", low(brand), name_dedup(F.coalesce(name, F.lit(""))), low(weight))


def signature_worker(name: Column, brand: Column) -> Column:
    return F.md5(F.concat_ws("|", strip(F.lower(name)), strip(F.lower(F.coalesce(brand, F.lit(""))))))


def signature_api(brand: Column, name: Column, weight: Column) -> Column:
    return _md5_16(F.coalesce(brand, F.lit("generic")), F.coalesce(name, F.lit("None")), F.coalesce(weight, F.lit("None")))


def request_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, 16)


def price(text: Column) -> Column:
    """A price text as a number, else null."""
    plain = F.replace(strip(F.regexp_replace(text, "[€$]", "")), F.lit(","), F.lit("."))
    return F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), plain.try_cast("double"))


def price_or_zero(text: Column) -> Column:
    return F.coalesce(price(text), F.lit(0.0))


def price_amount(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.replace(text, F.lit(","), F.lit(".")), r"\d+[.,]?\d*", 0), F.lit("")).try_cast("double")


def price_currency(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("€")), "EUR").when(F.contains(text, F.lit("$")), "USD").otherwise("")


def price_in_text(text: Column) -> Column:
    """Struct(amount, currency) by the first pattern that is met."""
    out = F.lit(None).cast("struct<amount:double,currency:string>")
    for pattern, currency in reversed(fixed.PRICE_PATTERNS):
        got = F.regexp_extract(text, pattern, 1)
        out = F.when(got != "", F.struct(F.replace(got, F.lit(","), F.lit(".")).try_cast("double").alias("amount"), F.lit(currency).alias("currency"))).otherwise(out)
    return out


def base_price(text: Column) -> Column:
    left = strip(F.split_part(text, F.lit(" / "), F.lit(1)))
    number = F.regexp_extract(text, r"(\d+[.,]\d{2})", 1)
    return (
        F.when(F.contains(text, F.lit(" / ")), F.when(F.contains(left, F.lit("€")), left).otherwise(F.concat(left, F.lit(" €"))))
        .when(number != "", F.concat(number, F.lit(" €")))
        .otherwise(F.lit(""))
    )


def eur(text: Column) -> Column:
    """As "X,YY €"; decimals are added only where there are none."""
    number = F.replace(F.regexp_extract(text, r"\d+(?:[.,]\d+)?", 0), F.lit("."), F.lit(","))
    return F.when(number == "", "").otherwise(F.concat(number, F.when(F.contains(number, F.lit(",")), "").otherwise(",00"), F.lit(" €")))


WEIGHT = r"(\d+(?:[.,]\d+)?)\s*(kg|g|ml|l|stk|stück)"


def weight_in_text(text: Column) -> Column:
    low = F.lower(text)
    return F.concat(F.regexp_extract(low, WEIGHT, 1), F.regexp_extract(low, WEIGHT, 2))


def largest_weight(text: Column) -> Column:
    """Of all weights in the text the one with the largest number, the first of equals."""
    found = F.regexp_extract_all(F.lower(text), F.lit(WEIGHT), 0)
    number = lambda x: F.replace(F.regexp_extract(x, r"\d+(?:[.,]\d+)?", 0), F.lit(","), F.lit(".")).try_cast("double")
    marked = F.transform(found, lambda x, i: F.struct(number(x).alias("n"), (-i).alias("i"), x.alias("x")))
    return F.coalesce(F.array_max(marked)["x"], F.lit(""))


def is_bio(text: Column) -> Column:
    return contains_any(F.lower(text), fixed.BIO_WORDS)


def unit(text: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in fixed.UNITS for x in kv])
    return F.try_element_at(table, strip(text))


def brand(text: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in fixed.BRANDS for x in kv])
    return F.coalesce(F.try_element_at(table, strip(F.lower(text))), strip(text))


def brand_variant(text: Column) -> Column:
    return first_hit(F.lower(text), fixed.BRAND_VARIANTS, strip(text))


def category(text: Column) -> Column:
    low, out = F.lower(text), F.lit(None).cast("string")
    for name, words in reversed(fixed.CATEGORY_WORDS):
        out = F.when(contains_any(low, words), F.lit(name)).otherwise(out)
    return out


def allergens_german(text: Column) -> Column:
    words = F.array(*[F.lit(w) for w in fixed.ALLERGENS_DE])
    return F.transform(F.filter(words, lambda w: F.contains(F.lower(text), w)), lambda w: F.initcap(w))


def allergen_groups(text: Column) -> Column:
    return F.filter(
        F.array(*[F.when(contains_any(F.lower(text), words), F.lit(group)) for group, words in fixed.ALLERGENS_EN]), lambda x: x.isNotNull()
    )


def nutrient(text: Column, name: str) -> Column:
    """The first pattern's value that lies in its range."""
    patterns, low, high = fixed.NUTRITION[name]
    got = [F.nullif(F.regexp_extract(F.lower(text), p, 1), F.lit("")).try_cast("double") for p in patterns]
    return F.coalesce(*[F.when(g.between(low, high), g) for g in got])


def ingredients(text: Column) -> Column:
    found = F.regexp_extract(F.lower(text), r"ingredients?[:\s]([^.;]+)", 1)
    return F.slice(F.filter(F.transform(F.split(found, "[,;]"), strip), lambda x: x != ""), 1, 8)


def html_text(html: Column, most: int = 3000) -> Column:
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"(?s)<[^>]+>", " ")
    return F.substring(F.trim(F.regexp_replace(bare, r"\s+", " ")), 1, most)


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"(?s)<[^>]+>", ""))


def html_images(html: Column, base: Column, most: int = 5) -> Column:
    """Absolute URLs of images that do not look like page furniture."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)<img[^>]+src=["']([^"']+)["']"""), 1)
    host = F.regexp_extract(base, r"^https?://[^/]+", 0)
    whole = F.transform(
        found,
        lambda u: F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).when(u.startswith("/"), F.concat(host, u)).otherwise(u),
    )
    return F.slice(F.filter(whole, lambda u: ~F.lower(u).rlike("|".join(fixed.IMAGE_SKIP_WORDS)) & u.startswith("http")), 1, most)


def file_name(text: Column) -> Column:
    clean = F.substring(F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\w]", "_"), "_+", "_"), F.lit("_")), 1, 50)
    return F.when(clean == "", "unnamed").otherwise(clean)


def search_term(brand_: Column, name: Column) -> Column:
    low = F.lower(name)
    joined = F.when(F.coalesce(brand_, F.lit("")) != "", F.concat_ws(" ", brand_, name)).otherwise(name)
    return first_hit(low, fixed.SEARCH_TERMS, joined)


def drop_preamble(text: Column) -> Column:
    """Without one leading preamble and one leading badge."""
    for words in (fixed.PREAMBLES, fixed.BADGES):
        text = strip(F.regexp_replace(strip(text), "(?iu)^(" + "|".join(words) + ")", ""))
    return text


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length, by code points; 1 for two empty texts."""
    longer = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def word_jaccard(a: Column, b: Column) -> Column:
    """Percent of common words, truncated; 50 where there are none."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")) for c in (a, b))
    common = F.size(F.array_intersect(x, y))
    return F.when(common == 0, 50).otherwise(F.floor(100 * common / F.size(F.array_union(x, y))).cast("int"))


def json_slice(text: Column) -> Column:
    """From the first brace to the last, else what a fence holds."""
    sliced = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.when(sliced != "", sliced).otherwise(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1))
