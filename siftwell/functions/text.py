"""Names, identifiers and formulas as Column expressions. The empty string is "missing", as in the sources' tables."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

VARIANTS = C.VARIANTS


def missing(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def _clean(text: str | None) -> str:
    text = html.unescape(text or "")
    for letter, name in C.GREEK.items():
        text = text.replace(letter, f" {name} ").replace(letter.upper(), f" {name} ")
    text = re.sub(r"<[^>]+>", " ", text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def clean_markup(c: Column) -> Column:
    """Entities, Greek letters, tags and accents out. NFKD has no built-in, so texts beyond plain ASCII go through Arrow; the rest
    never leave the JVM."""
    run = F.pandas_udf(lambda s: pd.Series([None if x is None else _clean(x) for x in s], dtype=object), "string")
    plain = ~c.rlike(r"[^\x00-\x7F]|&|<")
    return F.when(c.isNull() | plain, c).otherwise(run(F.when(~plain, c)))


def _fold(text: str | None) -> str:
    folded = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()
    return re.sub(r"[^a-z0-9]+", " ", folded.lower()).strip()


def fold_ascii(c: Column) -> Column:
    """The other normaliser, of alignments: NFKD, what isn't ASCII dropped (Greek letters too), lower case, alphanumerics."""
    return F.pandas_udf(lambda s: pd.Series([None if x is None else _fold(x) for x in s], dtype=object), "string")(c)


def normalize_name(c: Column, clean: bool = True) -> Column:
    """Lower case, ASCII apostrophes out, everything but a-z and 0-9 to single spaces."""
    c = F.lower(clean_markup(c) if clean else c)
    return F.trim(F.regexp_replace(F.replace(c, F.lit("'"), F.lit("")), "[^a-z0-9]+", " "))


def singular_token(t: Column) -> Column:
    kept = (F.length(t) <= 4) | t.rlike("(sses|osis|is|us|ss)$")
    return F.when((F.length(t) > 4) & t.endswith("ies"), F.concat(t.substr(F.lit(1), F.length(t) - 3), F.lit("y"))).when(kept | ~t.endswith("s"), t).otherwise(
        t.substr(F.lit(1), F.length(t) - 1)
    )


def singularize(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, " "), singular_token), " ")


def strip_stereo(c: Column) -> Column:
    """Without the leading tokens of stereochemistry; empty if there are no others."""
    return F.trim(F.regexp_replace(c, f"^(?:(?:{'|'.join(C.LEADING_STEREO_TOKENS)})(?: |$))+", ""))


def variants(c: Column, clean: bool = True) -> Column:
    """struct(exact, compact, singular, stereo_stripped) of a name; the last is made from the singular."""
    exact = normalize_name(c, clean)
    singular = singularize(exact)
    return F.struct(exact.alias("exact"), F.replace(exact, F.lit(" "), F.lit("")).alias("compact"), singular.alias("singular"), strip_stereo(singular).alias("stereo_stripped"))


def formula_key(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def inchi_key(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def inchi_block(c: Column) -> Column:
    return F.substring_index(inchi_key(c), "-", 1)


def prefixed_id(c: Column, prefix: str) -> Column:
    """``PREFIX:rest`` from digits or from the prefix in any case; any other value stays as it is, without outer white space."""
    value = F.trim(F.coalesce(c, F.lit("")))
    named = F.upper(value).startswith(f"{prefix.upper()}:")
    return F.when(named, F.concat(F.lit(f"{prefix}:"), F.regexp_replace(value, "^[^:]*:", ""))).when(value.rlike(r"^\p{Nd}+$"), F.concat(F.lit(f"{prefix}:"), value)).otherwise(value)


def split_multi(c: Column, separators: str = r"[;|*]") -> Column:
    """Trimmed non-empty values."""
    return F.filter(F.transform(F.split(c, separators), lambda x: F.trim(x)), lambda x: x != "")


def tokens(c: Column, letters_only: bool = False) -> Column:
    """Distinct lower-case tokens of a-z and, unless letters_only, 0-9."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+" if letters_only else "[a-z0-9]+"), F.lit(0)))


def name_tokens(c: Column) -> Column:
    """Distinct tokens of a normalised name."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def token_deletions(c: Column) -> Column:
    """A normalised name with one token left out, each in turn; none of a name of one token."""
    words = F.split(c, " ")
    left_out = F.array_distinct(F.transform(words, lambda w, i: F.array_join(F.filter(words, lambda x, j: j != i), " ")))
    return F.when(F.size(words) > 1, left_out).otherwise(F.array().cast("array<string>"))


def join_sorted(values: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))), ";")


def ec_numbers(c: Column) -> Column:
    """Distinct ``EC-`` numbers of two to four levels, in order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?i)(?:EC-)?\d+(?:\.[\d-]+){1,3}"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.concat(F.lit("EC-"), F.regexp_replace(F.upper(x), "^EC-", "")))))


def loci(*fields: Column) -> Column:
    found = F.regexp_extract_all(F.concat_ws(" ", *fields), F.lit(r"(?i)\bAT[1-5CM]G\d{5}\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, F.upper)))


def element_counts(formula: Column) -> Column:
    """map(element, atoms) of a flat molecular formula."""
    parts = F.regexp_extract_all(formula, F.lit(r"[A-Z][a-z]?\s*\d*"), F.lit(0))
    pairs = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, "[A-Z][a-z]?", 0).alias("e"), F.coalesce(missing(F.regexp_extract(p, r"\d+", 0)).cast("int"), F.lit(1)).alias("n")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["e"]))
    return F.map_from_entries(F.transform(names, lambda e: F.struct(e.alias("key"), F.aggregate(F.filter(pairs, lambda p: p["e"] == e), F.lit(0), lambda a, p: a + p["n"]).alias("value"))))


def first_category(c: Column, patterns=C.CATEGORY_PATTERNS, other: str = "Other") -> Column:
    """The first (name, pattern) that a text matches, in order."""
    return F.coalesce(*[F.when(c.rlike(f"(?i){p}"), F.lit(name)) for name, p in patterns], F.lit(other))


def semantic_classes(name: Column, definition: Column) -> Column:
    """Classes of a compound that its name and definition speak of, in the order of the patterns."""
    text = F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(definition, F.lit("")))
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(cls)) for cls, p in C.SEMANTIC_CLASS_PATTERNS.items()]))


def semantic_consistency(classes: Column, pathway_name: Column) -> Column:
    """How many of a compound's classes have a keyword among the pathway name's words, three at most, over three."""
    words = tokens(pathway_name, letters_only=True)
    hits = [F.when(F.array_contains(classes, cls) & F.arrays_overlap(words, F.array(*map(F.lit, keys))), 1).otherwise(0) for cls, keys in C.CLASS_KEYWORDS.items()]
    return F.least(F.lit(3.0), sum(hits[1:], hits[0]).cast("double")) / 3.0


def cofactor_like(compound_id: Column, name: Column) -> Column:
    """A ubiquitous helper molecule: by its id, or by a token anywhere inside its name."""
    return compound_id.isin(*C.COFACTOR_IDS) | contains_any(name, list(C.COFACTOR_NAME_TOKENS))


def plant_context_tags(brite_l1: Column, brite_l2: Column, brite_l3: Column, name: Column, has_aracyc: Column | None = None, has_plantcyc: Column | None = None, more: Column | None = None) -> Column:
    """Tags of a pathway's plant context, in their fixed order. more: further texts, joined by spaces."""
    l1, l2 = normalize_name(F.coalesce(brite_l1, F.lit(""))), normalize_name(F.coalesce(brite_l2, F.lit("")))
    rest = [normalize_name(F.coalesce(c, F.lit(""))) for c in (brite_l3, name, *([more] if more is not None else []))]
    text = F.concat_ws(" ", l1, l2, *rest)
    has = lambda where, words: contains_any(where, list(words))
    metabolic = l1 == "metabolism"
    found = [
        ("primary_metabolism", metabolic & has(l2, C.PRIMARY_BRITE_KEYWORDS)),
        ("secondary_metabolism", metabolic & (has(l2, C.SECONDARY_BRITE_KEYWORDS) | has(text, C.SECONDARY_NAME_KEYWORDS))),
        ("hormone_related", has(text, C.HORMONE_KEYWORDS)),
        ("stress_related", has(text, C.STRESS_KEYWORDS)),
        ("development_related", has(text, C.DEVELOPMENT_KEYWORDS)),
        ("transport_related", has(text, C.TRANSPORT_KEYWORDS)),
    ]
    tags = F.array_compact(F.array(*[F.when(F.coalesce(on, F.lit(False)), F.lit(tag)) for tag, on in found]))
    pmn = F.lit(False) if has_aracyc is None else F.coalesce(has_aracyc, F.lit(False))
    pmn = pmn if has_plantcyc is None else pmn | F.coalesce(has_plantcyc, F.lit(False))
    return F.when((F.size(tags) == 0) & pmn & metabolic, F.array(F.lit("primary_metabolism"))).otherwise(tags)


def safe_float(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def charge(c: Column) -> Column:
    """A charge as a whole number's text; other text as it is, missing as the empty string."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.coalesce(F.nullif(text, F.lit("")).try_cast("double").try_cast("long").cast("string"), text)


def display_name(chebi_name: Column, common_name: Column) -> Column:
    first = F.coalesce(missing(chebi_name), common_name)
    return F.when((common_name != "") & (common_name != first), F.concat_ws(" / ", first, common_name)).otherwise(first)


def ignorable_token(t: Column) -> Column:
    return t.rlike(r"^\p{Nd}+$") | t.isin(*C.LEADING_STEREO_TOKENS, *C.IGNORABLE_FUZZY_TOKENS)


def within_one_token(a: Column, b: Column) -> Column:
    """Arrays of tokens that are equal, differ in one token by at most one edit, or in one further token that may be ignored.

    The further token is the first one of the longer array that the shorter lacks; the rest must follow in order."""
    longer, shorter = F.when(F.size(a) > F.size(b), a).otherwise(b), F.when(F.size(a) > F.size(b), b).otherwise(a)
    differing = F.filter(F.zip_with(a, b, lambda x, y: F.when(x != y, F.struct(x.alias("x"), y.alias("y")))), lambda d: d.isNotNull())
    one_edit = (F.size(differing) == 1) & (F.levenshtein(F.get(differing, F.lit(0))["x"], F.get(differing, F.lit(0))["y"], 1) >= 0)
    # The first place where the longer goes its own way.
    place = F.aggregate(F.sequence(F.lit(0), F.size(shorter)), F.lit(-1), lambda found, i: F.when((found < 0) & ((i == F.size(shorter)) | (F.get(longer, i) != F.get(shorter, i))), i).otherwise(found))
    same_rest = F.slice(longer, place + 2, F.size(longer)) == F.slice(shorter, place + 1, F.size(shorter) + 1)
    one_more = same_rest & ignorable_token(F.get(longer, place))
    return (a == b) | F.when(F.size(a) == F.size(b), one_edit).when(F.abs(F.size(a) - F.size(b)) == 1, one_more).otherwise(False)


def keyword_tags(c: Column, keywords: list[tuple[str, list[str]]]) -> Column:
    """All tags with a keyword inside the text, in the order given."""
    low = F.lower(c)
    return F.array_compact(F.array(*[F.when(F.coalesce(*[F.when(low.contains(w), True) for w in words], F.lit(False)), F.lit(tag)) for tag, words in keywords]))


def contains_any(c: Column, words: list[str]) -> Column:
    """Containment of substrings, not of tokens."""
    low = F.lower(c)
    found = F.lit(False)
    for w in words:
        found = found | low.contains(w)
    return found


def good_synonym(c: Column) -> Column:
    """A name that people use: 3 to 120 characters, no InChI, CAS number, registry id, bare symbols or code."""
    t = F.trim(c)
    code = (~t.contains(" ")) & (F.regexp_count(t, F.lit(r"[\p{Nd}²³¹⁰-⁹₀-₉]")) >= 3) & ~t.rlike(r"\p{IsLowercase}")
    return (
        F.length(t).between(3, 120)
        & ~t.startswith("InChI=")
        & ~t.startswith("InChIKey=")
        & ~t.rlike(r"^\d{2,7}-\d{2}-\d$")
        & ~t.rlike(r"(?i)^(CID|SID|DTXSID|DTXCID|CHEBI|HMDB|LM)[A-Z0-9:\-]+$")
        & ~t.rlike(r"(?U)^[0-9\W_]+$")
        & ~code
    )
