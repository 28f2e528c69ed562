"""Text normalisation as Catalyst expressions (no Python in the row path)."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import vocabulary as V


@functools.cache
def fold_tables() -> tuple[str, str]:
    """``translate`` arguments that replace every precomposed letter by its base letter and delete combining marks.

    Built from the Unicode database by rule: a character whose canonical decomposition is one base character
    followed by marks maps to the base (up to U+30FF, the alphabets that have such letters); marks themselves have no counterpart and are dropped by ``translate``.
    """
    src, dst, marks = [], [], []
    for cp in range(0x80, 0x3100):
        ch = chr(cp)
        if unicodedata.category(ch)[0] == "M":
            marks.append(ch)
            continue
        nfd = unicodedata.normalize("NFD", ch)
        if len(nfd) > 1 and all(unicodedata.category(c)[0] == "M" for c in nfd[1:]):
            src.append(ch)
            dst.append(nfd[0])
    return "".join(src) + "".join(marks), "".join(dst)


def fold(c: Column) -> Column:
    """Removes accents (precomposed and combining); null stays null."""
    return F.translate(c, *fold_tables())


def folded_lower(c: Column) -> Column:
    """Lower case without accents."""
    return fold(F.lower(c))


def blank(c: Column) -> Column:
    """True for null, empty and white-space-only strings (Unicode white space and zero-width characters included)."""
    return c.isNull() | ~c.rlike(r"(?U)[^\s\p{Cf}]")


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` worked out once, however often ``f`` uses it."""
    return F.transform(F.array(c), f)[0]


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, f"^{V.SPACE}+|{V.SPACE}+$", "")


def collapsed(c: Column) -> Column:
    """Runs of white space made one space, none at the ends."""
    return strip(F.regexp_replace(c, f"{V.SPACE}+", " "))


def words(c: Column) -> Column:
    """The non-empty pieces between white space; an empty array for null and blank."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{V.SPACE}+"), lambda x: x != "")


def normalize_text(c: Column) -> Column:
    """De-duplication key: lower case without accents, only a-z, 0-9 and single spaces; empty for null."""
    return F.trim(F.regexp_replace(folded_lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def norm_for_similarity(c: Column) -> Column:
    """Lower case without accents, URLs and punctuation made single spaces, letters of all scripts kept."""
    t = F.regexp_replace(folded_lower(F.coalesce(c, F.lit(""))), r"https?://[^\s\x{A0}]+", " ")
    return collapsed(F.regexp_replace(t, r"[^\p{L}\p{N}_]+", " "))


def text_no_url(c: Column) -> Column:
    """Without web addresses; spaces beside them stay."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"https?://[^\s\x{A0}]+|www\.[^\s\x{A0}]+", ""))


def text_clean(c: Column) -> Column:
    """Without pictographs, one pair of outer quotes, accents and case; white space collapsed."""

    def unquoted(t: Column) -> Column:
        ends = (F.length(t) >= 2) & F.substring(t, 1, 1).isin('"', "'") & (F.substring(t, 1, 1) == F.substring(t, -1, 1))
        return F.when(ends, strip(t.substr(F.lit(2), F.length(t) - 2))).otherwise(t)

    return collapsed(folded_lower(bound(strip(F.regexp_replace(F.coalesce(c, F.lit("")), V.EMOJI, "")), unquoted)))


def urls(c: Column) -> Column:
    """Web addresses with a scheme, in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(c, F.lit(r"https?://[^\s\x{A0}]+"), F.lit(0)), F.array().cast("array<string>"))


def style_counts(text: Column, clean: Column) -> dict[str, Column]:
    """The six metrics: two lengths of the clean text, marks and capitals of the raw one."""
    t = F.coalesce(text, F.lit(""))
    latin = F.filter(F.split(F.regexp_replace(t, r"[^\p{L}\p{N}_]+", " "), " "), lambda x: x.rlike(f"^[{V.LATIN_WORD}]+$"))
    capitals = lambda w: F.size(F.filter(w, lambda x: (F.length(x) >= 3) & (F.upper(x) == x) & (F.lower(x) != x)))
    lengths = bound(F.coalesce(clean, F.lit("")), lambda c: F.struct(F.length(c).alias("c"), F.size(words(c)).alias("w")))
    return {
        "char_len": lengths["c"],
        "word_len": lengths["w"],
        "num_exclamations": F.regexp_count(t, F.lit("!")),
        "num_questions": F.regexp_count(t, F.lit(r"\?")),
        "num_ellipsis": F.regexp_count(t, F.lit(r"\.{3,}|…")),
        "uppercase_word_ratio": bound(latin, lambda w: F.when(F.size(w) > 0, capitals(w) / F.size(w)).otherwise(F.lit(0.0))),
    }


def normalize_rating(c: Column) -> Column:
    """The verdict before a colon or a spaced dash (all of it if that is under three letters), folded, without closing marks."""
    s = strip(F.coalesce(c, F.lit("")))
    head = strip(F.regexp_extract(s, rf"(?s)^(.*?)(?::|{V.SPACE}[-–—]{V.SPACE}|\z)", 1))
    return strip(F.regexp_replace(folded_lower(F.when(F.length(head) < 3, s).otherwise(head)), r"[.!?]+$", ""))


def rating_class(c: Column) -> Column:
    """``false_pure``, ``hard``, ``true_rating`` or ``other`` of a raw rating, with fallbacks on prefixes."""
    k = normalize_rating(c)
    return (
        F.when(k == "", "other").when(k.isin(V.HARD) | k.rlike(r"^\s*verdadeir[oa]\s*,?\s*mas\b"), "hard").when(k.isin(V.FALSE_PURE), "false_pure")
        .when(k.isin(V.TRUE_RATING), "true_rating").when(F.startswith(k, F.lit("fals")), "false_pure").when(k.rlike("^(engan|distorc)"), "hard")
        .when(k.rlike("^(verdadeir|cert)"), "true_rating").otherwise("other")
    )


def label_of_class(c: Column) -> Column:
    return F.when(c.isin("false_pure", "hard"), "fake").when(c == "true_rating", "true")


def model_rating_class(c: Column) -> Column:
    """The modelling side's classes: no head, no prefixes, and ``none`` for blanks."""
    k = folded_lower(strip(c))
    return F.when(blank(c), "none").when(k.isin(V.MODEL_HARD), "hard").when(k.isin(V.MODEL_FALSE), "false_pure").when(k.isin(V.MODEL_TRUE), "true_rating").otherwise("other")


def content_tokens(c: Column, stop: list[str]) -> Column:
    """Distinct words of four letters or more of the normalised text, without stop-words."""
    return F.array_distinct(F.filter(F.split(normalize_text(c), " "), lambda w: (F.length(w) >= 4) & ~w.isin(stop)))


def numbers(c: Column) -> Column:
    """Distinct numbers of a text: runs of digits, and ordinals in words."""
    t = normalize_text(c)
    digits = F.transform(F.regexp_extract_all(t, F.lit(r"\b\d+\b"), F.lit(0)), lambda x: x.try_cast("bigint"))
    ordinal = F.create_map(*[F.lit(x) for kv in V.ORDINALS.items() for x in kv])
    worded = F.transform(F.filter(F.split(t, " "), lambda w: w.isin(list(V.ORDINALS))), lambda w: F.element_at(ordinal, w).cast("bigint"))
    return F.array_sort(F.array_distinct(F.concat(digits, worded)))


def title_verdict(c: Column) -> Column:
    """``fake`` or ``true`` if a title says so, falsehood first; else null."""
    t = normalize_text(c)
    return F.when(t.rlike(V.TITLE_FALSE), "fake").when(t.rlike(V.TITLE_TRUE), "true")


def leaks_verdict(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(f"(?iu)(?U){V.LEAK}")


def mentions_ai(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(f"(?iu)(?U){V.AI}").cast("int")


def claim_like(c: Column) -> Column:
    """Five to forty words, no question, no opinion marker, a verb that claims."""
    t = strip(F.coalesce(c, F.lit("")))
    n = F.size(words(t))
    return n.between(5, 40) & ~F.endswith(t, F.lit("?")) & ~t.rlike(f"(?iu)(?U){V.OPINION}") & t.rlike(f"(?iu)(?U){V.CLAIM_VERB}")


def first_sentence(c: Column, most: int = 320) -> Column:
    """The first sentence of 20 to ``most`` characters without its closing mark, or the text's beginning."""
    s = collapsed(F.coalesce(c, F.lit("")))
    m = F.regexp_extract(s, rf"^(.{{20,{most}}}?[.!?])(?:\s|$)", 1)
    return F.btrim(F.when(m != "", m).otherwise(F.left(s, F.lit(most))), F.lit(" ."))


def last_part(c: Column, most: int = 2500, mark: str = "conclusao") -> Column:
    """From the last mention of ``mark`` on, or the last ``most`` characters."""
    t = F.coalesce(c, F.lit(""))
    at = F.length(t) - F.locate(mark[::-1], F.reverse(folded_lower(t))) - F.length(F.lit(mark)) + 2
    return F.when(folded_lower(t).contains(mark) & (F.length(folded_lower(t)) == F.length(t)), t.substr(at, F.length(t))).otherwise(F.right(t, F.lit(most)))


def domain(url: Column) -> Column:
    """Host of a web address in lower case without ``www.``; ``sem_url`` if there is none."""
    d = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^https?://(?:www\.)?([^/?#\s]+)", 1)
    return F.when(d == "", "sem_url").otherwise(d)


def html_text(c: Column) -> Column:
    """Text of a page: scripts and styles removed, tags made spaces, the common entities resolved, white space collapsed."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(ch))
    return collapsed(t)


def masked_entities(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    for pattern, tag in V.MASKS:
        t = F.regexp_replace(t, f"(?iu)(?U){pattern}", tag)
    return collapsed(t)


def masked_pii(c: Column) -> tuple[Column, dict[str, Column]]:
    """The masked text and how often each kind was masked, each counted on what the masks before it left."""
    counts = {}
    t = c
    for kind, pattern, tag in V.PII:
        counts[kind] = F.coalesce(F.regexp_count(t, F.lit(pattern)), F.lit(0))
        t = F.regexp_replace(t, pattern, tag.replace("[", r"\[").replace("]", r"\]"))
    return t, counts


def stable_id(*parts: Column) -> Column:
    """The first fifteen hexadecimal digits of SHA-1 over the parts joined by bars, as a number."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.sha1(F.encode(key, "UTF-8")), 1, 15), 16, 10).cast("bigint")


def era(date: Column) -> Column:
    """Era of an ISO date, left-closed at 2018-01-01 and 2022-12-01; ``sem_data`` for what is no date."""
    d = F.try_to_date(F.substring(date, 1, 10), "yyyy-MM-dd")
    return F.when(d.isNull(), "sem_data").when(d < F.lit("2018-01-01").cast("date"), "ate_2017").when(d < F.lit("2022-12-01").cast("date"), "2018_2022").otherwise("pos_gpt35")


def channel(group: Column) -> Column:
    """Channel of a group: the fixed map, then rules on prefixes and suffixes."""
    known = F.create_map(*[F.lit(x) for kv in V.CHANNELS.items() for x in kv])
    fc = F.startswith(group, F.lit("FC_"))
    return (
        F.when(group.isin(list(V.CHANNELS)), F.element_at(known, group)).when(fc & F.endswith(group, F.lit("_VIRAL")), "social").when(fc, "agency_claim")
        .when(F.startswith(group, F.lit("EXT_")), "external_claim").when(F.startswith(group, F.lit("NEWS_")), "press_true").otherwise("other")
    )


def shingles(c: Column, width: int = 3, chars: int = 5, least_words: int = 20) -> Column:
    """Distinct word ``width``-grams of the normalised text, or character ``chars``-grams without spaces for short ones."""
    # Bound once by transform: inside a lambda an outer expression would be worked out again for every element.
    return F.transform(F.array(normalize_text(c)), lambda key: F.transform(F.array(F.split(key, " ")), lambda w: _shingles(key, w, width, chars, least_words))[0])[0]


def _shingles(key: Column, w: Column, width: int, chars: int, least_words: int) -> Column:
    n = F.size(w)
    flat = F.replace(key, F.lit(" "), F.lit(""))
    m = F.length(flat)
    by_word = F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(width)), " "))
    by_char = F.transform(F.sequence(F.lit(1), F.greatest(m - chars + 1, F.lit(1))), lambda i: F.substr(flat, i, F.lit(chars)))
    return F.array_distinct(F.when(key == "", F.array().cast("array<string>")).when(n >= least_words, by_word).otherwise(by_char))
