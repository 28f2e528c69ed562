"""Pieces of DuckDB SQL that say the same as the expressions in ``corpusmill.functions.text``."""

from __future__ import annotations

from corpusmill.functions import vocabulary as V

WS = V.SPACE
LEFT, RIGHT = r"(?:^|[^\p{L}\p{M}\p{N}_])", r"(?:$|[^\p{L}\p{M}\p{N}_])"


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strings(xs: list[str]) -> str:
    return "(" + ", ".join(map(text, xs)) + ")"


def fold(x: str) -> str:
    return f"strip_accents(lower({x}))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapsed(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def norm(x: str) -> str:
    return f"trim(regexp_replace({fold(f'''coalesce({x}, '')''')}, '[^a-z0-9]+', ' ', 'g'))"


def blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, '[^\\t-\\r\\x1C-\\x20\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200F}}\\x{{2028}}-\\x{{202F}}\\x{{205F}}\\x{{3000}}\\x{{FEFF}}]'))"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '{WS}+'), lambda w: w <> '')"


def clean(x: str) -> str:
    t = strip(f"regexp_replace(coalesce({x}, ''), {text(V.EMOJI)}, '', 'g')")
    quoted = f"length({t}) >= 2 AND left({t}, 1) IN (chr(34), chr(39)) AND left({t}, 1) = right({t}, 1)"
    inner = f"CASE WHEN {quoted} THEN {strip(f'substr({t}, 2, length({t}) - 2)')} ELSE {t} END"
    return collapsed(fold(inner))


def no_url(x: str) -> str:
    return strip(rf"regexp_replace(coalesce({x}, ''), 'https?://[^\s\x0B\x{{A0}}]+|www\.[^\s\x0B\x{{A0}}]+', '', 'g')")


def rating(x: str) -> str:
    s = strip(f"coalesce({x}, '')")
    head = strip(f"regexp_extract({s}, '(?s)^(.*?)(?::|{WS}[-–—]{WS}|$)', 1)")
    return strip(f"regexp_replace({fold(f'CASE WHEN length({head}) < 3 THEN {s} ELSE {head} END')}, '[.!?]+$', '')")


def rating_class(k: str) -> str:
    """Of a normalised rating."""
    return (
        f"CASE WHEN {k} = '' THEN 'other' WHEN {k} IN {strings(V.HARD)} OR regexp_matches({k}, '^\\s*verdadeir[oa]\\s*,?\\s*mas\\b') THEN 'hard' WHEN {k} IN {strings(V.FALSE_PURE)} THEN 'false_pure'"
        f" WHEN {k} IN {strings(V.TRUE_RATING)} THEN 'true_rating' WHEN starts_with({k}, 'fals') THEN 'false_pure' WHEN regexp_matches({k}, '^(engan|distorc)') THEN 'hard'"
        f" WHEN regexp_matches({k}, '^(verdadeir|cert)') THEN 'true_rating' ELSE 'other' END"
    )


def tokens(x: str, stop: list[str]) -> str:
    return f"list_distinct(list_filter(string_split({norm(x)}, ' '), lambda w: length(w) >= 4 AND w NOT IN {strings(sorted(set(stop)))}))"


def era(x: str) -> str:
    d = f"CASE WHEN regexp_matches(substr({x}, 1, 10), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_cast(substr({x}, 1, 10) AS DATE) END"
    return f"CASE WHEN ({d}) IS NULL THEN 'sem_data' WHEN ({d}) < DATE '2018-01-01' THEN 'ate_2017' WHEN ({d}) < DATE '2022-12-01' THEN '2018_2022' ELSE 'pos_gpt35' END"


def channel(g: str) -> str:
    known = " ".join(f"WHEN {g} = {text(k)} THEN {text(v)}" for k, v in V.CHANNELS.items())
    return f"CASE {known} WHEN starts_with({g}, 'FC_') AND suffix({g}, '_VIRAL') THEN 'social' WHEN starts_with({g}, 'FC_') THEN 'agency_claim' WHEN starts_with({g}, 'EXT_') THEN 'external_claim' WHEN starts_with({g}, 'NEWS_') THEN 'press_true' ELSE 'other' END"


def between_words(pattern: str) -> str:
    r"""A pattern between ``\b`` for an engine whose ``\b`` knows ASCII only."""
    body = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return f"{LEFT}{body}{RIGHT}"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), {text(between_words(pattern))}, 'i')"


def domain(x: str) -> str:
    host = rf"regexp_extract(lower(coalesce({x}, '')), '^https?://(?:www\.)?([^/?#\s]+)', 1)"
    return f"CASE WHEN {host} = '' THEN 'sem_url' ELSE {host} END"
