"""Personal information inside free text (problem 5): a semi-Markov conditional random field.

Candidate segments are proposed by shape alone: every run of up to ``CORES`` words that are written alike (capitalised, or all
in lower or upper case) may be a name, every run of 6 to ``DIGITS`` digits with signs between a number, every at-sign or its
spelling an address of mail, every street word or capitalised run before a house number an address. Word lists
(``personal_words``) are features, never a condition. Features look at a whole candidate: its words and their endings, its
pattern of digits and signs, what stands on either side, whether it cuts a longer run. Everything between segments scores 0, so
the field's sums and its best labelling are dynamic programs over the candidates' ends; boundaries and types are chosen jointly.

A feature belongs to a group (a word in its place, a neighbour, a pattern); groups are scored once and remembered, and a run of
words is scored further only while the most that its other groups could add still makes it positive, which changes nothing.

Weights are fitted here by conditional likelihood on sentences put together from patterns, once in each application.

Defined results
---------------
* null stays null and holds nothing; a text without personal data is returned as it is
* kinds: ``email``, ``phone``, ``id_number``, ``address``, ``name``; each found span becomes ``[EMAIL]``, ``[PHONE]``, ...
* a given name without a surname, names of places, streets and institutions, and account handles are left alone
* an entity is bounded: names of more than ``CORES`` words and numbers of more than ``DIGITS`` digits are none
"""

from __future__ import annotations

import functools
import math
import random
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.personal_words import CALENDAR, FAMILY_ENDS, GIVEN, GIVEN_ENDS, JOIN, LEFT, PLACE, PLAIN, ROLE, STREET, SURNAMES, TITLE, training
from corpusmill.session import ship

KINDS = ["email", "phone", "id_number", "address", "name"]
#: The longest entities: words of a name without its joining words, and digits of a number.
CORES, DIGITS = 5, 20
# Words of which each counts by itself before a name.
BEFORE = set("em no na de da do dos das por pela pelo com e a o ao para sr sra dr dra dona".split())
_LETTER = r"(?:[^\W\d_]|[\u0300-\u036f])"
_WORD = re.compile(rf"{_LETTER}+(?:['’-]{_LETTER}+)*")
_SPACE = r"[\s\u200b-\u200f\ufeff]"
_AT = re.compile(r"\s?[(\[{<]\s?(?:arroba|at)\s?[)\]}>]\s?|\s+arroba\s+|\s?@\s?", re.I)
_DOT = r"(?:\s?[(\[{]\s?(?:ponto|dot)\s?[)\]}]\s?|\s(?:ponto|dot)\s|\.)"
_LOCAL = re.compile(rf"[\w.+-]+(?:(?:\s?[(\[{{]\s?(?:ponto|dot)\s?[)\]}}]\s?|\s(?:ponto|dot)\s)[\w.+-]+)*\Z", re.I)
_DOMAIN = re.compile(rf"[\w-]+(?:{_DOT}[\w-]+)+", re.I)
_URL = re.compile(r"https?://\S+|www\.\S+|[\w-]+(?:\.[\w-]+)+/\S+")
_DIGITS = re.compile(r"\d+")
_LINK = re.compile(r"[\s().+/–-]{1,3}\Z")
_UNIT = r"(?:ap(?:to|artamento)?\.?|bloco|bl\.?|conj(?:unto)?\.?|casa|s[ií]tio|lote|sala|loja|sobrado|cep:?|quadra|m[oó]dulo)(?![^\W\d_])"
_HOUSE = re.compile(
    rf"\.?{_SPACE}+(?P<name>(?:\d{{1,3}}{_SPACE}+de{_SPACE}+)?(?:{_LETTER}[\w\u0300-\u036f'’.-]*{_SPACE}*){{1,8}}?)(?P<mark>{_SPACE}*,?{_SPACE}*-?{_SPACE}*(?:\b(?:km|n\.?{_SPACE}?[oº°]?\.?|n[uú]mero|nº|lote|casa|quadra|bloco)(?![^\W\d_]))?{_SPACE}*[.:]?{_SPACE}*)(?P<num>\d{{1,6}}(?!\d|[.,]\d)|s{_SPACE}?/{_SPACE}?n\b\.?[º°o]?)",
    re.I,
)
_BLOCK = re.compile(rf"\.?{_SPACE}+\d{{1,4}}(?:[,{_SPACE[1:-1]}-]*{_UNIT}{_SPACE}*[\w-]+)+", re.I)
_REST = re.compile(
    rf"(?:[-/][A-Za-z]\b)?(?:{_SPACE}*[,-]?{_SPACE}*{_UNIT}{_SPACE}*(?=[\w-]*\d|[A-Za-z]\b)[\w-]*\w|{_SPACE}*,?{_SPACE}*fundos|{_SPACE}*,?{_SPACE}*\d{{1,3}}\s?\.?[oºª]?{_SPACE}*(?:andar|dto|esq)\b|{_SPACE}*[,-]{_SPACE}*\d{{5}}-\d{{3}}|{_SPACE}*[,-]?{_SPACE}*(?:(?i:bairro)|BAIRRO)(?:{_SPACE}(?-i:[A-ZÀ-Ý])[\w\u0300-\u036f]+){{1,3}})*",
    re.I,
)
_BARE = re.compile(rf"(?:[A-ZÀ-Ý]{_LETTER}+{_SPACE}+(?:d[aeo]s?{_SPACE}+)?){{0,3}}[A-ZÀ-Ý]{_LETTER}+,?{_SPACE}+(?:n\.?[oº°]?{_SPACE}*)?\d{{1,5}}(?=,?{_SPACE}*-?{_SPACE}*(?:{_UNIT}|bairro|fundos){_SPACE}*[\w-])")
_COUNTED = set("mil pessoas dias anos vezes reais milhoes milhao casos metros horas minutos euros votos cidades turistas carros bancos dentes unidades familias por dolares km".split())


@functools.lru_cache(maxsize=300_000)
def _fold(word: str) -> str:
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c))


@functools.lru_cache(maxsize=300_000)
def _word(w: str) -> tuple[str, str]:
    """A word folded, and its shape."""
    return _fold(w), "l" if w.islower() else ("u" if w.isupper() and len(w) > 1 else "c" if w[0].isupper() else "m")


@functools.lru_cache(maxsize=20_000)
def _gap(g: str) -> str:
    """What parts a word from the next: ``s`` white space, ``.`` a point, ``,`` a comma, empty for anything else."""
    x = g.strip(" \t\n\r\xa0\u200b\u200c\u200d\u200e\u200f\ufeff")
    return "s" if g and not x else x if x in (".", ",") else ""


_LABELS = LEFT["id"] | LEFT["tel"] | LEFT["other"]


@functools.lru_cache(maxsize=300_000)
def _class(w: str) -> str:
    """What lists say of a word, as one feature."""
    out = [n for n, s in (("given", GIVEN), ("family", SURNAMES), ("place", PLACE), ("plain", PLAIN), ("calendar", CALENDAR), ("title", TITLE), ("role", ROLE), ("label", _LABELS)) if w in s]
    return "+".join(out) or ("letter" if len(w) == 1 else "other")


class Text:
    """A text with its words: ``(from, to, folded, shape)``, shape being ``c`` capitalised (``t`` where a long text capitalises nearly all), ``u`` upper case, ``l`` lower case, ``m`` mixed."""

    def __init__(self, text: str):
        self.text = text
        self.words = [(m.start(), m.end(), *_word(m.group())) for m in _WORD.finditer(text)]
        long = [w[3] for w in self.words if w[1] - w[0] > 3]
        if len(long) > 6 and long.count("c") > 0.75 * len(long):
            self.words = [(a, b, w, "t" if shape == "c" else shape) for a, b, w, shape in self.words]
        self.starts, self.ends = [w[0] for w in self.words], [w[1] for w in self.words]
        self.urls = [m.span() for m in _URL.finditer(text)] if "." in text or "/" in text else []

    def in_url(self, a: int) -> bool:
        return any(lo <= a < hi for lo, hi in self.urls)

    def before(self, at: int, n: int) -> list[str]:
        k = bisect_right(self.ends, at)
        return [w[2] for w in self.words[max(0, k - n) : k]][::-1]

    def after(self, at: int) -> str:
        k = bisect_left(self.starts, at)
        return self.words[k][2] if k < len(self.words) and not self.text[at : self.starts[k]].strip(" ,\n\t") else ""


# Candidates are (from, to, kind, groups); ``features`` tells what a group consists of.


def features(group: tuple) -> list[str]:
    kind = group[0]
    if kind in ("first", "last", "inner"):
        w = group[1]
        return [f"{kind}_{_class(w)}", *([f"{kind}_len{len(w)}"] if len(w) < 3 else []), *([f"first_ends_{w.endswith(GIVEN_ENDS)}"] if kind == "first" else [f"last_ends_{w.endswith(FAMILY_ENDS)}"] if kind == "last" else [])]
    if kind == "beside":
        _, side, gap, of, shape, w = group
        return [f"{side}_{gap}", f"{side}_{gap}_{of}_{shape}", f"{side}_{gap}_{of}", *([f"left_is_{w}"] if w else [])] if gap in ("s", ".") else [f"{side}_{gap}", f"{side}_mark"]
    if kind == "form":
        _, shape, cores, join, order, one, two = group
        return ["bias", f"shape_{shape}", f"cores_{cores}_{order}", f"join_{join}", f"order_{order}_{shape}", f"pair_{one}_{two}", f"pair_{one}_{two}_{shape}", f"pair_{one}_{two}_{order}", f"pair_{one}_{two}_{join or 'none'}"]
    return list(group[1:])


def _names(t: Text, score: Tagger | None = None) -> list[tuple]:
    """Names; with a tagger only those that score above 0, and their scores."""
    s, words, out = t.text, t.words, []
    n = len(words)
    gaps = [_gap(s[x[1] : y[0]]) for x, y in zip(words, words[1:], strict=False)] + [""]
    for i, g in enumerate(gaps):
        if g == "." and words[i][1] - words[i][0] > 2:
            gaps[i] = ""  # only an initial's point doesn't end a sentence

    def side(k: int, step: int) -> tuple:
        """The group of what stands beside a candidate that begins or ends with word ``k``."""
        at = words[k][0] if step < 0 else words[k][1]
        near = s[at - 1 : at] if step < 0 else s[at : at + 1]
        name = "left" if step < 0 else "right"
        if not near:
            return ("beside", name, "edge", "", "", "")
        if near in "@#_/" or near.isdigit():
            return ("beside", name, "handle", "", "", "")
        j = k + step
        if not 0 <= j < n:
            return ("beside", name, f"mark{near}" if near.strip() else "edge", "", "", "")
        between, w, shape = gaps[min(j, k)], words[j][2], words[j][3]
        if step < 0 and not between and w in TITLE and s[words[j][1] : at].strip() == ".":
            return ("beside", name, ".", classes[j], shape, w if w in BEFORE else "")
        if between not in ("s", "."):
            return ("beside", name, "comma" if between == "," else f"mark{near.strip() or s[at - 2 : at - 1] * (step < 0)}", "", "", "")
        # A joining word is looked through: "Vasco da" + "Gama Silva" cuts a longer run.
        if w in JOIN and w != "e" and 0 <= j + step < n and gaps[min(j, j + step)] == "s" and words[j + step][3] in "ctu" and words[k][3] in "ctu":
            return ("beside", name, "s", classes[j + step], "join", "")
        if step < 0 and shape == "c" and (w in PLAIN or j == 0 or not gaps[j - 1] or s[words[j][0] - 1] == "\n"):
            shape = "S"  # the capital of a sentence's first word says little
        return ("beside", name, "s", classes[j], shape, w if step < 0 and w in BEFORE else "")

    def run(i: int, shape: str, most: int) -> Iterator[tuple[list[int], str]]:
        """Runs of words of one shape from ``i`` on, joining words passed over: the cores, and how they are joined."""
        cores, join = [i], ""
        yield cores, join
        while len(cores) < most and gaps[i] in ("s", "."):
            j = i + 1
            while j + 1 < n and j - i < 3 and words[j][2] in JOIN and gaps[j] == "s":
                j += 1
            w = words[j]
            if t.urls and t.in_url(w[0]) or (w[3] != shape and not (w[3] in "ct" and shape == "u" and w[1] - w[0] == 1)) or w[2] in JOIN:
                return
            for x in range(i + 1, j):
                kind = "e" if words[x][2] == "e" else "capital" if words[x][3] == shape and shape in "ct" else "join"
                join = join if join == "capital" else kind
            if "\n" in s[words[i][1] : w[0]]:
                join = "lines"
            cores, i = [*cores, j], j
            yield cores, join

    # What words inside a name can add, summed up: with it the bound below holds for names of any length.
    gain = [0.0]
    if score:
        info = [score.info[x[2]] for x in words]
        classes = [x[0] for x in info]
        ending: dict[str, dict[str, float]] = {}
        for (_, _, _, shape), (of, _, x, y) in zip(words, info, strict=True):
            gain.append(gain[-1] + y if y > 0 else gain[-1])
            there = ending.setdefault(shape, {})
            if there.get(of, -1e9) < x:
                there[of] = x
    else:
        info, classes = [], [_class(x[2]) for x in words]
    known: dict[tuple[str, str], float] = {}

    def beyond(shape: str, one: str) -> float:
        """The most that last word, form and right side can add to a name in this text, by the first word's shape and class."""
        x = known.get((shape, one))
        if x is None:
            x = known[shape, one] = score.right + max(score.best[shape, one, two] + most for two, most in ending[shape].items())
        return x

    for k in range(n):
        at, _, w, shape = words[k]
        if gaps[k] not in ("s", ".", ",") or w in JOIN or shape == "m" or t.urls and t.in_url(at):
            continue
        if gaps[k] != ",":
            one, begun = classes[k], 0.0
            if score:
                # Gone on with only while what can still be added makes a name of it.
                begun = info[k][1]
                rest = beyond(shape, one) + gain[min(n, k + 3 * CORES)] - gain[k + 1]
                if begun + rest + score.left <= 0:
                    continue
            left = side(k, -1)
            begun += score.beside[left] if score else 0.0
            if not score or begun + rest > 0:
                for cores, join in run(k, shape, CORES):
                    if len(cores) > 1:
                        end = cores[-1]
                        z = words[end][2]
                        form = ("form", shape, len(cores), join, "fore", one, classes[end])
                        got = None
                        if score:
                            got = begun + info[end][2] + score.form[form]
                            for x in cores[1:-1]:
                                got += info[x][3]
                            if got + score.right <= 0:
                                continue
                        right = side(end, 1)
                        if score:
                            got += score.beside[right]
                            if got <= 0:
                                continue
                        out.append((at, words[end][1], "name", (("first", w), ("last", z), *[("inner", words[x][2]) for x in cores[1:-1]], left, right, form), got))
        # Surnames, a comma, given names.
        for c, cores, join in ([(k, [k], "")] if gaps[k] == "," else [(k + 1, [k, k + 1], "")] if gaps[k] == "s" and gaps[k + 1] == "," and words[k + 1][3] == shape else []):
            given = words[c + 1]
            if given[3] != shape or given[2] in JOIN:
                continue
            start = k - 1 if k and words[k - 1][2] in JOIN and gaps[k - 1] == "s" else k
            left, one, z = side(start, -1), classes[c + 1], words[c][2]
            if score and info[c + 1][1] + score.beside[left] + beyond(shape, one) + gain[min(n, c + 3 * CORES)] - gain[k] <= 0:
                continue
            for more, _ in run(c + 1, shape, 3):
                e = more[-1]
                f = (("first", given[2]), ("last", z), *[("inner", words[x][2]) for x in [*cores[:-1], *more[1:]]], left, side(e, 1), ("form", shape, len(cores) + len(more), join or ("join" if start < k else ""), "back", one, classes[c]))
                got = score.total(f, "name") if score else None
                if got is None or got > 0:
                    out.append((words[start][0], words[e][1], "name", f, got))
    return out


def _emails(t: Text) -> list[tuple[int, int, str, tuple]]:
    out, s = [], t.text
    for m in _AT.finditer(s):
        # The part before the at-sign reaches back over its characters, and over spelled points between them.
        a = m.start()
        while True:
            while a and (s[a - 1].isalnum() or s[a - 1] in "_.+-"):
                a -= 1
            spelled = re.search(r"[\w+-](\s?[(\[{]\s?(?:ponto|dot)\s?[)\]}]\s?|\s(?:ponto|dot)\s)\Z", s[max(0, a - 14) : a], re.I)
            if not spelled or a == m.start():
                break
            a -= len(spelled.group(1))
        dom = _DOMAIN.match(s, m.end())
        if a == m.start() or not dom:
            continue
        at = m.group()
        style = ("plain" if at == "@" else "spaced" if at == " @ " else "open_left" if at[0].isspace() else "open_right") if at.strip() == "@" else "spelled"
        whole = dom.end()
        for x in re.finditer(r"[\w-]+(?=" + _DOT + r"|\Z)", dom.group() + ".", re.I):
            b = m.end() + x.end()
            if x.start() and b <= whole:
                last = _fold(x.group())
                out.append((a, b, "email", (("mail", "mail_bias", f"at_{style}", "mail_whole" if b == whole else "mail_cut", f"mail_tld{min(len(last), 4)}_{style}", f"before_{s[a - 1 : a] if s[a - 1 : a] in '/@:' else 'other'}"),)))
    return out


def _numbers(t: Text) -> list[tuple[int, int, str, tuple]]:
    out, s = [], t.text
    groups = [m.span() for m in _DIGITS.finditer(s)]
    if sum(b - a for a, b in groups) < 6:
        return out
    linked = [bool(_LINK.match(s, groups[i][1], groups[i + 1][0])) and "\n" not in s[groups[i][1] : groups[i + 1][0]] for i in range(len(groups) - 1)] + [False]
    for i, (a0, _) in enumerate(groups):
        digits = 0
        for j in range(i, len(groups)):
            if j > i and not linked[j - 1]:
                break
            digits += groups[j][1] - groups[j][0]
            if digits > DIGITS:
                break
            if digits < 6:
                continue
            b0 = groups[j][1]
            first, last = i == 0 or not linked[i - 1], not linked[j]
            lead = re.search(r"(?:\+\s?\(?|\(\s?)\Z", s[max(0, a0 - 3) : a0])
            a = a0 - len(lead.group()) if lead else a0
            letters = re.search(r"(?<![^\W_])[A-Za-z]{2}\s?\Z", s[max(0, a0 - 4) : a0]) if i == j and first else None
            starts = [(a, "")] if digits > 6 else []
            if letters and digits < 10:
                starts.append((a0 - len(letters.group()), "AA"))
            tail = re.match(r"[-\s]?[Xx]\b|\s\d\s?[A-Z]{2}\d\b", s[b0 : b0 + 8])
            for begin, mark in starts:
                for end in ([b0 + tail.end(), b0] if tail else [b0]):
                    pattern = mark + re.sub(r"\d+", lambda m: str(len(m.group())), re.sub(r"\s+", " ", s[a if not mark else a0 : end])) if j - i < 7 else "many"
                    seps = "".join(sorted(set(re.sub(r"\d", "", s[a0:end]))))
                    left = t.before(begin, 4)
                    if re.search(r"(?i)\bc\.\s?p\.\s?f\.?\s*\Z", s[max(0, begin - 10) : begin]):
                        left = ["cpf", *left[3:]]
                    f = ["num_bias", f"digits{digits}", f"pat_{pattern}", f"seps{digits}_{seps}", f"groups{min(j - i, 4)}", "num_first" if first else "num_cut_left", "num_last" if last else "num_cut_right"]
                    run = re.sub(r"\D", "", s[a0:end])
                    if i == j:
                        f.append(f"nine{digits}_{len(run) > 2 and run[2] == '9'}_{digits < 10 and run[0] == '9'}_{run[:2] in ('55', '00')}")
                    if mark:
                        f += ["letters", f"letters{digits}"]
                    for k, w in enumerate(left):
                        f += [f"left{min(k, 2)}_{c}" for c, ws in LEFT.items() if w in ws]
                        if k == 0 and any(w in ws for ws in LEFT.values()):
                            f.append(f"left_{w}")
                    if re.search(r"[$€£@#_=]\s?\Z", s[max(0, begin - 2) : begin]):
                        f.append("money")
                    if s[begin - 1 : begin].isalnum() or s[begin - 1 : begin] in ("/", ".", "-", ",", ":"):
                        f.append("joined_left")
                    if re.match(r"\s*/\d|[.,:]\d|[^\W\d_]|%", s[end : end + 3]):
                        f.append("joined_right")
                    if t.in_url(begin):
                        f.append("in_url")
                    if t.after(end) in _COUNTED:
                        f.append("counted")
                    f = ("num", *f)
                    out += [(begin, end, kind, (f,)) for kind in ("phone", "id_number")]
    return out


def _addresses(t: Text) -> list[tuple[int, int, str, tuple]]:
    out, s = [], t.text

    def add(a: int, end: int, f: list[str]) -> None:
        rest = _REST.match(s, end)
        near = t.before(a, 1)
        f = [*f, "counted"] if t.after(end) in _COUNTED else f
        f += [f"addr_left_{near[0]}"] if near and len(near[0]) < 4 else []
        if t.in_url(a):
            f.append("in_url")
        if re.match(r"\s[^\W\d_]", s[end : end + 2]) and s[end + 1].islower():
            f.append("addr_goes_on")
        longer = rest is not None and rest.end() > end
        out.append((a, end, "address", (("addr", *f, *(["addr_short"] if longer else [])),)))
        if longer:
            out.append((a, rest.end(), "address", (("addr", *f, "addr_long"),)))

    for a, b, w, shape in t.words:
        if w not in STREET or (len(w) < 3 and shape == "l" and s[b : b + 1] != "."):
            continue
        m = _BLOCK.match(s, b)
        if m:
            add(a, m.end(), ["addr_bias", "addr_block", f"addr_shape_{shape}"])
        m = _HOUSE.match(s, b)
        if m:
            inner = [_fold(x) for x in re.findall(_LETTER + "+", m.group("name"))]
            plain = sum(x in PLAIN and x not in JOIN for x in inner)
            cores = [x for x in re.findall(_LETTER + "+", m.group("name")) if _fold(x) not in JOIN]
            f = ["addr_bias", f"addr_plain{min(plain, 2)}", f"addr_parts{min(len(cores), 5)}", "addr_comma" if "," in m.group("mark") else "addr_no_comma", f"addr_shape_{shape}"]
            f += [f"addr_mark_{bool(re.search('[a-zº°-]', m.group('mark'), re.I))}", f"addr_capital_{bool(cores) and cores[0][0].isupper()}_{shape}", f"addr_lower{min(sum(x[0].islower() for x in cores), 2)}_{shape}"]
            f += ["addr_sentence"] * bool(re.search(r"[^\W\d_]{4,}\.\s", m.group("name"))) + ["addr_none"] * (not m.group("num")[0].isdigit()) + ["addr_year"] * bool(re.fullmatch("(?:19|20)\\d\\d", m.group("num"))) + ["addr_year_bare"] * bool(re.fullmatch("(?:19|20)\\d\\d", m.group("num")) and not m.group("mark").strip())
            f += ["addr_month"] * any(x in CALENDAR for x in inner[2:3]) + ["addr_em"] * any(x in ("em", "tera", "terao", "recebeu", "ate", "desde") for x in inner)
            add(a, m.end(), f)
    for m in _BARE.finditer(s):
        if _fold(_WORD.match(m.group()).group()) not in STREET:
            add(m.start(), m.end(), ["addr_bias", "addr_bare", f"addr_bare_{_class(_fold(_WORD.match(m.group()).group()))}"])
    return out


def candidates(t: Text, score: Tagger | None = None) -> list[tuple]:
    """``(from, to, kind, groups, ...)`` of each candidate segment. A tagger leaves out names that can't score above 0, as they stand in no best labelling."""
    mail = _emails(t) if "@" in t.text or "arroba" in t.text.lower() or _AT.search(t.text) else []
    return mail + _numbers(t) + _addresses(t) + _names(t, score)


def _order(segments: list) -> list:
    return sorted(range(len(segments)), key=lambda i: (segments[i][1], segments[i][0]))


def best_labelling(segments: list[tuple[int, int, str]], score: list[float]) -> list[tuple[int, int, str]]:
    """The set of disjoint segments of greatest total score, by dynamic programming over their ends."""
    order = [i for i in _order(segments) if score[i] > 0]
    ends, best, back = [0], [0.0], [(None, 0)]
    for i in order:
        a, b, _ = segments[i]
        lo = bisect_right(ends, a) - 1
        value = best[lo] + score[i]
        if value > best[-1]:
            ends.append(b), best.append(value), back.append((i, lo))
    chosen, at = [], len(ends) - 1
    while at > 0:
        i, lo = back[at]
        chosen.append(segments[i])
        at = lo
    return chosen[::-1]


def _marginals(segments: list[tuple[int, int, str]], score: list[float]) -> list[float]:
    """Probability of each segment: sums over all sets of disjoint segments, forward and backward."""
    points = sorted({p for a, b, _ in segments for p in (a, b)})
    at = {p: i for i, p in enumerate(points)}
    n = len(points)
    e = [math.exp(min(30.0, x)) for x in score]
    ending, starting = [[] for _ in range(n)], [[] for _ in range(n)]
    for i, (a, b, _) in enumerate(segments):
        ending[at[b]].append(i), starting[at[a]].append(i)
    fwd, bwd = [1.0] * n, [1.0] * n
    for p in range(n):
        fwd[p] = (fwd[p - 1] if p else 1.0) + sum(fwd[at[segments[i][0]]] * e[i] for i in ending[p])
    for p in range(n - 1, -1, -1):
        bwd[p] = (bwd[p + 1] if p + 1 < n else 1.0) + sum(bwd[at[segments[i][1]]] * e[i] for i in starting[p])
    return [fwd[at[a]] * e[i] * bwd[at[b]] / fwd[-1] for i, (a, b, _) in enumerate(segments)]




@functools.cache
def weights(examples: int = 9000, epochs: int = 5) -> dict[tuple[str, str], float]:
    """Feature weights by kind: stochastic ascent of the conditional likelihood with decaying steps."""
    data, r = [], random.Random(1)
    memo: dict[tuple, tuple] = {}
    for text, gold in training(examples):
        c = candidates(Text(text))
        if not c:
            continue
        seg = [x[:3] for x in c]
        want = [0.0] * len(c)
        # A true span counts at the candidate that covers most of it.
        for a, b, kind in gold:
            near = [(-(abs(x[0] - a) + abs(x[1] - b)), i) for i, x in enumerate(seg) if x[2] == kind and x[0] < b and a < x[1]]
            if near:
                want[max(near)[1]] = 1.0
        feats = []
        for x in c:
            f = []
            for g in x[3]:
                if g not in memo:
                    memo[g] = tuple(features(g))
                f += memo[g]
            feats.append([(y, x[2]) for y in f])
        data.append((seg, feats, want))
    w: dict[tuple[str, str], float] = {}
    grown: dict[tuple[str, str], float] = {}
    for _ in range(epochs):
        r.shuffle(data)
        for seg, feats, want in data:
            p = _marginals(seg, [sum(w.get(f, 0.0) for f in fs) for fs in feats])
            for fs, y, q in zip(feats, want, p, strict=True):
                g = y - q
                if abs(g) > 2e-3:
                    for f in fs:
                        grown[f] = grown.get(f, 1.0) + g * g
                        w[f] = w.get(f, 0.0) * 0.9998 + 0.7 * g / math.sqrt(grown[f])
    return w


class _Memo(dict):
    """Values of a function by its argument, kept up to a bound."""

    def __init__(self, of, most: int = 300_000):
        super().__init__()
        self.of, self.most = of, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        x = self[key] = self.of(key)
        return x


class Tagger:
    """Finds the personal data of texts with given weights; scores of groups are remembered."""

    def __init__(self, w: dict[tuple[str, str], float]):
        self.w = w
        name = lambda g: sum(w.get((f, "name"), 0.0) for f in features(g))
        #: A word's class and its scores as first, last and inner word of a name.
        self.info = _Memo(lambda x: (_class(x), name(("first", x)), name(("last", x)), name(("inner", x))))
        self.beside, self.form = _Memo(name), _Memo(name)
        self.other = _Memo(lambda key: sum(w.get((f, key[1]), 0.0) for f in features(key[0])))
        # The most that each group can add to a name, from the weights.
        names = {f: x for (f, kind), x in w.items() if kind == "name"}
        top = lambda keys: max((names.get(k, 0.0) for k in keys), default=0.0)
        classes = {f.split("_", 1)[1] for f in names if f.startswith(("first_", "last_")) and "ends" not in f and "len" not in f} | {"other", "letter"}

        def beside(side: str) -> float:
            words = max(names.get(f"{side}_{g}", 0.0) + names.get(f"{side}_{g}_{c}", 0.0) + top(f"{side}_{g}_{c}_{x}" for x in ("c", "t", "u", "l", "m", "S", "join")) for g in ("s", ".") for c in classes)
            marks = names.get(f"{side}_mark", 0.0) + top(f for f in names if re.fullmatch(rf"{side}_(?:edge|handle|comma|mark.+)", f))
            return max(0.0, marks, words + max(0.0, top(f for f in names if f.startswith(f"{side}_is_"))))

        self.left, self.right = beside("left"), beside("right")
        #: The most the form can add, by shape and the classes of the first and the last word.
        self.best = _Memo(lambda x: max(self.form["form", x[0], cores, join, order, x[1], x[2]] for join in ("", "join", "e", "capital", "lines") for order in ("fore", "back") for cores in range(2, CORES + 1)))

    def total(self, groups: tuple, kind: str) -> float:
        return sum([self.other[g, kind] for g in groups])

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """The personal data of a text: ``(from, to, kind)``, in order and disjoint."""
        c = candidates(Text(text), self)
        return best_labelling([x[:3] for x in c], [x[4] if len(x) > 4 else self.total(x[3], x[2]) for x in c]) if c else []


_taggers: dict[int, Tagger] = {}


def _tagger(w: dict[tuple[str, str], float]) -> Tagger:
    """One tagger a worker process: what it remembers serves its later tasks."""
    key = hash(frozenset(w.items()))
    if key not in _taggers:
        _taggers.clear()
        _taggers[key] = Tagger(w)
    return _taggers[key]


def masked(text: str, found: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def detect(rows: DataFrame, id_col: str, text_col: str, mask: bool = False) -> DataFrame:
    """``(id, kinds)``, kinds being those that occur; with ``mask`` also ``(masked)``. One row per row of ``rows``.

    Without ``mask``, rows that hold nothing are left out.
    """
    ship(rows.sparkSession)
    w = weights()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = _tagger(w)
        for b in batches:
            ids, kinds, texts = [], [], []
            for i, t in zip(b["id"], b["text"], strict=True):
                got = tagger.spans(t) if t else []
                if got or mask:
                    ids.append(i), kinds.append(sorted({k for _, _, k in got})), texts.append(masked(t, got) if t else t)
            if not ids:
                continue
            yield pd.DataFrame({"id": pd.Series(ids, dtype="Int64"), "kinds": pd.Series(kinds, dtype=object)} | ({"masked": pd.Series(texts, dtype=object)} if mask else {}))

    return rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.lit(mask) | (F.col(text_col) != "")).mapInPandas(run, "id bigint, kinds array<string>" + ", masked string" * mask)


def found(main: DataFrame) -> DataFrame:
    """``(rid, field, kind)``: one row for each row, field and kind that occurs in it."""
    out = None
    for field in ("text", "factcheck_claimant"):
        one = detect(main, "rid", field).select(F.col("id").alias("rid"), F.lit(field).alias("field"), F.explode("kinds").alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()
