"""Language of texts and of their segments (problem 2): segmentation-marginalised unigrams.

Each language gives every piece of a fixed public vocabulary a probability. A word's probability is the sum over all ways
of segmenting it into pieces, worked out by a forward algorithm; pieces don't cross words, so a text's probability is the
product over its words and each distinct word of a batch is scored once. A text's sentences then form a chain whose
states are languages; changing language costs ``SWITCH`` nats, which names and borrowed words don't repay but sentences do.

Piece probabilities come from expected counts under the same forward sums (EM), on at most ``SAMPLE`` labelled texts of
each language, taken by the order of a hash. Labels are partly wrong, so each round first asks the model of the round before
which language a text has. The bound is a parameter; everything else covers all data.

Defined results
---------------
* null texts and texts without Latin letters have no segment and no language
* a language without labelled texts cannot be found; without any labels all texts are of the first language, confidence 0.2
* a segment's confidence is its language's posterior given its words alone, at equal priors
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import blank, folded_lower
from corpusmill.session import ship

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LANGS = ["pt", "es", "en", "fr", "it"]
# Codes and names by which labels name a language, without accents, in lower case.
NAMES = {
    "pt": ["pt", "por", "ptb", "portugues", "portuguese", "portugais", "portoghese"],
    "es": ["es", "spa", "esp", "espanol", "espanhol", "spanish", "castellano", "castelhano"],
    "en": ["en", "eng", "ing", "ingles", "english", "anglais", "inglese"],
    "fr": ["fr", "fra", "fre", "frances", "french", "francais", "francese"],
    "it": ["it", "ita", "italiano", "italian", "italien"],
}
SAMPLE, ROUNDS, SWITCH = 500, 3, 9.0
#: Words are scored together with words of like length: up to SHORT letters, twice that, and so on. Words of the fit are at most FITTED letters long.
SHORT, FITTED = 32, 128
#: Where a sentence may end. Numbers and abbreviations that part wrongly do no harm: the chain puts the parts together again.
_ENDS = re.compile(r"[.!?…;:|\n]+(?=[\s\"'”»)*_\]~]|$)|\n|\s[/—–•-]+\s|[“”«»()\[\]]")
_WORD = re.compile(r"[a-z]+")


def label_language(label: Column) -> Column:
    """The language a label names, null if it names none; country and spelling don't matter."""
    head = F.regexp_extract(folded_lower(label), r"^[^a-z]*([a-z]+)", 1)
    out = F.lit(None).cast("string")
    for lang, names in NAMES.items():
        out = F.when(head.isin(names), lang).otherwise(out)
    return F.when(blank(label), None).otherwise(out)


def load_pieces(path: str) -> dict[str, int]:
    """The vocabulary's pieces of letters a-z, a word's first piece marked by ``_``; single letters are added where missing."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[str, int] = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if re.fullmatch("▁?[a-z]+", p):
            pieces.setdefault(p.replace("▁", "_"), len(pieces))
    for c in "abcdefghijklmnopqrstuvwxyz":
        pieces.setdefault(c, len(pieces))
        pieces.setdefault("_" + c, len(pieces))
    return pieces


class Lattice:
    """All segmentations of a list of distinct words, as edges in the order of where they end."""

    def __init__(self, words: list[str], pieces: dict[str, int]):
        at, lo, hi, piece = [], [], [], []
        self.reach = max(map(len, pieces), default=1)
        for w, word in enumerate(words):
            marked = "_" + word
            n = len(marked)
            for j in range(2, n + 1):
                for i in range(max(0, j - self.reach), j):
                    if i == 1:
                        continue  # the mark alone is no piece
                    k = pieces.get(marked[i:j])
                    if k is not None:
                        at.append(w), lo.append(i), hi.append(j), piece.append(k)
        self.n, self.at, self.lo, self.hi, self.piece = len(words), np.array(at, int), np.array(lo, int), np.array(hi, int), np.array(piece, int)
        self.size = np.array([len(w) + 1 for w in words], int)
        self.longest = int(self.size.max()) if len(words) else 1
        order = np.argsort(self.hi, kind="stable")
        self.at, self.lo, self.hi, self.piece = self.at[order], self.lo[order], self.hi[order], self.piece[order]
        self.cut = np.searchsorted(self.hi, np.arange(self.longest + 3))

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """Forward sums ``[word, position, language]``; position 0 is 1."""
        a = np.zeros((self.n, self.longest + 1, prob.shape[1]))
        a[:, 0] = 1
        for j in range(1, self.longest + 1):
            s = slice(self.cut[j], self.cut[j + 1])
            if s.start < s.stop:
                np.add.at(a[:, j], self.at[s], a[self.at[s], self.lo[s]] * prob[self.piece[s]])
        return a

    def score(self, prob: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language. Sums of long words are scaled as they go, so that they don't vanish."""
        rows = np.arange(self.n)
        if self.longest <= FITTED:
            return np.log(self.forward(prob)[rows, self.size] + 1e-290)
        # Only the last ``reach`` positions are looked back at: they are kept in a ring and scaled together.
        ring = np.zeros((self.n, self.reach + 1, prob.shape[1]))
        ring[:, 0] = 1
        scale, out = np.zeros((self.n, prob.shape[1])), np.full((self.n, prob.shape[1]), np.log(1e-290))
        for j in range(1, self.longest + 1):
            here = j % (self.reach + 1)
            ring[:, here] = 0
            s = slice(self.cut[j], self.cut[j + 1])
            if s.start < s.stop:
                np.add.at(ring[:, here], self.at[s], ring[self.at[s], self.lo[s] % (self.reach + 1)] * prob[self.piece[s]])
            done = self.size == j
            if done.any():
                out[done] = np.log(ring[done, here] + 1e-290) + scale[done]
            if j % 8 == 0:
                top = ring.max(1)
                top[top <= 0] = 1
                ring /= top[:, None, :]
                scale += np.log(top)
        return out

    def counts(self, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected number of each piece, words weighted by ``weight[word, language]``."""
        a = self.forward(prob)
        total = a[np.arange(self.n), self.size]
        b = np.zeros_like(a)
        b[np.arange(self.n), self.size] = 1
        for j in range(self.longest, 0, -1):
            s = slice(self.cut[j], self.cut[j + 1])
            if s.start < s.stop:
                np.add.at(b, (self.at[s], self.lo[s]), b[self.at[s], j] * prob[self.piece[s]])
        gain = a[self.at, self.lo] * prob[self.piece] * b[self.at, self.hi] * (weight / (total + 1e-300))[self.at]
        out = np.zeros_like(prob)
        np.add.at(out, self.piece, gain)
        return out


def score_words(words: list[str], pieces: dict[str, int], prob: np.ndarray) -> np.ndarray:
    """Log probability of each distinct word in each language, words of like length together, so that one long word doesn't widen all."""
    out = np.zeros((len(words), prob.shape[1]))
    group = np.array([max(0, (len(w) - 1) // SHORT).bit_length() for w in words], int)
    for g in np.unique(group):
        which = np.flatnonzero(group == g)
        step = max(1, 20_000_000 // (SHORT << int(g)) // prob.shape[1])
        for k in range(0, len(which), step):
            part = which[k : k + step]
            out[part] = Lattice([words[i] for i in part], pieces).score(prob)
    return out


def fit(texts: list[str], labels: list[str], pieces: dict[str, int], rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities ``[piece, language]`` from texts without accents in lower case."""
    lists = [[w for w in _WORD.findall(t) if len(w) <= FITTED] for t in texts]
    vocab = sorted({w for x in lists for w in x})
    index = {w: i for i, w in enumerate(vocab)}
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    word = np.array([index[w] for x in lists for w in x], int)
    label = np.array([LANGS.index(x) for x in labels], int)
    prob = np.full((len(pieces), len(LANGS)), 1.0 / len(pieces))
    if not len(word):
        return prob
    lattice = Lattice(vocab, pieces)
    who = label
    for r in range(rounds + 1):
        if r:
            score = np.zeros((len(lists), len(LANGS)))
            np.add.at(score, doc, lattice.score(prob)[word])
            who = score.argmax(1)
        weight = np.zeros((len(vocab), len(LANGS)))
        np.add.at(weight, (word, who[doc]), 1)
        got = lattice.counts(prob, weight)
        # Each language backs off to all of them together, and those to even shares: unseen pieces cost alike.
        every = got.sum(1, keepdims=True) + 0.01
        every /= every.sum()
        prob = (got + 300 * every) / (got.sum(0, keepdims=True) + 300)
    return prob


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence that has any."""
    return [w for w in (_WORD.findall(s) for s in _ENDS.split(text)) if w]


def places(text: str, folded: str) -> list[tuple[int, int]]:
    """Where each sentence's words begin and end, in code points of ``text``, of which ``folded`` is the form without accents in lower case."""
    out, at = [], 0
    for m in [*_ENDS.finditer(folded), None]:
        words = list(_WORD.finditer(folded, at, m.start() if m else len(folded)))
        if words:
            out.append((words[0].start(), words[-1].end()))
        at = m.end() if m else at
    if len(text) != len(folded):
        # Letters with marks of their own, ligatures and the like change the length: each code point is folded by itself.
        owner = [i for i, c in enumerate(text) for x in unicodedata.normalize("NFD", c.lower()) if not unicodedata.combining(x)]
        if len(owner) != len(folded):
            owner = [i * len(text) // max(len(folded), 1) for i in range(len(folded))]
        out = [(owner[a], owner[b - 1] + 1) for a, b in out]
    return out


def _chain(score: np.ndarray) -> np.ndarray:
    """The most probable languages of a text's sentences, one row of log probabilities each."""
    best, back = score[0], []
    for row in score[1:]:
        k = int(best.argmax())
        stay = best >= best[k] - SWITCH
        back.append(np.where(stay, np.arange(len(best)), k))
        best = np.where(stay, best, best[k] - SWITCH) + row
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return np.array(path[::-1])


def segmenter(prob: np.ndarray, pieces: dict[str, int]):
    """The function that turns ``(id, text)`` batches, texts in folded form, into segments; where ``source``, the text as it is, is given, with their places."""
    cache: dict[str, np.ndarray] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, sizes, flat, counts = [], [], [], []
            for i, t in zip(b["id"], b["text"], strict=True):
                parts = sentences(t) if t else []
                if parts:
                    ids.append(i)
                    counts.append(len(parts))
                    for p in parts:
                        sizes.append(len(p))
                        flat += p
            if not ids:
                continue
            code, uniques = pd.factorize(np.array(flat, dtype=object))
            new = [w for w in uniques if w not in cache]
            if new:
                if len(cache) > 400_000:
                    cache.clear()
                    new = list(uniques)
                cache.update(zip(new, score_words(new, pieces, prob), strict=True))
            table = np.array([cache[w] for w in uniques])
            sizes, counts = np.array(sizes), np.array(counts)
            score = np.add.reduceat(table[code], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            first = np.concatenate([[0], np.cumsum(counts)[:-1]])
            lang = score.argmax(1)
            low, high = np.minimum.reduceat(lang, first), np.maximum.reduceat(lang, first)
            for k in np.flatnonzero(low != high):
                s = slice(first[k], first[k] + counts[k])
                lang[s] = _chain(score[s])
            # Neighbouring sentences of one language are one segment.
            owner = np.repeat(np.arange(len(ids)), counts)
            starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (lang[1:] != lang[:-1])]))
            total = np.add.reduceat(score, starts)
            p = np.exp(total - total.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            l = lang[starts]
            extra = {}
            if "source" in b:
                spans = [x for t, f in zip(b["source"], b["text"], strict=True) if f and sentences(f) for x in places(t, f)]
                ends = np.concatenate([starts[1:], [len(lang)]]) - 1
                extra = {"from": np.array([spans[i][0] for i in starts]), "to": np.array([spans[i][1] for i in ends])}
            yield pd.DataFrame(extra | {
                "id": np.array(ids)[owner[starts]], "segment": starts - first[owner[starts]], "lang": np.array(LANGS)[l], "confidence": p[np.arange(len(l)), l],
                "words": np.add.reduceat(sizes, starts), "sentences": np.diff(np.concatenate([starts, [len(lang)]])), "gain": total[np.arange(len(l)), l] - np.where(np.arange(len(LANGS)) == l[:, None], -np.inf, total).max(1),
            })

    return run


def train(main: DataFrame, provenance: DataFrame, sample: int = SAMPLE, vocabulary: str = VOCABULARY):
    """The segmenter fitted on at most ``sample`` labelled texts of each language."""
    labelled = provenance.select("rid", label_language(F.col("lang_variant")).alias("label")).where("label IS NOT NULL")
    picked = None
    for lang in LANGS:
        one = labelled.where(F.col("label") == lang).orderBy(F.xxhash64("rid"), "rid").limit(sample)
        picked = one if picked is None else picked.unionByName(one)
    # At most ``sample`` rows of each language: a bound known beforehand. Of several labels of a row the first by name counts.
    rows = main.select("rid", "text").join(F.broadcast(picked.groupBy("rid").agg(F.min("label").alias("label"))), "rid").select("rid", folded_lower(F.col("text")).alias("text"), "label").where("text IS NOT NULL").collect()
    rows.sort(key=lambda r: r["rid"])
    pieces = load_pieces(vocabulary)
    prob = fit([r["text"] for r in rows], [r["label"] for r in rows], pieces)
    return segmenter(prob, pieces)


def segments(main: DataFrame, provenance: DataFrame, with_places: bool = True) -> DataFrame:
    """``(id, segment, lang, confidence, words, sentences, gain)`` and ``from, to``: the segments of each text, numbered by their first sentence.

    ``gain`` is by how many nats the segment's language exceeds all others; the segment's words stand between ``from`` and ``to``, in code
    points of the text, the first being 0.
    """
    ship(main.sparkSession)
    run = train(main, provenance)
    told = "id bigint, segment int, lang string, confidence double, words int, sentences int, gain double"
    rows = main.select(F.col("rid").alias("id"), folded_lower(F.col("text")).alias("text"), *([F.col("text").alias("source")] if with_places else []))
    return rows.mapInPandas(run, "from int, to int, " + told if with_places else told)


def found(main: DataFrame, provenance: DataFrame) -> DataFrame:
    """``(rid, lang)``: the languages of each text whose label is missing or wrong, or that has several.

    A text's main language is that of the most words. Another counts beside it with a segment that gains at least ``APART`` over all others.
    """
    seg = segments(main, provenance, with_places=False).groupBy("id", "lang").agg(F.sum("words").alias("words"), F.max("gain").alias("gain"))
    label = provenance.select("rid", label_language(F.col("lang_variant")).alias("l")).groupBy("rid").agg(F.min("l").alias("l1"), F.max("l").alias("l2"), F.bool_or(F.col("l").isNull()).alias("none"))
    per = seg.groupBy(F.col("id").alias("rid")).agg(F.sort_array(F.collect_list(F.struct("words", "lang", "gain")), False).alias("ls"))  # at most one for each language
    lang = F.col("ls")[0]["lang"]
    per = per.withColumn("main", lang).withColumn("ls", F.filter("ls", lambda x: (x["lang"] == lang) | (x["gain"] >= APART)))
    case = (F.size("ls") > 1) | F.coalesce(F.col("none"), F.lit(True)) | (F.col("l1") != F.col("main")) | (F.col("l2") != F.col("main"))
    return per.join(label, "rid", "left").where(case).select("rid", F.explode("ls").alias("x")).select("rid", "x.lang")


#: Nats by which a segment's language must exceed all others to count as a second language of its text: names and borrowed words don't gain as much.
APART = 12.0
