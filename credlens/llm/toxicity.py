"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are lower-cased, homoglyphs and full-width forms are folded to Latin letters and digits
or signs that stand for letters inside a word are read as those letters.  A lexicon of whole
words and word beginnings, each with a weight, is matched by one Aho-Corasick automaton;
matches inside an exception phrase do not count.  The weighted matches, normalised by text
length, give the score through a logistic curve.

The lexicon is learned: for a bounded sample of labelled rows the rate of every
word and word beginning is compared between toxic and other texts; entries are taken by
their evidence, leaving out what an earlier entry already explains.  Words that begin like an entry
but are known from clean texts only become exceptions.

Null and empty texts match nothing and get the score of zero matches.  With no labelled rows,
or one class only, the lexicon is ``SEEDS`` with fixed curve parameters.  Repeated rows get equal
scores; rows of ``labels`` with null ids or null marks are ignored; of several marks for one id
the largest holds.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlens.llm.common import bounded_sample, held_out, kept, map_text

#: Labelled rows the lexicon is fitted on at most.
MAX_LABELLED = 3000
MAX_ENTRIES = 400
#: Evidence is divided by (1 + words / 100) to this power.
LENGTH_POWER = 0.25
#: An entry occurs in so many toxic texts, in such a share of them, and is so much (e^) more frequent there.
MIN_SUPPORT, MIN_SHARE, MIN_WEIGHT = 4, 0.02, 2.3
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clownfish", "scum line", "pond scum",
              "sore loser rule", "stupid question")
#: Used where nothing can be learned.
SEEDS = {"idiot": 4.0, "moron": 4.0, "stupid": 3.0, "pathetic": 3.0, "worthless": 3.0, "scum": 4.0,
         "loser": 3.0, "disgusting": 3.0, "trash": 2.5, "clown": 2.0}

#: Look-alike letters, by what they look like.
LOOKALIKES = {"a": "аαɑ", "b": "ьƅ", "c": "сϲ", "e": "еεҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "ј", "k": "кκ",
              "l": "ӏⅼ", "m": "мⅿ", "n": "пո", "o": "оοօ", "p": "рρ", "r": "г", "s": "ѕ", "t": "тτ", "u": "υս",
              "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ"}
#: Digits and signs written for letters inside a word.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_FOLD = {ord(c): latin for latin, cs in LOOKALIKES.items() for c in cs}
_FOLD |= {c: unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF01, 0xFF5F)}  # full-width forms
_FOLD |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}  # invisible characters
_ODD = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
_LEET = re.compile(r"(?<=[^\W\d_])[013457@$!|8]+(?=[^\W\d_])|(?<![\w@$!|.+-])[013457@$]{1,2}(?=[^\W\d_][^\W_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """Lower case, look-alikes as Latin letters, digit substitutions read as letters."""
    t = (text or "").lower()
    if not t.isascii() and _ODD.search(t):
        t = unicodedata.normalize("NFC", t.translate(_FOLD))
    return _LEET.sub(lambda m: "".join(LEET[c] for c in m[0]), t)


@dataclass
class Lexicon:
    """``entries``: (pattern, whole word?, weight); score = 1 / (1 + exp(-(bias + evidence)))."""
    entries: list[tuple[str, bool, float]]
    exceptions: list[str] = field(default_factory=lambda: list(EXCEPTIONS))
    bias: float = -2.0

    def matcher(self, numbered: bool = False):
        """The automaton; ``numbered``: matches carry the entry's place instead of its weight."""
        import ahocorasick
        a = ahocorasick.Automaton()
        for k, (word, whole, weight) in enumerate(self.entries):
            a.add_word(word, (len(word), whole, float(k) if numbered else weight))
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), None, 0.0))
        a.make_automaton()
        return a


def matches(text: str | None, automaton) -> tuple[list[float], float]:
    """(values of the lexicon words found, length normaliser (1 + words / 100) ** LENGTH_POWER)."""
    t = fold(text)
    hits, safe, n = [], [], len(t)
    for end, (size, whole, value) in automaton.iter(t) if t else ():
        a, b = end - size + 1, end + 1
        if a and t[a - 1].isalnum() or (whole is not False and b < n and t[b].isalnum()):
            continue  # entries start at a word's start; whole words and phrases end at its end
        if whole is None:
            safe.append((a, b))
        else:
            hits.append((a, b, value))
    found = {a: value for a, b, value in hits if not any(x <= a and b <= y for x, y in safe)}  # one per word: the longest
    return list(found.values()), (1 + t.count(" ") / 100) ** LENGTH_POWER


def evidence(text: str | None, automaton) -> float:
    """Weighted matches, normalised by length."""
    found, norm = matches(text, automaton)
    return sum(found) / norm


def _units(text: str, shortest: int = 4, longest: int = 8) -> tuple[Counter, Counter]:
    """Occurrences of every word and of every word beginning."""
    words = Counter(_WORD.findall(fold(text)))
    begins: Counter = Counter()
    for w, c in words.items():
        for k in range(shortest, min(longest, len(w)) + 1):
            begins[w[:k]] += c
    return words, begins


def fit(texts: list[str | None], labels: list[int], max_entries: int = MAX_ENTRIES) -> Lexicon:
    """Learn entries, weights, exceptions and the curve from labelled texts."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Lexicon([(w, True, s) for w, s in SEEDS.items()])
    n_toxic = y.sum()
    seen = ({True: Counter(), False: Counter()}, {True: Counter(), False: Counter()})  # [toxic][whole]
    support = {True: Counter(), False: Counter()}  # toxic texts that hold it
    n_words = [1.0, 1.0]
    for t, lab in sorted(zip(texts, labels, strict=True), key=lambda r: -r[1]):  # toxic texts first
        words, begins = _units(t or "")
        n_words[int(lab)] += sum(words.values())
        seen[int(lab)][True].update(words)
        seen[int(lab)][False].update(begins if lab else {b: c for b, c in begins.items() if b in seen[1][False]})
        if lab:
            support[True].update(words.keys())
            support[False].update(begins.keys())

    def weight(w, whole):  # log ratio of the rates per word
        return (math.log((seen[1][whole][w] + 0.5) / n_words[1]) - math.log((seen[0][whole][w] + 0.5) / n_words[0]))

    least = max(MIN_SUPPORT, MIN_SHARE * n_toxic)
    able = {(w, whole): weight(w, whole) for whole in (True, False) for w, c in support[whole].items()
            if c >= least and len(w) >= 3}
    able = {k: v for k, v in able.items() if v > MIN_WEIGHT}
    # Best evidence first (weight x toxic texts); with equal evidence the narrower entry: a whole
    # word, then the longer beginning.  A unit mostly explained by an earlier one is left out.
    chosen: list[tuple[str, bool]] = []
    taken: Counter = Counter()  # occurrences of a beginning inside chosen units
    for k in sorted(able, key=lambda k: (round(able[k] * support[k[1]][k[0]], 9), k[1], len(k[0]), k[0]), reverse=True):
        w, whole = k
        if len(chosen) == max_entries:
            break
        if any(not c[1] and w.startswith(c[0]) for c in chosen) or taken[w] >= 0.8 * seen[1][whole][w]:
            continue
        chosen.append(k)
        for n in range(1, len(w) + 1):
            taken[w[:n]] += seen[1][whole][w]
    entries = [(w, whole, 1.0) for w, whole in sorted(chosen)]
    begins = [w for w, whole, _ in entries if not whole]
    safe = sorted(w for w, c in seen[0][True].items() if c >= 4 and not seen[1][True][w]
                  and any(w.startswith(b) for b in begins))
    lexicon = Lexicon(entries, list(EXCEPTIONS) + safe)
    automaton = lexicon.matcher(numbered=True)
    x = np.zeros((len(texts), len(entries)))
    for i, t in enumerate(texts):
        found, norm = matches(t, automaton)
        for k in found:
            x[i, int(k)] += 1 / norm
    prior = np.array([able[k] for k in sorted(chosen)])
    w, bias = _weights(x, y, prior)
    strong = np.flatnonzero(w > 0.1 * w.max(initial=0.0))
    w, bias = _weights(x[:, strong], y, prior[strong], pull=1e-5)  # the entries that stay, hardly held back
    lexicon.entries = [(*entries[k][:2], float(v)) for k, v in zip(strong, w, strict=True)]
    lexicon.bias = bias
    return lexicon


def _weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray, pull: float = 2e-4, steps: int = 1500) -> tuple[np.ndarray, float]:
    """Non-negative logistic regression by Adam; entries with a higher rate ratio are pulled less to 0."""
    n, d = x.shape
    w, b = np.full(d, 0.5), -2.0
    cost = pull * (prior.max(initial=1.0) / np.maximum(prior, 1e-9)) ** 2
    m, v = np.zeros(d + 1), np.zeros(d + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        g = np.append(x.T @ (p - y) / n + cost, (p - y).mean())  # a constant pull thins the lexicon out
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = np.maximum(w - step[:-1], 0.0), b - step[-1]
    return np.minimum(w, 12.0), float(b)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Lexicon:
    """Fit on at most ``max_labelled`` labelled rows outside the held-out fifth.

    Only that bounded sample reaches the driver; its ids are broadcast, so documents do not
    shuffle."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = F.broadcast(bounded_sample(marks, max_labelled))
    # Copies of an id give the same row: one of them is enough.
    rows = docs.select("doc_id", "text").join(picked, "doc_id").toPandas().drop_duplicates("doc_id")
    rows = rows.sort_values("doc_id")
    return fit([t if isinstance(t, str) else "" for t in rows["text"]], [int(v > 0) for v in rows["toxic"]])


def score_text(df: DataFrame, lexicon: Lexicon, text_col: str = "text", carry=("doc_id",), names=None) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` for every whole text; one pass, no shuffle."""
    key = str(hash((tuple(lexicon.entries), tuple(lexicon.exceptions))))

    def run(texts):
        matcher = kept("matcher", key, lexicon.matcher)
        x = np.array([evidence(t, matcher) for t in texts])
        p = 1 / (1 + np.exp(-np.clip(lexicon.bias + x, -30, 30)))
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32), "evidence": x}

    return map_text(df, run, "score double, predicted int, evidence double", text_col, carry, names)
