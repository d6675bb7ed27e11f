"""Language identification of words in code-switched text by a linear-chain CRF.

Every word gets features (its identity, prefixes, suffixes, letter n-grams, the languages whose
lexicon holds it); learned weights score each language, learned transitions score language
changes between neighbouring words, and forward-backward gives each word's language
probabilities.  A document's language is the one with the largest share of its letters.

Training sequences are cut from labelled documents: segments of different documents follow each
other, so the model sees switches at known places.  The labels come from the documents' own
``lang``; language, source and id are never inputs of a prediction.

A run of more than ``LONGEST`` letters is several neighbouring nodes, so every letter of a text without
spaces counts.  Null, empty and letterless texts: ``und`` with score 0.  Without a labelled row everything is
``und``.  Ties go to the language that sorts first.  Repeated rows get equal results.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from credlens.llm.common import held_out, kept, map_text

#: Labelled documents per language the model is fitted on at most, and words used of them.
MAX_PER_LANGUAGE = 300
MAX_TRAIN_WORDS = 120_000
BUCKETS = 1 << 15
LEXICON = 200
SEQUENCE, BATCH, EPOCHS = 48, 64, 12
#: Words of a long text are labelled in windows; marginals count in the middle only, the
#: neighbours on both sides are the context that the chain needs.
WINDOW, CONTEXT = 256, 32
REMEMBER = 400_000

#: Letters of one node of the chain: longer runs, as of scripts without spaces, are several nodes.
LONGEST = 40

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased, in pieces of at most ``LONGEST``.  Numerals such as ½ or Ⅷ are no letters."""
    out: list[str] = []
    for run in _WORD.findall(text.lower()) if text else ():
        if len(run) <= LONGEST and run.isalpha():
            out.append(run)
            continue
        for part in "".join(c if c.isalpha() else " " for c in run).split():
            out += [part[i:i + LONGEST] for i in range(0, len(part), LONGEST)]
    return out


def word_features(word: str, lexicon: dict[str, int], first: int) -> list[int]:
    """Feature numbers of a word; numbers below ``first`` are the lexicons of the languages."""
    w = word
    names = ["w" + w]
    for k in (1, 2, 3, 4):
        if len(w) >= k:
            names += [f"p{w[:k]}", f"s{w[-k:]}"]
    b = f"^{w}$"
    names += ["g" + b[i:i + 3] for i in range(len(b) - 2)]
    names += ["b" + w[i:i + 2] for i in range(len(w) - 1)]
    out = [first + zlib.crc32(n.encode()) % (BUCKETS - first) for n in names]
    if w in lexicon:
        out.append(lexicon[w])
    return out


@dataclass
class Crf:
    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray       # buckets x languages
    transitions: np.ndarray   # from x to, log scale

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp(score - max) of every word and language."""
        feats = [word_features(w, self.lexicon, len(self.languages)) for w in words]
        size = np.array([len(f) for f in feats])
        flat = np.fromiter((i for f in feats for i in f), np.int64, int(size.sum()))
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        score = np.add.reduceat(self.weights[flat], starts, axis=0) / np.sqrt(size)[:, None]
        return np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float32)


def forward_backward(e: np.ndarray, a: np.ndarray, pairs: np.ndarray | None = None,
                     lengths: np.ndarray | None = None) -> np.ndarray:
    """Marginals (sequences x words x languages) for emissions ``e`` and transition factors ``a``;
    ``pairs`` gets the expected number of each transition added; ``lengths`` tells padded sequences' ends."""
    n, t, k = e.shape
    shortest = t if lengths is None else int(lengths.min())
    alpha = np.empty_like(e)
    now = np.ones((n, k), e.dtype)
    for i in range(t):
        now = (now if i == 0 else now @ a) * e[:, i]
        now /= now.sum(axis=1, keepdims=True)
        alpha[:, i] = now
    beta = np.ones((n, k), e.dtype)
    back = a.T.copy()
    for i in range(t - 1, -1, -1):
        g = alpha[:, i] * beta
        alpha[:, i] = g / g.sum(axis=1, keepdims=True)
        ahead = e[:, i] * beta
        if pairs is not None and i:
            p = alpha[:, i - 1, :, None] * a * ahead[:, None, :]
            pairs += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta = ahead @ back
        beta /= beta.sum(axis=1, keepdims=True)
        if lengths is not None and i >= shortest:
            beta[lengths <= i] = 1.0  # padding tells nothing about the words before it
    return alpha


def fit(texts: list[str], langs: list[str], seed: int = 17) -> Crf | None:
    """Learn lexicons, feature weights and transitions from labelled whole texts."""
    names = sorted(set(langs))
    if not names:
        return None
    k, rng = len(names), np.random.default_rng(seed)
    code = {n: i for i, n in enumerate(names)}
    docs: list[list[list[str]]] = [[] for _ in names]
    for t, lang in zip(texts, langs, strict=True):
        if w := words_of(t):
            docs[code[lang]].append(w)
    if not any(docs):
        return None
    count = [Counter(w for d in own for w in d) for own in docs]
    total = [max(1, sum(c.values())) for c in count]
    lexicon = {}
    for i, c in enumerate(count):
        for w, n in c.most_common(LEXICON):
            if all(j == i or n / total[i] > 3 * count[j][w] / total[j] for j in range(k)):
                lexicon[w] = i
    # Sequences of one to four segments, each from a random document of a random language.
    able = [i for i in range(k) if docs[i]]
    seqs, labels = [], []
    for _ in range(max(1, min(MAX_TRAIN_WORDS, 200 * sum(len(d) for d in docs)) // SEQUENCE)):
        seq, lab = [], []
        parts = int(rng.integers(1, 5))
        while len(seq) < SEQUENCE:
            i = int(rng.choice(able))
            d = docs[i][int(rng.integers(len(docs[i])))]
            n = min(SEQUENCE - len(seq), max(4, SEQUENCE // parts))
            s = int(rng.integers(max(1, len(d) - n + 1)))
            got = d[s:s + n]
            seq += got
            lab += [i] * len(got)
        seqs.append(seq)
        labels.append(lab)
    index: dict[str, int] = {}
    at = np.array([[index.setdefault(w, len(index)) for w in s] for s in seqs])
    y = np.array(labels)
    feats = [word_features(w, lexicon, k) for w in index]
    size = np.array([len(f) for f in feats])
    flat, starts = np.concatenate([np.array(f) for f in feats]), np.concatenate([[0], np.cumsum(size)[:-1]])
    word_of = np.repeat(np.arange(len(size)), size)
    scale = 1 / np.sqrt(size)
    w = np.zeros((BUCKETS, k))
    trans = np.zeros((k, k))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(seqs))
        for b in range(0, len(order), BATCH):
            rows = order[b:b + BATCH]
            uniq, inv = np.unique(at[rows], return_inverse=True)
            inv = inv.reshape(len(rows), -1)
            pos = np.concatenate([np.arange(starts[u], starts[u] + size[u]) for u in uniq])
            loc = np.searchsorted(uniq, word_of[pos])
            f = flat[pos]
            score = np.zeros((len(uniq), k))
            for c in range(k):
                score[:, c] = np.bincount(loc, w[f, c], len(uniq)) * scale[uniq]
            e = np.exp(score - score.max(axis=1, keepdims=True))[inv]
            a = np.exp(trans)
            gt = np.zeros_like(trans)
            g = forward_backward(e, a, gt)
            # Expected minus observed counts: emissions from marginals, transitions from pairs.
            err = g.copy()
            np.put_along_axis(err, y[rows][..., None], np.take_along_axis(err, y[rows][..., None], 2) - 1, 2)
            grad_word = np.zeros((len(uniq), k))
            for c in range(k):
                grad_word[:, c] = np.bincount(inv.ravel(), err[..., c].ravel(), len(uniq)) * scale[uniq]
            gw = np.zeros_like(w)
            for c in range(k):
                gw[:, c] = np.bincount(f, grad_word[loc, c], BUCKETS)
            np.add.at(gt, (y[rows][:, :-1].ravel(), y[rows][:, 1:].ravel()), -1)
            step += 1
            for grad, p, m, v, l2 in ((gw / len(rows), w, state[0], state[1], 1e-5), (gt / len(rows), trans, state[2], state[3], 1e-3)):
                grad = grad + l2 * p
                m += 0.1 * (grad - m)
                v += 0.01 * (grad * grad - v)
                p -= 0.03 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return Crf(names, lexicon, w.astype(np.float32), trans.astype(np.float32))


class Tagger:
    """A model with the emissions of words met so far, bounded by ``REMEMBER``."""

    def __init__(self, model: Crf):
        self.model, self.known = model, {}
        self.table = np.zeros((1, len(model.languages)), np.float32)
        self.factors = np.exp(model.transitions).astype(np.float32)

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Language probabilities of every word of every document (lists of words)."""
        if len(self.known) > REMEMBER:
            self.known.clear()
            self.table = self.table[:1]
        new = list({w for d in docs for w in d} - self.known.keys())
        for i in range(0, len(new), 50_000):
            part = new[i:i + 50_000]
            base = len(self.table)
            self.table = np.concatenate([self.table, self.model.emissions(part)])
            self.known.update(zip(part, range(base, base + len(part)), strict=True))
        k = self.table.shape[1]
        flat = [np.fromiter(map(self.known.__getitem__, d), np.int64, len(d)) for d in docs]
        out = [np.zeros((len(d), k), np.float32) for d in docs]
        jobs = [(i, s) for i, d in enumerate(docs) for s in range(0, len(d), WINDOW)]
        jobs.sort(key=lambda j: min(len(docs[j[0]]), j[1] + WINDOW + CONTEXT) - max(0, j[1] - CONTEXT))
        for b in range(0, len(jobs), 1024):
            part = jobs[b:b + 1024]
            spans = [(i, max(0, s - CONTEXT), min(len(docs[i]), s + WINDOW + CONTEXT), s) for i, s in part]
            width = max(z - a for _, a, z, _ in spans)
            at = np.zeros((len(spans), width), np.int64)  # row 0 of the table: padding
            for r, (i, a, z, _) in enumerate(spans):
                at[r, :z - a] = flat[i][a:z]
            e = self.table[at]
            e[at == 0] = 1.0
            g = forward_backward(e, self.factors, lengths=np.array([z - a for _, a, z, _ in spans]))
            for r, (i, a, z, s) in enumerate(spans):
                stop = min(len(docs[i]), s + WINDOW)
                out[i][s:stop] = g[r, s - a:stop - a]
        return out


def tagger(model: Crf) -> Tagger:
    return kept("tagger", zlib.crc32(model.weights.tobytes()), lambda: Tagger(model))


def tag(text: str | None, model: Crf) -> list[tuple[str, str]]:
    """(word, language) of every word of a text."""
    words = words_of(text)
    if not words:
        return []
    best = tagger(model).marginals([words])[0].argmax(axis=1)
    return [(w, model.languages[i]) for w, i in zip(words, best, strict=True)]


def train(docs: DataFrame, per_language: int = MAX_PER_LANGUAGE) -> Crf | None:
    """Fit on at most ``per_language`` documents of each language, outside the held-out fifth.

    Spark keeps the first few of each language before it shuffles (ids and languages only);
    the bounded sample of ids is broadcast, so texts do not move."""
    w = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    ids = (docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
           .select("doc_id", "lang").withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_language)
           .select("doc_id").distinct())
    rows = docs.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()).toPandas()
    rows = rows.sort_values(["doc_id", "lang", "text"]).drop_duplicates("doc_id")
    return fit(list(rows["text"]), list(rows["lang"]))


OUT = "lang_pred string, score double, n_letter_words bigint, n_switches bigint"


def predict(df: DataFrame, model: Crf | None, text_col: str = "text", carry=("doc_id",), names=None) -> DataFrame:
    """Language of every whole text, its share of the letters, and changes of language inside."""
    def run(texts):
        out = {"lang_pred": [], "score": [], "n_letter_words": [], "n_switches": []}
        docs = [words_of(t) for t in texts]
        probs = tagger(model).marginals(docs) if model else [np.zeros((0, 1))] * len(docs)
        for d, p in zip(docs, probs, strict=True):
            if not len(p):
                row = ("und", 0.0, len(d), 0)
            else:
                size = np.fromiter(map(len, d), np.float64, len(d))
                share = size @ p / size.sum()
                best = int(share.argmax())
                row = (model.languages[best], min(1.0, float(share[best])), len(d), int((np.diff(p.argmax(axis=1)) != 0).sum()))
            for name, v in zip(out, row, strict=True):
                out[name].append(v)
        return out

    return map_text(df, run, OUT, text_col, carry, names)
