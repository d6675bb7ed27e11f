"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans (e-mail, IPv4, payment card with Luhn check, international
phone).  The network is trained in numpy on labelled spans: those of a bounded sample of
documents, as they stand and rewritten in the ways people disguise them (``name [at] host [dot]
tld``, ``1[.]2[.]3[.]4``, cards with dots, phones without the plus sign), half of the addresses with
made-up names and hosts of any length.  Texts are read in overlapping windows.  The windows of a text are
reconciled globally: a place's tag scores are the mean over the windows that hold it, those
near a window's edge weighing little, and windows that touch are decoded as one lattice by one Viterbi
pass, so a span of any length is found whole wherever it lies.  What the patterns did not find
already and what passes the check of its kind is added; base spans always stay.

A span of any kind holds a digit, an at sign or a bracketed "at", so a window without one
has no span and is not computed.  All windows of a text are looked at, never a prefix.

Null and empty texts have no spans (digest of the empty string); long texts are decoded whole.  Without
any labelled span the network adds nothing.  Repeated rows get equal results; of spans with one start (ties)
the kinds come as listed.  An empty table gives no row.  Only the id and the text are read, so extra
columns, whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credlens.llm.common import bounded_sample, kept, map_text

KINDS = ("email", "ip", "card", "phone")
#: Documents the network is trained on at most, labelled spans used of them, and their windows.
MAX_DOCUMENTS, MAX_SPANS = 1000, 900
#: Characters of lattices decoded together.
LATTICE = 400_000
WINDOW, STRIDE = 96, 48
HIDDEN, STEPS, BATCH, RATE = 16, 600, 64, 0.02
CHARS = 128
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({] ?[aA][tT] ?[\])}]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_HOST_CHARS = _LOCAL_CHARS - frozenset("._%+")
_DIGITS = frozenset("0123456789")

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by start, then kind."""
    out: list[Span] = []
    at, stop = text.find("@"), 0
    while at >= 0:
        # A match starts where the run of local characters before the sign starts.
        a = at
        while a > stop and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end(), 0))
            stop = m.end()
        at = text.find("@", max(at + 1, stop))
    if _DIGIT.search(text):
        out += [(*m.span(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = _digits(m[0])
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((*m.span(), 2))
        if "+" in text:
            out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
        out.sort(key=lambda s: (s[0], s[2]))
    return out


# --- the network --------------------------------------------------------------------------------
def char_ids(text: str) -> np.ndarray:
    """ASCII as it is, 1 for any other character; 0 pads."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(a < CHARS, np.maximum(a, 2), 1).astype(np.uint8)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Per direction: input table (chars x 4H), recurrent matrix (H x 4H); output layer; transitions."""
    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 3) -> Network:
        r, h = np.random.default_rng(seed), HIDDEN
        p = {}
        for d in "fb":
            p["w" + d] = r.normal(0, 0.3, (CHARS, 4 * h))
            p["w" + d][:, h:2 * h] += 0.5  # remember by default
            p["u" + d] = r.normal(0, 0.2, (h, 4 * h))
        p["o"] = r.normal(0, 0.2, (2 * h, TAGS))
        p["c"] = np.zeros(TAGS)
        p["t"] = np.zeros((TAGS, TAGS))
        return cls(p)

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        h = HIDDEN
        w, u = self.p["w" + d], self.p["u" + d]
        n, t = x.shape
        out = np.empty((n, t, h), w.dtype)
        hid, cell = np.zeros((n, h), w.dtype), np.zeros((n, h), w.dtype)
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = w[x[:, k]] + hid @ u
            s = _sigmoid(z[:, :3 * h])
            g = np.tanh(z[:, 3 * h:])
            old_h, old_c = hid, cell
            cell = s[:, h:2 * h] * cell + s[:, :h] * g
            tc = np.tanh(cell)
            hid = s[:, 2 * h:] * tc
            out[:, k] = hid
            if keep is not None:
                keep.append((k, s, g, old_h, old_c, tc))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, "f"), self._run(x, "b")], axis=2)
        return both @ self.p["o"] + self.p["c"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags and its gradient."""
        p, h, (n, t) = self.p, HIDDEN, x.shape
        kept = {"f": [], "b": []}
        hid = np.concatenate([self._run(x, d, kept[d]) for d in "fb"], axis=2)
        e = hid @ p["o"] + p["c"]
        loss, de, dt = crf_gradients(e, p["t"], y)
        g = {"t": dt, "c": de.sum((0, 1)), "o": hid.reshape(-1, 2 * h).T @ de.reshape(-1, TAGS)}
        dh_all = de @ p["o"].T
        for d, part in (("f", dh_all[..., :h]), ("b", dh_all[..., h:])):
            u = p["u" + d]
            gw, gu = np.zeros_like(p["w" + d]), np.zeros_like(u)
            dh, dc = np.zeros((n, h)), np.zeros((n, h))
            for k, s, gate, old_h, old_c, tc in reversed(kept[d]):
                dh = dh + part[:, k]
                i, f, o = s[:, :h], s[:, h:2 * h], s[:, 2 * h:]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gate * i * (1 - i), dc * old_c * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - gate * gate)], axis=1)
                np.add.at(gw, x[:, k], dz)
                gu += old_h.T @ dz
                dh, dc = dz @ u.T, dc * f
            g["w" + d], g["u" + d] = gw, gu
        return loss, g


def _lse(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradients(e: np.ndarray, trans: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss of a linear-chain CRF and its gradients by emissions and transitions."""
    n, t, k = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0]
    for i in range(1, t):
        alpha[:, i] = e[:, i] + _lse(alpha[:, i - 1, :, None] + trans, 1)
    for i in range(t - 2, -1, -1):
        beta[:, i] = _lse(trans + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
    z = _lse(alpha[:, -1], 1)
    marg = np.exp(alpha + beta - z[:, None, None])
    pair = np.zeros((k, k))
    for i in range(1, t):
        pair += np.exp(alpha[:, i - 1, :, None] + trans + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]).sum(0)
    rows = np.arange(n)[:, None]
    gold = e[rows, np.arange(t), y].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
    marg[rows, np.arange(t), y] -= 1
    np.add.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
    return float((z - gold).mean()), marg / n, pair / n


def viterbi(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of every window."""
    n, t, k = e.shape
    back = np.zeros((n, t, k), np.int8)
    best = e[:, 0]
    for i in range(1, t):
        s = best[:, :, None] + trans
        back[:, i] = s.argmax(axis=1)
        best = np.take_along_axis(s, back[:, i][:, None, :].astype(np.int64), 1)[:, 0] + e[:, i]
    out = np.empty((n, t), np.int8)
    out[:, -1] = best.argmax(axis=1)
    rows = np.arange(n)
    for i in range(t - 1, 0, -1):
        out[:, i - 1] = back[rows, i, out[:, i]]
    return out


def lattice(parts: list[tuple[int, np.ndarray]], length: int) -> np.ndarray:
    """Mean tag scores of ``length`` places from windows (start, scores); near its edges a window weighs little."""
    total, weight = np.zeros((length, TAGS), np.float32), np.zeros((length, 1), np.float32)
    for start, e in parts:
        n = min(len(e), length - start)
        place = np.arange(1, len(e) + 1, dtype=np.float32)
        w = np.minimum(place, place[::-1])[:n, None]
        total[start:start + n] += w * e[:n]
        weight[start:start + n] += w
    return total / weight


def viterbi_all(lattices: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Best tags of lattices of different lengths; those of like length are decoded together."""
    out: list = [None] * len(lattices)
    order = sorted(range(len(lattices)), key=lambda i: len(lattices[i]))
    at = 0
    while at < len(order):
        end, longest = at, 0
        while end < len(order) and (end == at or len(lattices[order[end]]) * (end - at + 1) <= LATTICE):
            longest = len(lattices[order[end]])
            end += 1
        # behind a lattice's end only "outside" is possible
        e = np.full((end - at, longest, TAGS), -1e6, np.float32)
        e[:, :, 0] = 0.0
        for r, i in enumerate(order[at:end]):
            e[r, :len(lattices[i])] = lattices[i]
        for r, (i, tags) in enumerate(zip(order[at:end], viterbi(e, trans), strict=True)):
            out[i] = tags[:len(lattices[i])]
        at = end
    return out


def tags_of(length: int, spans: list[Span], start: int = 0) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for a, b, kind in spans:
        a, b = a - start, b - start
        if b <= 0 or a >= length:
            continue
        y[max(a, 0):min(b, length)] = 2 + 2 * kind
        if a >= 0:
            y[a] = 1 + 2 * kind
    return y


def spans_of(tags: np.ndarray) -> list[Span]:
    """Runs of one kind; a begin tag starts a new one."""
    out, a, kind = [], 0, -1
    for i, t in enumerate(tags.tolist() + [0]):
        k = (t - 1) // 2 if t else -1
        if k != kind or (t and t % 2 and i > a):
            if kind >= 0:
                out.append((a, i, kind))
            a, kind = i, k
    return out


# --- labelled spans -----------------------------------------------------------------------------
def disguise(value: str, kind: int, rng: np.random.Generator) -> str:
    """A value the way people write it to slip past patterns."""
    form = int(rng.integers(3))
    if kind == 0:
        local, _, host = value.partition("@")
        bracket = ("[{}]", "({})", "{{{}}}")[form]
        gap, dots = (("", " ")[int(rng.integers(2))] for _ in range(2))
        dot = (".", bracket.format("dot"), dots + bracket.format("dot") + dots)[int(rng.integers(3))]
        return local + gap + bracket.format("at") + gap + host.replace(".", dot)
    if kind == 1:
        return value.replace(".", ("[.]", " . ", "(.)")[form])
    if kind == 2:
        d = _digits(value)
        return (".", "/", "_")[form].join(d[i:i + 4] for i in range(0, len(d), 4))
    d = _digits(value)[-10:].rjust(10, "5")
    return (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[form]


_LETTERS = np.array(list("eeeeaaaiioourrnnttsslldcmphgbfvkjwyzxq"))


def made_up(rng: np.random.Generator) -> str:
    """An address with a name and a host of random length, with or without digits."""
    def word(low, high):
        return "".join(rng.choice(_LETTERS, int(rng.integers(low, high))))

    local = (".", ".", "-", "_")[int(rng.integers(4))].join(word(2, 20) for _ in range(int(rng.integers(1, 4))))
    if rng.random() < 0.3:
        local += str(int(rng.integers(0, 2000)))
    labels = ["-".join(word(2, 12) for _ in range(int(rng.integers(1, 3)))) for _ in range(int(rng.integers(1, 6)))]
    return f"{local}@{'.'.join(labels)}.{word(2, 5)}"


def example(text: str, span: Span, hidden: bool, rng: np.random.Generator) -> tuple[str, list[Span], int]:
    """(whole text, its spans, start of a window that meets the span): a span as it stands or disguised."""
    a, b, kind = span
    lo = max(0, a - 2 * WINDOW)
    if not hidden:
        whole, spans = text, [(p + lo, q + lo, k) for p, q, k in base_spans(text[lo:b + 2 * WINDOW])]
        at, size = a, b - a
    else:
        value = made_up(rng) if kind == 0 and rng.random() < 0.6 else text[a:b]
        value = disguise(value, kind, rng)
        before, after = (re.sub(r"[0-9@+]", "x", t) for t in (text[lo:a], text[b:b + 2 * WINDOW]))
        whole, at, size = before + value + after, len(before), len(value)
        spans = [(at, at + size, kind)]
    # the window may cut the span at either side
    start = int(rng.integers(max(0, at - WINDOW + 8), max(1, at + size - 8) + 1))
    return whole, spans, max(0, min(start, len(whole) - 1))


def fit(texts: list[str], seed: int = 11) -> Network | None:
    """Train on windows around the labelled spans of whole texts and on windows without any."""
    rng = np.random.default_rng(seed)
    found = [(t, s) for t in texts for s in base_spans(t)]
    if not found:
        return None
    order = rng.permutation(len(found))[:MAX_SPANS].tolist()
    xs, ys = [], []

    def add(text, spans, start):
        part = text[start:start + WINDOW]
        x = np.zeros(WINDOW, np.uint8)
        x[:len(part)] = char_ids(part)
        xs.append(x)
        ys.append(tags_of(WINDOW, spans, start))

    for hidden in (False, True, True, True):
        for i in order:
            add(*example(*found[i], hidden, rng))
    addresses = [f for f in found if f[1][2] == 0] or found
    for i in rng.integers(0, len(addresses), MAX_SPANS).tolist():  # addresses of every length and place
        text, (a, b, _) = addresses[i]
        add(*example(text, (a, b, 0), True, rng))
    for text in texts:  # digits that are no personal data, and plain prose
        places = [m.start() for m in _TRIGGER.finditer(text)] or [0]
        add(text, base_spans(text), max(0, int(rng.choice(places)) - int(rng.integers(WINDOW))))
    x, y = np.array(xs), np.array(ys)
    net = Network.new()
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(a) for k, a in net.p.items()}
    for step in range(1, STEPS + 1):
        rows = rng.integers(0, len(x), BATCH)
        _, g = net.gradients(x[rows].astype(np.int64), y[rows])
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        rate = RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1)))
        for k, a in g.items():
            a = a * min(1.0, 5.0 / (norm + 1e-9))
            m[k] += 0.1 * (a - m[k])
            v[k] += 0.01 * (a * a - v[k])
            net.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return Network({k: a.astype(np.float32) for k, a in net.p.items()})


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Network | None:
    """Fit on at most ``MAX_DOCUMENTS`` documents that hold a digit or an at sign.

    Ids alone are ordered for the choice; the chosen ones are broadcast, so only the sample's
    texts reach the driver."""
    ids = bounded_sample(docs.where(F.col(text_col).rlike("[0-9@]") & F.col(id_col).isNotNull()).select(id_col), MAX_DOCUMENTS, id_col)
    rows = docs.select(id_col, text_col).where(F.col(text_col).rlike("[0-9@]")).join(F.broadcast(ids.distinct()), id_col)
    return fit(sorted(r[1] for r in rows.dropDuplicates([id_col]).collect()))


# --- decoding whole texts -----------------------------------------------------------------------
_AT = re.compile(r"\s?[\[({] ?at ?[\])}]\s?", re.I)
_DOT = re.compile(r"\s?[\[({] ?(?:dot|\.) ?[\])}]\s?", re.I)
_LOOSE_PHONE = re.compile(r"(?:\+|00)?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}")


def plausible(value: str, kind: int) -> bool:
    """Is a decoded value one of its kind, once a disguise is taken off?"""
    if kind == 0:
        return [s[:2] for s in base_spans(_DOT.sub(".", _AT.sub("@", value))) if s[2] == 0] == [
            (0, len(_DOT.sub(".", _AT.sub("@", value))))]
    if kind == 1:
        parts = re.sub(r"\s*[\[(]?\s*\.\s*[\])]?\s*", ".", value).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    d = _digits(value)
    if kind == 2:
        return 12 <= len(d) <= 19 and luhn(d) and re.fullmatch(r"[0-9](?:[ ./_-]{0,2}[0-9])+", value) is not None
    return 9 <= len(d) <= 15 and _LOOSE_PHONE.fullmatch(value) is not None


def decode(texts: list[str], net: Network | None, at_once: int = 2048) -> list[list[Span]]:
    """Spans of the network for whole texts: windows that touch are one lattice."""
    jobs, arrays, runs = [], [], []  # runs: (text, first window, windows)
    for i, t in enumerate(texts):
        places = {m.start() // STRIDE for m in _TRIGGER.finditer(t)} if net else ()
        arrays.append(char_ids(t) if places else None)
        # a window before and one behind those that hold a trigger: the ends of a long span
        for k in sorted({w for p in places for w in (p - 2, p - 1, p, p + 1) if w >= 0 and w * STRIDE < len(t)}):
            if runs and runs[-1][0] == i and runs[-1][1] + runs[-1][2] == k:
                runs[-1][2] += 1
            else:
                runs.append([i, k, 1])
            jobs.append((i, k * STRIDE))
    scores = []
    for b in range(0, len(jobs), at_once):
        part = jobs[b:b + at_once]
        x = np.zeros((len(part), WINDOW), np.uint8)
        for r, (i, s) in enumerate(part):
            own = arrays[i][s:s + WINDOW]
            x[r, :len(own)] = own
        scores += list(net.emissions(x))
    at, lattices = 0, []
    for i, first, n in runs:
        length = min((n - 1) * STRIDE + WINDOW, len(arrays[i]) - first * STRIDE)
        lattices.append(lattice([(j * STRIDE, scores[at + j]) for j in range(n)], length))
        at += n
    found: list[list[Span]] = [[] for _ in texts]
    for (i, first, _), tags in zip(runs, viterbi_all(lattices, net.p["t"]) if runs else (), strict=True):
        if tags.any():
            found[i] += [(first * STRIDE + a, first * STRIDE + e, kind) for a, e, kind in spans_of(tags)]
    return found


def added_spans(text: str, base: list[Span], decoded: list[Span]) -> list[Span]:
    """Decoded spans that no base span touches and that pass the check of their kind, or else of another."""
    out = []
    for a, b, kind in decoded:
        while a < b and text[a].isspace():
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
            b -= 1
        # no part of a word or number stays outside
        left, right = (_LOCAL_CHARS, _HOST_CHARS) if kind == 0 else (_DIGITS, _DIGITS)
        while 0 < a < b and text[a - 1] in left:
            a -= 1
        while a < b < len(text) and text[b] in right:
            b += 1
        if any(a < q and p < b for p, q, _ in base):
            continue
        # a card in dots may look like an address to the network: the checks tell the kind
        kind = next((k for k in (kind, *range(len(KINDS))) if plausible(text[a:b], k)), None)
        if kind is not None:
            out.append((a, b, kind))
    return out


def _join(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


def _shared(net: Network | None) -> Network | None:
    """One copy of the weights per worker process."""
    if net is None:
        return None
    return kept("net", zlib.crc32(b"".join(a.tobytes() for a in net.p.values())), lambda: net)


OUT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def find(df: DataFrame, net: Network | None, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """Base and added spans of every whole text; one pass, no shuffle."""
    def run(texts):
        texts = [t or "" for t in texts]
        out: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": [], "n_added": []}
        for t, decoded in zip(texts, decode(texts, _shared(net)), strict=True):
            base = base_spans(t)
            more = added_spans(t, base, decoded)
            for i, k in enumerate(KINDS):
                out[f"n_{k}"].append(sum(s[2] == i for s in base))
            out["base_sha256"].append(hashlib.sha256(_join(base).encode()).hexdigest())
            out["spans"].append(_join(base + more))
            out["n_added"].append(len(more))
        return out

    return map_text(df, run, OUT, text_col, carry)


def redact(df: DataFrame, net: Network | None, out_col: str, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """``out_col``: every text with its spans replaced by ``[EMAIL]`` and so on; null stays null."""
    def run(texts):
        whole = [t or "" for t in texts]
        out = []
        for t, decoded in zip(whole, decode(whole, _shared(net)), strict=True):
            base = base_spans(t)
            spans, parts, at = sorted(base + added_spans(t, base, decoded)), [], 0
            for a, b, kind in spans:
                if a >= at:
                    parts += [t[at:a], f"[{KINDS[kind].upper()}]"]
                at = max(at, b)
            out.append("".join([*parts, t[at:]]))
        return {out_col: [None if t is None else x for t, x in zip(texts, out, strict=True)]}

    return map_text(df, run, f"{out_col} string", text_col, carry)
