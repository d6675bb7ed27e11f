"""BPE encoding and decoding with public tokenizer files, by tree concatenation.

Encoding whole texts repeats the same words over and over, and one long text occupies one
core.  Here a long text is cut into a binary tree of halves; its leaves are encoded in
parallel, on any executor, and neighbours are joined bottom-up.  Around each join a window is
encoded again and grows on both sides until its outer tokens agree exactly with the tokens of
both halves; the inner tokens then replace those at the join.  The result equals the
library's encoding of the whole text.

Leaves are encoded through :class:`Encoder`, which asks the tokenizers library once per
distinct pre-token (told apart by 64-bit hashes) and concatenates; that is exact because neither
vocabulary merges across the border of a pre-token.

Null and empty texts have no tokens (decoded: empty).  Repeated rows and ids are encoded row
by row; nothing is truncated, padded or dropped.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credlens.llm.common import arrow_schema, chunks, kept, map_text, prepare, schema_of, tokenizer

#: Pre-tokens an encoder remembers; above it the memory is emptied and filled anew.
REMEMBER = 1_200_000
#: Bytes of the longest pre-token that is remembered; texts with longer ones go the slow way.
LONGEST = 64
#: Characters in a leaf of the tree.
LEAF = 16_384
#: Longer texts are dealt out to several tasks, in parts of so many characters.
SPREAD = 65_536

_BETWEEN_SPACES = re.compile(r"\s \s|\s \Z")
_SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

# Byte classes of plain texts (ASCII and the accented letters of Latin-1): white space, letter,
# digit, other, border between texts.
_SPACE, _LETTER, _DIGIT, _OTHER, _BORDER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[0xFF] = _BORDER
#: Tabulation hashing: a random number for each place in a pre-token and byte value there.
_TABLE = np.random.default_rng(20_24).integers(1, 1 << 63, (LONGEST, 256), np.uint64, endpoint=True)


class _Memory:
    """Open-addressing table from 64-bit hashes to id lists, all in flat arrays."""

    def __init__(self, dtype: str, entries: int):
        self.bits = max(10, (2 * entries).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)  # 0: empty
        self.value = np.zeros(1 << self.bits, np.int32)
        self.n, self.used = 0, 0
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.flat = np.zeros(4096, dtype)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if unknown."""
        mask = np.int64((1 << self.bits) - 1)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        key = self.keys[slot]
        out = self.value[slot]
        out[key == 0] = -1
        open_ = np.flatnonzero((key != h) & (key != 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & mask
            key, want = self.keys[slot], h[open_]
            out[open_] = np.where(key == want, self.value[slot], -1)
            go = (key != want) & (key != 0)
            open_, slot = open_[go], slot[go]
        return out

    def add(self, h: np.ndarray, lists: list[np.ndarray]) -> None:
        """Remember distinct hashes that are not known yet."""
        sizes = np.array([len(x) for x in lists], np.int32)
        n, used = self.n + len(h), self.used + int(sizes.sum())
        if n > len(self.start):
            self.start, self.size = (np.resize(x, 2 * n) for x in (self.start, self.size))
        if used > len(self.flat):
            self.flat = np.resize(self.flat, 2 * used)
        self.flat[self.used:used] = np.concatenate(lists)
        self.size[self.n:n] = sizes
        self.start[self.n:n] = self.used + np.cumsum(sizes) - sizes
        entry = np.arange(self.n, n, dtype=np.int32)
        mask = np.int64((1 << self.bits) - 1)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            free = self.keys[slot[todo]] == 0
            self.keys[slot[todo[free]]] = h[todo[free]]  # of several for one slot the last stays
            won = self.keys[slot[todo]] == h[todo]
            self.value[slot[todo[won]]] = entry[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & mask
        self.n, self.used = n, used


class Encoder:
    """Texts to little-endian ids with one tokenizer file, exactly as the library does.

    The library encodes each distinct pre-token once; plain texts are cut into pre-tokens,
    hashed and put together by array operations.  ``dtype`` is uint16 where the vocabulary
    allows, else uint32."""

    def __init__(self, path: str, remember: int = REMEMBER):
        self.remember = remember
        self.library = tokenizer(path)
        self.dtype = "<u2" if self.library.get_vocab_size() <= 65536 else "<u4"
        self.memory = _Memory(self.dtype, remember)
        self.separator = next((t.content for t in self.library.get_added_tokens_decoder().values()
                               if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)), None)

        def ids(t):
            return self.library.encode(t, add_special_tokens=False).ids
        # The two known ways to cut; a file of another kind is left to the library as it is.
        self.dropped = ids("A b's 12") == ids("a") + ids("b") + ids("'s") + ids("1") + ids("2")
        self.prefixed = not self.dropped and ids("A b's  12") == ids("A") + ids(" b") + ids("'s") + ids(" ") + ids(" 12")

    def _pieces(self, text: str) -> list[str]:
        """Parts of any text whose encodings, concatenated, are the encoding of the text.

        Where white space is dropped: the words between ASCII white space, which the normaliser
        and the pre-tokeniser of such a file remove.  Where a space belongs to the word after it:
        cut before a space, unless it stands between two white-space characters or ends a run
        of them, where the pre-tokeniser looks at its neighbours.  Any other file: the whole
        text."""
        if self.dropped:
            return _ascii_split(text)
        if not self.prefixed:
            return [text]
        if _BETWEEN_SPACES.search(text):
            return _SAFE_CUT.split(text)
        first, *rest = text.split(" ")
        parts = [" " + p for p in rest]
        if first:
            parts.insert(0, first)
        return parts

    def _ask(self, words: list[str]) -> list[np.ndarray]:
        """The library's ids of each word."""
        if self.separator is None or any(self.separator in w for w in words):
            return [np.array(e.ids, self.dtype) for e in self.library.encode_batch(words, add_special_tokens=False)]
        # A special token ends what the library merges, so many words go through one call.
        mark, out = self.library.token_to_id(self.separator), []
        groups = [words[i:i + 256] for i in range(0, len(words), 256)]
        for g, e in zip(groups, self.library.encode_batch([self.separator.join(g) for g in groups],
                                                          add_special_tokens=False), strict=True):
            ids = np.array(e.ids, self.dtype)
            ends = np.append(np.flatnonzero(ids == mark), len(ids)).tolist()
            out += [ids[a:b] for a, b in zip([0] + [x + 1 for x in ends[:-1]], ends, strict=True)]
        return out

    def _slow(self, texts: list[str]) -> list[bytes]:
        pieces = [self._pieces(t) for t in texts]
        words = list(set(chain.from_iterable(pieces)))
        known = dict(zip(words, (x.tobytes() for x in self._ask(words)), strict=True))
        return [b"".join(map(known.__getitem__, p)) for p in pieces]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian numbers of ``dtype``."""
        out: list[bytes | None] = [None if t else b"" for t in texts]
        # Apostrophes begin endings like 's, and special tokens hold "<|": both need a closer look.
        plain = [i for i, t in enumerate(texts) if t and (self.dropped or self.prefixed) and "'" not in t and "<|" not in t]
        for a, b in chunks([texts[i] for i in plain], 1_000_000):
            self._fast(plain[a:b], texts, out)
        slow = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(slow, self._slow([texts[i] for i in slow]), strict=True):
            out[i] = x
        return out

    def _fast(self, at: list[int], texts: list, out: list) -> None:
        """Encode plain texts; the others stay None."""
        raws = [(texts[i].lower() if self.dropped else texts[i]).encode("utf-8") for i in at]
        data = np.frombuffer(b"\xff" + b"\xff".join(raws) + b"\xff", np.uint8)
        kind = _CLASS[data]
        borders = np.flatnonzero(kind == _BORDER)
        after = np.append(data[1:], np.uint8(0xFF))
        odd = np.flatnonzero(((data >= 0xC0) & (data != 0xC3) & (data != 0xFF))
                             | ((data == 0xC3) & ((after == 0x97) | (after == 0xB7))))
        first = np.ones(len(data), bool)
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        if self.dropped:
            first |= kind == _DIGIT
        else:
            last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _BORDER))
            first[last] = True          # the last white space before a word stands alone ...
            first[last[data[last] == 32] + 1] = False  # ... or, a space, begins the word
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(data)))
        keep = kind[starts] != _BORDER
        if self.dropped:
            keep &= kind[starts] != _SPACE
        long = keep & (sizes > LONGEST)
        bad = np.zeros(len(at), bool)
        bad[np.searchsorted(borders, np.concatenate([odd, starts[long]]), side="right") - 1] = True
        place = np.arange(len(data), dtype=np.int64) - np.repeat(starts, sizes)
        np.minimum(place, LONGEST - 1, out=place)
        place *= 256
        place += data
        with np.errstate(over="ignore"):
            h = np.add.reduceat(_TABLE.ravel()[place], starts)
        h = h ^ (h << np.uint64(32))
        h[h == 0] = 1
        h, starts, sizes = h[keep], starts[keep], sizes[keep]
        text_of = np.searchsorted(borders, starts, side="right") - 1
        if bad.any():
            good = ~bad[text_of]
            h, starts, sizes, text_of = h[good], starts[good], sizes[good], text_of[good]
        entry = self.memory.find(h)
        new = np.flatnonzero(entry < 0)
        if len(new):
            fresh, where = np.unique(h[new], return_index=True)
            raw = data.tobytes()
            words = [raw[a:a + n].decode("utf-8") for a, n in zip(starts[new[where]].tolist(), sizes[new[where]].tolist(), strict=True)]
            if self.memory.n + len(fresh) > self.remember:
                self.memory = _Memory(self.dtype, max(self.remember, len(fresh)))
                fresh, where = np.unique(h, return_index=True)
                words = [raw[a:a + n].decode("utf-8") for a, n in zip(starts[where].tolist(), sizes[where].tolist(), strict=True)]
            self.memory.add(fresh, self._ask(words))
            entry = self.memory.find(h)
        n = self.memory.size[entry].astype(np.int64)
        ends = np.cumsum(n)
        flat = np.repeat(self.memory.start[entry] - (ends - n), n)
        flat += np.arange(len(flat))
        ids = self.memory.flat[flat].tobytes()
        width = np.dtype(self.dtype).itemsize
        stop = np.append(0, ends)[np.searchsorted(text_of, np.arange(len(at) + 1))] * width
        for k, i in enumerate(at):
            if not bad[k]:
                out[i] = ids[stop[k]:stop[k + 1]]


def _ascii_split(text: str) -> list[str]:
    """Words between the ASCII white space (``str.split`` would also cut at other characters)."""
    return [w.decode("utf-8") for w in text.encode("utf-8").split()]


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return kept("encoder", path, lambda: Encoder(path))


# --- tree concatenation ---------------------------------------------------------------------
def _edge(own: list[int], offsets: list, half: np.ndarray, whole: list[int], text: str, left: bool) -> int | None:
    """Where a window's tokens and a half's tokens agree: the number of window tokens to keep
    outside the join, or None.

    Left of the join ``own`` are the tokens of the half's last characters and must end as the
    half does; the kept border lies between two of them which the joined window ``whole`` has
    too, the one inside the border as well, so every neighbouring pair in the result is a pair
    that one of the encodings produced.  Right of the join all this is mirrored."""
    n = len(own)
    tail = half[-n:] if left else half[:n]
    if len(tail) < n:
        n = len(tail)
    a = own[len(own) - n:] if left else own[:n]
    same = np.asarray(a) == tail
    if left:
        agree = n - int(np.flatnonzero(~same)[-1]) - 1 if not same.all() else n  # tokens at the end that agree
        match = 0
        while match < min(len(own), len(whole)) and own[match] == whole[match]:
            match += 1
        for i in range(min(match - 1, len(own) - 1), 0, -1):
            x = offsets[i][0]
            if len(own) - i <= agree and x >= offsets[i - 1][1] and (text[x - 1].isalnum() or text[x - 1].isspace()):
                return i
        return None
    agree = int(np.flatnonzero(~same)[0]) if not same.all() else n
    match = 0
    while match < min(len(own), len(whole)) and own[-1 - match] == whole[-1 - match]:
        match += 1
    for j in range(max(len(own) - match + 1, 1), len(own)):
        x = offsets[j][0]
        if j <= agree and x >= offsets[j - 1][1] and (text[x - 1].isalnum() or text[x - 1].isspace()):
            return len(own) - j
    return None


def join_halves(left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray, path: str,
                window: int = 32) -> tuple[np.ndarray, int]:
    """(ids of ``left + right``, characters of the last window); exact, see the module text."""
    library = tokenizer(path)
    while True:
        a, b = left[-window:], right[:window]
        if len(a) == len(left) and len(b) == len(right):
            ids = np.array(library.encode(left + right, add_special_tokens=False).ids, left_ids.dtype)
            return ids, len(left) + len(right)
        lo = library.encode(a, add_special_tokens=False)
        ro = library.encode(b, add_special_tokens=False)
        both = library.encode(a + b, add_special_tokens=False).ids
        i = 0 if len(a) == len(left) else _edge(lo.ids, lo.offsets, left_ids, both, a, True)
        j = 0 if len(b) == len(right) else _edge(ro.ids, ro.offsets, right_ids, both, b, False)
        if i is not None and j is not None and i + j <= len(both):
            middle = np.array(both[i:len(both) - j], left_ids.dtype)
            keep_left = left_ids[:len(left_ids) - (len(lo.ids) - i)] if len(a) < len(left) else left_ids[:0]
            keep_right = right_ids[len(ro.ids) - j:] if len(b) < len(right) else right_ids[:0]
            return np.concatenate([keep_left, middle, keep_right]), len(a) + len(b)
        window *= 2


def join_tree(parts: list[tuple[str, np.ndarray]], path: str) -> np.ndarray:
    """Ids of the concatenated parts, joined pairwise bottom-up."""
    while len(parts) > 1:
        up = []
        for k in range(0, len(parts) - 1, 2):
            (a, x), (b, y) = parts[k], parts[k + 1]
            up.append((a + b, join_halves(a, x, b, y, path)[0]))
        parts = up + parts[len(parts) - len(parts) % 2:]
    return parts[0][1]


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of the tree of halves, in order; each of at most ``leaf`` characters."""
    if len(text) <= leaf:
        return [text]
    mid = len(text) // 2
    return halves(text[:mid], leaf) + halves(text[mid:], leaf)


def encode_texts(texts: list[str | None], path: str, leaf: int = LEAF) -> list[np.ndarray]:
    """Ids of whole texts; texts over ``leaf`` characters by tree concatenation."""
    enc = encoder(path)
    leaves = [halves(t, leaf) if t else [""] for t in texts]
    raw = iter(enc.encode(list(chain.from_iterable(leaves))))
    out = []
    for own in leaves:
        ids = [np.frombuffer(next(raw), enc.dtype) for _ in own]
        out.append(ids[0] if len(own) == 1 else join_tree(list(zip(own, ids, strict=True)), path))
    return out


def raw_ids(ids: list[np.ndarray], path: str) -> dict:
    return {"n_tokens": [len(x) for x in ids], "ids": [x.astype("<u4").tobytes() for x in ids]}


def digests(ids: list[np.ndarray], path: str) -> dict:
    """Digests of the ids and of the text they decode to, made where the ids are: neither is
    carried through the plan."""
    decoded = decode_ids(ids, path)
    return {"n_tokens": [len(x) for x in ids], "ids_sha256": [decimal_sha256(x) for x in ids],
            "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in decoded]}


RAW = (raw_ids, "n_tokens bigint, ids binary")
DIGESTS = (digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF,
           spread: int = SPREAD, result=RAW) -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` (little-endian uint32) of every whole text; with
    ``result=DIGESTS`` hashes of the ids and of the decoded text instead.

    Texts up to ``spread`` characters are encoded where they lie.  Longer ones are cut into
    parts that are encoded on any executor and meet again by (id, text hash) to be joined;
    only they are shuffled."""
    finish, ddl = result

    def run(texts):
        return finish(encode_texts(texts, path, leaf), path)

    def run_part(texts):
        return raw_ids(encode_texts(texts, path, leaf), path)

    long = F.coalesce(F.length(text_col) > spread, F.lit(False))
    near = map_text(df.where(~long), run, ddl, text_col, (id_col,))
    big = df.where(long).select(F.col(id_col), F.col(text_col).alias("text"))
    parts = _map_parts(big, id_col, spread).repartition("key", "part_no")
    done = map_text(parts, run_part, RAW[1], "part", (id_col, "key", "part_no", "part"))
    whole = done.groupBy(id_col, "key").agg(F.sort_array(F.collect_list(F.struct("part_no", "part", "ids"))).alias("parts"))
    return near.unionByName(_join_parts(whole, id_col, path, finish, ddl))


def _map_parts(big: DataFrame, id_col: str, spread: int) -> DataFrame:
    """One row per part of a long text; ``key`` tells texts of the same id apart."""
    prepare(big.sparkSession)
    schema = T.StructType([big.schema[id_col], *schema_of("key string, part_no int, part string").fields])

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                parts = [halves(t, spread) for t in texts[a:b]]
                flat = [(i, hashlib.sha256(texts[a + i].encode()).hexdigest(), n, p)
                        for i, own in enumerate(parts) for n, p in enumerate(own)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array([f[0] for f in flat], pa.int64()))]
                    + [pa.array([f[k] for f in flat], t) for k, t in ((1, pa.string()), (2, pa.int32()), (3, pa.string()))],
                    names=[id_col, "key", "part_no", "part"])

    return big.mapInArrow(run, schema)


def _join_parts(whole: DataFrame, id_col: str, path: str, finish, ddl: str) -> DataFrame:
    added = schema_of(ddl)
    types = arrow_schema(added)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("parts")[i].as_py()
                copies = sum(r["part_no"] == 0 for r in rows)  # equal rows of one id
                parts = [(r["part"], np.frombuffer(r["ids"], "<u4")) for r in rows[::copies]]
                got = finish([join_tree(parts, path)], path)
                one = batch.column(id_col).slice(i, 1).take(pa.array([0] * copies, pa.int64()))
                yield pa.RecordBatch.from_arrays([one] + [pa.array(got[f.name] * copies, f.type) for f in types],
                                                 names=[id_col, *types.names])

    return whole.select(id_col, "parts").mapInArrow(run, T.StructType([whole.schema[id_col], *added.fields]))


# --- decoding -------------------------------------------------------------------------------
def decode_ids(ids: list[np.ndarray], path: str, at_once: int = 400_000) -> list[str]:
    """The library's decoding of every id list, special tokens kept."""
    out: list[str] = []
    for a, b in chunks(ids, at_once):
        out += tokenizer(path).decode_batch([x.tolist() for x in ids[a:b]], skip_special_tokens=False)
    return out


def decode(df: DataFrame, path: str, ids_col: str = "ids", carry=("doc_id",)) -> DataFrame:
    """``decoded``: the text of little-endian uint32 ids (null: empty)."""
    def run(rows):
        return {"decoded": decode_ids([np.frombuffer(r or b"", "<u4") for r in rows], path)}

    return map_text(df, run, "decoded string", ids_col, carry)


_DECIMALS: list[str] = []


def decimal_sha256(ids: np.ndarray) -> str:
    """SHA-256 of the decimal ids joined by one space."""
    if not _DECIMALS:
        _DECIMALS.extend(map(str, range(1 << 16)))
    numbers = ids.tolist()
    names = map(_DECIMALS.__getitem__, numbers) if max(numbers, default=0) < len(_DECIMALS) else map(str, numbers)
    return hashlib.sha256(" ".join(names).encode()).hexdigest()
