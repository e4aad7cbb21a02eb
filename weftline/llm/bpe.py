"""Byte-level BPE over length-bucketed padded matrices.

A text is cut by the pattern; each distinct piece is encoded once for a batch. Pieces that are tokens
need no merges. The others are padded, by length bucket, into numpy matrices of token ids; each round
every row merges its leftmost pair of least rank, found through an open-addressing hash table of
pairs, and is compacted by one column; rows without a pair leave. Only the two pairs beside a merge
are looked up again. A piece of more than LONG bytes is a matrix of its own, folded into rows: the
leftmost pair of least rank is found through the rows' minima, and cells are compacted at the end, so
that a round does not cost the piece's length.

A null text is empty: no ids. The vocabulary (about 50,000 tokens) is read on the driver and sent
with the tasks, so executors need no file.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from weftline.llm.arrow import map_batches

NONE = np.int32(2**31 - 1)
#: Cells of a padded matrix, and encoded pieces that a worker remembers.
CELLS, REMEMBER = 1 << 21, 200_000
#: Bytes from which on a piece is folded, and cells in a row of it.
LONG, FOLD = 1024, 256


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of base64 token and rank."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


class PairTable:
    """(left id, right id) to the rank of the joined token, NONE if there is none; linear probing over a power of two."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens)}
        pairs = [(rank[t[:k]], rank[t[k:]], i) for i, t in enumerate(tokens) for k in range(1, len(t)) if t[:k] in rank and t[k:] in rank]
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        left = np.array([p[0] for p in pairs], np.int64) << 32 | np.array([p[1] for p in pairs], np.int64)
        value, slot = np.array([p[2] for p in pairs], np.int32), self._slot(left)
        while len(left):  # each free slot takes one key, the rest move on
            _, one = np.unique(slot, return_index=True)
            one = one[self.keys[slot[one]] == -1]
            self.keys[slot[one]], self.ranks[slot[one]] = left[one], value[one]
            rest = np.ones(len(left), bool)
            rest[one] = False
            left, value, slot = left[rest], value[rest], (slot[rest] + 1) & (1 << self.bits) - 1
        self.ids = np.array([rank[bytes([b])] for b in range(256)], np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = (key ^ key >> 29).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE also where either id is negative (padding)."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        out = np.full(key.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot, key = self._slot(key[todo]), key[todo]
        while len(todo):
            found = self.keys[slot]
            hit = found == key
            out[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (found != -1)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & (1 << self.bits) - 1
        return out


def merge_rows(ids: np.ndarray, table: PairTable) -> list[np.ndarray]:
    """ids: a row of token ids for each piece, padded with -1. The ids after all merges, by row."""
    n, w = ids.shape
    done: list[np.ndarray | None] = [None] * n
    row = np.arange(n)
    rank = table.look_up(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, w - 1)
    while len(row):
        at = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
        every = np.arange(len(row))
        best = rank[every, at] if rank.shape[1] else np.full(len(row), NONE)
        over = best == NONE
        if over.any():
            for r, x in zip(row[over].tolist(), ids[over]):
                done[r] = x[x >= 0]
            on = ~over
            row, ids, rank, at, best = row[on], ids[on], rank[on], at[on], best[on]
            every = every[: len(row)]
            if not len(row):
                break
        ids[every, at] = best
        w = ids.shape[1] - 1
        keep = np.arange(w)
        ids = np.take_along_axis(ids, keep + (keep > at[:, None]), 1)
        keep = keep[: w - 1]
        rank = np.take_along_axis(rank, keep + (keep >= at[:, None]), 1) if w > 1 else rank[:, :0]
        for side in (at - 1, at):
            ok = np.flatnonzero((side >= 0) & (side < w - 1))
            if len(ok):
                rank[ok, side[ok]] = table.look_up(ids[ok, side[ok]], ids[ok, side[ok] + 1])
    return done


def merge_folded(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """ids: the token ids of one long piece. The ids after all merges: the same as from merge_rows."""
    n = len(ids)
    size = -(-n // FOLD) * FOLD
    rank = np.full(size, NONE, np.int32)
    rank[: n - 1] = table.look_up(ids[:-1], ids[1:])
    folded = rank.reshape(-1, FOLD)
    least = folded.min(1)
    token, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], int] = {}

    def pair(i: int) -> int:
        """The rank of cell i with the next one; NONE for the last cell."""
        if after[i] == n:
            return int(NONE)
        key = token[i], token[after[i]]
        if key not in known:
            known[key] = int(table.look_up(np.array(key[:1], np.int32), np.array(key[1:], np.int32))[0])
        return known[key]

    while True:
        row = int(least.argmin())
        best = int(least[row])
        if best == NONE:
            break
        i = row * FOLD + int(folded[row].argmin())
        gone = after[i]
        token[i], token[gone], after[i] = best, -1, after[gone]
        if after[i] < n:
            before[after[i]] = i
        rank[gone], rank[i] = NONE, pair(i)
        changed = {row, gone // FOLD}
        if before[i] >= 0:
            rank[before[i]] = pair(before[i])
            changed.add(before[i] // FOLD)
        for r in changed:
            least[r] = folded[r].min()
    out = np.array(token, np.int32)
    return out[out >= 0]


class Codec:
    """Encode and decode with a vocabulary; remembers the pieces it has encoded, up to REMEMBER."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.table = tokens, PairTable(tokens)
        self.rank, self.cut = {t: i for i, t in enumerate(tokens)}, regex.compile(pattern).findall
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def _encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """By buckets of like length."""
        out: list[np.ndarray] = [np.array([], np.int32)] * len(pieces)
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                out[i] = merge_folded(self.table.ids[np.frombuffer(p, np.uint8)], self.table)
        order = sorted((i for i, p in enumerate(pieces) if len(p) <= LONG), key=lambda i: len(pieces[i]))
        start = 0
        while start < len(order):
            bucket = 1 << (len(pieces[order[start]]) - 1).bit_length()
            stop = start
            while stop < len(order) and len(pieces[order[stop]]) <= bucket and (stop == start or (stop - start) * bucket < CELLS):
                stop += 1
            w = len(pieces[order[stop - 1]])
            ids = np.full((stop - start, w), -1, np.int32)
            for r, i in enumerate(order[start:stop]):
                ids[r, : len(pieces[i])] = self.table.ids[np.frombuffer(pieces[i], np.uint8)]
            for i, x in zip(order[start:stop], merge_rows(ids, self.table)):
                out[i] = x
            start = stop
        return out

    def learn(self, pieces: set[str]) -> None:
        """Make ``known`` hold each piece: number of ids, decimal ids with a comma after each, and the bytes they decode to."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        new = [p for p in pieces if p not in self.known]
        hard = []
        for p in new:
            i = self.rank.get(p.encode())
            if i is None:
                hard.append(p)
            else:
                self.known[p] = (1, f"{i},", self.tokens[i])
        for p, ids in zip(hard, self._encode_pieces([p.encode() for p in hard])):
            ids = ids.tolist()
            self.known[p] = (len(ids), "".join([f"{i}," for i in ids]), self.decode(ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        pieces = self.cut(text)
        self.learn(set(pieces))
        return [int(i) for p in pieces for i in self.known[p][1].split(",")[:-1]]

    def digest(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """For each text: number of ids, SHA-256 of the decimal ids with commas between, SHA-256 of the decoded bytes."""
        cut = [self.cut(t or "") for t in texts]
        self.learn(set().union(*cut))
        out = []
        for pieces in cut:
            found = [self.known[p] for p in pieces]
            ids = "".join([x[1] for x in found])[:-1]
            out.append((sum([x[0] for x in found]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(b"".join([x[2] for x in found])).hexdigest()))
        return out


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[list[bytes], str]:
    import public_tokenizers as P

    return read_ranks(P.path(name)), P.PATTERN


def tokenize(df: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: tuple[list[bytes], str] | None = None) -> DataFrame:
    """key with ids, a list for each row."""
    return _map(df, text, key, vocabulary, lambda codec, texts: [[codec.encode(t or "") for t in texts]], "ids array<int>", [pa.list_(pa.int32())])


def _map(df, text, key, vocabulary, f, schema, kinds):
    shared = df.sparkSession.sparkContext.broadcast(vocabulary or public_vocabulary())

    def run(batches):
        codec = Codec(*shared.value)
        for b in batches:
            columns = f(codec, b.column(1).to_pylist())
            names = [key, *(x.split()[0] for x in schema.split(", "))]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=names)

    return map_batches(df.select(key, text), run, f"{key} {dict(df.dtypes)[key]}, {schema}")


def op7_bpe(documents: DataFrame) -> DataFrame:
    f = lambda codec, texts: list(zip(*codec.digest(texts))) or [[], [], []]
    return _map(documents, "text", "doc_id", None, f, "n_tokens long, ids_sha256 string, decoded_sha256 string", [pa.int64(), pa.string(), pa.string()])
