"""Operator 2: SentencePiece encoding with seeded merge-dropout, and decoding.

Method: a text's characters are merged as the model's agenda has it -- the
pair whose piece has the highest score first, the leftmost of equals -- but
each candidate merge is skipped with probability ``dropout``.  Whether it is
follows from a hash keyed by the seed over the row's key and the candidate's
span, so a segmentation is repeatable and differs by seed, row and place.
No piece joins a character and a blank after it, so words are merged apart:
all words of a batch are ragged numpy arrays, and each round takes every
word's next agenda item; a long word has a heap, with the same result.  Characters without a piece fall back to bytes.

Decoding joins pieces and bytes and drops the blank in front that the model
adds; every segmentation of a text decodes to that text.  (The character
U+2581, which stands for a blank in pieces, decodes to a blank.)

Defined results: a NULL or empty text has no pieces; rows without a key hash
as key 0; repeated rows are segmented alike; an empty table gives an empty
result; other columns are ignored.  Texts are never cut.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import text_or_empty
from chainyard.llm.crc32c import ids_crc32
from chainyard.llm.ragged_bpe import NO_MERGE, PairRanks

BLANK = "▁"
#: Characters that are merged at once.
AT_ONCE = 400_000
#: Characters beyond which a word (a text without blanks) has an agenda of its own.
LONG_WORD = 512


def _mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit number over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def skipped(seed: int, key: np.ndarray, start: np.ndarray, middle: np.ndarray,
            end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidates that join [start, middle) and [middle, end) of
    the rows' texts are skipped."""
    if dropout <= 0:
        return np.zeros(len(start), bool)
    with np.errstate(over="ignore"):
        h = np.full(len(start), seed & (2**64 - 1), np.uint64)
        for part in (key, start, middle, end):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.int64).view(np.uint64))
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53 < dropout


def _mixed(h: int) -> int:
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return h ^ (h >> 31)


def drawn(seed: int, *parts: int) -> float:
    """The number that ``skipped`` compares with the dropout, for one candidate."""
    h = seed & (2**64 - 1)
    for part in parts:
        h = _mixed((h * 0x9E3779B97F4A7C15 + part) & (2**64 - 1))
    return (h >> 11) * 2.0**-53


class PieceModel:
    """Pieces and merges of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = {model.id_to_piece(i): i for i in range(n)
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        if any(BLANK in p.lstrip(BLANK) for p in plain):
            raise ValueError("a piece joins a character and a blank after it")
        self.bytes = np.zeros(256, np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.bytes[int(model.id_to_piece(i)[3:5], 16)] = i
        # symbols: the pieces, then characters that only longer pieces have
        symbol = {p: k for k, p in enumerate(plain)}
        for p in list(plain):
            for c in p:
                symbol.setdefault(c, len(symbol))
        self.id_of = np.full(len(symbol) + 1, -1, np.int64)
        self.id_of[:len(plain)] = list(plain.values())
        self.unknown = len(symbol)
        self.of_char = np.full(0x110000, self.unknown, np.int32)
        for s, k in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = k
        splits = [(symbol[p[:k]], symbol[p[k:]], symbol[p], -model.get_score(i))
                  for p, i in plain.items() for k in range(1, len(p))
                  if p[:k] in symbol and p[k:] in symbol]
        left, right, made, cost = map(np.array, zip(*splits))
        self.made = made.astype(np.int32)
        # pieces of equal score share a rank; places decide between them
        self.rank = np.unique(cost, return_inverse=True)[1].astype(np.int32)
        self.pairs = PairRanks(left, right, np.arange(len(left), dtype=np.int32), len(symbol) + 1)
        self.pair_of = {a * len(symbol) + b: k for k, (a, b) in
                        enumerate(zip(left.tolist(), right.tolist()))}
        self.text_of = [b""] * n
        for p, i in plain.items():
            self.text_of[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(self.bytes.tolist()):
            self.text_of[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace").removeprefix(" ")

    def encode(self, keys: list[int], texts: list[str], seed: int, dropout: float
               ) -> list[np.ndarray]:
        """Ids of each text."""
        out, a = [], 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size + len(texts[b]) <= AT_ONCE):
                size += len(texts[b])
                b += 1
            out += self._encode(keys[a:b], texts[a:b], seed, dropout)
            a = b
        return out

    def _encode(self, keys, texts, seed, dropout) -> list[np.ndarray]:
        texts = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        lens = np.array([len(t) for t in texts])
        ends = np.cumsum(lens)
        starts = ends - lens
        row = np.repeat(np.arange(len(texts)), lens)
        blank = chars == ord(BLANK)
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        opens[starts[lens > 0]] = True
        final = self._merged(self.of_char[chars], np.cumsum(opens), row, starts,
                             np.array(keys, np.int64), seed, dropout)
        at = np.flatnonzero(final >= 0)
        ids = self.id_of[final[at]]
        ids, at = self._with_bytes(ids, at, chars)
        cuts = np.searchsorted(at, ends)
        return np.split(ids, cuts[:-1]) if len(texts) else []

    def _merged(self, syms, word, row, starts, keys, seed, dropout) -> np.ndarray:
        """The symbol that starts at each character, or -1 within one."""
        n = len(syms)
        final = np.full(n, -1, np.int32)
        place, word = np.arange(n), word.astype(np.int32)
        # where the symbol after each one ends, by place
        stop = place + 1

        def ranked(i: np.ndarray) -> np.ndarray:
            """Pair of each symbol i with the next one, NO_MERGE where none is
            or where its merge is skipped."""
            out = np.full(len(i), NO_MERGE, np.int32)
            inner = np.flatnonzero(i + 1 < len(syms))
            j = i[inner]
            same = word[j] == word[j + 1]
            inner, j = inner[same], j[same]
            pair = self.pairs(syms[j], syms[j + 1])
            there = pair != NO_MERGE
            inner, j, pair = inner[there], j[there], pair[there]
            r, p = row[place[j]], place[j]
            drop = skipped(seed, keys[r], p - starts[r], place[j + 1] - starts[r],
                           stop[place[j + 1]] - starts[r], dropout)
            out[inner[~drop]] = pair[~drop]
            return out

        pair = ranked(np.arange(n))
        rank = np.where(pair == NO_MERGE, NO_MERGE, self.rank[np.minimum(pair, len(self.rank) - 1)])
        if n:
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(first, n))
            for a in np.flatnonzero(size > LONG_WORD).tolist():
                a, b = int(first[a]), int(first[a] + size[a])
                own = int(starts[row[a]])
                final[a:b] = self._agenda(syms[a:b].tolist(), pair[a:b].tolist(), a - own,
                                          int(keys[row[a]]), seed, dropout)
            keep = np.repeat(size <= LONG_WORD, size)
            syms, word, place = syms[keep], word[keep], place[keep]
            pair, rank = pair[keep], rank[keep]
        while len(syms):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(first, len(syms)))
            best = np.minimum.reduceat(rank, first)
            live = best != NO_MERGE
            if not live.all():
                keep = np.repeat(live, size)
                final[place[~keep]] = syms[~keep]
                syms, word, place = syms[keep], word[keep], place[keep]
                pair, rank = pair[keep], rank[keep]
                best, size = best[live], size[live]
                if not len(syms):
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[np.concatenate(([True], word[at[1:]] != word[at[:-1]]))]  # the leftmost
            syms[at] = self.made[pair[at]]
            stop[place[at]] = stop[place[at + 1]]
            keep = np.ones(len(syms), bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))
            syms, word, place = syms[keep], word[keep], place[keep]
            pair, rank = pair[keep], rank[keep]
            again = np.concatenate((new, new[new > 0] - 1))
            pair[again] = ranked(again)
            rank[again] = np.where(pair[again] == NO_MERGE, NO_MERGE,
                                   self.rank[np.minimum(pair[again], len(self.rank) - 1)])
        return final

    def _agenda(self, syms: list[int], pairs: list[int], offset: int, key: int, seed: int,
                dropout: float) -> list[int]:
        """The symbols of one long word, by a heap of its candidates: one step
        for each merge, where rounds would pass over the whole word."""
        n = len(syms)
        after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        rank, made, n_symbols = self.rank.tolist(), self.made.tolist(), self.unknown
        agenda = [(rank[p], i, i + 1, i + 2, p) for i, p in enumerate(pairs) if p != NO_MERGE]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, end, p = heapq.heappop(agenda)
            if syms[i] < 0 or after[i] != j or syms[j] < 0 or stop[j] != end:
                continue  # one of both has been merged since
            syms[i], syms[j], stop[i], after[i] = made[p], -1, end, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b >= n or n_symbols in (syms[a], syms[b]):
                    continue
                p = self.pair_of.get(syms[a] * n_symbols + syms[b])
                if p is not None and not (dropout > 0 and drawn(
                        seed, key, offset + a, offset + b, offset + stop[b]) < dropout):
                    heapq.heappush(agenda, (rank[p], a, b, stop[b], p))
        return syms

    def _with_bytes(self, ids, at, chars) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the bytes of characters that have no piece."""
        lost = ids < 0
        if not lost.any():
            return ids, at
        code = np.where(lost, chars[at], 0)
        count = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        ids, at, lost, code, count = (np.repeat(x, count) for x in (ids, at, lost, code, count))
        low = code >> (6 * (count - 1 - nth))
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[count]
        byte = np.where(count == 1, code, np.where(nth == 0, lead | low, 0x80 | (low & 0x3F)))
        return np.where(lost, self.bytes[byte & 0xFF], ids), at


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each worker process and file."""
    return PieceModel(path)


def encode_with_dropout(docs: DataFrame, model: str, seed: int, dropout: float,
                        key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array) and decoded (text) of each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a in range(0, len(texts), 200):
                ids = m.encode([k or 0 for k in keys[a:a + 200]], texts[a:a + 200], seed, dropout)
                yield pa.RecordBatch.from_pydict({
                    key: pa.array(keys[a:a + 200], pa.int64()),
                    "ids": pa.array(ids, pa.list_(pa.int64())),
                    "decoded": pa.array([m.decode(x) for x in ids], pa.string())})

    rows = docs.select(F.col(key).cast("bigint").alias(key), text_or_empty(text).alias("t"))
    return rows.mapInArrow(encode, f"`{key}` long, ids array<long>, decoded string")


def encode_digest(docs: DataFrame, model: str, seed: int, dropout: float,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_pieces, ids_crc32 and lossless (the ids decode to the text) of
    each row, without moving ids and texts back from the workers."""

    @F.arrow_udf("n_pieces long, ids_crc32 long, lossless boolean")
    def digest(keys: pa.Array, batch: pa.Array) -> pa.Array:
        m, texts = piece_model(model), batch.to_pylist()
        ids = m.encode([k or 0 for k in keys.to_pylist()], texts, seed, dropout)
        return pa.StructArray.from_arrays(
            [pa.array([len(x) for x in ids], pa.int64()),
             pa.array([ids_crc32(x) for x in ids], pa.int64()),
             pa.array([m.decode(x) == t for x, t in zip(ids, texts)], pa.bool_())],
            ["n_pieces", "ids_crc32", "lossless"])

    found = docs.select(F.col(key), digest(F.col(key).cast("bigint"), text_or_empty(text)).alias("d"))
    return found.select(F.col(key), "d.*")
