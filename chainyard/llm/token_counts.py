"""Operator 1: token counts of whole texts under a byte-level BPE.

Method: rank-synchronous array merging.  A batch's pre-tokens that no
earlier batch has counted become ragged numpy arrays of byte symbols; each
round applies every sequence's lowest-rank pair at once; the symbols that
survive are the tokens.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; repeated
rows are counted one by one; an empty table gives an empty result; other
columns of the input are ignored.  Strings of the vocabulary's special
tokens inside a text count as one token each, as the library's default has
it.  Texts are never cut.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import text_or_empty
from chainyard.llm.ragged_bpe import PairRanks, surviving_symbols

#: White space of the pre-tokenizer's pattern (fixed values: Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pre-tokenizer's pattern (fixed values), with its white space written out.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+"
          % (SPACE, SPACE, SPACE, SPACE))
#: White space with the run after it: no pre-token crosses such a unit's ends.
UNITS = re.compile("[%s]*[^%s]+|[%s]+" % (SPACE, SPACE, SPACE))
#: Entries of a worker's memory of counted units; it starts anew beyond.
MEMORY = 400_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    a printable Latin-1 byte stands for itself, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in set(own)]
    return chars | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenCounter:
    """Counts tokens with the vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs])
        right = np.array([vocab[b] for _, b in pairs])
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.ranks = PairRanks(left, right, np.arange(len(pairs), dtype=np.int32), len(vocab))
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.byte_id[byte] = vocab[char]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > MEMORY:
            self.known.clear()
        units, added = [], []
        for text in texts:
            parts = [text]
            if self.special is not None and "<" in text:
                parts = self.special.split(text)
            added.append(len(parts) - 1)
            units.append([u for part in parts for u in UNITS.findall(part)])
        self._learn(list(set().union(*units).difference(self.known)))
        known = self.known.__getitem__
        return [a + sum(map(known, us)) for a, us in zip(added, units)]

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        split = [self.pieces.findall(u) for u in new]
        numbers: dict[str, int] = {}
        which = np.array([numbers.setdefault(p, len(numbers)) for ps in split for p in ps])
        raw = [p.encode() for p in numbers]
        lens = np.array([len(b) for b in raw])
        flat = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        counts = surviving_symbols(flat, lens, self.ranks, self.merged)
        ends = np.cumsum([len(ps) for ps in split])
        total = np.concatenate(([0], np.cumsum(counts[which])))[ends]
        self.known.update(zip(new, np.diff(total, prepend=0).tolist()))


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter for each worker process and vocabulary."""
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of each row."""

    @F.arrow_udf("bigint")
    def n_tokens(batch: pa.Array) -> pa.Array:
        return pa.array(counter(tokenizer).count(batch.to_pylist()), pa.int64())

    body = text_or_empty(text)
    return (docs.select(F.col(key), F.octet_length(body).cast("bigint").alias("n_bytes"),
                        n_tokens(body).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
