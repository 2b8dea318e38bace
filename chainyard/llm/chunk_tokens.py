"""Token ids of whole texts, as the tokenizers library gives them, by arrays.

Where a tokenizer drops white space, a text's ids are the ids of its
white-space chunks one after another.  A batch's texts are split and their
chunks numbered by Arrow; chunks that a worker does not know are split into words by the
tokenizer's pattern, all at once, and the distinct words merged by ranks over
ragged arrays (``ragged_bpe``); the texts' ids are then gathered by number.
Chunks with special strings or unusual separators, and tokenizers of other
kinds, go through the library.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from chainyard.llm.ragged_bpe import PairRanks, merged_symbols
from chainyard.llm.token_counts import byte_symbols

#: Chunks that a worker remembers (some 50 bytes each); beyond, the half that occurs
#: in most batches stays.
MEMORY = 1_000_000
#: Stands between chunks: a numeral that no pattern joins with its neighbours.
BETWEEN = "↉"
#: Chunks that the library itself splits: separators on which patterns differ,
#: what may hold a special token, and what stands between chunks.
ODD = "[\\x00\\x1c-\\x1f]|<\\||" + BETWEEN


def gathered(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run one after another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of strings in bytes, and their bytes one after another (as those
    of arrays that a kernel has just made lie)."""
    size = pc.binary_length(strings).to_numpy().astype(np.int64)
    total = int(size.sum())
    return size, np.frombuffer(strings.buffers()[2], np.uint8, total) if total else np.zeros(0, np.uint8)


class Runs:
    """Runs of ids, by number."""

    def __init__(self, dtype):
        self.n, self.used = 0, 0
        self.ids = np.zeros(1 << 16, dtype)
        self.starts, self.lens, self.batches = (np.zeros(1 << 12, np.int64) for _ in range(3))

    def add(self, ids: np.ndarray, lens: np.ndarray) -> None:
        more, n = self.used + len(ids), self.n + len(lens)
        while more > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n > len(self.lens):
            self.starts, self.lens, self.batches = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.lens, self.batches))
        self.ids[self.used:more] = ids
        self.starts[self.n:n] = self.used + np.cumsum(lens) - lens
        self.lens[self.n:n], self.batches[self.n:n] = lens, 0
        self.n, self.used = n, more

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lens = self.lens[numbers]
        return self.ids[gathered(self.starts[numbers], lens)], lens


class ChunkEncoder:
    """Ids of texts under a tokenizers file, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        one = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        #: Whether white space leaves no trace in the ids.
        self.by_chunk = all(one(s) == one("a") + one("b")
                            for s in ("a b", "a  b", "a\tb", "a\n\n b", " a\r\nb ", "a\x0b\x0cb"))
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.pattern = self._word_pattern(spec)
        if self.pattern is not None:
            self._merges(spec["model"])
        steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
        kinds = [n.get("type") for n in steps]
        spaces = [n.get("pattern") for n in steps if n.get("type") == "Replace"]
        self.lowers = ("Lowercase" in kinds and set(kinds) <= {"NFC", "NFKC", "Replace", "Lowercase"}
                       and all(p == {"Regex": r"\s+"} for p in spaces))
        self.chunks = pa.array([], pa.large_string())
        self.known = Runs(self.dtype)

    @staticmethod
    def _word_pattern(spec: dict):
        """The compiled pattern of words, if the file's steps are: keep the
        pattern's matches, write each as byte symbols, merge pairs by rank."""
        import regex
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if len(steps) != 2 or steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
            return None
        keeps = steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        plain = not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
        model = spec["model"]
        ranks = model["type"] == "BPE" and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if not (keeps and plain and ranks):
            return None
        pattern, b = regex.compile(steps[0]["pattern"]["Regex"]), BETWEEN
        apart = pattern.findall(f"1{b}1{b}!{b}!{b}a{b}a's{b}{b}'s{b}") == [
            "1", b, "1", b, "!", b, "!", b, "a", b, "a", "'s", b, b, "'s", b]
        return pattern if apart else None

    def _merges(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.ranks = PairRanks(left, right, np.arange(len(pairs), dtype=np.int32),
                               max(vocab.values()) + 1)
        self.inner, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.inner[byte], self.last[byte] = vocab[char], vocab[char + suffix]

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text of a list or an Arrow array of strings; NULL is empty."""
        if not self.by_chunk:
            texts = [t or "" for t in (texts.to_pylist() if isinstance(texts, pa.Array) else texts)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, self.dtype) for e in found]
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        chunks = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
        ids, lens = self._ids(chunks.flatten())
        ends = np.concatenate([[0], np.cumsum(lens)])[chunks.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after another, and their number in each."""
        coded = chunks.dictionary_encode()
        own = coded.dictionary
        if len(self.chunks) + len(own) > MEMORY:
            self._forget()
        found = pc.index_in(own, value_set=self.chunks)
        new = own.filter(found.is_null())
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if len(new):
            at[at < 0] = len(self.chunks) + np.arange(len(new))
            self._learn(new)
            self.chunks = pa.concat_arrays([self.chunks, new])
        self.known.batches[at] += 1
        return self.known.of(at[coded.indices.to_numpy()])

    def _forget(self) -> None:
        """Keep the chunks that occurred in most batches, up to half the memory."""
        old, batches = self.known, self.known.batches[:len(self.chunks)]
        kept = np.sort(np.argsort(-batches, kind="stable")[:MEMORY // 2])
        kept = kept[batches[kept] > 1]
        self.chunks = self.chunks.take(pa.array(kept))
        self.known = Runs(self.dtype)
        self.known.add(*old.of(kept))
        self.known.batches[:len(kept)] = batches[kept] // 2

    def _learn(self, new: pa.Array) -> None:
        """Add the ids of chunks to the known ones, in order."""
        odd = (np.ones(len(new), bool) if self.pattern is None else
               pc.match_substring_regex(new, ODD).to_numpy(zero_copy_only=False))
        ascii_ = pc.string_is_ascii(new).to_numpy(zero_copy_only=False)
        groups = [(odd, self._by_library), (~odd & ascii_, self._by_words),
                  (~odd & ~ascii_, self._by_words)]
        lens, parts = np.zeros(len(new), np.int64), []
        for on, ids_of in groups:
            if on.any():
                ids, lens[on] = ids_of(new.filter(pa.array(on)))
                parts.append((on, ids))
        whole = np.zeros(int(lens.sum()), self.dtype)
        for on, ids in parts:
            whole[np.repeat(on, lens)] = ids
        self.known.add(whole, lens)

    def _by_library(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks.to_pylist(),
                                                                 add_special_tokens=False)]
        return (np.array([i for ids in found for i in ids], self.dtype),
                np.array(list(map(len, found)), np.int64))

    def _by_words(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # each chunk and a line feed, which no chunk holds
        size, data = _bytes_of(chunks)
        joined = np.full(len(data) + len(chunks), ord("\n"), np.uint8)
        own = np.ones(len(joined), bool)
        own[np.cumsum(size + 1) - 1] = False
        joined[own] = data
        normal = joined.tobytes().decode()
        if self.lowers and normal.isascii():
            # no white space and no marks to compose: letters change by their case alone
            normal = normal.lower().replace("\n", BETWEEN)
        else:
            normal = normal.replace("\n", BETWEEN)
            if self.tokenizer.normalizer is not None:
                normal = self.tokenizer.normalizer.normalize_str(normal)
        coded = pa.array(self.pattern.findall(normal), pa.large_string()).dictionary_encode()
        at, words = coded.indices.to_numpy(), coded.dictionary
        between = pc.index(words, BETWEEN).as_py()
        size, data = _bytes_of(words)
        syms, ends = self.inner[data], np.cumsum(size) - 1
        syms[ends] = self.last[data[ends]]
        ids, lens = merged_symbols(syms, size, self.ranks, self.merged)
        starts = np.cumsum(lens) - lens
        lens[between] = 0  # each chunk ends with it
        chunk = np.cumsum(at == between) - (at == between)
        total = np.bincount(chunk, lens[at], len(chunks)).astype(np.int64)
        return ids[gathered(starts[at], lens[at])].astype(self.dtype), total


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker process and tokenizer."""
    return ChunkEncoder(path)
