"""Token counts, records, packing and SentencePiece against the libraries."""

import collections
import heapq
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chainyard.llm import packing_bm25
from chainyard.llm import queries as Q
from chainyard.llm.chunk_tokens import ChunkEncoder
from chainyard.llm.crc32c import crc32c, masked
from chainyard.llm.packing_bm25 import Bm25Index, fill_windows, pack_documents
from chainyard.llm.sentencepiece_dropout import (PieceModel, encode_digest, encode_with_dropout,
                                                 skipped)
from chainyard.llm.token_counts import TokenCounter, token_counts
from chainyard.llm.token_records import (_filesystem, fetch_token_records, read_shuffled,
                                         read_token_records, unframe, write_token_records)
from chainyard.session import shared_dir

from .conftest import SMALL, rows

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECE = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [*"ab Z9'\n\t  　\u0085\x1c\x00​é!<|>s.—ßΣσ漢字😀́İ", "<|endoftext|>",
         " <|endoftext|>", "'re", "'ll", "  ", "<|startoftext|>", "ing", " the", "    "]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def library(path, texts):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts],
                                                   add_special_tokens=False)
    return [e.ids for e in found]


def test_counts_and_ids_equal_the_library_on_random_texts():
    texts = random_texts(4000)
    assert TokenCounter(BYTE).count(texts) == [len(x) for x in library(BYTE, texts)]
    got = ChunkEncoder(WORD).encode(texts)
    assert [x.tolist() for x in got] == library(WORD, texts)


def test_ids_of_a_tokenizer_that_keeps_blanks_come_from_whole_texts():
    texts = random_texts(300)
    encoder = ChunkEncoder(BYTE)
    assert not encoder.by_chunk
    assert [x.tolist() for x in encoder.encode(texts)] == library(BYTE, texts)


def test_token_counts_of_odd_rows(spark, docs, no_docs, clashing):
    want = collections.Counter()
    for doc_id, text, *_ in rows():
        n = len(library(BYTE, [text])[0])
        want[doc_id, len((text or "").encode()), n, n > 20] += 1
    for df in (docs, clashing):
        got = token_counts(df, BYTE, limit=20)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert collections.Counter(map(tuple, got.collect())) == want
    assert token_counts(no_docs, BYTE, limit=20).count() == 0


@pytest.fixture(scope="module")
def table_ids():
    import duckdb
    found = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet' order by 1").fetchall()
    return {d: x for (d, _), x in zip(found, library(WORD, [t for _, t in found]))}


def test_registered_token_counts(spark):
    import duckdb
    found = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    want = {(d, len(t.encode()), len(x), len(x) > 1024)
            for (d, t), x in zip(found, library(BYTE, [t for _, t in found]))}
    assert set(map(tuple, Q.op1_token_counts(spark, SMALL).collect())) == want


def test_registered_records_round_trip(spark, table_ids):
    got = sorted(map(tuple, Q.op8_token_records(spark, SMALL).collect()))
    start, want = 0, []
    for d, ids in table_ids.items():
        want.append((d, start, len(ids) + 1, crc(ids + [2])))
        start += len(ids) + 1
    assert got == want


def test_records_of_odd_rows(spark, docs, no_docs, clashing):
    for df in (docs, clashing):
        path = shared_dir(spark, "records")
        assert write_token_records(df, path, WORD, end_id=2).agg({"n_records": "sum"}).first()[0] \
            == len(rows())
        got = read_token_records(spark, path).orderBy("start").collect()
        texts = [r[1] for r in rows()]
        want = collections.Counter((r[0], tuple(x + [2])) for r, x in zip(rows(), library(WORD, texts)))
        assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u2"))) for r in got) == want
        keys = [-1 if r.doc_id is None else r.doc_id for r in got]
        assert keys == sorted(keys)
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    path = shared_dir(spark, "records")
    write_token_records(no_docs, path, WORD, end_id=2)
    assert read_token_records(spark, path).count() == 0


@pytest.mark.parametrize("read_bytes", [1, 8 << 20])
def test_records_by_place_and_in_drawn_order(spark, docs, no_docs, monkeypatch, read_bytes):
    monkeypatch.setattr("chainyard.llm.token_records.READ_BYTES", read_bytes)
    path = shared_dir(spark, "records")
    write_token_records(docs, path, WORD, end_id=2)
    fields = ("shard", "record", "doc_id", "n_tokens", "ids")
    whole = [tuple(r[c] for c in fields) for r in read_token_records(spark, path).collect()]
    orders = []
    for seed in (1, 1, 2):
        got = [tuple(r[c] for c in fields) for r in read_shuffled(spark, path, seed).collect()]
        assert collections.Counter(got) == collections.Counter(whole)
        orders.append(got)
    assert orders[0] == orders[1] != orders[2]
    places = [r[:2] for r in whole[::3]] * 2  # asked for twice, with another column
    pairs = spark.createDataFrame([(*p, "x") for p in places], "shard int, record int, ids string")
    got = [tuple(r[c] for c in fields) for r in fetch_token_records(pairs, path).collect()]
    assert collections.Counter(got) == collections.Counter(whole[::3] * 2)
    assert fetch_token_records(pairs.limit(0), path).count() == 0
    for odd in ((whole[0][0], 10 ** 6), (10 ** 6, 0), (None, 0), (whole[0][0], None), (whole[0][0], -1)):
        with pytest.raises(Exception, match="no record"):
            fetch_token_records(spark.createDataFrame([odd], "shard long, record long"), path).collect()
    none = shared_dir(spark, "records")
    write_token_records(no_docs, none, WORD, end_id=2)
    assert read_shuffled(spark, none, 1).count() == 0


def test_damaged_record_is_found(spark, docs):
    path = shared_dir(spark, "records")
    shard = write_token_records(docs, path, WORD, end_id=2).first()
    files, folder = _filesystem(path)
    with files.open_input_file(f"{folder}/{shard.records}") as f:
        data = bytearray(f.read())
    with files.open_input_file(f"{folder}/{shard.offsets}") as f:
        offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
    assert len(unframe(bytes(data), offsets)) == shard.n_records
    # any record can be fetched alone by its offsets
    one = offsets[3:5]
    assert len(unframe(bytes(data[one[0]:one[1]]), one - one[0])) == 1
    data[offsets[1] - 6] ^= 1
    with pytest.raises(ValueError):
        unframe(bytes(data), offsets)


def test_crc32c():
    def slow(s):
        reg = 0xFFFFFFFF
        for b in s:
            reg ^= b
            for _ in range(8):
                reg = (reg >> 1) ^ (0x82F63B78 if reg & 1 else 0)
        return reg ^ 0xFFFFFFFF

    rng = np.random.default_rng(0)
    sizes = [*range(20), 507, 508, 509, 511, 512, 513, 1020, 1024, 3000]
    strings = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes]
    assert crc32c(strings).tolist() == [slow(s) for s in strings]
    assert crc32c([b"123456789"])[0] == 0xE3069283
    assert masked(np.array([0xE3069283], np.uint32))[0] == (
        ((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def check_pieces(pieces, ids, window):
    """Every id in exactly one piece; windows gapless; returns the padding."""
    cover, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == crc(own[p.start:p.start + p.length])
        cover[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for d, own in ids.items():
        assert [a for a, _ in sorted(cover[d])] == np.cumsum(
            [0] + [n for _, n in sorted(cover[d])])[:-1].tolist()
        assert sum(n for _, n in cover[d]) == len(own)
    padding = 0
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert 0 < total <= window
        padding += window - total
    return padding


def test_registered_packing(spark, table_ids):
    ids = {d: x + [1] for d, x in table_ids.items()}
    pieces = Q.op5_packing(spark, SMALL).collect()
    assert check_pieces(pieces, ids, 2048) < 2048  # one shard: one window has padding


def test_packing_of_odd_rows(spark, docs, no_docs, clashing):
    for df in (docs, clashing):
        pieces = pack_documents(df, WORD, end_id=1, window=16, shard_chars=3000).collect()
        want = collections.Counter()
        for r in rows():
            want[r[0]] += len(library(WORD, [r[1]])[0]) + 1
        got = collections.Counter()
        for p in pieces:
            got[p.doc_id] += p.length
            assert len(p.ids) == p.length and crc(p.ids) == p.ids_crc32
        assert got == want
    assert pack_documents(no_docs, WORD, end_id=1).count() == 0


def test_packing_loads_and_learns_in_tasks(spark, monkeypatch):
    """pipeline: neither the tokenizer nor the sample of its packing is in the driver."""
    driver, real = os.getpid(), packing_bm25.encoder

    def in_tasks(path):
        assert os.getpid() != driver, "the driver loads the tokenizer"
        return real(path)

    def learn(*_):
        raise AssertionError("the driver learns the centres")

    monkeypatch.setattr(packing_bm25, "encoder", in_tasks)
    monkeypatch.setattr(packing_bm25.Places, "__init__", learn)
    df = spark.createDataFrame([(i, f"word{i % 7} " * 40) for i in range(200)],
                               "doc_id long, text string")
    pieces = pack_documents(df, WORD, end_id=1, window=64, shard_chars=5000).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) > 1
    whole = collections.Counter()
    for p in pieces:
        whole[p.doc_id] += p.length
    assert {(p.doc_id, p.doc_tokens) for p in pieces} == set(whole.items())


def test_documents_that_share_terms_are_packed_across_the_whole_input(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(2400)]
    common = [f"word{k}" for k in range(50)]
    texts = [" ".join(rng.choices(words[60 * (i % 40):60 * (i % 40) + 60], k=30)
                      + rng.choices(common, k=30)) for i in range(1200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    chars = sum(map(len, texts))
    pieces = pack_documents(df, WORD, end_id=1, window=256, shard_chars=chars // 10).collect()
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces}
    sizes = collections.Counter(shard.values())
    assert len(shard) == 1200 and max(sizes.values()) < 2 * 120
    together = [shard[a] == shard[b] for a in range(1200) for b in range(a % 40, a, 40)]
    assert sum(together) > 0.6 * len(together)  # a tenth, were they dealt by chance


def test_bm25_scores_and_neighbours():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint16) for _ in range(30)]
    index = Bm25Index(docs)
    mean = np.mean([len(d) for d in docs])
    for seed in (0, 7):
        want = np.zeros(30)
        for t in set(docs[seed].tolist()):
            df = sum(t in d for d in docs)
            for k, d in enumerate(docs):
                tf = int((d == t).sum())
                want[k] += np.log1p((30 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        np.testing.assert_allclose(index.scores(seed), want)
    # the neighbours of the first seed share its terms
    docs = [np.arange(10), np.arange(100, 109), np.arange(1, 9), np.arange(200, 208)]
    first = fill_windows([d.astype(np.uint16) for d in docs], 18)[0]
    assert [d for d, _, _ in first] == [0, 2]


def slow_pieces(model, key, text, seed, dropout):
    """The agenda with a heap, one candidate after another."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(259, sp.get_piece_size())}
    s = "▁" + text.replace(" ", "▁") if text else ""
    n = len(s)
    end, nxt, prv = [i + 1 for i in range(n)], list(range(1, n + 1)), list(range(-1, n - 1))
    alive, agenda = [True] * n, []

    def add(a):
        if a >= 0 and nxt[a] < n and s[a:end[nxt[a]]] in score:
            heapq.heappush(agenda, (-score[s[a:end[nxt[a]]]], a, nxt[a], end[nxt[a]]))

    for i in range(n):
        add(i)
    while agenda:
        _, a, b, e = heapq.heappop(agenda)
        if not (alive[a] and alive[b] and nxt[a] == b and end[b] == e):
            continue
        if skipped(seed, *(np.array([x]) for x in (key, a, b, e)), dropout)[0]:
            continue
        end[a], alive[b], nxt[a] = e, False, nxt[b]
        if nxt[a] < n:
            prv[nxt[a]] = a
        add(prv[a])
        add(a)
    out = []
    for i in range(n):
        if alive[i]:
            p = s[i:end[i]]
            out += [sp.piece_to_id(p)] if p in score else [3 + x for x in p.encode()]
    return out


def test_pieces_equal_the_library_and_the_agenda():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model, texts = PieceModel(PIECE), random_texts(400, seed=5)
    keys = list(range(len(texts)))
    assert [x.tolist() for x in model.encode(keys, texts, 7, 0.0)] == sp.encode(texts)
    got = model.encode(keys, texts, 7, 0.2)
    for k in range(0, 400, 4):
        assert got[k].tolist() == slow_pieces(model, k, texts[k], 7, 0.2)
    assert [model.decode(x) for x in got] == texts
    other = model.encode(keys, texts, 8, 0.2)
    assert sum(a.tolist() != b.tolist() for a, b in zip(got, other)) > 100
    # every candidate skipped: characters alone
    assert max(map(len, model.encode([1], ["hello there"], 7, 1.0))) == 12


def test_long_words_have_the_same_pieces():
    import random
    import time
    rng, model = random.Random(3), PieceModel(PIECE)
    texts = ["".join(rng.choice("abcdeinrst") for _ in range(n)) + " after " + "é漢" * 400 for n in (600, 3000)]
    for dropout in (0.0, 0.1):
        got = model.encode([5, 6], texts, 9, dropout)
        assert [x.tolist() for x in got] == [slow_pieces(model, k, t, 9, dropout)
                                             for k, t in zip((5, 6), texts)]
        assert [model.decode(x) for x in got] == texts
    spent = []
    for n in (20_000, 200_000):
        text = "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
        start = time.process_time()
        assert model.decode(model.encode([1], [text], 9, 0.1)[0]) == text
        spent.append((time.process_time() - start) / n)
    assert spent[1] < 3 * spent[0] + 1e-5  # in proportion


def test_sentencepiece_of_odd_rows(spark, docs, no_docs, clashing):
    model = PieceModel(PIECE)
    want = collections.Counter(
        (r[0], tuple(model.encode([r[0] or 0], [r[1] or ""], 7, 0.1)[0]), r[1] or "") for r in rows())
    got = encode_with_dropout(clashing, PIECE, 7, 0.1).collect()
    assert collections.Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == want
    got = encode_digest(docs, PIECE, 7, 0.1).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(
        {(d, len(x), crc(x), True): n for (d, x, _), n in want.items()})
    assert encode_digest(no_docs, PIECE, 7, 0.1).count() == 0


def test_registered_sentencepiece(spark):
    got = Q.op2_sentencepiece_dropout(spark, SMALL).collect()
    assert len(got) == 200 and all(r.lossless for r in got)
