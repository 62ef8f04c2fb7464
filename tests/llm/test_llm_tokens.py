import hashlib
import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, by_id, documents, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seriesrel.llm import bpe, wavelet

ALPHABET = list("abcz ABZ  .,!?'sS\n\t019éÉÈñßİΣσςǅ̧́ﬁΩ한글日本ª\r\x0b\x1c\x85 ​_-<|>😀") + [
    "<|endoftext|>", "<|startoftext|>", "'ll", "don't", "DON'T.", "Å"]


def texts():
    r = random.Random(4)
    return [None, "", " ", "a", "<|endoftext|>", *("".join(r.choices(ALPHABET, k=r.randrange(60))) for _ in range(400)),
            " ".join(prose(9, 30_000)), "x" * 5000]


def test_bpe_equals_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, rows = Tokenizer.from_file(path), list(enumerate(texts()))
    got = by_id(bpe.digests(documents(spark, rows), path))
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(got[i])[1:] == want, ascii((t or "")[:80])


def test_bpe_round_trip_keeps_columns(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark, [(1, "one two"), (1, "one two"), (None, None)])
    back = bpe.decode(bpe.encode(docs, path), path)
    assert back.columns == [*docs.columns, "ids", "n_tokens", "decoded"]
    assert sorted(r.decoded for r in back.collect()) == ["", "one two", "one two"]
    assert bpe.digests(spark.createDataFrame([], DOCS), path).count() == 0


def test_remembered_words_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 60_000)
    monkeypatch.setattr(bpe, "LARGEST", 6_000, raising=False)
    path, r = public_tokenizers.path("byte_bpe_50k.json"), random.Random(8)
    lib, one = Tokenizer.from_file(path), bpe.ByteBpe(path)
    for i in range(400):
        text = " ".join(["of", "the", "".join(r.choices("abcdeé한", k=20 + i)), "x" * 3000 * (i % 50 == 0), "of"])
        assert np.frombuffer(one.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    for kept in (one._old, one._young):
        assert kept and sum(sys.getsizeof(w) + sys.getsizeof(ids) for w, ids in kept.items()) <= bpe.REMEMBERED
    assert " the" in one._young


def test_token_files_move_few_texts_at_once(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, rows = Tokenizer.from_file(path), list(enumerate(texts()))
    out = bpe.encoded_documents(documents(spark, rows).withColumn("encoded", F.lit(1)), path)
    assert "Arrow" not in out._jdf.queryExecution().executedPlan().toString()    # a batch has 10,000 whole texts
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "token_ids", "decoded_sha256"]
    got = by_id(out)
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].token_ids == np.array(ids, "<u4").tobytes()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_shards_hold_the_librarys_ids_in_order(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib, rows = Tokenizer.from_file(path), [(i * 37 % 1009, t) for i, t in enumerate(texts())] + [(None, "first")]
    wavelet.write_shards(documents(spark, rows), path, str(tmp_path / "w"))
    got = by_id(wavelet.read_documents(spark, str(tmp_path / "w")))
    start = 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, wavelet.END], "<u4")
        assert tuple(got[i])[1:] == (start, len(ids), zlib.crc32(ids.tobytes())), ascii((t or "")[:80])
        start += len(ids)


def test_shards_of_nothing_and_of_repeats(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    wavelet.write_shards(spark.createDataFrame([], DOCS), path, str(tmp_path / "a"))
    assert wavelet.read_documents(spark, str(tmp_path / "a")).count() == 0
    wavelet.write_shards(documents(spark, [(1, "a"), (1, "a")]), path, str(tmp_path / "b"))
    assert sorted(r.start for r in wavelet.read_documents(spark, str(tmp_path / "b")).collect()) == [0, 2]


@pytest.mark.parametrize("top", [1, 2, 300, 49_000, 1 << 20])
def test_wavelet_rank_and_select(top):
    r = np.random.default_rng(top)
    ids = (r.zipf(1.3, 3000) % top).astype(np.uint32)
    zeros, planes = wavelet.WaveletMatrix.build(ids)
    w = wavelet.WaveletMatrix(len(ids), zeros, planes)
    assert (w.unpack() == ids).all()
    for at in (0, 1, 7, 8, 511, 512, 513, 2999):
        assert w.access(at) == ids[at]
    for token in {int(ids[0]), int(ids[77]), top - 1, 5}:
        places = np.flatnonzero(ids == token)
        assert w.count(token) == len(places) and w.count(token, 1000) == (places < 1000).sum()
        assert [w.find(token, n) for n in range(min(3, len(places)))] == places[:3].tolist()
        assert w.find(token, len(places)) == -1
    assert w.count(1 << 25) == 0
