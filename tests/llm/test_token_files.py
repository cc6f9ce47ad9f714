import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareflow.llm import token_files as T
from fareflow.llm.packing import public_tokenizer as other_tokenizer

ODD = ["a", "bc", "'s", "'", "'ll", " ", "  ", "\n", "\n\n", "\t", ".", ",", "...", "9", "12", "é", "\xa0", " ", "　", "\x85", "\x1c", "丁"]
ODD += ["😀", "Don't", "<|endoftext|>", "<|", "(", "\r\n", "x" * 70, "_", "ö", "×", "÷", " é", "ß,", "ñ\n", "ǅ", "ɐ", "я", " the"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(T.public_tokenizer())


def ids_of(tokenizer, text, end=T.END_ID):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


def through_windows(texts, window, path=None):
    ids, ends, n = [], [], 0
    for part, row_ends in T.encoded(pa.array(texts, pa.string()), T.PieceIds(path or T.public_tokenizer()), T.END_ID, window):
        ends += (row_ends + n).tolist()
        ids.append(part)
        n += len(part)
    assert len(ends) == len(texts)
    assert not ends or ends[-1] == n
    return [x.tolist() for x in np.split(np.concatenate(ids), ends[:-1])] if ids else []


@pytest.mark.parametrize("window", [5, 50, 1000, T.WINDOW])
@pytest.mark.parametrize("cached", [10, T.CACHED])
def test_ids_equal_the_tokenizers(tokenizer, monkeypatch, window, cached):
    monkeypatch.setattr(T, "CACHED", cached)
    rng = random.Random(window)
    texts = [None, "", "", " ", "\n", "a\n", *("".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(1500)), "", None]
    assert through_windows(texts, window) == [ids_of(tokenizer, t) for t in texts]


def test_any_text(tokenizer):
    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(max_size=40) | st.text(alphabet=" \n'sé×a.9\xa0", max_size=40), max_size=8), st.integers(1, 60))
    def check(texts, window):
        texts = [t.encode("utf-8", "ignore").decode() for t in texts]
        assert through_windows(texts, window) == [ids_of(tokenizer, t) for t in texts]

    check()


def test_a_tokenizer_of_another_kind_gets_whole_texts():
    path = other_tokenizer()
    texts = ["Hello,  World 's\n\nx", None, "é.é " * 20]
    assert through_windows(texts, 7, path) == [ids_of(Tokenizer.from_file(path), t) for t in texts]


@pytest.mark.parametrize("bits", [T.BYTE_PLANES, T.BIT_PLANES])
@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000])
def test_planes_round_trip(bits, n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 50_000, 2**32):
        ids = rng.integers(0, high, n).astype(np.uint32)
        planes = T.to_planes(ids, bits)
        assert len(planes) == 32 // bits
        assert T.from_planes(planes, n, bits).tolist() == ids.tolist()
    assert T.to_planes(np.full(9, 7, np.uint32), T.BYTE_PLANES)[1:] == [b""] * 3


def test_a_crc_is_joined_from_its_parts():
    data = np.random.default_rng(1).bytes(4 * 1000)
    cuts = [0, 1, 5, 900, 1000]
    parts = [(100 + a, b - a, zlib.crc32(data[4 * a : 4 * b])) for a, b in zip(cuts, cuts[1:])]
    assert T.crc_joined(parts[::-1]) == zlib.crc32(data)


def written(spark, tmp_path, docs, **kw):
    table = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, digest string, copy int").repartition(4)
    path = str(tmp_path / "ids")
    T.write_ids(table, path, T.public_tokenizer(), **kw)
    return path


def plain(tokenizer, docs):
    """Rows in order of the key; equal keys in any order of texts."""
    rows, at = [], 0
    for key, text in docs:
        ids = ids_of(tokenizer, text)
        rows.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows


@pytest.mark.parametrize("bits", [T.BYTE_PLANES, T.BIT_PLANES])
@pytest.mark.parametrize("chunk", [3, 64, T.CHUNK])
def test_documents_and_ranges_read_back(spark, tmp_path, tokenizer, bits, chunk):
    rng = random.Random(chunk)
    docs = [(k, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 40)))) for k in range(-20, 60)]
    docs = [(None, None), *docs, (60, "word " * 3000), (61, "")]
    path = written(spark, tmp_path, docs, chunk=chunk, bits=bits)
    want = plain(tokenizer, docs)
    assert sorted(map(tuple, T.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1]) == want
    every = [i for _, text in docs for i in ids_of(tokenizer, text)]
    index = sorted(map(tuple, spark.read.parquet(f"{path}/index").select("start", "n_ids", "n_docs").collect()))
    assert [s for s, _, _ in index] == np.cumsum([0, *(n for _, n, _ in index[:-1])]).tolist()
    assert sum(n for _, n, _ in index) == len(every)
    assert sum(n for *_, n in index) == len(docs)
    for start, stop in ((0, len(every)), (10, 11), (5, 777), (len(every) - 1, len(every) + 50), (len(every), len(every) + 1), (9, 9)):
        got = sorted(map(tuple, T.read_range(spark, path, start, stop).collect()))
        assert [i for _, ids in got for i in ids] == every[start:stop]
        assert not got or got[0][0] == start


def test_a_hot_key_is_dealt_over_tasks(spark, tmp_path, tokenizer):
    docs = [(5, "same text")] * 3000 + [(k, f"t {k}") for k in range(10)] + [(5, "other")] * 2
    path = written(spark, tmp_path, docs)
    rows = T.read_documents(spark, path).collect()
    assert len(rows) == len(docs)
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(d[0] for d in docs)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows[:-1])]).tolist()
    by_text = {zlib.crc32(np.array(ids_of(tokenizer, t), "<u4").tobytes()) for _, t in docs}
    assert {r.ids_crc32 for r in rows} == by_text


def test_an_empty_table(spark, tmp_path):
    path = written(spark, tmp_path, [])
    assert T.read_documents(spark, path).collect() == []
    assert T.read_range(spark, path, 0, 10).collect() == []


def test_the_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    rows = T.op11_token_files(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in rows] == plain(tokenizer, docs)
