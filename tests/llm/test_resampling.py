import hashlib
import random
import re
import zlib
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from fareflow.llm import resampling as R
from fareflow.llm.common import numbered
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, rank string"


def plain_features(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return words + [a + b" " + b for a, b in zip(words, words[1:])]


def plain(docs, target, share=R.SHARE):
    s, t = (Counter(zlib.crc32(f) % R.BUCKETS for x in side for f in plain_features(x)) for side in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()) + R.BUCKETS, sum(t.values()) + R.BUCKETS
    rows = []
    for key, text in docs:
        found = [zlib.crc32(f) % R.BUCKETS for f in plain_features(text)]
        gain = [floor(1000 * log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in found]
        weight = floor(sum(gain) / len(gain)) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(found), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    drawn = share * len(able) // 100
    ranked = [(*r, n if n <= drawn else None) for n, r in enumerate(able, 1)]
    return sorted(ranked + [(*r, None) for r in rows if r[1] < 39], key=str)


def run(spark, docs, target, **kw):
    docs = spark.createDataFrame([(*d, "clash") for d in docs], DOCS).repartition(3)
    target = spark.createDataFrame([(t, 1) for t in target], "text string, n_features int")
    return sorted((tuple(r) for r in R.resample(docs, target, **kw).collect()), key=str)


def text_of(rng, n):
    return " ".join(rng.choice(["alpha", "Beta", "gamma7", "été", "x", "y-z", "丁", "o" * 300]) for _ in range(n))


@pytest.mark.parametrize("window", [1, 7, 100, R.WINDOW])
def test_hashes_equal_crc32_in_any_window(window):
    rng = random.Random(window)
    texts = [None, "", "a", " a  b ", "..", "é" * 400 + " Ünd A1", "q" * 512 + " " + "r" * 513, "y " + "z" * 5000]
    texts += [" ".join("k" * rng.choice([1, 120, 130, 250, 255, 256, 257, 511, 512, 513, 800]) for _ in range(8)) for _ in range(40)]
    texts += ["".join(rng.choice("ab é.9Z ") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for column in (pa.array(texts), pa.array(["before", *texts]).slice(1)):
        got = [[] for _ in texts]
        for rows, crc in R.features(*R._texts(column), window=window):
            for row, value in zip(rows.tolist(), crc.tolist(), strict=True):
                got[row].append(value)
        assert [sorted(g) for g in got] == [sorted(map(zlib.crc32, plain_features(t))) for t in texts]


def test_moving_past_zeros_and_constants():
    n = np.array([0, 1, 2, 255, 256, 257, 1000, 65_537])
    whole = [zlib.crc32(b"span" + bytes(k)) for k in n.tolist()]
    linear = np.full(len(n), zlib.crc32(b"span") ^ zlib.crc32(bytes(4)), np.uint32)
    assert (R.moved(linear, n) ^ R.constants(n + 4)).tolist() == whole


def test_against_a_plain_version(spark):
    rng = random.Random(5)
    docs = [(k, text_of(rng, rng.choice([0, 1, 19, 20, 21, 60]))) for k in range(120)]
    docs += [(None, text_of(rng, 40)), (-3, None), (500, ""), (501, text_of(rng, 20_000))]
    docs += [(7, text_of(rng, 50))] * 60 + [(7, text_of(rng, 21)), (8, "x " * 30), (8, "x " * 30)]
    target = [text_of(rng, 30) for _ in range(10)] + [None, "", "alpha beta"] * 3
    assert run(spark, docs, target) == plain(docs, target)
    assert run(spark, docs, target, share=100) == plain(docs, target, share=100)


def test_empty_tables(spark):
    rng = random.Random(6)
    docs = [(k, text_of(rng, 25)) for k in range(9)]
    assert run(spark, [], ["alpha"]) == []
    assert run(spark, docs, []) == plain(docs, [])
    assert run(spark, [(None, None)], [None]) == plain([(None, None)], [None])


def test_documents_like_the_target_are_drawn_more_often(spark):
    rng = random.Random(7)
    like, unlike = ([f"{kind}{i}" for i in range(50)] for kind in "ab")
    docs = [(k, " ".join(rng.choice(like if k % 2 else unlike) for _ in range(60))) for k in range(400)]
    target = [" ".join(rng.choice(like) for _ in range(60)) for _ in range(50)]
    drawn = [r[0] for r in run(spark, docs, target) if r[4] is not None]
    assert len(drawn) == 100
    assert sum(k % 2 for k in drawn) > 90


def test_places_over_ranges(spark):
    rows = spark.createDataFrame([(k % 7, k) for k in range(500)] + [(3, 1000)] * 300, "a long, b long").repartition(5)
    placed = numbered(rows, [F.desc("a"), F.asc("b")], "place", "places").orderBy("place").collect()
    assert [r.place for r in placed] == list(range(1, 801))
    assert [(-r.a, r.b) for r in placed] == sorted((-r.a, r.b) for r in placed)
