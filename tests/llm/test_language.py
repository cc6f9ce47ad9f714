import numpy as np
from pyspark.sql import functions as F

from fareflow.llm import language
from fareflow.llm.language import Network, fit_languages, has_letter, highest_hash, identify


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    net = Network(["a", "b", "c"], seed=3)
    for p in net._parameters():
        p *= 0.5
    data = rng.integers(0, 5, (4, 6)).astype(np.uint8)
    mask = np.arange(6) < np.array([6, 4, 1, 5])[:, None]
    label = np.array([0, 1, 2, 1])

    def loss():
        total = 0.0
        for row, live, k in zip(data, mask, label, strict=True):
            text = row[live]
            for at in range(len(text)):
                total -= np.log(_shares(net, text)[at][k])
        return total / mask.sum()

    for p, g in zip(net._parameters(), net.gradients(data, mask, label), strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in p.shape)
            if p.shape[0] == 256:
                at = (int(rng.integers(0, 5)), at[1])
            was = p[at]
            p[at] = was + 1e-2
            _refresh(net)
            up = loss()
            p[at] = was - 1e-2
            _refresh(net)
            down = loss()
            p[at] = was
            _refresh(net)
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3


def _refresh(net):
    for d in (net.ahead, net.behind):
        d.__dict__.pop("recurrent", None)


def _shares(net, text):
    """Distributions of every position, one after the other."""

    def states(layer, data):
        h, out, n = np.zeros(language.HIDDEN), [], language.HIDDEN
        for b in data:
            x, u = layer.tables[b], h @ layer.back
            z, r = (np.clip(0.25 * (x[k : k + n] + u[k : k + n]) + 0.5, 0, 1) for k in (0, n))
            c = np.tanh(x[2 * n :] + r * u[2 * n :])
            h = (1 - z) * c + z * h
            out.append(h)
        return out

    both = np.concatenate([states(net.ahead, text), states(net.behind, text[::-1])[::-1]], axis=1)
    share = np.exp(both @ net.out + net.bias)
    return share / share.sum(axis=1, keepdims=True)


def test_pooling_is_the_mean_over_all_positions():
    net = Network(["a", "b", "c"], seed=5)
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 127, 128, 129, 700)]
    for text, got in zip(texts, net.pooled(texts), strict=True):
        pieces = [np.frombuffer(text[k : k + language.WINDOW], np.uint8) for k in range(0, len(text), language.WINDOW)]
        want = np.concatenate([_shares(net, p) for p in pieces]).mean(axis=0) if pieces else np.zeros(3)
        assert np.allclose(got, want, atol=1e-4)
        assert len(net.positions(text)) == len(text)


def test_held_out_accuracy_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    parts = {"x": ["th", "ing", "er", "on"], "y": ["sch", "ung", "ei", "ver"], "z": ["ño", "que", "ción", "ar"]}
    rows = [(k, " ".join("".join(rng.choice(parts[name], 3)) for _ in range(rng.integers(2, 40))), name, "c") for k in range(900) for name in [list(parts)[k % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, key string")
    net = fit_languages(docs.filter("doc_id % 3 != 1 OR doc_id % 2 = 0"))
    assert net.languages == ["x", "y", "z"]
    found = {r.doc_id: r for r in identify(docs, net).collect()}
    right = [found[k].lang_pred == name for k, _, name, _ in rows if k % 6 == 1]
    assert np.mean(right) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !"), (None, "thinger"), (5, "ñoque " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in identify(odd, net).collect()}
    assert got == {1: ("und", False), 2: ("und", False), 3: ("und", False), None: ("x", True), 5: ("z", True)}
    assert identify(odd.limit(0), net).count() == 0
    both = identify(odd.withColumn("lang", F.lit("x")), net, keep=("lang", "text"))
    assert both.columns == ["doc_id", "lang", "text", "lang_pred", "score"]
    rows = lambda df: sorted(df.select("doc_id", "text").collect(), key=str)
    assert rows(both) == rows(odd) and {r.doc_id: (r.lang_pred, r.score > 0) for r in both.collect()} == got


def test_without_labels_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert fit_languages(docs) is None
    assert [(r.lang_pred, r.score) for r in identify(docs, None).collect()] == [("und", 0.0)]


def test_every_language_has_its_share_of_hashes():
    for rows in (1, 799, 800, 801, 10**6, 10**9, 10**12, 10**15):
        share = (highest_hash(800, rows) + 2**63) / 2**64
        assert abs(share * rows - min(800, rows)) < 1e-3 * 800


def test_only_letters_are_letters():
    assert all(map(has_letter, ("a", "1é", "丁", "б", "ª")))
    assert not any(map(has_letter, (None, "", "12 34", "²½①Ⅷ", "_-×")))
