import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareflow.llm import packing
from fareflow.llm.packing import Packer, WordIds, pack, public_tokenizer


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(public_tokenizer())
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZé É.,!'s\n\t ́ÉßİΣσ0١|<>- "), st.characters(codec="utf-8")), max_size=60))
def test_word_by_word_gives_the_tokenizers_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizer()) if not hasattr(packing, "_t") else packing._t
    packing._t = tokenizer
    assert _words().of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _words(kept=[]):  # noqa: B006
    if not kept:
        kept.append(WordIds(public_tokenizer()))
    return kept[0]


def test_fixed_words():
    tokenizer = Tokenizer.from_file(public_tokenizer())
    for text in ("It's, don't <|endoftext|> x<|startoftext|>. ÉTÉ. Größe!! ét Ⅳ ǅ ﬁ. a.b,c 12.5 İI. ΟΔΟΣ.  x", "." * 40):
        assert _words().of(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_full_cache_starts_anew(monkeypatch, whole):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    text = " ".join(f"Word{chr(97 + k)}, other{k}" for k in range(20))
    assert WordIds(public_tokenizer()).of(text) == whole(text).tobytes()


def check(rows, texts, whole):
    """Every id in one piece, sequences gapless, full or a power of two."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.append(whole(texts[r.doc_id] or ""), 1).astype("<u4")
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in (*pieces.values(), *sequences.values()):
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
    sizes = [sum(x for _, x in parts) for parts in sequences.values()]
    assert all(s <= 2048 and s & (s - 1) == 0 for s in sizes)
    assert {k: sum(x for _, x in parts) for k, parts in pieces.items()} == {k: len(whole(t or "")) + 1 for k, t in texts.items()}
    return sizes


def test_documents_of_all_lengths(spark, whole):
    r = random.Random(1)
    texts = {k: " ".join(r.choice(("the", "Bär", "xyzzy,")) for _ in range(r.choice((0, 1, 5, 300, 2047, 9000)))) for k in range(60)}
    texts |= {90: None, 91: "", 92: "a " * 120_000, 93: " ".join(["a"] * 2047), 94: " ".join(["a"] * 4095)}
    docs = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "doc_id long, text string, offset string")
    sizes = check(pack(docs, public_tokenizer()).collect(), texts, whole)
    assert sum(s == 2048 for s in sizes) > 0.6 * len(sizes)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string").coalesce(1)
    rows = pack(docs, public_tokenizer()).collect()
    assert sum(r.length for r in rows) == 6
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert pack(docs.limit(0), public_tokenizer()).count() == 0


def test_the_level_minimises_the_sum_of_squares():
    r = random.Random(5)
    packer = Packer(0, size=16)
    for doc in range(400):
        length = r.randint(1, 16)
        before = packer.levels.copy()

        def total(level, length=length, before=before):
            after = before.copy()
            after[level] -= level > 0
            after[level + length] += level + length < 16
            return int((after[1:16] ** 2).sum())

        choices = [total(h) for h in range(17 - length) if h == 0 or before[h]] if length < 16 else [total(0)]
        list(packer.add(doc, bytes(4 * length)))
        assert int((packer.levels[1:16] ** 2).sum()) == min(choices)
        assert packer.count == packer.levels.sum() == sum(map(len, packer.open.values()))


def test_few_windows_stay_open(monkeypatch):
    monkeypatch.setattr(packing, "MAX_OPEN", 8)
    packer, rows = Packer(0, size=64), []
    for doc in range(500):
        rows += packer.add(doc, bytes(4 * (33 + doc % 20)))
        assert packer.count <= 8
    rows += packer.end()
    assert sum(r[2] for r in rows) == sum(33 + d % 20 for d in range(500))


def test_small_word_tables_change_no_id(monkeypatch, whole):
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    words = WordIds(public_tokenizer())
    for text in ("The cat, the dog; the CAT saw 12 Ünïted dogs!", "the the mouse's house (cat) the", "", " a  b\tc "):
        assert words.of(text) == whole(text).tobytes()
    assert max(len(words._words), len(words._older), len(words._stems), len(words._older_stems)) <= 4


def test_an_emptied_windows_pieces_follow_the_same_rule():
    """Held against a plain version that tries every window, with single pieces in the windows."""
    r = random.Random(9)
    for _ in range(200):
        packer, size = Packer(0, size=16), 16
        windows = sorted(r.randint(1, 15) for _ in range(r.randint(1, 30)))
        for doc, level in enumerate(windows):
            packer._put(level, [(doc, level, 0, bytes(4 * level))])
        left, closed = windows.pop(0), 0
        while left:
            squares = lambda ws: sum(ws.count(k) ** 2 for k in range(1, size))

            def after(level, left=left, windows=windows):
                rest = windows.copy()
                rest.remove(level)
                return rest + [level + left] * (level + left < size)

            if not windows:
                windows, left = [left], 0
                break
            level = min(sorted(set(windows), reverse=True), key=lambda k: squares(after(k)))
            closed += level + left >= size
            windows, left = after(level), max(0, level + left - size)
        rows = list(packer.empty_one())
        assert sorted(k for k in range(16) for _ in range(packer.levels[k])) == sorted(windows)
        assert len({row[5] for row in rows}) == closed


def test_no_window_is_left_open_and_no_id_lost_whatever_the_bound(monkeypatch):
    lengths = [random.Random(k).choice((1, 3, 9, 33, 40, 63, 64, 200)) for k in range(300)]
    for bound in (1, 2, 16, 4096):
        monkeypatch.setattr(packing, "MAX_OPEN", bound)
        packer, rows = Packer(0, size=64), []
        for doc, length in enumerate(lengths):
            rows += packer.add(doc, bytes(4 * length))
            assert packer.count <= bound
        rows += packer.end()
        covered = defaultdict(list)
        for doc, start, length, _, total, _, _ in rows:
            assert total == lengths[doc]
            covered[doc].append((start, start + length))
        assert all(sorted(x)[0][0] == 0 and [b for _, b in sorted(x)][:-1] == [a for a, _ in sorted(x)][1:] for x in covered.values())
        assert {d: sum(b - a for a, b in x) for d, x in covered.items()} == dict(enumerate(lengths))
        sizes = defaultdict(int)
        for row in rows:
            sizes[row[5]] += row[2]
        assert all(x & (x - 1) == 0 for x in sizes.values())
        assert sum(x < 64 for x in sizes.values()) <= 6


def test_a_word_of_plain_letters_is_kept_once(whole):
    words = WordIds(public_tokenizer())
    text = "window door Window, window DOOR,"
    assert words.of(text) == whole(text).tobytes()
    kept = [w for table in (words._words, words._older, words._stems, words._older_stems) for w in table]
    assert sorted(kept) == sorted(["", "window", "door", "Window,", "DOOR,", ","])


def test_the_word_tables_fit_beside_five_other_tasks(monkeypatch):
    """Of plain words none of which comes again: what the full tables hold, at 200 bytes a word."""
    monkeypatch.setattr(WordIds, "_packed", lambda self, ids: bytes(8))
    monkeypatch.setattr(WordIds, "_plain", lambda self, stem: bytes(8), raising=False)
    words, most = WordIds(public_tokenizer()), 0
    monkeypatch.setattr(words, "_tokenizer", None)
    monkeypatch.setattr(words, "_model", type("Model", (), {"tokenize": staticmethod(lambda stem: [])})())
    letters = str.maketrans("0123456789", "abcdefghij")
    for low in range(0, 1_000_000, 50_000):
        words.of(" ".join(f"x{k}".translate(letters) for k in range(low, low + 50_000)))
        most = max(most, sum(map(len, (words._words, words._older, words._stems, words._older_stems))))
    assert most * 200 <= 60_000_000
