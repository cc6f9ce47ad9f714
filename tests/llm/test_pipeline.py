import random

import corpus_pipeline
from fareflow.llm.packing import public_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_planted_cases(spark, tmp_path):
    r = random.Random(6)
    word = lambda: "".join(r.choice(("th", "er", "on", "ing", "ble")) for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = {k: "\n".join(text(40) for _ in range(4)) for k in range(60)}
    item, line = text(30), text(12)
    rows[60] = rows[3]
    rows[61] = " ".join([*rows[4].replace("\n", " ").split(), "tail"])
    rows[62] = f"{text(50)} {item} {text(50)}"
    rows[63], rows[64] = "12 34", None
    rows[65], rows[66] = f"{text(30)}\n{line}", f"{text(30)}\n{line.upper()}!"
    spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows.items()], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), SCHEMA)
        kept.append({d.doc_id: d.text for d in docs.collect()})
    language, lines, copies, clean = kept
    assert set(rows) - set(language) == {63, 64}
    assert set(language) - set(lines) == {60}
    assert lines[66] == rows[66].split("\n")[0] and lines[65] == rows[65]
    assert set(lines) - set(copies) == {61}
    assert set(copies) - set(clean) == {62}
    assert all(clean[k] == rows[k] for k in range(60))

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizer())
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in clean.values())
    assert {p.doc_id for p in pieces} == set(clean) and sum(p.length for p in pieces) == want


def test_the_benchmark_stage_judges_missing_and_repeated_ids_by_text(spark, tmp_path):
    r = random.Random(7)
    text = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    item, clean = text(30), text(60)
    leak = f"{text(20)} {item} {text(20)}"
    rows = [(None, leak), (None, clean), (1, leak), (1, clean), (2, leak), (3, None)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], SCHEMA)
    left = corpus_pipeline.by_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted(((d.doc_id, d.text) for d in left), key=str) == sorted([(None, clean), (1, clean), (3, None)], key=str)


def test_one_text_of_a_group_stays_whatever_its_id(spark, tmp_path):
    r = random.Random(8)
    text = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    one, two, three = text(60), text(60), text(60)
    rows = [(1, one), (1, two), (1, f"{two} tail"), (2, f"{one} tail"), (2, three), (2, three), (None, one), (3, ""), (3, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], SCHEMA)
    left = corpus_pipeline.by_copy(spark, docs, str(tmp_path)).collect()
    texts = [(d.doc_id, d.text) for d in left]
    assert (1, one) in texts and texts.count((2, three)) == 2 and (None, one) in texts
    assert ((1, two) in texts) != ((1, f"{two} tail") in texts)
    assert {(3, ""), (3, None)} <= set(texts) and len(texts) == 7
