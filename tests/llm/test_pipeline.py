import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from dimloom.llm import disclosure, queries

WORDS = ["river", "stone", "house", "green", "quiet", "paper", "seven", "cloud", "table", "music", "north", "early", "glass", "field"]


def write(spark, folder):
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "y"]) for _ in range(n))
    item = " ".join(f"exam{chr(97 + i)}" for i in range(14))
    docs = [(i, say(60) + (" you gribbler" if i % 5 == 0 else ""), "en", "s", 0) for i in range(200)]
    docs += [(300, docs[1][1], "en", "s", 0), (301, docs[2][1] + " end", "en", "s", 0), (302, say(20) + " " + item + " " + say(20), "en", "s", 0),
             (303, say(40) + " write to zoe@mail.example.org now", "en", "s", 0), (304, None, "en", "s", 0), (305, "", None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return {d[0]: d[1] for d in docs}


def test_each_stage_does_its_work_on_what_is_left(spark, tmp_path):
    folder = str(tmp_path)
    texts = write(spark, folder)
    left, docs, columns = set(texts), spark.read.parquet(f"{folder}/documents.parquet"), None
    expected = {"toxicity": {i for i in range(200) if i % 5 == 0}, "simhash near-dedup": {300, 301, 305}, "benchmark decontamination": {302}, "pii": set()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        left -= expected[name]
        assert docs.columns == columns and {r.doc_id for r in docs.select("doc_id").collect()} == left, name
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert kept == {i: texts[i].replace("zoe@mail.example.org", disclosure.LABEL["email"]) if texts[i] else texts[i] for i in left}
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()}
    for i, text in kept.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {i: r.ids_sha256 for i, r in got.items()}


def test_eleven_queries_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)


def test_stages_hand_few_texts_at_once_to_python(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(2500)], "doc_id long, text string").coalesce(1)
    dict(corpus_pipeline.STAGES)["bpe"](spark, docs, "")

    def sizes(batches):
        for batch in batches:
            yield batch.head(1).assign(n=len(batch))[["n"]]

    assert [r.n for r in docs.mapInPandas(sizes, "n long").collect()] == [1000, 1000, 500]
