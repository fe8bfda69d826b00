import hashlib
import random

import public_tokenizers as P
from edge import frame, odd_texts, prose
from pyspark.sql import functions as F

import corpus_pipeline
from trailmill.llm import bpe, quality
from trailmill.llm.queries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STOP = ["the", "and", "of", "to", "in"]


def good(n, seed):
    rnd = random.Random(seed)
    words = prose(n, seed).replace("\n", " ").split(" ")
    return " ".join(rnd.choice(STOP) if rnd.random() < 0.25 else w for w in words)


def documents(spark):
    texts = [good(60 + i % 50, i) for i in range(80)]
    texts += [texts[0], texts[0] + " tail", texts[1], good(70, 500) + " write to jane.doe@mail.example.com or 227.5.221.1 now"]
    texts += odd_texts()
    ids = [None if i == 90 else i for i in range(len(texts))]
    return frame(spark, texts, sources=["abc"[i % 3] for i in range(len(texts))], ids=ids).select(*COLUMNS), texts


def test_every_stage_takes_all_that_is_left(spark, tmp_path):
    docs, texts = documents(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "encoding"]
    stages, out = dict(corpus_pipeline.STAGES), {}
    for name in names:
        docs = stages[name](spark, docs, "")
        out[name] = docs.collect()
        if name != "encoding":
            assert docs.columns == COLUMNS
        docs = spark.createDataFrame(out[name], docs.schema)
    kept = {r["doc_id"] for r in out["quality_rules"]}
    judged = quality.judged(documents(spark)[0]).where("kept").select("doc_id").collect()
    assert kept == {r["doc_id"] for r in judged} and set(range(80)) <= kept
    left = {r["doc_id"] for r in out["near_duplicates"]}
    assert not {80, 81, 82} & left and {0, 1, 83} <= left
    private = {r["doc_id"]: r["text"] for r in out["personal_data"]}
    assert "jane.doe" not in private[83] and "227.5.221.1" not in private[83] and private[1] == texts[1]
    assert {r["doc_id"] for r in out["source_mix"]} <= set(private)
    own = bpe.codec(P.path(RANKS), P.PATTERN)
    for r in out["encoding"]:
        assert own.decode(r["ids"]).decode() == private[r["doc_id"]] and len(r["ids"]) == r["n_tokens"]
        assert r["decoded_sha256"] == hashlib.sha256(private[r["doc_id"]].encode()).hexdigest()


def test_run_applies_the_stages_to_documents(spark, tmp_path):
    docs, _ = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, str(tmp_path))
    assert rows and sorted(map(str, rows)) == sorted(map(str, step.collect()))


def test_stages_of_nothing(spark):
    docs = documents(spark)[0].where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
