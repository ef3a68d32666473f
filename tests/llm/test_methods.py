"""Steps of the methods against plain, slow versions."""

import json

import numpy as np
import public_tokenizers
import pytest
import corpus_pipeline
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import bpe, langid, quality
from tillsight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.VOCABULARY)


def _small_network(seed=0):
    random = np.random.default_rng(seed)
    return {
        "taps": random.normal(0, 0.3, (quality.WIDTH, 256, quality.FILTERS)).astype(np.float32),
        "bias": random.normal(0, 0.1, quality.FILTERS).astype(np.float32),
        "out": random.normal(0, 0.3, 2 * quality.FILTERS + 1).astype(np.float32),
    }


def _plain_score(p, text):
    """The network byte by byte and chunk by chunk."""
    x = quality.padded(text).tolist() + [0] * quality.WIDTH
    size, step = quality.CELL * quality.CELLS, quality.CELL * quality.STRIDE
    tops = []
    for start in range(0, len(quality.padded(text)) - size + 1, step):
        places = [sum(p["taps"][j][x[at + j]] for j in range(quality.WIDTH)) for at in range(start, start + size)]
        tops.append(np.maximum(np.max(places, axis=0) + p["bias"], 0))
    seen = np.concatenate([np.mean(tops, axis=0), np.max(tops, axis=0), [1]])
    return 1 / (1 + np.exp(-seen @ p["out"]))


def test_scores_match_a_plain_network(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    texts = ["", "a", "x" * 255, "é" * 300] + [(t or "")[:1500] for t in texts[:60]] + [max((t or "" for t in texts), key=len)[:20_000]]
    p = _small_network()
    network = quality.Network(p["taps"], p["bias"], p["out"])
    assert max(abs(network.score(t) - _plain_score(p, t)) for t in texts) < 1e-4


def test_training_sees_what_scoring_sees():
    """The loss of a step is that of the scores, for long documents too."""
    p = _small_network(1)
    network = quality.Network(p["taps"], p["bias"], p["out"])
    texts = ["short", "a longer text, " * 40, "".join(chr(33 + i % 90) for i in range(200_000))]
    good = np.array([1, 0, 1], np.float32)
    loss, _ = quality.slopes(p, [quality.padded(t) for t in texts], good, np.ones(3, np.float32))
    scores = np.array([network.score(t) for t in texts])
    assert abs(loss + np.mean(np.log(np.where(good == 1, scores, 1 - scores)))) < 1e-4


def test_gradient_matches_differences():
    p = {k: v.astype(np.float64) for k, v in _small_network(2).items()}
    docs = [quality.padded("some text " * k) for k in (1, 30, 100)]
    good, weight = np.array([1, 0, 1], np.float32), np.array([1, 2, 0.5], np.float32)
    _, slope = quality.slopes(p, docs, good, weight)
    random = np.random.default_rng(3)
    for name, v in p.items():
        used = np.argwhere(np.abs(slope[name]) > 1e-4)
        for at in map(tuple, used[random.permutation(len(used))[:12]]):
            old, step = v[at], 2e-3
            v[at] = old + step
            up = quality.slopes(p, docs, good, weight)[0]
            v[at] = old - step
            down = quality.slopes(p, docs, good, weight)[0]
            v[at] = old
            assert abs((up - down) / (2 * step) - slope[name][at]) < 0.02 * abs(slope[name][at]) + 3e-4, (name, at)


def test_long_documents_are_trained_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda raw, good: seen.extend(raw))
    rows = [(i, f"{i} " * (30_000 if i % 5 == 0 else 3)) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    quality.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), labels)
    texts = dict(rows)
    assert seen and {r.decode() for r in seen} <= set(texts.values()) and max(map(len, seen)) > 30_000


def test_quality_of_long_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    found = QUERIES["op5_quality"](spark, "/root/testdata/sf0.01")
    both = found.join(docs, "doc_id").join(labels.withColumnRenamed("doc_id", "_of"), F.col("doc_id") == F.col("_of"))
    right = both.where("held_out").groupBy((F.octet_length("text") > 16_384).alias("long")).agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share"), F.count(F.lit(1)).alias("n")
    )
    shares = {r.long: (r.share, r.n) for r in right.collect()}
    assert all(share >= 0.95 for share, _ in shares.values()), shares


def test_chunk_joins_that_disagree_are_widened(monkeypatch):
    library = Tokenizer.from_file(PATH)
    text = "".join(f"word{k * 7919 % 1000} and more, " for k in range(400))
    ids = library.encode(text, add_special_tokens=False).ids
    made = bpe.Encoder(PATH)
    assert len(made._windows(made._chunks([text])[0])) > 3
    assert np.frombuffer(made.encode(text), "<u4").tolist() == ids and made.widened == 0 and made.repaired > 0
    other = bpe.Encoder(PATH)
    windows = bpe.Encoder._windows
    monkeypatch.setattr(bpe.Encoder, "_windows", lambda self, row: [(w, left, right + b"\0\0\0\0") for w, left, right in windows(self, row)])
    assert np.frombuffer(other.encode(text), "<u4").tolist() == ids and other.widened == 1


def test_shared_chunks_are_reused():
    passage = "".join(f"word{k * 7919 % 1000} and more, " for k in range(400))
    made = bpe.Encoder(PATH)
    made.encode("intro " + passage)
    before = made.reused
    made.encode("another beginning of some length " + passage)
    assert made.reused - before > 0.6 * (len(made.encode(passage)) // 4)


@pytest.mark.parametrize("change", [
    lambda d: d["pre_tokenizer"].update(pretokenizers=d["pre_tokenizer"]["pretokenizers"][1:]),
    lambda d: d["model"]["vocab"].update({"inĠthe": 60_000}),
    lambda d: d["added_tokens"][0].update(content="<| start |>"),
    lambda d: d.update(decoder={"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}),
])
def test_tokenizers_that_reach_across_spaces_are_refused(tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        made = json.load(f)
    change(made)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(made), encoding="utf-8")
    with pytest.raises(ValueError, match="across a space"):
        bpe.Encoder(str(path))
    with pytest.raises(ValueError, match="across a space"):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def _plain_language(model, text):
    """Counts, margins and weighted losses of a text, one by one."""
    counts = langid.counts(text).tolist()
    size = sum(counts) ** 0.5
    x = [c**0.5 / size if size else 0.0 for c in counts]
    some = [i for i, c in enumerate(x) if c]
    distances = []
    for k in range(len(model.languages)):
        total = 0.0
        for b in range(model.words.shape[1]):
            margin = sum(x[i] * float(model.weights[i, b]) for i in some) + float(model.weights[-1, b])
            total += float(model.trust[k, b]) * np.log1p(np.exp(-np.clip(margin * float(model.words[k, b]), -30, 30)))
        distances.append(total)
    away = [np.exp(-(d - min(distances)) * model.words.shape[1] / 2) for d in distances]
    best = int(np.argmax(away))
    return model.languages[best], away[best] / sum(away)


def test_decoding_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs)
    rows = docs.where("text is not null").limit(200).withColumn("held_out", F.lit(False))
    texts = {r.doc_id: r.text for r in rows.collect()}
    found = [r for r in langid.predict(rows, model).collect() if r.lang_pred != "und"]
    assert len(found) > 150
    for r in found:
        lang, share = _plain_language(model, texts[r.doc_id])
        assert abs(r.score - share) < 1e-4
        assert r.lang_pred == lang or abs(share - 0.5) < 1e-3


def test_more_languages_than_all_partitions(spark):
    """Nine languages get random codewords, and are told apart as fewer are."""
    random = np.random.default_rng(8)
    letters = ["".join(chr(97 + (7 * k + j * j) % 26) for j in range(9)) for k in range(9)]
    rows = [(i, " ".join("".join(random.choice(list(letters[i % 9]), 5)) for _ in range(40)), f"l{i % 9}") for i in range(540)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(df.where("doc_id < 360"))
    assert model.words.shape == (9, 32)
    held = langid.predict(df.where("doc_id >= 360").withColumn("held_out", F.lit(True)), model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 9}" for r in held) >= 0.95 * len(held)


def test_pipeline_without_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_with_repeated_and_missing_ids(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 7 == 0, None).when(F.col("doc_id") % 5 == 0, 3).otherwise(F.col("doc_id")))
    odd = odd.union(docs.limit(20).withColumn("text", F.lit(None).cast("string"))).withColumns({"score": F.lit("own"), "_copies": F.lit(1)})
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, at = at, corpus_pipeline.materialize(stage(spark, at, str(tmp_path)))
        assert at.columns == odd.columns, name
        if name == "simhash_near_dedup":
            texts = [r.text for r in at.collect()]
            assert len(texts) == len(set(texts)) < before.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == at.count() > 0
