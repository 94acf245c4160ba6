from __future__ import annotations

import random
import struct

import public_tokenizers
from llm.fixtures import folder
from llm.test_bpe import plain as bpe_plain  # noqa: F401
from llm.test_contamination import brute as contaminated
from llm.test_pii import plain as personal
from llm.test_simhash import classes, plain_fingerprint

import __spark_entry__
import corpus_pipeline
from assayline.llm import bytecnn


def rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    item = " ".join(word() for _ in range(15))
    texts, labels = [], []
    for i in range(160):
        body = [word() for _ in range(rng.randint(40, 150))]
        if i % 4 == 0:
            texts.append(" ".join(w + rng.choice(["###", "%%%"]) for w in body))
        elif i % 10 == 1:
            texts.append(" ".join([*body, item]))
        elif i % 10 == 3:
            texts.append(" ".join([*body, "mail me@host.example or 10.2.3.4"]))
        elif i % 10 == 7:
            texts.append(rng.choice(texts))
        else:
            texts.append(" ".join(body))
        labels.append((i, int("###" not in texts[-1] and "%%%" not in texts[-1]), 0))
    texts += [None, ""]
    return [(i, t, "en", "s", len(t or ""), i) for i, t in enumerate(texts)], labels, [(1, item), (2, "go")]


def test_pipeline_stage_by_stage(spark, tmp_path, bpe_plain):  # noqa: F811
    docs, labels, items = rows()
    frames = dict(
        documents=spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score int"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame(items, "item_id long, text string"),
    )
    sf = folder(spark, tmp_path, **frames)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    net = bytecnn.fit_on(documents, frames["labels"])
    scores = net.probability(bytecnn.features(net, [(d[1] or "").encode() for d in docs]))
    left = [d for d, s in zip(docs, scores) if s >= 0.3]
    assert 100 < len(left) < 135

    label = classes([plain_fingerprint(d[1]) for d in left])
    left = [d for i, d in enumerate(left) if label[i] == i]
    left = [d for d, (_, hit, _) in zip(left, contaminated([d[1] for d in left], items)) if not hit]
    want = {}
    for d in left:
        text = d[1] or ""
        for kind, a, b in sorted(personal(text), key=lambda s: -s[1]):
            text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
        ids = bpe_plain(text)
        want[d[0]] = (len(ids), struct.pack(f"<{len(ids)}I", *ids), True)
    got = {r.doc_id: (r.n_tokens, bytes(r.token_ids), r.decodes) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want
    one = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        one = stage(spark, one, sf)
        assert one.columns == documents.columns and one.dtypes == documents.dtypes


def test_empty_documents(spark, tmp_path):
    docs, labels, items = rows()
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    sf = folder(spark, tmp_path, documents=empty, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_all_queries_are_registered():
    assert public_tokenizers.path("byte_bpe_50k.json")
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


def test_similar_documents_far_apart_in_bits_are_one_group(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 8)))
    texts, far = [], 0
    for _ in range(40):
        body = [word() for _ in range(100)]
        texts += [" ".join(body), " ".join([*body[:50], word(), *body[51:-2], word(), word()])]
        a, b = map(plain_fingerprint, texts[-2:])
        far += (a ^ b).bit_count() > 4
    assert far > 10
    texts += ["few words", "Few  words", "few others", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(0, 80, 2), 80, 82, 83]
