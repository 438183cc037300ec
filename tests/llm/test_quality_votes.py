"""Votes of the nearest labelled texts: exactness of cosines and votes, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from test_operators import documents, edge, empty  # noqa: F401

from tablesift.llm import quality_votes as qv
from tablesift.llm.registry import QUERIES


def texts_of(n, seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    good = [" ".join(word() for _ in range(rng.randint(5, 60))) + "." for _ in range(n)]
    bad = [rng.choice([" ".join(word().upper() + "!!" for _ in range(30)), " ".join(word() + "###" for _ in range(30)), " ".join([word()] * 30), " | ".join(word() for _ in range(30))]) for _ in range(n)]
    return good, bad


def fitted(n=80):
    good, bad = texts_of(n)
    row, term, weight = qv.counted_terms(good + bad)
    ends = np.searchsorted(row, np.arange(2 * n + 1))
    return qv.fit([(term[a:b], weight[a:b]) for a, b in zip(ends[:-1], ends[1:])], np.repeat([1.0, 0.0], n))


def test_shapes():
    assert qv.shapes("Rewh.### the OF!! 2024-01 Éa | x") == "ul.### l uu!! d-d l | l"
    assert qv.shapes("") == ""


def test_scores_are_votes_of_the_nearest_by_brute_force():
    voters, (good, bad) = fitted(), texts_of(60, 1)
    own = good + bad + ["", None, "   ", good[0]]
    got = voters.score(own)
    vectors = np.array([voters.vectors_of(*qv.counted_terms([t]), 1)[0] for t in own], float)
    for x, score in zip(vectors, got):
        near = np.rint((x @ voters.vectors.T.astype(float)) * (1 << qv.COSINE_BITS)) / (1 << qv.COSINE_BITS)
        least = max(np.sort(near)[-qv.NEIGHBOURS], 0)
        weight = np.where(near >= least, near, 0) ** qv.POWER
        want = weight @ voters.labels / weight.sum() if weight.sum() else voters.labels.mean()
        assert abs(score - want) < 1e-3
    assert np.mean((got[:60] >= 0.3)) > 0.95 and np.mean(got[60:120] < 0.3) > 0.95
    assert got[120] == got[121] == got[122] == 0.5 and got[123] == got[0]
    # A text's score doesn't depend on the texts around it.
    assert np.allclose(voters.score(own[::-1])[::-1], got, atol=1e-4)


def test_directions_span_what_the_texts_share():
    """The subspace holds as much of the labelled texts as that of a full decomposition."""
    voters = fitted(30)
    good, bad = texts_of(30)
    row, term, weight = qv.counted_terms(good + bad)
    dense = np.zeros((60, 1 << qv.BITS), np.float32)
    dense[row, term] = weight * voters.rarity[term]
    dense /= np.sqrt((dense * dense).sum(1, keepdims=True))
    dense = dense[:, dense.any(0)]
    basis = voters.projection[voters.projection.any(1)]
    best = np.linalg.svd(dense, compute_uv=False)[: basis.shape[1]] ** 2
    assert ((dense @ basis) ** 2).sum() > 0.98 * best.sum() and np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-4)


def test_held_out_accuracy(spark):
    """Of documents that no voter comes from, over the labelled ones of a larger table."""
    rows = QUERIES["op13_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = rows.join(labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    own = got[got["held_out"]]
    good, bad = own[own["quality"] == 1]["score"].to_numpy(), own[own["quality"] == 0]["score"].to_numpy()
    area = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    accuracy = (own["predicted"] == own["quality"]).mean()
    assert len(bad) and area > 0.97 and accuracy > max(0.95, own["quality"].mean()) and (good >= 0.3).mean() > 0.98
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()


def test_labels_outside_text_and_held_out_ones_count_for_nothing(spark):
    good, bad = texts_of(40)
    rows = list(enumerate(good + bad))
    labels = [(i, int(i < 40)) for i in range(80)]
    turned = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in labels]
    docs = documents(spark, rows)
    one, two = (qv.train(docs, spark.createDataFrame(y, "doc_id long, quality int")) for y in (labels, turned))
    assert (one.score(good) == two.score(good)).all() and (one.labels == two.labels).all()
    assert len(qv.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"), max_rows=20).labels) == 20


def test_edges(spark, edge, empty):  # noqa: F811
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert qv.train(edge, none) == 0.5
    assert qv.train(edge, spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")) == 1.0
    edge = edge.withColumn("quality", F.lit("clash")).withColumn("label", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    voters = qv.train(edge, labels)
    got = qv.scored(edge, voters)
    assert got.count() == edge.count() and set(got.columns) == {*edge.columns, "score"}
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert qv.scored(empty, voters).count() == 0
    assert qv.train(empty, labels) == 0.5
