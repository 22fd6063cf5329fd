import zlib

import numpy as np
import pytest

from copyaudit.llm import byte_cnn as q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return q.fit(docs, labels)


def test_halves_cover_the_text():
    for n in (0, 1, q.HALF - 1, q.HALF, q.HALF + 1, 5 * q.HALF + 3):
        data = bytes(i % 251 + 1 for i in range(n))
        rows = q.text_windows(data)
        assert len(rows) == max(1, -(-n // q.HALF))
        assert b"".join(r[:q.HALF].tobytes() for r in rows)[:n] == data


def test_scores_do_not_depend_on_grouping(network, monkeypatch):
    texts = [b"", b"one", b"the cat and the dog " * 40, b"x | y | z " * 900, "é ö ".encode() * 300]
    together = q.text_scores(network, texts)
    alone = np.array([q.text_scores(network, [t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    monkeypatch.setattr(q, "SLICE", 3)
    assert np.allclose(q.text_scores(network, texts), alone, atol=1e-5)


def test_forward_pass_against_loops(network):
    text = b"A plain text of some words, then more of them. " * 9
    values = []
    rows = q.text_windows(text)
    for k in range(len(rows) - 1):
        best = np.full(q.FILTERS, -np.inf)
        for half in rows[k:k + 2]:
            for at in range(q.HALF):
                patch = np.concatenate([network.embed[b] for b in half[at:at + q.WIDTH]])
                best = np.maximum(best, patch @ network.filters)
        active = np.maximum(best + network.bias, 0)
        values.append(np.maximum(active @ network.hidden + network.hidden_bias, 0) @ network.out)
    a, b, c = network.combine
    want = 1 / (1 + np.exp(-(a * min(values) + b * np.mean(values) + c)))
    assert abs(q.text_scores(network, [text])[0] - want) < 1e-4


def test_gradients(monkeypatch):
    rng = np.random.default_rng(3)
    net = q.Network.fresh(rng)
    texts = [rng.integers(0, 256, (n, q.HALF + q.SPAN)).astype(np.uint8) for n in (1, 3)]
    labels, balance = np.array([1, 0]), np.ones(2)

    def loss():
        total = 0.0
        for t, y in zip(texts, labels, strict=True):
            both = np.maximum(net.responses(t[:, :q.SPAN]).max(axis=1), net.responses(t[:, q.HALF:]).max(axis=1))
            values = net.chunk_values(both)
            a, b, c = net.combine
            p = 1 / (1 + np.exp(-(a * values.min() + b * values.mean() + c)))
            total -= np.log(p if y else 1 - p) / 2
        return total

    grads = q._gradients(net, texts, labels, balance)
    for w, g in zip(net.arrays(), grads, strict=True):
        for i in rng.choice(w.size, 3):
            old = w.flat[i]
            w.flat[i] = old + 1e-3
            up = loss()
            w.flat[i] = old - 1e-3
            down = loss()
            w.flat[i] = old
            assert abs((up - down) / 2e-3 - g.flat[i]) < 2e-2 + 0.05 * abs(g.flat[i])


def test_held_out_accuracy(spark):
    rows = q.op2_byte_cnn(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert sum(p == y for p, y in seen) / len(seen) > 0.9
    assert sum(p == y for p, y in seen if y) / sum(y for _, y in seen) > 0.93


def test_awkward_rows(spark, awkward, nothing, network):
    assert q.score(awkward, network).count() == awkward.count()
    assert q.score(nothing, network).count() == 0
    kept = q.keep_good(awkward, network)
    assert kept.columns == awkward.columns and kept.count() <= awkward.count()
    assert q.keep_good(nothing, network).count() == 0


def test_labels_missing_null_or_of_one_class(spark, awkward):
    schema = "doc_id long, quality int, toxic int"
    for rows in ([], [(None, 1, None), (1, None, 0)], [(1, 1, 0), (5, 1, 0)]):
        assert q.fit(awkward, spark.createDataFrame(rows, schema)) is None
    assert {r.score for r in q.score(awkward, None).collect()} == {0.5}
    both = q.chunk_samples(awkward, spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 0), (3, 0, 0)], schema))
    assert {y for _, y in both} <= {0, 1}
