"""The recurrent network: gradients against differences, scores against a plain step-by-step pass."""

import numpy as np

from runpulse.llm import queries as Q
from runpulse.llm.gru import PER_CLASS, UNITS, WINDOW, Gru
from runpulse.llm.lm_scoring import score_documents


def network(seed=5):
    net = Gru(3 * PER_CLASS, 4, seed=seed)
    rng = np.random.default_rng(seed)
    for k, v in net.p.items():
        net.p[k] = (v + 0.1 * rng.standard_normal(v.shape)).astype(np.float32)
    return net, rng


def test_gradients_point_where_the_loss_falls():
    net, rng = network()
    targets = rng.integers(0, 3 * PER_CLASS + 4, (5, 6))
    mask = rng.random(targets.shape) < 0.8
    inputs = np.concatenate([np.zeros((1, 6), dtype=np.int64), targets[:-1]])
    state = np.zeros((6, UNITS), dtype=np.float32)

    def loss():
        states, _ = net.forward(inputs, state, net.table())
        return -net.log_probs(states.reshape(-1, UNITS)[mask.ravel()], targets.ravel()[mask.ravel()]).astype(np.float64).mean()

    grads, _ = net._gradients(inputs, targets, mask, state)
    ours, plain = [], []
    for name, value in net.p.items():
        flat = value.reshape(-1)
        for at in np.argsort(-np.abs(grads[name].reshape(-1)))[:4]:
            kept, ends = flat[at], []
            for step in (0.02, -0.02):
                flat[at] = kept + step
                ends.append(loss())
            flat[at] = kept
            ours.append(grads[name].reshape(-1)[at])
            plain.append((ends[0] - ends[1]) / 0.04)
    ours, plain = np.array(ours), np.array(plain)
    scale = (ours @ plain) / (plain @ plain)  # long gradients are shortened
    assert 0 < scale <= 1.01 and np.abs(ours - scale * plain).max() < 0.02 * np.abs(ours).max()


def test_scores_equal_a_plain_pass():
    net, rng = network(7)
    texts = [rng.integers(0, 3 * PER_CLASS + 4, n) for n in (1, WINDOW, 3 * WINDOW + 5, 2, 40)]
    extra = rng.standard_normal(3 * PER_CLASS + 4)
    got = net.score(np.concatenate(texts), np.array([len(t) for t in texts]), extra)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for text, found in zip(texts, got):
        h, last, total = np.zeros(UNITS), 0, 0.0
        for token in text:
            x, u = p["emb"][last] @ p["wx"] + p["b"], h @ p["wh"]
            z, r = sigmoid(x[:UNITS] + u[:UNITS]), sigmoid(x[UNITS : 2 * UNITS] + u[UNITS : 2 * UNITS])
            n = np.tanh(x[2 * UNITS :] + r * u[2 * UNITS :])
            h = (1 - z) * n + z * h
            logits = h @ p["wc"] + p["bc"]
            kind = token // PER_CLASS if token < net.words else token - net.words + net.classes
            total += logits[kind] - np.log(np.exp(logits).sum()) + extra[token]
            if token < net.words:
                inner = h @ p["wo"][kind] + p["bo"][kind]
                total += inner[token % PER_CLASS] - np.log(np.exp(inner).sum())
            last = token
        assert abs(found - total) < 1e-3 * len(text)


def test_scores_do_not_depend_on_partitions(spark, sf_dir, fresh):
    docs = Q.table(spark, sf_dir, "documents")
    found = []
    for parts in (1, 7):
        path = fresh()
        docs.repartition(parts).write.mode("overwrite").parquet(path)
        rows = score_documents(spark.read.parquet(path)).collect()
        found.append({r.doc_id: (r.n_tokens, r.score) for r in rows})
    one, seven = found
    assert one.keys() == seven.keys()
    assert all(abs(one[k][1] - seven[k][1]) <= 1e-6 * one[k][0] for k in one)
