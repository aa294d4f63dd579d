import numpy as np

from tallyboard.llm import language_id as l

SMALL = l.Settings(docs_per_language=40, windows_per_doc=3, steps=80, batch=48)
EN, DE = "the cat and the dog went to the other town with them ", "der Hund und die Katze gehen nicht über schöne Straßen "


def test_gradients_are_those_of_the_loss():
    net = l.Network(["a", "b", "c"], l.Settings(hidden=3, window=6), np.float64)
    rng = np.random.default_rng(1)
    x, lengths, y = rng.integers(97, 103, (6, 4)), np.array([6, 4, 1, 5]), np.array([0, 2, 1, 2])
    _, grads = net.loss(x, lengths, y)
    for p, g in zip(net.parameters(), grads):
        for at in zip(*[rng.integers(0, s, 6) for s in p.shape]):
            if p.shape[-1] == 256:
                at = (at[0], 97 + at[1] % 6)
            was, e = p[at], 1e-6
            p[at] = was + e
            up = net.loss(x, lengths, y)[0]
            p[at] = was - e
            down = net.loss(x, lengths, y)[0]
            p[at] = was
            assert abs((up - down) / (2 * e) - g[at]) < 1e-6


def test_reading_without_the_tape_gives_the_same():
    net = l.Network(["a", "b"], l.Settings(hidden=4, window=16))
    texts = [b"some text that is longer than a window", b"", b"x", b"sixteen bytes ok"]
    best, score = net.label(texts)
    for t, b, s in zip(texts, best, score):
        total = np.zeros(2)
        for i in range(0, len(t), 16):
            x = np.frombuffer(t[i:i + 16].ljust(16), np.uint8).astype(np.intp)[:, None]
            states = np.concatenate([net.units[0].forward(x)[0], net.units[1].forward(x[::-1])[0][::-1]], axis=1)
            e = np.exp(np.matmul(net.out, states) + net.bias)
            total += (e / e.sum(axis=1, keepdims=True))[:len(t[i:i + 16]), :, 0].sum(axis=0)
        if t:
            assert abs(total.max() / len(t) - s) < 1e-4 and total.argmax() == b
        else:
            assert s == 0


def table(docs):
    rng = np.random.default_rng(3)
    text = lambda words, n: " ".join(rng.choice(words.split(), n))
    return docs(*[(i, text(EN if i % 2 else DE, 4 + i % 50), "en" if i % 2 else "de") for i in range(200)])


def test_held_out_accuracy_and_odd_texts(docs):
    data = table(docs)
    net = l.learn(data.filter("doc_id < 150"), SMALL)
    found = l.identify(data.filter("doc_id >= 150"), net).collect()
    assert sum(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de") for r in found) >= 0.95 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)
    odd = docs((1, None), (2, ""), (3, "123 !?"), (4, EN * 2000), (None, DE), (4, EN * 2000))
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in l.identify(odd, net).collect())
    assert got == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "en"), ("4", "en"), ("None", "de")]


def test_reruns_agree(docs):
    data = table(docs)
    one, two = l.learn(data, SMALL), l.learn(data.repartition(5), SMALL)
    assert all((a == b).all() for a, b in zip(one.parameters(), two.parameters()))


def test_nothing_to_learn_from(docs):
    data = docs((1, "some text"), (2, None, "en"))
    assert l.learn(data) is None
    assert [(r["lang_pred"], r["score"]) for r in l.identify(data, None).collect()] == [("und", 0.0)] * 2
    assert l.identify(docs(), l.train({"a": [b"x"], "b": [b"y"]}, SMALL)).count() == 0


def test_the_sample_is_bounded_whatever_the_ids(docs, monkeypatch):
    """Null, repeated and equal rows draw no more than the bound, and what is collected stays within it."""
    data = docs(*[(None, f"{EN} {i}", "en") for i in range(3000)], *[(7, f"{DE} {i}", "de") for i in range(3000)], *[(None, EN, "en")] * 3000)
    seen, collect = [], type(data).collect
    monkeypatch.setattr(type(data), "collect", lambda df: (seen.append(collect(df)), seen[-1])[1])
    found = l._sampled(data, SMALL)
    assert {lang: len(parts) for lang, parts in found.items()} == {"en": 120, "de": 120}
    assert max(map(len, seen)) <= 2 * SMALL.docs_per_language * SMALL.windows_per_doc
    many = docs(*[(i, f"text {i}", f"l{i % 40}") for i in range(400)], *[(i, EN, "en") for i in range(50)])
    assert len(l._sampled(many, l.Settings(languages=5, docs_per_language=2))) == 5
