import numpy as np

from gavelline.llm import toxicity as t

INSULTS = ["blockhead", "nitwit", "scoundrel", "buffoon"]


def texts(n, seed, words=INSULTS, share=0.3):
    draw = np.random.default_rng(seed)
    syllables = ["an", "the", "or", "ing", "re", "lo", "mi", "tan", "del", "so"]
    out, toxic = [], []
    for _ in range(n):
        text = ["".join(draw.choice(syllables, draw.integers(1, 4))) for _ in range(draw.integers(30, 300))]
        bad = draw.random() < share
        if bad:
            for _ in range(1 + len(text) // 60):
                text.insert(draw.integers(0, len(text)), str(draw.choice(words)))
        out.append(" ".join(text))
        toxic.append(float(bad))
    return out, np.array(toxic)


def test_held_out_and_misspelt():
    model = t.fit(*texts(500, 1))
    fresh, toxic = texts(300, 2)
    right = (np.array([model.score(x) for x in fresh]) >= 0.5) == toxic
    assert right.mean() > 0.95
    misspelt, toxic = texts(300, 3, ["blokhead", "nitwitt", "scoundrell", "buffoonn"])
    found = np.array([model.score(x) for x in misspelt]) >= 0.5
    assert found[toxic == 1].mean() > 0.8 and found[toxic == 0].mean() < 0.05


def test_runs():
    found, stretch = t.runs("ab")
    assert len(found) == len(stretch) == 3  # " ab", "ab ", " ab "
    assert len(t.runs("")[0]) == 0
    assert set(t.runs("Word, word!")[0]) == set(t.runs("word")[0])


def test_awkward_rows(spark, awkward, nothing):
    draw, toxic = texts(60, 4)
    documents = spark.createDataFrame([(100 + k, x) for k, x in enumerate(draw)], "doc_id long, text string")
    documents = documents.unionByName(awkward.select("doc_id", "text"))
    labels = [(100 + k, 1, int(v)) for k, v in enumerate(toxic)] + [(None, 1, 1), (7, 1, 0), (99_999, 0, 1), (11, 1, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = t.fitted(documents, labels)
    rows = t.scored(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 11}) == 1
    assert t.scored(nothing, model).count() == 0
    assert t.fitted(nothing, labels) is None and t.fitted(documents, labels.filter("toxic = 1")) is None
    assert {r.score for r in t.scored(awkward, None).collect()} == {0.0}
    again = t.fitted(documents.repartition(3), labels)
    assert np.array_equal(again.weight, model.weight)


def test_an_insult_is_found_wherever_it_stands():
    """One insult in a long text, at all 64 places of a stretch: stretches overlap, so none of them divides it."""
    model = t.fit(*texts(500, 1))
    clean, _ = texts(1, 9, share=0)
    for word in INSULTS:
        scores = []
        for offset in range(64):
            text = "lo " * 3 + "x" * (offset % 7) + " " + "re" * (offset // 2) + " " + word + " " + clean[0][:400]
            scores.append(model.score(text))
        assert min(scores) > 0.5, (word, min(scores))


def test_score_by_plain_stretches():
    """The score equals that of runs listed one by one."""
    draw = np.random.default_rng(2)
    model = t.Model(draw.normal(size=1 << t.BITS).astype(np.float32), -0.3)
    for text in (*texts(6, 5)[0], "a", "ab cd", "x" * 200, "é" * 70 + " ok", " \n"):
        data = b" " + text.encode().translate(t._NORMAL) + b" "
        means = []
        found = [(i, n) for n in range(t.SHORT, t.LONG + 1) for i in range(len(data) - n + 1) if 32 not in data[i + 1 : i + n - 1]]
        buckets = dict(zip(sorted(found, key=lambda x: (x[1], x[0])), t.runs(text)[0]))
        for begin in range(0, len(data), t.STEP):
            mine = [float(model.weight[buckets[i, n]]) for i, n in found if begin <= i < begin + t.STRETCH]
            if mine:
                means.append(sum(mine) / len(mine))
        want = t._chance(max(means, default=0.0) + model.bias)
        assert abs(model.score(text) - want) < 1e-6
