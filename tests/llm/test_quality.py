import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gavelline.llm import quality as q


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab中# |\n\t\x0b\x1c\xa0", max_size=60))
def test_statistics(text):
    assert q.statistics(text)[:5] == plain(text)


def made(n=3000, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.random((n, 3))
    return x, ((x[:, 0] > 0.4) & (x[:, 1] < 0.7)).astype(float)


def test_trees_learn_and_stay_monotone():
    x, y = made()
    noisy = np.where(np.random.default_rng(1).random(len(y)) < 0.1, 1 - y, y)
    trees = q.fit(x, noisy, [0, -1, 1], trees=40)
    fresh, truth = made(seed=4)
    assert ((trees.score(fresh) >= 0.5) == truth).mean() > 0.97
    grid = np.random.default_rng(2).random((200, 3))
    for feature, sign in ((1, -1), (2, 1)):
        scores = []
        for value in np.linspace(0, 1, 60):
            grid[:, feature] = value
            scores.append(trees.score(grid))
        assert (np.diff(np.array(scores), axis=0) * sign >= -1e-12).all()


def test_flat_arrays_equal_a_walk():
    x, y = made(500)
    trees = q.fit(x, y, [0, 0, 0], trees=5)

    def walk(node, row):
        while trees.left[node] != node:
            node = trees.left[node] if row[trees.feature[node]] <= trees.limit[node] else trees.right[node]
        return trees.value[node]

    want = [1 / (1 + np.exp(-trees.base - sum(walk(r, row) for r in trees.roots))) for row in x[:100]]
    assert np.allclose(trees.score(x[:100]), want)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rules(spark, corpus, awkward, nothing):
    good = [" ".join(f"word{(k * i * 7) % 1009}" for i in range(80)) + "." for k in range(1, 150)]
    bad = ["| # " * 5 + " ".join(f"w{(k * i) % 887} |" for i in range(60)) for k in range(1, 150)]
    documents = corpus(good + bad)
    labels = labelled(spark, [(k, int(k < len(good)), 0) for k in range(0, len(good + bad), 2)] + [(None, 1, 0), (9999, 0, 0)])
    rows = q.rules(documents, labels).collect()
    assert all(r.kept == (r.doc_id < len(good) and not r.base_failed) for r in rows)
    assert q.kept_documents(documents, labels).columns == documents.columns
    assert q.kept_documents(documents, labels).count() == sum(r.kept for r in rows)
    for none in (labels.limit(0), labelled(spark, [(0, 1, 0)])):
        for r in q.rules(awkward, none).collect():
            assert r.kept != r.base_failed
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    for r in q.rules(awkward, labels).collect():
        if r.doc_id is not None and r.doc_id not in (11, 12):
            n, *rest, repeated = plain(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest, repeated)
            assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
    assert q.rules(nothing, labels).count() == 0 and q.kept_documents(nothing, labels).count() == 0
