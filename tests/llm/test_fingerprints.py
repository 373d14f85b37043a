import hashlib
from collections import Counter

import numpy as np

from gavelline.llm import fingerprints as fp


def jaccard(a, b):
    a, b = fp.terms(a), fp.terms(b)
    terms = set(a) | set(b)
    return sum(min(a[t], b[t]) for t in terms) / sum(max(a[t], b[t]) for t in terms) if terms else 1.0


def test_collisions_follow_the_generalised_jaccard():
    draw = np.random.default_rng(5)
    errors = []
    for k in range(60):
        words = [f"w{i}" for i in draw.integers(0, 60, 120)]
        other = words[: 2 * k] + [f"v{i}" for i in draw.integers(0, 60, 60)] * (1 + k % 3)
        a, b = " ".join(words), " ".join(other)
        errors.append(fp.likeness(*fp.signatures([a, b], 512)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.08


def test_weights_count():
    a, b = fp.signatures(["x " * 50 + "y", "x " * 50 + "z"], 256)
    c, d = fp.signatures(["x y", "x z"], 256)
    assert fp.likeness(a, b) > 0.85 and 0.2 < fp.likeness(c, d) < 0.5


def test_forgetting_changes_nothing(monkeypatch):
    texts = [" ".join(f"t{(k * i) % 311}" for i in range(90)) for k in range(1, 40)]
    want = fp.Sampler(32, 9)
    monkeypatch.setattr(fp, "REMEMBERED", 50)
    few = fp.Sampler(32, 9)
    for t in texts:
        assert (want.sample(t) == few.sample(t)).all()


def check(documents):
    rows = fp.with_next(documents).collect()
    order = sorted(((r.doc_id, r.text or "") for r in documents.collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((d, len(t)) for d, t in order)
    ids = [d for d, _ in order]
    by_id = {r.doc_id: r for r in rows}
    prints = {}
    for k, (d, t) in enumerate(order):
        if ids.count(d) == 1 and ids.count(ids[(k + 1) % len(ids)]) == 1:
            other = order[(k + 1) % len(order)][1]
            new = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
            own, edited, following = fp.signatures([t, new, other])
            r = by_id[d]
            assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            assert (r.fingerprint, r.edited_fingerprint) == (fp.written(own), fp.written(edited))
            assert (r.near_edited, r.near_next) == (fp.likeness(own, edited), fp.likeness(own, following))
        prints.setdefault(t, set()).update(r.fingerprint for r in rows if r.doc_id == d and ids.count(d) == 1)
    assert all(len(p) <= 1 for p in prints.values())
    return rows


def test_awkward_rows(awkward, nothing, corpus):
    check(awkward)
    check(awkward.repartition(9))
    assert fp.with_next(nothing).count() == 0
    alone = check(corpus(["only one document here"]))
    assert alone[0].near_next == 1.0
    check(corpus([f"text {k} of a long row of texts {k * 7}" for k in range(700)]).repartition(6))
