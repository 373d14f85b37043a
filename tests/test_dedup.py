import random

import pytest

from gavelline.functions.similarity import cuts, ratio, segment_lengths, text_keys, whole_edits
from gavelline.operators import dedup


def indel_ratio(a, b):
    """Ratio by the plain table of common subsequences."""
    if a == b:
        return 100
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b):
            diagonal, row[j + 1] = row[j + 1], diagonal + 1 if x == y else max(row[j + 1], row[j])
    return round(100 * 2 * row[-1] / (len(a) + len(b)))


def mutate(rng, text, n, letters):
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars) + 1)
        if rng.random() < 0.5 and chars:
            del chars[min(i, len(chars) - 1)]
        else:
            chars.insert(i, rng.choice(letters))
    return "".join(chars)


def clean(link):
    from urllib.parse import urlparse

    p = urlparse(link)
    return (p.scheme + "://" + p.netloc + p.path) if p.scheme and p.netloc else link


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def one_by_one(rows, store, fuzzy=True):
    """Kept sequence numbers of rows (seq, headline, source, link), tested and added one at a time."""
    links = [r[1] for r in store]
    heads = [r[0] for r in store]
    kept = []
    for seq, headline, source, link in sorted(rows):
        known = False
        if link:
            known = any(lower(x).startswith(lower(clean(link))) for x in links)
            if not known and fuzzy and headline is not None:
                known = any(indel_ratio(headline, h) > 90 for h in heads)
        if known or headline is None or source is None or link is None or (link == "" and "" in links):
            continue
        kept.append(seq)
        links.append(link)
        heads.append(headline)
    return kept


def test_ratio_equals_plain_table():
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 40)))
        b = mutate(rng, a, rng.randrange(0, 8), "abc ")
        assert ratio(a, b) == (indel_ratio(a, b) if a and b else (100 if a == b else 0))


def test_alike_texts_share_a_segment():
    """A segment of the longer text is a stretch of the shorter one, at a place that the lengths allow."""
    rng = random.Random(5)
    checked = 0
    for _ in range(6000):
        letters = rng.choice(["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz "])
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 80)))
        b = mutate(rng, a, rng.randrange(1, 2 + len(a) // 6), letters)
        if a != b and a and b and ratio(a, b) > 90:
            checked += 1
            longer, shorter = sorted((a, b), key=len, reverse=True)
            segments, starts, _, _ = text_keys(longer)
            _, _, stretches, places = text_keys(shorter)
            where = {}
            for key, at in zip(stretches, places):
                where.setdefault(key, []).append(at)
            L, m = len(longer), len(shorter)
            hits = [(p, q) for key, p in zip(segments, starts) for q in where.get(key, ())]
            assert any(200 * (abs(q - p) + abs((L - p) - (m - q))) < 19 * (L + m) for p, q in hits), (a, b)
    assert checked > 1000
    for n in range(1, 600):
        starts, lengths = cuts(n)
        assert len(starts) == whole_edits(n, n) + 1 and lengths.sum() == n and lengths.min() > 0
        assert {int(x) for m in range(n, n * 219 // 181 + 2) if 200 * (m - n) < 19 * (m + n) for x in cuts(m)[1]} == set(segment_lengths(n).tolist())


def _headlines(rng, n):
    words = "tea auction price firm week garden buyer export steady demand lower higher crop rain".split()
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 9))) for _ in range(n // 3)]
    return [mutate(rng, rng.choice(base), rng.randrange(0, 7), "abcxyz ") for _ in range(n)]


@pytest.mark.parametrize("partners", [1, 16])
def test_fuzzy_flags_equal_all_pairs(spark, monkeypatch, partners):
    monkeypatch.setattr(dedup, "FIRST_PARTNERS", partners)
    rng = random.Random(11)
    heads = _headlines(rng, 300)
    new, store = heads[:150] + ["", "ab"], heads[150:]
    df = dedup.headline_fuzzy_dup(
        spark.createDataFrame([(h,) for h in new], "headline string"), spark.createDataFrame([(h,) for h in store], "headline string")
    )
    got = sorted((r["headline"], r["is_duplicate"]) for r in df.collect())
    assert got == sorted((h, any(indel_ratio(h, s) > 90 for s in store)) for h in new)
    assert 20 < sum(d for _, d in got) < 140


def _feed(rng, n):
    heads = _headlines(rng, n)
    links = ["https://a.example.com/news", "https://A.example.com/newsroom/x?utm=1", "https://a.example.com/n",
             "http://b.example.org", "http://b.example.org/x;p=1", "http://b.example.organic/y", "mailto:x", "plain"]
    rows = []
    for seq, h in enumerate(heads):
        link = rng.choice(links) if rng.random() < 0.25 else f"https://site{rng.randrange(40)}.example.com/{rng.randrange(60)}?q={seq}"
        if rng.random() < 0.03:
            link = rng.choice(["", None])
        rows.append((seq, None if rng.random() < 0.02 else h, None if rng.random() < 0.02 else "s", link))
    return rows


@pytest.mark.parametrize("seed,fuzzy,partners", [(1, True, 16), (2, True, 1), (3, False, 1)])
def test_greedy_equals_one_by_one(spark, monkeypatch, seed, fuzzy, partners):
    monkeypatch.setattr(dedup, "FIRST_PARTNERS", partners)
    rng = random.Random(seed)
    rows = _feed(rng, 160)
    store = [(h, l) for _, h, s, l in _feed(rng, 40) if h and l and s]
    new = spark.createDataFrame(rows, "seq bigint, headline string, source string, link string").repartition(5)
    stored = spark.createDataFrame(store, "headline string, link string")
    told = []
    got = sorted(r["seq"] for r in dedup.news_dedup_greedy(new, stored, fuzzy, watch=lambda *x: told.append(x)).collect())
    assert got == one_by_one(rows, store, fuzzy)
    # open rows only ever leave, and the look gets wider where they do not
    assert all(b < a or wide > reach for (reach, a), (wide, b) in zip(told, told[1:])) and len(told) <= 12


def test_a_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Copies that differ in a few letters leave as soon as the first of them is kept."""
    rng = random.Random(4)
    base = "the weekly tea auction closed firm on steady demand from all exporters"
    rows = [(k, mutate(rng, base, 1, "xyz"), "s", f"http://h{k}.example.com/") for k in range(1500)]
    rows += [(2000 + k, "".join(rng.choice("abcdefgh ") for _ in range(40)), "s", f"http://i{k}.example.com/") for k in range(100)]
    sizes = []

    def counted(*args, pairs=dedup.alike_pairs):
        found = pairs(*args)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(dedup, "alike_pairs", counted)
    new = spark.createDataFrame(rows, "seq bigint, headline string, source string, link string")
    told = []
    got = sorted(r["seq"] for r in dedup.news_dedup_greedy(new, new.filter("false"), watch=lambda *x: told.append(x)).collect())
    assert got == [0] + list(range(2000, 2100)) == one_by_one(rows, [])
    assert sum(sizes) < 100 * len(rows) and len(told) <= 4


def test_chain_keeps_both_ends(spark):
    a = "tea prices firm at the weekly auction"
    b = a.replace("weekly", "week")
    c = b.replace("prices", "price")[:-4]
    assert indel_ratio(a, b) > 90 and indel_ratio(b, c) > 90 and indel_ratio(a, c) <= 90
    rows = [(1, a, "s", "http://x.example.com/1"), (2, b, "s", "http://x.example.com/2"), (3, c, "s", "http://x.example.com/3")]
    new = spark.createDataFrame(rows, "seq bigint, headline string, source string, link string")
    empty = spark.createDataFrame([], "headline string, link string")
    got = sorted(r["seq"] for r in dedup.news_dedup_greedy(new, empty).collect())
    assert got == one_by_one(rows, [])


def test_link_prefix_rules(spark):
    stored = ["https://a.example.com/newsroom/x", "HTTP://B.example.org/Path?x=1", "ftp://c.example.net/z", "weird"]
    new = ["https://a.example.com/news", "http://b.example.org/path", "http://b.example.org", "https://a.example.co",
           "https://a.example.com/other", "wei", "x", "", None, "ftp://c.example.net/z#top", "https://a.example.com/newsroom/x?y"]
    df = dedup.link_exists_anti(
        spark.createDataFrame([(n,) for n in new], "link string"), spark.createDataFrame([(s,) for s in stored], "link string")
    )
    got = sorted(str(r["link"]) for r in df.collect())
    want = [n for n in new if not n or not any(lower(s).startswith(lower(clean(n))) for s in stored)]
    assert got == sorted(str(w) for w in want)


def test_first_lines_of_documents_equal_all_pairs(spark):
    from gavelline.bindings import news
    from gavelline.functions.similarity import ratio

    sf = "/root/testdata/sf0.001"
    lines = {r["seq"]: r["headline"] for r in news._first_lines(spark, sf).collect()}
    got = {r["seq"]: r["is_duplicate"] for r in news.first_line_fuzzy_dup(spark, sf).collect()}
    even = {h for k, h in lines.items() if k % 2 == 0}
    assert got == {k: any(ratio(h, x) > 90 for x in even) for k, h in lines.items() if k % 2}
    assert max(map(len, lines.values())) > 500 and 0 < sum(got.values()) < len(got)


def test_walk_over_a_hot_site(spark):
    """Most links are of one site, prefixes nest, and ranges begin inside of them; no row per prefix length is made."""
    from gavelline.operators.prefixes import prefix_matches

    rng = random.Random(6)
    parts = ["a", "ab", "b", "news", "newsroom", "x"]
    texts = ["http://hot.example/" + "/".join(rng.choice(parts) for _ in range(rng.randrange(6))) for _ in range(3000)]
    texts += [f"http://s{k}.example/{rng.choice(parts)}" for k in range(200)] + ["http://hot.exam", "h", "中", "中文"]
    stored = sorted(set(texts[::2] + ["中文 x"]))
    wanted = sorted(set(texts[1::2]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many ranges as there are shuffle partitions
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        frames = [spark.createDataFrame([(t,) for t in ts], f"{c} string") for c, ts in (("clean", wanted), ("low", stored))]
        got = sorted(map(tuple, prefix_matches(*frames).collect()))
        once = prefix_matches(*frames, once=True).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted((w, s) for w in wanted for s in stored if s.startswith(w))
    assert {r.clean for r in once} == {w for w, _ in got} and len(once) < len(wanted) + 23 * 30


def test_no_cross_joins(spark):
    new = spark.createDataFrame([("http://x.example.com/1",)], "link string")
    plan = dedup.link_exists_anti(new, new)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
