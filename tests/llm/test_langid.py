from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelline.llm import langid

#: A few words of each language.
WORDS = {
    "en": "the quick brown fox jumps over lazy dogs while nobody watches them running through thick woods".split(),
    "de": "der schnelle braune fuchs springt über faule hunde während niemand ihnen beim laufen zuschaut".split(),
    "es": "el rápido zorro marrón salta sobre perros perezosos mientras nadie los mira corriendo por el bosque".split(),
}


def segmentations(word, vocabulary):
    """All ways to cut a word into pieces of the vocabulary."""
    for cuts in product((0, 1), repeat=len(word) - 1):
        parts, last = [], 0
        for place, here in enumerate(cuts, 1):
            if here:
                parts.append(word[last:place])
                last = place
        parts.append(word[last:])
        if all(p in vocabulary for p in parts):
            yield [vocabulary[p] for p in parts]


@pytest.fixture(scope="module")
def vocabulary():
    """The pieces that words can hold, read without the operator's tree."""
    import base64

    import public_tokenizers

    with open(public_tokenizers.path(langid.VOCABULARY + ".tiktoken"), "rb") as lines:
        found = [base64.b64decode(line.split()[0]) for line in lines]
    numbers = langid.pieces(langid.VOCABULARY).number
    usable = [p for p in found if all(c in range(97, 123) or c > 127 or (c == 32 and not k) for k, c in enumerate(p))]
    assert set(usable) == set(numbers) and all(bytes([c]) in numbers for c in [32, *range(97, 123), *range(128, 256)])
    return numbers


def test_sum_over_all_segmentations(vocabulary):
    draw = np.random.default_rng(5)
    table = np.log(draw.dirichlet(np.ones(len(vocabulary)), 3).T)
    words = [langid.as_bytes(w) for w in ("a", "the", "über", "perezosos", "ñ", "中文", "laufen", "x" * 11)]
    got = langid.log_probabilities(words, table, langid.VOCABULARY)
    for word, row in zip(words, got):
        ways = list(segmentations(word, vocabulary))
        assert len(ways) > 1
        np.testing.assert_allclose(row, np.log(sum(np.exp(table[w].sum(axis=0)) for w in ways)), rtol=1e-9)


def test_expected_pieces_by_brute_force(vocabulary):
    draw = np.random.default_rng(6)
    table = np.log(draw.dirichlet(np.ones(len(vocabulary)), 2).T)
    words, lang, n = [langid.as_bytes(w) for w in ("laufen", "the", "the", "ñu")], np.array([0, 1, 0, 1]), np.array([3, 5, 1, 2])
    expected = np.zeros(table.shape)
    for word, k, times in zip(words, lang, n):
        ways = list(segmentations(word, vocabulary))
        chance = np.array([np.exp(table[w, k].sum()) for w in ways])
        for way, c in zip(ways, chance / chance.sum()):
            np.add.at(expected, (way, k), c * times)
    got = langid.expected_pieces(words, lang, n, table, langid.VOCABULARY) / langid.UNITS
    np.testing.assert_allclose(got, expected, atol=1e-4)


def test_long_words_do_not_underflow():
    table = np.full((langid.pieces(langid.VOCABULARY).size, 2), -40.0)
    got = langid.log_probabilities([langid.as_bytes("q" * 64), langid.as_bytes("\U0001F600" * 64)], table, langid.VOCABULARY)
    assert np.isfinite(got).all() and (got < -100).all()


def corpus(spark, per=60):
    draw = np.random.default_rng(3)
    rows = []
    for k in range(per):
        for lang, words in WORDS.items():
            rows.append((len(rows), " ".join(draw.choice(words, 12)).capitalize() + ".", lang, "s"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_held_out_documents(spark):
    docs = corpus(spark)
    bucket = F.crc32(F.col("doc_id").cast("string")) % 5
    out = langid.labelled(docs, langid.fitted(docs, bucket != 0)).join(docs.withColumn("held", bucket == 0), "doc_id")
    held = out.filter("held").collect()
    assert len(held) > 20 and all(r.lang == r.lang_pred and 0.9 < r.score <= 1 for r in held)


def test_held_out_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bucket = F.crc32(F.col("doc_id").cast("string")) % 5
    out = langid.labelled(docs, langid.fitted(docs, bucket != 0, rounds=2)).join(docs.withColumn("held", bucket == 0), "doc_id")
    held = out.filter("held").select("lang", "lang_pred").collect()
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)


def test_held_out_rows_do_not_teach(spark):
    docs = corpus(spark, 20)
    first = langid.fitted(docs, F.col("doc_id") < 30)
    changed = docs.withColumn("text", F.when(F.col("doc_id") < 30, F.col("text")).otherwise(F.lit("zzz qqq")))
    changed = changed.withColumn("lang", F.when(F.col("doc_id") < 30, F.col("lang")).otherwise(F.lit("xx")))
    second = langid.fitted(changed, F.col("doc_id") < 30)
    assert first.langs == second.langs and (first.table == second.table).all()


def test_sample_and_partitions_leave_the_model_alone(spark):
    docs = corpus(spark, 30)
    one, other = (langid.fitted(d, F.lit(True), most=7) for d in (docs.coalesce(1), docs.repartition(5, "text")))
    assert (one.table == other.table).all()


def test_awkward_rows(spark, awkward, nothing):
    docs = corpus(spark, 20)
    model = langid.fitted(docs, F.lit(True))
    out = langid.labelled(awkward, model).collect()
    assert len(out) == awkward.count()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in out:
        letters = r.doc_id is None or any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.lang_pred in (model.langs if letters else ["und"]) or r.doc_id is None
        assert 0 <= r.score <= 1 and (letters or r.score == 0)
    assert langid.labelled(nothing, model).collect() == []
    empty = langid.fitted(nothing, F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.labelled(awkward, empty).collect()} == {("und", 0.0)}
    nobody = langid.fitted(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert nobody.langs == []


def test_long_runs_and_long_texts(spark):
    model = langid.fitted(corpus(spark, 20), F.lit(True))
    reader = langid.Reader(model)
    whole, twice = reader.likelihoods(["laufen " * 5, "laufen " * 300_000])
    np.testing.assert_allclose(twice, whole * 60_000, rtol=1e-9)
    run, parts = reader.likelihoods(["a" * 200, " ".join(["a" * 64] * 3 + ["a" * 8])])
    np.testing.assert_allclose(run, parts)
    assert reader.likelihoods(["12 ²½ _ !", "", None]) == [None] * 3


def test_memory_of_words_is_bounded(spark, monkeypatch):
    model = langid.fitted(corpus(spark, 10), F.lit(True))
    texts = [f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(3000)]
    plain = langid.Reader(model).likelihoods(texts)
    reader = langid.Reader(model)
    reader.most = 100
    parts = [x for k in range(0, 3000, 50) for x in reader.likelihoods(texts[k : k + 50])]
    assert len(reader.place) <= 150
    np.testing.assert_allclose(np.array(parts), np.array(plain))
