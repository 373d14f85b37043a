import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, shard string, _row string, h1 string"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with awkward rows: nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""

    def make(texts, sources=("a", None, "b")):
        rows = [
            (k, t, "en", sources[k % len(sources)], None if t is None else len(t), 7, "s", "r", "h") for k, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward(spark):
    long_text = " ".join(f"word{k % 977} other{k % 31}" for k in range(40_000))
    shared = "This very line is shared by more than five of the documents here."
    rows = [(k, f"Text {k} of its own kind.\n{shared}\nIts {k * k} end, all said.", "en", "a", 1) for k in range(7)]
    rows += [(7, None, None, None, None), (8, "", "en", "b", 0), (9, " \t\r\n\n", "en", None, 5), (None, "no id at all", "de", "b", 3)]
    rows += [(10, long_text, "en", "c", len(long_text)), (11, "repeated row", "en", "b", 12), (11, "repeated row", "en", "b", 12)]
    rows += [(12, "same id", "en", "a", 7), (12, "other text under one id", "en", "a", 7), (None, None, None, None, None)]
    rows += [(13, "\x0bĞ ÄÖ 中文 \x0c " + "中" * 90, "zh", "é", 9), (14, "x " * 70, "en", "b", 140), (15, shared, "en", "a", 1)]
    rows += [(-3, "The end.  Two spaces <|endoftext|> and a name. ", "en", "a", 5)]
    more = [(*r, 1, "s", "r", "h") for r in rows]
    return spark.createDataFrame(more, SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
