import pytest
from texts import prose

@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text): nulls, empties, ties, repeated rows, special strings, odd spaces, a very long text."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (None, base), (None, None), (6, " \t\n\x0b\x0c\r "), (7, "<|endoftext|>one<|endoftext|><|endoftext|> two's  'll 've\n\n x"),
        (8, prose(2, 60_000)), (9, "one"), (10, "ONE"), (11, "  é日本語 ﬁ 12³Ⅷ\u0085x\x1cy"), (12, prose(3, 55) + "\n" + base + "\n" + prose(4, 10)), (13, "spam " * 300), (14, "spam " * 300 + "ham"), (15, "a\nb\na\n\n\n"),
    ]


CLASHES = "row string, key string, words string, n string, h1 string, cid string, component string, bucket string, sig string, span string, label string, `a.b` string"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """With extra columns whose names operators use inside."""
    extra = ["x"] * 11 + [None]
    return spark.createDataFrame([(i, t, *extra) for i, t in odd_texts], "doc_id long, text string, " + CLASHES)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
