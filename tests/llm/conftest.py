import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns named like results."""
    long = " ".join(f"word{i % 997} plain" for i in range(60_000))
    rows = [
        (1, None, None, 5, "x"), (2, "", "en", 5, "x"), (3, "  \n ", None, 5, None), (4, "...!?", "en", 5, "x"), (5, "a", "en", 5, "x"), (6, "é", "fr", 5, "x"),
        (7, long, "en", 5, "x"), (8, "the same words again and again", "en", 5, "x"), (9, "The same, words again and again!", "en", 5, "x"),
        (10, "one two three", "en", 5, "x"), (10, "one two three", "en", 5, "x"), (None, "a text without an id", "en", 5, "x"), (11, "<|endoftext|> it's 　 end", "en", 5, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int, n_tokens string")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")
