"""Small corpora with the cases every operator must stand."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch long, kept string, n_words string, fp string"


def documents():
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, passages that
    texts share, line feeds, characters of several bytes, marks that some operators use inside."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdeéöñ", k=rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))

    passage, other = prose(60), prose(30)
    texts = [
        "", None, "   \n\t ", "one", "One, two three. Four", prose(40), passage, prose(20) + " " + passage + " " + prose(9),
        passage + "\n" + other, other + " " + passage, prose(12_000), "la " * 700, "aaaa" * 300, "x\0y \0z  <|endoftext|>  end ",
        "a b  c\x0bd\x1ce \x85f", "I'll don't we're 1234 56,78 !!! ??", prose(300), "日本語 テキスト " * 30, "🙂 " * 60,
    ]
    texts += [texts[16], texts[16] + " extra", passage, texts[7]]
    rows = [(k, t, "en", "s", None if t is None else len(t), k % 3, "kept", "x", None) for k, t in enumerate(texts)]
    rows += [rows[7], rows[8], (None, passage, None, None, None, None, None, None, None), (None, "alone", None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
