import random

import pytest

WORDS = [f"{a}{b}" for a in ("lo", "mi", "ra", "te", "un", "so", "ka", "vel") for b in ("ra", "ne", "ti", "pos", "dun", "lim", "che")]
PASSAGE = " ".join(WORDS[i * 5 % len(WORDS)] + str(i % 7) for i in range(60))


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if i % 9 == 8 else "") for i in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"x{seed}y{i}" if r.random() < share else w for i, w in enumerate(text.split()))


def corpus() -> list[tuple]:
    """Ties, copies, near copies, a common passage, NULLs, blank and very long texts, repeated rows and ids."""
    base = prose(1, 240)
    texts = [
        base, base, base, edited(base, 2, 0.02), edited(base, 3, 0.03), edited(base, 4, 0.12), base.upper(), base.replace(" ", "\n"),
        None, "", " \t\n", "one", "one two three", "ONE two\x0bthree", "one two three four", "one two three four five",
        prose(5, 90) + " " + PASSAGE + " " + prose(6, 40), PASSAGE, prose(7, 30) + "\n" + PASSAGE + "\n" + prose(8, 10), PASSAGE + " " + PASSAGE,
        "spam " * 300, "spam " * 301, "a a", "12345 ### *** !!!", "ção über naïve ´quotes´ ²³ ¼ µ", "日本語のテキスト and text", "a b c\x1cd \x85",
        "text with <|endoftext|> and <|startoftext|> inside", " ▁odd▁ marks  two  spaces ", prose(9, 30_000), "z" * 70_000,
        "x" * 49, "x" * 50, "x" * 51, "it's we'll THEY'D i'm", "é combining ﬁ ligature", "İSTANBUL İ",
    ]
    near = prose(10, 120)
    texts += [edited(near, 20 + k, 0.015 * k) for k in range(8)]
    rows = [(i * 3 % 101 + 1, t, ("en", "fr", None)[i % 3], "src", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[3], (None, base, "en", "src", 1), (None, None, None, None, None), (rows[1][0], "same id, other text", "en", "src", 2)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("uid", "keys", "n", "row", "root", "bucket", "n_words", "kept", "lang_pred", "score", "rest", "_t", "_w")


@pytest.fixture(scope="session")
def docs(spark):
    """The corpus with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)]).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return corpus()
