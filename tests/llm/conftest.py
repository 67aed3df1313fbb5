import random

import pytest

# Names that operators use inside; documents may have columns of these names.
CLASHING = ("kept", "fp", "words", "hits", "spans", "part", "rank", "length", "_n", "_bad_id",
            "root", "component_id", "template", "payload", "digest", "first")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = ["ti", "on", "er", "an", "the", "ing", "re", "ha", "st", "ou", "ble", "nd", "é", "ñ"]
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + r.choice(["", "", "", ".", ",", ".\n"]) for w in words)


def odd_texts() -> list[str | None]:
    base = prose(1, 80)
    near = base.split(" ")
    near[40] = "changed"
    return [None, "", " \n\t ", "one", "two words", base, base, " ".join(near), prose(2, 300),
            prose(3, 120).replace(" ", "\n"), "\n".join(["the same line here"] * 30),
            "A  b\x0bc\x1cd e f K \U0001f600 \0 x",
            "UPPER CASE WORDS!! " * 20, "### $$$ %%% " * 30, prose(4, 30000),
            "x" * 30000, "<|endoftext|> and </s> marks\r\n ★★ 5km 3.5 kg"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in any column, empty and long texts, copies,
    repeated rows and ids, and columns of clashing names."""
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", None)[i % 2], None if t is None else len(t))
            for i, t in enumerate(odd_texts())]
    rows += [rows[5], rows[8], (None, "no id here but some words", None, None, None), (None,) * 5,
             (8, "another text under a repeated id", "en", "a", 32)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                        "n_chars long")
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit(7).alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
