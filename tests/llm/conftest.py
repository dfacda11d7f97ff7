import random

import pytest

PROSE = ("the river ran past the old mill and the children watched the boats go by until evening came and all of them "
         "walked home along the narrow road").split()


def prose(seed: int, n: int) -> str:
    g = random.Random(seed)
    return " ".join(g.choice(PROSE) + g.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """doc_id, text: nulls, empty and blank texts, repeated rows, a null id, no letters, odd characters, a long text."""
    one = prose(1, 60)
    return [(1, one), (2, None), (3, ""), (4, " \n\t "), (5, one), (5, one), (None, prose(2, 30)), (6, prose(3, 40_000)),
            (7, "123 456 -- 7"), (8, "año 漢字 🙂 ñandú x  two  spaces"), (9, "word"), (10, "x" * 5000),
            (11, one + " more")]


#: Further columns whose names operators use for their own.
EXTRA = ("score", "key", "value", "id", "n", "component_id", "shard", "lang_pred", "a", "b", "h", "node")


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(d, t, "en" if i % 2 else None, f"s{i % 3}", len(t or ""), *[i] * len(EXTRA))
            for i, (d, t) in enumerate(odd_rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + \
        ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def tokenizers_at():
    import public_tokenizers

    return public_tokenizers.path
