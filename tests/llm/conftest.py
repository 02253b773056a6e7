import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, __extra string"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with columns that operators don't know."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"s{(r[0] or 0) % 3}", len(r[1] or ""), 1, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, one long text, ties and repeated rows."""
    passage = " ".join(f"passage{i}" for i in range(60))
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, f"before {passage} after it"),
        (6, f"{passage}\nother words here"),
        (6, f"{passage}\nother words here"),
        (None, f"nameless {passage}"),
        (7, long),
        (8, "ab " * 300),
        (9, "é ü 😀   x y " + passage.upper()),
        (10, f"before {passage} after it"),
    ]
