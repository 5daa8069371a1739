import pytest

#: Columns of other meaning whose names the operators use inside.
CLASHING = {"key": "k", "rep": 7, "n": -1, "size": "big", "pattern": "p", "place": 3.5, "runs": "r", "digest": "d", "token": "t", "times": 9, "row": "w", "ids": "i"}


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source), with columns of clashing names."""

    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        ddl = "doc_id long, text string, lang string, source string, n_chars long"
        extra = [(*r, *CLASHING.values()) for r in rows]
        kinds = ", ".join(f"{c} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for c, v in CLASHING.items())
        return spark.createDataFrame(extra, f"{ddl}, {kinds}")

    return make


@pytest.fixture(scope="session")
def odd_texts():
    """Ids and texts that every operator must take: nulls, empty, white space, long, repeated rows, odd characters."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    return [
        (1, f"{word} one two three\nsecond line"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, f"{word} one two three\nsecond line"), (7, word), (7, word),
        (8, "é ▁ü 😀 日本 \x00 ￾ end"), (9, "x" * 5000), (None, word + " without id"), (10, "word"), (11, "a a a a a a a a a a a a a a a a"),
    ]
