"""A small table with every odd case, and plain answers."""

import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n string, key string, text_hash string, "
          "row string, shard string, score string, a string, b string, id string")


def rows_of(*pairs):
    """Rows with further columns whose names the operators use inside."""
    return [(i, t, "en", "s", None if t is None else len(t), *["extra"] * 9) for i, t in pairs]


ODD = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (3, ""), (4, " \n\t "),
       (5, "short text"), (6, LONG), (7, "one two three four five six seven"), (8, "A b\nc d\ne f\ng h"), (9, "A b\nc d\ne f\nz"),
       (None, "no id at all here my friend"), (None, "no id at all here my friend"), (11, "0 1 2 !? ... <|endoftext|> x")]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(*ODD), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
