import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text[, lang, source]) as a documents table."""

    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", None if r[1] is None else len(r[1])) for r in rows]
        schema = DOCS + "".join(f", {name} string" for name in extra)
        return spark.createDataFrame([r + ("x",) * len(extra) for r in full], schema)

    return make


#: Rows that every operator must take: null id, text, lang and source, empty and blank texts, a repeated row, one id with two texts.
ODD = [(None, "a text without an id but with words", None, None), (1, None, "en", "src0"), (2, "", "en", None), (3, " \t\n ", None, "src1"),
       (4, "one two three four five six seven", "en", "src0"), (4, "one two three four five six seven", "en", "src0"), (5, "first text", "en", "src0"), (5, "second text", "de", "src1"),
       (6, "word " * 30_000, "en", "src0")]

#: Names that operators use inside; as columns of the input they must not disturb.
CLASHING = ("row", "doc", "words", "block", "score", "gone", "near", "new", "target", "shard", "kept", "in", "source_size", "h1", "w")
