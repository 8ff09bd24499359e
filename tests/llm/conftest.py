import pytest

#: Names that the operators use inside; tables may bring them along.
EXTRA = ["score", "node", "split", "key", "digest", "bucket", "position", "gone_id", "term", "_hash", "size"]


@pytest.fixture()
def documents(spark):
    def make(rows, extra=True):
        """Rows of (doc_id, text[, source[, lang]]) as a documents table with clashing extra columns."""
        names = EXTRA if extra else []
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(
            f", {n} string" for n in names)
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s",
                 None if r[1] is None else len(r[1]), *["x"] * len(names)) for r in rows]
        return spark.createDataFrame(full, schema)
    return make
