import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns named like things inside the operators.
CLASH = DOCS + ", node long, component string, key string, size long, copies int, line_gone string, kept_id string, mix_copies long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clash=False, partitions=3):
        """``rows``: ``(doc_id, text)`` or ``(doc_id, text, source)``."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        if clash:
            full = [r + (7, "c", "k", 3, 1, "g", "x", 5) for r in full]
        return spark.createDataFrame(full, CLASH if clash else DOCS).repartition(partitions)

    return make
