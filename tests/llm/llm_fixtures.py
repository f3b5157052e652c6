"""Documents for the tests of this folder: plain and adverse rows."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves, carried as extra columns
CLASHING = "score double, kept boolean, _row string, _id long, _text string, spans string, length long, label int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs; with ``clashing``, columns of the operators' own names too."""

    def build(pairs, clashing=False, partitions=3):
        rows = [(d, t, "en", None, None if t is None else len(t)) for d, t in pairs]
        schema = DOCUMENTS
        if clashing:
            rows = [r + (0.5, True, "row", 7, "other", "s", 3, 1) for r in rows]
            schema += ", " + CLASHING
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return build


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
ADVERSE = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id at all here"), (None, None), (4, "Same Text"), (5, "same text"),
    (5, "same text"), (6, LONG), (7, LONG), (8, "a"), (9, "ÉÀ ñ 漢字 🙂"), (10, "Ünïcode\x00zero"),
]
