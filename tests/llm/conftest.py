import pytest

#: Names that operators use inside; as extra columns they must not disturb anything.
CLASHING = ["key", "row", "digest", "score", "ids", "pieces", "place", "word", "learn", "text_b", "n", "band", "_key", "slot", "html"]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with extra columns of clashing names."""

    def make(pairs, names=("doc_id", "text"), types=("bigint", "string")):
        extra = [c for c in CLASHING if c not in names]
        schema = ", ".join([*(f"`{n}` {t}" for n, t in zip(names, types)), *(f"`{c}` string" for c in extra)])
        return spark.createDataFrame([(*p, *(["x"] * len(extra))) for p in pairs], schema)

    return make
