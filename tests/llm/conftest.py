import random

import pytest

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
# Columns whose names the operators use inside or in their results.
CLASHES = (
    "id", "score", "n", "key", "hub", "component_id", "kept", "pii", "row", "rank", "start",
    "mix_epoch", "_row", "_total", "_copy", "text_", "Doc", "verdict", "set", "found",
)


def documents(spark, texts, lang="en", source="s"):
    """Texts as documents, ids counting from 0; a pair gives the id too."""
    rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, source, 0) for i, t in rows], DOCUMENT)


def with_clashes(df):
    from pyspark.sql import functions as F

    taken = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit(1.5).alias(c) for c in CLASHES if c.lower() not in taken])


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture
def ws(spark):
    from basketweave.workspace import Workspace

    return Workspace(spark)
