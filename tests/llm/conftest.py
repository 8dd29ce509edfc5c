import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names the operators use inside.
CLASHES = "digest salt norm fp root key size packed did twin keys bucket shard hash score label row pass position".split()


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source]) rows, with clashing extra columns if wanted."""

    def build(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clash:
            for name in CLASHES:
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build


@pytest.fixture(scope="session")
def labels(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return build


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def prose(seed: int, n: int) -> str:
    """Words in an order that only the seed decides."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 13) % 7))
    return " ".join(out)


#: Nulls, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (1, None),
    (2, ""),
    (3, "  \t\n "),
    (4, prose(1, 60)),
    (5, prose(1, 60)),
    (5, prose(1, 60)),
    (5, prose(2, 60)),
    (None, prose(2, 60)),
    (None, None),
    (6, prose(1, 30) + "  \n" + prose(3, 40) + " " + prose(1, 30)),
    (7, "é　ü ÀÉ " * 30),
    (8, prose(4, 20_000)),
    (9, "same " * 500),
    (10, "x"),
]


@pytest.fixture(scope="session")
def odd():
    return ODD


@pytest.fixture(scope="session")
def text():
    return prose
