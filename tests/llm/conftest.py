import random

import pytest
from pyspark.sql import Row
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # Columns whose names the operators also use inside.
    *[StructField(name, StringType()) for name in
      ("row", "key", "word", "_row", "Row0", "bits", "_bits", "_lines", "_dropped", "flag", "part", "node", "kept")],
])
MORE = len(DOCS) - 5


def words(seed, n, stems="an el ti on re ver sch ió ß gra lo mi".split()):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Write (doc_id, text, lang) rows as a documents table and read it again."""

    def write(rows, parts=3):
        rows = [Row(*r, *[None] * (3 - len(r)), "src", None, *"x" * MORE) for r in rows]
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        spark.createDataFrame(rows, DOCS).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)

    return write


#: Rows that every operator must survive: nulls, empty, ties, repeated rows, odd characters, a long text.
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (None, "no id here"), (4, "same text twice over"), (4, "same text twice over"),
    (5, "same text twice over"), (6, "Ünïcode 文字 и текст 🙂  x"), (7, "a"), (8, "a b"), (9, "\x00\x01 7 8 9"),
    (10, words(1, 6000)), (11, words(1, 6000)), (4, "another text under this id"),
]
