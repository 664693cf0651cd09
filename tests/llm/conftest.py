import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCUMENT + ", row string, size string, shard string, slot string, report string, found string, copies string, key string, id string, hash string, kept string, coin string"


@pytest.fixture(scope="session")
def store(spark, tmp_path_factory):
    """Writes rows as a table in files and reads it back, as operators get theirs."""
    folder = tmp_path_factory.mktemp("tables")
    count = iter(range(10**6))

    def put(rows, schema, files=3):
        path = str(folder / f"t{next(count)}.parquet")
        df = spark.createDataFrame(rows, schema)
        df.repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return put


@pytest.fixture(scope="session")
def documents(store):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns of clashing names."""
    words = "the cat and the dog went to see a very old house near that river today".split()
    long = " ".join(f"{w}{k % 977}" if k % 3 else w for k, w in enumerate(words * 12000))
    rows = [
        (1, " ".join(words), "en", "a", 1), (1, " ".join(words), "en", "a", 1), (2, " ".join(words), "en", None, None),
        (3, None, None, None, None), (None, "the cat and the dog", "en", "b", 2), (None, None, None, "b", None), (None, "the cat and the dog", "en", "b", 2),
        (4, "", "fr", "a", 0), (5, " \n\t ", None, "c", 0), (6, long, "en", "c", len(long)), (7, "1234 !? — 5", "en", "c", 3),
        (8, "le chat et le chien sont dans la maison avec les enfants", "fr", "d", 4), (9, "Ünï \U0001F600 cödé\nSAME LINE HERE\nsame line here ", "fr", "d", 4),
        (10, "  Same Line Here\nother", None, "d", 4),
    ]
    return store([r + ("x",) * 12 for r in rows], CLASHING)


@pytest.fixture(scope="session")
def no_documents(store):
    return store([], CLASHING, 1)
