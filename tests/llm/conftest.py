import pytest
from pyspark.sql import functions as F

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud".split()


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) to a documents table with the remaining columns and some of clashing names."""

    def build(rows, **extra):
        frame = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}") for i, t in rows], "doc_id long, text string, lang string, source string")
        frame = frame.withColumn("n_chars", F.char_length("text").cast("long"))
        return frame.withColumns({name: F.lit(value) for name, value in extra.items()})

    return build


@pytest.fixture(scope="session")
def text_of():
    return prose
