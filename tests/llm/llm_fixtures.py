"""Small tables for the operators' tests: (doc_id, text) rows with every awkward case."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def texts(seed: int = 3, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "délta", "ÉTA", "x1", "y-z", "日本", "the", "of", "#", "##$", "10"]
    out: list[str | None] = [None, "", " ", "\n\n", "one", "one two", "\x1cодин\x85two\xa0three", "a" * 700, "b c " * 400]
    for _ in range(n):
        out.append("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", ". "]) for _ in range(rng.randint(1, 80))))
    passage = " ".join(rng.choice(words) for _ in range(70))
    out += [f"{out[9 + k]} {passage} tail {k}" for k in range(6)]
    out += [out[12], out[12], out[13] + " more", out[14].upper() if out[14] else "", out[15].replace("alpha", "omega", 1)]
    out.append(" ".join(rng.choice(words) for _ in range(4000)))  # a long one
    return out


def rows(some: list[str | None]) -> list[tuple]:
    """Ids in another order than the rows; the last two rows share an id and a text."""
    n = len(some)
    made = [((i * 7) % n + 1, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(some)]
    return [*made, (n + 5, "twice the same row here", None, None, None), (n + 5, "twice the same row here", None, None, None)]


def table(spark, some, extra: tuple = ()):
    """A documents table; ``extra``: names of further columns, that operators may use themselves."""
    df = spark.createDataFrame(rows(some), DOCS)
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("mine").alias(c) for c in extra])


def empty(spark):
    return spark.createDataFrame([], DOCS)
