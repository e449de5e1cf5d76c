"""Small tables for tests: odd rows, and documents with planted copies."""

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, row int, tid int, root int, taken int"
LONG = " ".join(f"w{i % 997} x{i}" for i in range(30_000))


def odd_rows() -> list[tuple]:
    plain = "the quick brown fox jumps over the lazy dog and then runs home again to sleep"
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\r ", None, None), (4, "one", "en", None), (5, plain, "en", "b"),
        (6, plain, "en", "b"), (6, plain, "en", "b"), (None, plain, None, None), (None, None, None, None), (7, LONG, "en", "b"),
        (8, "é 漢字 \U0001F600 <|endoftext|> it's 12 +1 (702) 555-0742 a.b@c.example.com 10.0.0.1", "fr", "c"),
        (9, plain.upper(), "en", "c"), (2**60 + 1, "two words", "en", "c"),
    ]
    return [(*r, len(r[1] or ""), 1, "s", 2, 3, 4, 5) for r in rows]


def odd_docs(spark: SparkSession) -> DataFrame:
    """Nulls, empty and long texts, equal rows, null ids, and extra columns whose names operators use themselves."""
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ODD_SCHEMA)


def planted(seed: int = 5, bases: int = 12, words: int = 60) -> list[tuple[int, str]]:
    """Documents with exact copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    texts = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(words // 2, 3 * words))]
        texts.append(base)
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(copy)
    passage = [rng.choice(vocabulary) for _ in range(40)]
    texts += [[rng.choice(vocabulary) for _ in range(rng.randint(2, 60))] + passage for _ in range(15)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]
