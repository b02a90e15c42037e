"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, other columns."""

import random

EXTRA = "text string, doc_id long, score double, kept string, n int, row int, shard int, label int, value array<int>"


def words(seed: int, count: int) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho".split()) + str(chosen.randrange(40)) for _ in range(count))


def rows() -> list[tuple[int | None, str | None]]:
    long = words(1, 30_000)
    near = words(2, 300)
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, "a b c d"), (7, near), (8, near + " tail"), (9, near), (9, near), (9, "other text of the same id"),
        (None, near), (None, None), (12, long), (13, long + " x"), (14, "é́ ñ \U0001d518 日本語 <|endoftext|> a\x1cb\x00"), (15, "x" * 70_000), (16, "a  b \n\n c"),
    ]


def frame(spark, pairs=None):
    data = [(t, i, 0.5, "yes", k, k, k, 1, [k]) for k, (i, t) in enumerate(rows() if pairs is None else pairs)]
    return spark.createDataFrame(data, EXTRA)
