import random
import re
import time

import pytest
from pyspark.sql import functions as F

from newsledger.functions.keywords import escape_literal, keyword_pattern, reachable
from newsledger.functions.pii import PiiScanner


def flat(words):
    return "|".join(map(re.escape, words))


def test_the_first_keyword_in_order_wins():
    assert reachable(["ab", "abc", "b", "ab"]) == ["ab", "b"] and reachable(["abc", "ab"]) == ["abc", "ab"]
    chosen = random.Random(1)
    for _ in range(400):
        words = ["".join(chosen.choice("ab.(\\é日") for _ in range(chosen.randrange(1, 5))) for _ in range(chosen.randrange(1, 40))]
        text = "".join(chosen.choice("ab.(\\é日 ") for _ in range(200))
        assert re.findall(keyword_pattern(words), text) == re.findall(flat(words), text), words


def test_deep_and_wide_keyword_sets():
    for words in (["a" * n for n in range(300, 0, -1)], [chr(c) + "x" for c in range(0x4E00, 0x4E00 + 3000)], ["same"]):
        text = "aaaa" * 100 + " ".join(words[::7]) + " same"
        assert re.findall(keyword_pattern(words), text) == re.findall(flat(words), text)


@pytest.mark.parametrize("count", [3, 40])
def test_keywords_in_spark(spark, count):
    words = ["\\s", "\\d+", "a-b", "[x]", "^", "日本", "\U0001d518", "tab\t", "x y", "x"] + [f"word {k}" for k in range(60, 0, -1)]
    words = words[:count]
    texts = ["\\s and s \\d+ 1", "a-b [x] ^ 日本 \U0001d518", "tab\tx yx word 12 word 1", "nothing", "", None]
    scanner = PiiScanner(words, rules=())
    got = [r.m for r in spark.createDataFrame([(t,) for t in texts], "t string").select(scanner.mask(F.col("t")).alias("m")).collect()]
    assert got == [re.sub(flat(words), "[CUSTOM]", t or "") for t in texts]


def test_thousands_of_keywords_cost_little_more_than_three(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8).cache()
    chosen = random.Random(2)
    many = ["".join(chosen.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(5_000)]
    took = {}
    for name, words in (("warm", many[:3]), ("few", many[:3]), ("many", many)):
        start = time.time()
        docs.select(PiiScanner(words).mask(F.col("text")).alias("m")).write.format("noop").mode("overwrite").save()
        took[name] = time.time() - start
    assert took["many"] < 4 * took["few"] + 3, took  # a flat alternation takes some hundred times as long
    docs.unpersist()


def test_literals_in_classes():
    for c in map(chr, range(1, 128)):
        assert re.fullmatch(f"[{escape_literal(c)}]", c) and re.fullmatch(escape_literal(c), c)
