import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def hard_rows():
    """Null ids and texts, empty, wordless and very long texts, repeated rows and ids, near copies, shared passages."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeilnorstu") for _ in range(rng.randint(2, 8))) for _ in range(400)] + ["Élan", "straße", "don't", "ñandú"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, long_text = say(80), say(60_000)
    texts = [say(rng.randint(1, 200)) for _ in range(40)]
    texts += [texts[0]] * 6 + [texts[1] + " " + say(1) for _ in range(6)]
    texts += [f"{say(20)} {passage} {say(20)}" for _ in range(8)] + [passage]
    texts += [None, "", "   \t\n", "1234 5678", "...", "a", "\x00\x01 b", "𝒳𝒴 漢字 混ぜる", long_text, long_text[1000:200_000]]
    rows = [(k * 3 - 5, t) for k, t in enumerate(texts)]
    rows += [(rows[3][0], rows[3][1])] * 3 + [(rows[4][0], texts[5]), (None, texts[2]), (None, None), (2**62 + 1, texts[7])]
    return [(d, t, rng.choice(["aa", "bb", None]) if k % 9 else None, f"src{k % 3}" if k % 5 else None, len(t) if t else None) for k, (d, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def hard(spark: SparkSession, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(hard):
    """The same rows with columns named like the operators' own, and of types that are easily lost."""
    from pyspark.sql import functions as F

    names = ["shard", "slot", "bucket", "fp", "root", "record", "score", "fingerprint", "ord", "piece", "length", "words", "spans", "held_out", "carried", "kept", "item_id",
             "__made", "__null", "__ord", "__txt", "tie", "left", "c0"]
    keyed = F.create_map(F.lit(2), F.lit("x"), F.lit(-1), F.col("lang"))
    return hard.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)], F.timestamp_micros(F.lit(1_700_000_000_123_456)).alias("seen"),
                       F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.col("n_chars").cast("int")).alias("words by kind"),
                       F.when(F.col("doc_id").isNotNull(), keyed).alias("keyed"), F.array(F.struct(F.lit(None).cast("double").alias("x"), F.timestamp_micros(F.lit(7)).alias("t"))).alias("nested"))
