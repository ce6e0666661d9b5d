"""Operator 12 against a plain trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weekcast.llm import prefixes
from weekcast.llm.queries import op12_conversation_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))              # remainder with the sign of c
        built[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, b in built.items():
        ends[b].append(c)
        for d in range(len(b) + 1):
            members[b[:d]].add(c)
    children = defaultdict(int)
    for k in members:
        if k:
            children[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        own_saving = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own_saving
            leaves[k[:d]] += not children[k]
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(COLUMNS).collect())


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = []
    for c in list(range(-12, 60)) + [10**15 + 2, 2**62]:
        if c % 11 == 4:
            continue                                    # absent openings
        for t in range(rng.randint(1, 12)):
            rows.append((c, t if rng.random() > .1 else None, rng.choice(["user", "assistant", None]), rng.choice(["hi", "straße", "", None, "ok then"])))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(10)]          # one conversation, 400 times
    rows += [(c, 0, "user", "alone") for c in range(2000, 2060)]                                 # turnless once rebuilt, or proper prefixes
    rows += rows[:40] + [(None, 0, "user", "nobody's"), (5, 3, "a", "bc"), (5, 3, "ab", "c"), (7, 0, "x" * 100_000, "y" * 300_000)]
    return rows


def test_against_a_plain_trie(spark, talks):
    df = spark.createDataFrame(talks, SCHEMA).repartition(7)
    got = prefixes.trie(df)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert found(got) == plain(talks)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op12_conversation_prefix_trie(spark, path)) == plain(rows)


def test_long_end_lists(spark):
    """More ids than a run holds: the digest is fed run by run."""
    rows = [(c * 5, 0, "u", "t") for c in range(20_000)]
    assert found(prefixes.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_edges(spark, talks):
    df = spark.createDataFrame(talks[:50], SCHEMA)
    assert prefixes.trie(df.limit(0)).collect() == []
    names = ["n", "pos", "depth", "hi", "lo", "weight", "leaf", "size", "base", "h", "digest", "a", "b"]
    extra = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)], F.create_map(F.lit("a"), F.lit(1)).alias("map"))
    assert found(prefixes.trie(extra)) == plain(talks[:50])
    nameless = df.withColumn("conv_id", F.lit(None).cast("long"))
    assert prefixes.trie(nameless).collect() == []
