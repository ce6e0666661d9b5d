"""Operator 13 against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from weekcast.llm import collocations

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, longest=4, support=30, cover=80, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    longer = defaultdict(int)
    for (lang, w), a in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i:i + k]] = max(longer[lang, w[i:i + k]], a)
    out = defaultdict(list)
    for (lang, w), a in cands.items():
        if 100 * longer[lang, w] >= cover * a:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, le, ri, n[lang], -s) for lang, v in out.items() for r, (s, a, p, le, ri) in enumerate(sorted(v)[:top], 1))


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["The", "of", "AND", "straße", "élan", "𝒳", "don't", "a", "b", "漢字", "x\x0by", "q\x1fr", "né e"]
    say = lambda k: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  ", " ; "]) for _ in range(k))
    out = [(say(rng.randint(0, 120)), rng.choice(["en", "fr", None])) for _ in range(150)]
    out += [("to be or not to be", "en")] * 40 + [("New York City Hall", "de"), ("new york city", "de")] * 20 + [("a a a a a a", "es")] * 6
    out += [(None, "en"), ("", None), ("...,,,", "en"), (None, None), ("word", ""), ("lone", "it"), (say(30_000), "en"), ("w" * 700_000 + " tail " + "of the " * 90_000, "xx")]
    return out


@pytest.mark.parametrize("options", [{"support": 30}, {"support": 2, "top": 7}, {"support": 3, "cover": 50, "longest": 3}, {"support": 2, "longest": 2}])
def test_against_plain_counting(spark, rows, options):
    df = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(6)
    got = collocations.mine(df, **options)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert found(got) == plain(rows, **options)


def test_counts_go_before_the_relation_is_shuffled(spark, rows, monkeypatch):
    done, save, free = [], collocations.save, collocations.free
    monkeypatch.setattr(collocations, "save", lambda df, name, **o: (done.append(name), save(df, name, **o))[1])
    monkeypatch.setattr(collocations, "free", lambda session, *saved: (done.append("free"), free(session, *saved)))
    collocations.frequent_phrases(spark.createDataFrame(rows, "text string, lang string"), 2, 3)
    steps = done[done.index("words") + 1:]
    assert steps == [x for k in (1, 2) for x in (f"groups-{k}", "free", f"relation-{k}", f"frequent-{k}", "free")] + ["free"]


def test_cut_keeps_pieces():
    text = b"ab cd, ef gh. ij " * 50_000
    parts = list(collocations.cut(text, 1000))
    assert max(map(len, parts)) <= 1000 and b"\n".join(parts).replace(b"\n", b"").replace(b",", b"").replace(b".", b"") == text.replace(b",", b"").replace(b".", b"")
    pieces = lambda t: [p.split() for p in re.split(rb"[.,\n]", t) if p.split()]
    assert [p for x in parts for p in pieces(x)] == pieces(text)
    assert list(collocations.cut(b"x" * 5000, 1000)) == [b"x" * 5000] and list(collocations.cut(b"", 10)) == [b""]


def test_edges(spark, rows):
    df = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows[:180])], SCHEMA)
    assert collocations.mine(df.limit(0)).collect() == []
    assert collocations.mine(df.limit(3), support=1000).collect() == []
    extra = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(["phrase", "f", "k", "n", "key", "shard", "owner", "part", "rank", "score", "words", "__text"])],
                      F.create_map(F.lit("a"), F.lit(1)).alias("map"))
    assert found(collocations.mine(extra, support=5)) == plain(rows[:180], support=5)
