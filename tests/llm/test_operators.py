"""Each operator against a plain version, on rows with every awkward case."""

import hashlib
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import SCHEMA
from weekcast.llm import (common, contamination, langid, packing, passages, ppm, sharding, simhash, sketches, substrings, suffixes, toxicity)
from weekcast.llm.common import row_hash
from weekcast.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


def key(x):
    return brute.order(x)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ------------------------------------------------------------------ 1
def test_toxicity_learns_and_handles_awkward_rows(spark, hard, nothing, clashing):
    rows = [(k, ("you stupid moron " if k % 3 == 0 else "you there ") + " ".join(f"word{(k * 7 + j) % 50}" for j in range(20))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    held = [k for k, _ in rows if brute.remainder(k, 5) == 0]
    assert {k for k, r in got.items() if r.held_out} == set(held)
    assert all(got[k].predicted == int(k % 3 == 0) for k in held)
    assert [rows[3][1][s.start:s.end] for s in got[3].spans] == ["stupid", "moron"]
    for table in (hard, clashing):
        made = toxicity.score(table, labels).collect()
        assert len(made) == hard.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in made)
    assert toxicity.score(nothing, labels).count() == 0
    assert {r.predicted for r in toxicity.score(hard, labels.limit(0)).collect()} == {0}


def test_toxicity_sample_takes_long_texts_and_repeated_ids(spark, monkeypatch):
    fitted = []
    plain = toxicity.fit_field
    monkeypatch.setattr(toxicity, "fit_field", lambda texts, toxic, **k: fitted.append((texts, toxic)) or plain(texts, toxic, **k))
    rows = [(k, ("you stupid moron " if k % 3 == 0 else "you there ") + " ".join(f"word{(k * 7 + j) % 50}" for j in range(20))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows], "doc_id long, toxic int")
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    first = labels.filter(train).orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").first().doc_id
    long = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("long words "), 500_000)).otherwise(F.col("text")))
    again = docs.filter(F.col("doc_id") == first).crossJoin(spark.range(5000)).select("doc_id", "text")
    for table in (long, docs.unionByName(again), long.unionByName(long)):
        fitted.clear()
        got = {r.doc_id: r for r in toxicity.score(table, labels).collect()}
        (texts, toxic), = fitted
        assert len(texts) == labels.filter(train).count() == len(toxic) and sum(map(len, texts)) <= toxicity.SAMPLE_BYTES
        assert all(r.predicted == int(k % 3 == 0) for k, r in got.items() if r.held_out)
    fitted.clear()
    toxicity.fit(long, labels, train, most_bytes=6000)                      # the long one doesn't fit, others do
    assert {True, False} == set(fitted[0][1].tolist()) and 4000 < sum(map(len, fitted[0][0])) <= 6000


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, 9]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    unary, trans = rng.normal(size=offsets[-1]) * 2, rng.normal(size=(2, 2))
    p, pairs = toxicity.marginals(unary, offsets, trans)
    want, counts = np.zeros(len(unary)), np.zeros((2, 2))
    for a, b in zip(offsets, offsets[1:]):
        n, total = b - a, 0.0
        part, part_counts = np.zeros(n), np.zeros((2, 2))
        for path in range(1 << n):
            tags = [path >> k & 1 for k in range(n)]
            steps = list(zip([0, *tags], tags))
            w = np.exp(sum(unary[a + k] * t for k, t in enumerate(tags)) + sum(trans[s] for s in steps))
            total += w
            part += w * np.array(tags)
            for s in steps:
                part_counts[s] += w
        if n:
            want[a:b], counts = part / total, counts + part_counts / total
    assert np.allclose(p, want) and np.allclose(pairs, counts)


def test_marginals_do_not_depend_on_segments(monkeypatch):
    rng = np.random.default_rng(2)
    offsets, trans = np.array([0, 700, 700, 730]), rng.normal(size=(2, 2))
    unary = rng.normal(size=730) * 3
    one, _ = toxicity.marginals(unary, offsets, trans)
    monkeypatch.setattr(toxicity, "SEGMENT", 1000)
    whole, _ = toxicity.marginals(unary, offsets, trans)
    assert np.allclose(one, whole)


# ------------------------------------------------------------------ 2
def test_sharding_counts_slots_and_records(hard, hard_rows, nothing, clashing):
    made = sharding.external_shuffle(hard, shards=7).select("record.*", "size", "text_crc32", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in made) == Counter(hard_rows)
    counts = Counter(r.shard for r in made)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in made if r.shard == s) == list(range(n))
    assert all(r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in made)
    again = sharding.external_shuffle(hard.repartition(5), shards=7).select("record.doc_id", "text_crc32", "shard", "slot")
    assert Counter(rows_of(again)) == Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in made)     # the seed alone decides
    assert sharding.external_shuffle(nothing).count() == 0
    assert sharding.external_shuffle(clashing).select("record.shard").distinct().count() == 1


def test_sharding_matches_a_plain_shuffle(hard):
    """Scatter by the seeded hash, sort, Fisher-Yates and deal, on one machine; rows equal in hash, checksum and size are interchangeable."""
    rows = [(r.doc_id, r.text, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1, r.tie) for r in hard.withColumn("tie", row_hash(hard)).collect()]
    size = max(1 << 10, sum(r[3] for r in rows) // 40)
    made = sharding.external_shuffle(hard, shards=5, seed=9, bucket_bytes=size)
    buckets = max(2 * hard.sparkSession.sparkContext.defaultParallelism, -(-sum(r[3] - 1 for r in rows) // size))

    def bucket(doc, crc, n):
        h = xxhash.xxh64_intdigest((9).to_bytes(4, "little"), 42)
        for value in (doc, crc, n):
            h = xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), h) if value is not None else h
        return (h - (1 << 64) if h >> 63 else h) % buckets

    held = {}
    for r in rows:
        held.setdefault(bucket(r[0], r[2], r[3]), []).append((r[4], r[2], r[3], r[0]))
    dealt, at = [], 0
    for b in sorted(held):
        some = sorted(held[b], key=lambda r: r[:3])
        order = np.arange(len(some))
        np.random.default_rng([9, b]).shuffle(order)
        for k in order.tolist():
            dealt.append((key(some[k][3]), some[k][1], at % 5, at // 5))
            at += 1
    assert len(held) > 10
    assert sorted((key(r.doc_id), r.text_crc32, r.shard, r.slot) for r in made.select("record.doc_id", "text_crc32", "shard", "slot").collect()) == sorted(dealt)


def test_written_shards_read_back(hard, tmp_path):
    shuffled = sharding.external_shuffle(hard, shards=3)
    sharding.write_shards(shuffled, str(tmp_path / "out"))
    assert hard.sparkSession.read.parquet(str(tmp_path / "out")).count() == hard.count()


# ------------------------------------------------------------------ 3, 4
@pytest.mark.parametrize(("operator", "plain"), [(suffixes, brute.byte_repeats), (substrings, brute.word_repeats)])
def test_repeats_match_plain_version(operator, plain, hard, hard_rows, nothing, clashing):
    short = [r for r in hard_rows if len(r[1] or "") < 3000]
    few = hard.filter("text is null or length(text) < 3000")
    for table in (few, clashing.filter("text is null or length(text) < 3000")):
        made = operator.deduplicate(table)
        got = sorted((key(r.doc_id), r.n_units, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in made.collect())
        assert got == plain(short)
    assert any(r[2] for r in plain(short))
    assert operator.deduplicate(nothing).count() == 0
    long = operator.deduplicate(hard).filter("n_units > 20000").collect()       # one text holds a part of the other
    assert sum(r.n_removed >= r.n_units - 2 for r in long) == 1 and len(long) == 2


@pytest.mark.parametrize(("method", "plain"), [(suffixes.BytePassages(), brute.byte_repeats), (substrings.WordPassages(), brute.word_repeats)])
def test_hot_anchors_match_plain_version(method, plain, hard, hard_rows):
    short = [r for r in hard_rows if len(r[1] or "") < 3000]
    made = passages.remove_repeats(hard.filter("text is null or length(text) < 3000"), method, hot_entries=0)     # all are hot
    got = sorted((key(r.doc_id), r.n_units, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in made.collect())
    assert got == plain(short)


@pytest.mark.parametrize(("method", "words"), [(suffixes.BytePassages(), 12), (substrings.WordPassages(), 40)])
def test_hot_anchors_do_not_fill_one_bucket(method, words):
    rng = np.random.default_rng(9)
    say = lambda n: " ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (n, 6)))
    phrase, buckets = say(words), 16
    texts = [f"{say(60)} {phrase} {say(60)}".encode() for _ in range(400)]
    rows = [SimpleNamespace(shard_key=str(k), **common.pack(list(range(k, 400, 4)), texts[k::4])) for k in range(4)]
    asked = pd.concat([passages._ask(r, method, 1) for r in rows], ignore_index=True)
    sent = {}
    for hot_entries in (10**9, 100):
        for row in rows:
            replies = passages._answer(asked, hot_entries)
            row.replies = replies[replies["shard_key"] == row.shard_key].to_dict("records")
        made = pd.concat([passages._gather(r, method, 1, buckets) for r in rows])
        body = made[made["bucket"] >= 0]["body"].map(zstandard.ZstdDecompressor().decompress)
        entries = body.map(lambda b: int(np.frombuffer(b, "<i8", 1)[0])).groupby(made["bucket"][made["bucket"] >= 0].to_numpy()).sum()
        sent[hot_entries] = entries.reindex(range(buckets), fill_value=0)
    assert sent[10**9].max() >= 150 and sent[10**9].max() > 3 * sent[10**9].mean()      # without it, one bucket gets most documents
    assert sent[100].max() < 2 * sent[100].mean()


def test_a_bucket_of_byte_passages_is_merged_in_parts():
    rng = np.random.default_rng(4)
    line = rng.integers(97, 123, 400_000).astype(np.uint8)
    first = np.arange(0, 399_000, 40)
    size = np.full(len(first), 60)
    part = rng.integers(0, passages.PARTS, len(first)).astype(np.uint8)
    method = suffixes.BytePassages()
    sent = [method.message(line, passages.Entries(first, size, first * 0, np.full(len(first), k), first.astype(np.uint64) + np.uint64(k), part)) for k in range(4)]
    assert all(f.all() == (k > 0) and f.any() == (k > 0) for k, f in enumerate(method.solve(sent)))       # other hashes, so none is equal at once
    tracemalloc.start()
    method.solve(sent)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * sum(map(len, sent))


def test_repeats_drop_each_exchange_before_the_next(spark, hard, monkeypatch):
    done, save, free = [], passages.save, passages.free
    monkeypatch.setattr(passages, "save", lambda df, name, **o: (done.append(name), save(df, name, **o))[1])
    monkeypatch.setattr(passages, "free", lambda session, *saved: (done.append("free"), free(session, *saved)))
    suffixes.deduplicate(hard)
    assert done == ["contexts", "free", "windows", "free"]


def test_batches_of_shards_are_limited_by_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    common.ship(spark)
    large = spark.range(20).repartition(1).select(F.expr("unhex(repeat('ab', 1000000))").alias("b"))
    assert max(r.n for r in large.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n int").collect()) < 12


def test_transform_is_the_sorted_suffixes():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 90, 20)
    data = rng.integers(97, 99, size.sum()).astype(np.uint8)
    strings = np.split(data, np.cumsum(size)[:-1])
    rows = sorted((tuple(s[k:]) + (0,), i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
    want = [s[k - 1] + 1 if k else 0 for s, k in ((strings[i], k) for _, i, k in rows)]
    bwt = suffixes.transform(data, size)
    assert bwt.tolist() == want
    lengths, names, at = suffixes.rows_of(bwt, suffixes.last_to_first(bwt), np.arange(len(size)))
    assert lengths.tolist() == size.tolist()
    place = {(i, len(strings[i]) - k): r for r, (_, i, k) in enumerate(rows)}
    assert all(place[i, back] == r for back, (ns, rs) in enumerate(zip(names, at)) for i, r in zip(ns.tolist(), rs.tolist()))


# ------------------------------------------------------------------ 5
def test_pieces_and_packing(hard, hard_rows, nothing):
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    made = packing.pack(packing.cut(hard, ranks), group_pieces=20).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for doc, text, *_ in hard_rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[key(doc), k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((key(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in made) == want
    bins = {}
    for r in sorted(made, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == bins.get(r.sequence_id, 0)
        bins[r.sequence_id] = r.offset + r.length
    assert max(bins.values()) <= 1024 and len(bins) <= -(-sum(bins.values()) // 1024) + 2
    assert packing.pack(packing.cut(nothing, ranks)).count() == 0


def test_pretokens_match_the_tokenizer():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from weekcast.llm.tokens import Encoder

    encoder = Encoder(vocabulary("byte_bpe_50k.tiktoken"))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(alphabet=st.sampled_from(list("'  \n\tsstrevmldaZé９7.!<|>漢  ")) | st.characters(max_codepoint=0x2FF), max_size=30), max_size=5))
    def check(texts):
        assert [x.tolist() for x in encoder.many(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    check()


def test_added_tokens_get_their_ids(spark):
    from weekcast.llm.queries import pieces

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark} x\n{mark}", f"it's  {mark}  's <|endoftext|", "<|endof", "plain text", "", f"word {mark}" * 700]
    want = []
    for k, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want += [(k, x, a, b - a, zlib.crc32(ids[a:b].tobytes())) for x, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert sorted(rows_of(pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))) == want


def test_groups_stay_bounded_when_bins_stay_open(spark):
    rows = [(k, 0, 0, 700, k) for k in range(1500)] + [(2**63 - 1, 0, 0, 600, 7)] * 500
    made = packing.pack(spark.createDataFrame(rows, packing.PIECE_SCHEMA), group_pieces=100).collect()
    assert Counter(r.doc_id for r in made) == Counter([*range(1500), *[None] * 500])
    assert len({r.sequence_id for r in made}) == 2000                       # no two fit together
    assert max(Counter(r.sequence_id >> 20 for r in made).values()) < 200    # level and group


def test_later_rounds_fill_bins_without_one_last_group(spark):
    lengths = np.random.default_rng(8).integers(150, 700, 1500).tolist()
    rows = [(k, 0, 0, n, k) for k, n in enumerate(lengths)]
    made = packing.pack(spark.createDataFrame(rows, packing.PIECE_SCHEMA), group_pieces=100).collect()
    fill = Counter()
    for r in sorted(made, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert len(made) == 1500 and max(fill.values()) <= 1024
    assert max(Counter(r.sequence_id >> 20 for r in made).values()) < 200
    assert len(fill) <= 1.01 * len(packing.pack_group(lengths))


def test_local_search_beats_best_fit_alone():
    rng = np.random.default_rng(5)
    better = 0
    for _ in range(20):
        lengths = rng.integers(200, 520, 120).tolist()
        plain, searched = packing.best_fit(lengths, 1024), packing.pack_group(lengths, 1024)
        assert sorted(i for b in searched for i in b) == list(range(120)) and all(sum(lengths[i] for i in b) <= 1024 for b in searched)
        assert len(searched) <= len(plain)
        better += len(searched) < len(plain)
    assert better


# ------------------------------------------------------------------ 6
def test_simhash_components(hard, hard_rows, nothing, clashing, monkeypatch):
    linked, least = brute.linked(hard_rows)
    want = Counter(linked)
    for large in (simhash.LARGE, 3):                            # 3: nodes are split again and again
        monkeypatch.setattr(simhash, "LARGE", large)
        got = simhash.link(hard).collect()
        assert Counter((key(r.doc_id), r.fingerprint, key(r.component_id)) for r in got) == want
    assert simhash.link(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns and sorted(key(r.doc_id) for r in kept.collect()) == least


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (30, 20, 2)).astype(np.uint64)
    codes = np.unique(np.concatenate([base, (base[:, None] ^ flips[:, :, 0] ^ flips[:, :, 1]).ravel()]))
    node = (codes % np.uint64(3)).astype(np.int64)
    index = simhash.GrayIndex(node, codes)
    got = {frozenset((int(index.codes[a]), int(index.codes[b]))) for x, y in index.pairs(2) for a, b in zip(x, y)}
    want = {frozenset((int(a), int(b))) for i, a in enumerate(codes) for j, b in enumerate(codes[:i]) if node[i] == node[j] and int(a ^ b).bit_count() <= 2}
    assert got == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 400)], "a long, b long")
    got = dict(rows_of(simhash.components(edges)))
    assert all(got[k] == 0 for k in range(1, 201)) and got[500] == 400


# ------------------------------------------------------------------ 7
def test_language_identification(spark, hard, nothing, clashing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert all(r.held_out == (brute.remainder(r.doc_id, 3) == 1) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95
    for table in (hard, clashing):
        made = langid.predict(table).join(hard.select("doc_id", "text").distinct(), "doc_id").collect()
        assert all(0 <= r.score <= 1 for r in made) and {r.lang_pred for r in made} <= {"aa", "bb", "und"}
    made = hard.select("text", langid.identify(F.col("text"), langid.fit(hard)).alias("m")).collect()
    assert all((r.m.lang_pred == "und") == (r.text is None or not any(map(str.isalpha, r.text))) for r in made)
    assert langid.predict(nothing).count() == 0
    assert {r.lang_pred for r in langid.predict(hard.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# ------------------------------------------------------------------ 8
def test_contamination(spark, hard, hard_rows, nothing, clashing, monkeypatch):
    words = brute.WORD.findall(hard_rows[0][1].lower())
    items = [(1, " ".join(words[:14])), (2, " ".join(words[3:5])), (3, "..."), (4, None), (None, hard_rows[50][1]), (5, "漢字 混ぜる"), (5, "漢字 混ぜる"), (6, "not there at all")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contaminated(hard_rows, items)
    assert any(r[2] for r in want)
    for table, few in ((hard, contamination.FEW_DOCS), (clashing, 0)):         # 0: candidates' documents are shuffled
        monkeypatch.setattr(contamination, "FEW_DOCS", few)
        got = contamination.report(table, benchmark).collect()
        assert sorted((key(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got) == want
        assert all(r.contaminated == (r.n_hit > 0) for r in got)
        assert contamination.clean(table, benchmark).count() == sum(not r[2] for r in want)
    assert contamination.report(nothing, benchmark).count() == 0
    assert contamination.report(hard, benchmark.limit(0)).filter("contaminated").count() == 0


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "alpha beta x gamma delta"), (2, "alpha beta gamma delta"), (3, "delta gamma y y beta alpha")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    assert {r.ord for r in contamination.occurrences(docs, benchmark).collect()} == {2}
    assert {r.ord for r in contamination.occurrences(docs, benchmark, slop=1).collect()} == {1, 2}


def test_contamination_plan_is_native(spark, hard):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = contamination.report(hard, benchmark)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ 9
def test_scores_match_plain_version(hard, hard_rows, nothing, clashing, monkeypatch):
    few = hard.filter("text is null or length(text) < 3000")
    rows = [r for r in hard_rows if len(r[1] or "") < 3000]
    want = sorted((*b, s) for b, s in zip(brute.unigram(rows), brute.matching(rows, ppm.ORDER), strict=True))
    for limit in (ppm.TRIE_BYTES, 20_000):                      # 20,000: several passes over the trie
        monkeypatch.setattr(ppm, "TRIE_BYTES", limit)
        made = ppm.score(few).collect()
        got = sorted((key(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in made)
        assert np.allclose(np.array(got, dtype=float), np.array(want, dtype=float))
        assert all(r.held_out == (brute.remainder(r.doc_id, 7) == 2) for r in made)
    assert ppm.score(clashing).count() == len(hard_rows)
    assert ppm.score(nothing).count() == 0
    untrained = ppm.score(few.filter("doc_id = 1")).collect() if brute.remainder(1, 7) == 2 else []
    assert all(r.train_tokens == 0 for r in untrained)


# ------------------------------------------------------------------ 10
def test_fingerprints(hard, hard_rows, nothing, clashing):
    rows = sorted(((key(d), t or "") for d, t, *_ in hard_rows))
    for table in (hard, clashing):
        made = sketches.edited_likeness(table).collect()
        got = sorted((key(r.doc_id), r.n_chars, r.edited_sha256) for r in made)
        want = []
        for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
            cut = len(t) // 4
            want.append((d, len(t), brute.sha((t[:len(t) - cut] + after[:cut]).encode())))
        assert got == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in made)
    same = sketches.fingerprint(hard).select("text", "fingerprint").distinct().groupBy("text").count().filter("count > 1")
    assert same.count() == 0
    assert sketches.edited_likeness(nothing).count() == 0


def test_fingerprints_match_plain_sketches(hard):
    """Bottom-128 sets and their likeness, from sets of shingles; the operator only gives a shingle's hash."""
    few = hard.filter("text is null or length(text) < 3000")
    rows = sorted((key(r.doc_id), r.text or "") for r in few.collect())
    known = {}

    def bottom(text):
        found = sorted(b" ".join(x) for x in brute.shingles(text))
        new = [x for x in found if x not in known]
        known.update(zip(new, (int(h[0]) for h in sketches.sketch_many(new)), strict=True) if new else [])
        return sorted({known[x] for x in found})[:sketches.K]

    def like(a, b):
        union = sorted(set(a) | set(b))[:sketches.K]
        return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0

    want = []
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 4
        own, edited = bottom(t), bottom(t[:len(t) - cut] + after[:cut])
        want.append((d, sketches.encode(np.array(own, dtype=np.uint64)), sketches.encode(np.array(edited, dtype=np.uint64)), round(like(own, edited), 9), round(like(own, bottom(after)), 9)))
    got = [(key(r.doc_id), r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in sketches.edited_likeness(few).collect()]
    assert sorted(got) == sorted(want)


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 3000)]
    a, b = " ".join(words[:2000]), " ".join(words[1000:])
    x, y = sketches.sketch_many([a.encode(), b.encode()])
    both, mine = brute.shingles(a) & brute.shingles(b), brute.shingles(a)
    assert abs(sketches.resemblance(x, y) - len(both) / len(mine | brute.shingles(b))) < 0.15
    assert abs(sketches.containment(x, y) - len(both) / len(mine)) < 0.2
    assert abs(sketches.distinct_count(x) / len(mine) - 1) < 0.3
    parts = sketches.sketch_many([" ".join(words[:1004]).encode(), " ".join(words[1000:2000]).encode()])
    assert (sketches.merge(*parts) == x).all()
    assert (sketches.decode(sketches.encode(x)) == x).all()
    empty = sketches.sketch_many([b""])[0]
    assert sketches.resemblance(empty, empty) == 1.0 and sketches.resemblance(empty, x) == 0.0


# ------------------------------------------------------------------ queries
def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if int(n[2:].split("_")[0]) <= 10))
def test_queries_return_every_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert QUERIES[name](spark, SF).select("doc_id").distinct().count() == docs.count()


def test_schema_fixture_is_the_tables_schema(spark):
    assert [(f.name, f.dataType) for f in spark.read.parquet(f"{SF}/documents.parquet").schema] == [(f.name, f.dataType) for f in SCHEMA]
