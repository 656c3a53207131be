"""Clustering, best-fit packing and resampling against plain versions on odd cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bestfit, importance, lloyd

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# --- clustering


def plain_lloyd(rows, clusters, rounds, dims, seed="2:"):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(256 * x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    digest = lambda r: hashlib.sha256(f"{seed}{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r), r[1]))[:clusters]]

    def assigned():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        groups = defaultdict(list)
        for (c, _), (_, v) in zip(assigned(), kept):
            groups[c].append(v)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    final = assigned()
    inertia = Counter()
    for c, d in final:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    long = lambda n: n if n < 1 << 63 else None
    whole = sum(inertia.values())
    if any(long(d) is None for _, d in final):
        whole = None
    lost = {c for c, d in final if long(d) is None}
    return [
        (i, c, long(d), None if c in lost else inertia[c], whole, sha[c]) for (i, _), (c, d) in zip(kept, final)
    ]


def vectors_of(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumn("chunk", F.lit("x")).withColumn("cluster", F.lit(3)).repartition(3)


def by_text(rows):
    return sorted(map(str, map(tuple, rows)))


def test_clusters_are_those_of_plain_integers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate((rng.normal(size=(700, 6)) + rng.integers(0, 3, (700, 1))).tolist())]
    rows += [(700, None), (701, [1.0] * 5), (702, [None] * 6), (703, [float("nan")] * 6), (704, [float("inf")] + [0.0] * 5)]
    rows += [rows[0], rows[0], (None, [0.5] * 6), (None, [-0.5] * 6), (705, [1.7e308] * 6), (706, [])]
    got = lloyd.clustered(vectors_of(spark, rows), clusters=7, rounds=3, dims=6, block=4).collect()
    assert by_text(got) == by_text(plain_lloyd(rows, 7, 3, 6))


def test_clusters_of_equal_few_and_no_vectors(spark):
    same = [(i, [0.25, -0.25]) for i in range(5)]
    got = lloyd.clustered(vectors_of(spark, same), clusters=3, rounds=2, dims=2, block=1).collect()
    assert by_text(got) == by_text(plain_lloyd(same, 3, 2, 2)) and {r.cluster for r in got} == {0}
    few = lloyd.clustered(vectors_of(spark, same[:2]), clusters=40, rounds=2, dims=2).collect()
    assert by_text(few) == by_text(plain_lloyd(same[:2], 40, 2, 2))
    assert lloyd.clustered(vectors_of(spark, same).limit(0), dims=2).collect() == []


def test_clusters_of_huge_numbers_stay_exact(spark):
    rows = [(i, [x, 1.0]) for i, x in enumerate([1e30, 1e30, -3e12, 5e6, 7e6, 0.0, 1.0])]
    got = lloyd.clustered(vectors_of(spark, rows), clusters=3, rounds=3, dims=2, block=1).collect()
    assert by_text(got) == by_text(plain_lloyd(rows, 3, 3, 2))


def test_packed_arrays_come_back():
    for values in ([[0, -1], [127, -128]], [[40_000, -5]], [[1 << 40, -(1 << 61)]], [[2**31 - 1, -(2**31)]]):
        array_ = np.array(values, np.int64)
        assert (lloyd.unpacked(lloyd.packed(array_), 2) == array_).all()


# --- best-fit packing


def test_open_bins_match_a_plain_search():
    rng = np.random.default_rng(5)
    bins, plain, closed, plain_closed = bestfit.OpenBins(64, 4), [], [], []
    for n, length in enumerate(rng.integers(1, 65, 3000).tolist()):
        closed += bins.put(n, length)
        fits = [b for b in plain if b[0] >= length]
        if fits:
            best = min(b[0] for b in fits)
            chosen = [b for b in plain if b[0] == best][-1]
            plain.remove(chosen)
        else:
            if len(plain) == 4:
                fullest = min(b[0] for b in plain)
                out = [b for b in plain if b[0] == fullest][-1]
                plain.remove(out)
                plain_closed.append(out[1])
            chosen = [64, []]
        chosen[1].append((n, 64 - chosen[0]))
        chosen[0] -= length
        (plain.append(chosen) if chosen[0] else plain_closed.append(chosen[1]))
    assert closed == plain_closed
    assert sorted(map(str, bins.rest())) == sorted(str(b[1]) for b in plain)


def test_pieces_hold_every_id_once(spark, docs, rows, nothing):
    for size, most in ((2048, 256), (32, 3)):
        got = bestfit.pack(docs, WORD_BPE, size=size, open_bins=most).collect()
        coder = Tokenizer.from_file(WORD_BPE)
        ids = {i: coder.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in rows}
        times = Counter(i for i, *_ in rows)
        wanted = Counter()
        for i, n in times.items():
            for piece, at in enumerate(range(0, len(ids[i]), size)):
                part = ids[i][at : at + size]
                wanted[i, piece, at, len(part), zlib.crc32(array("I", part).tobytes())] += n
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= size
        # Bins left by all tasks were joined: at most one is half empty, or few could be better.
        total = sum(r.length for r in got)
        assert len(sequences) <= 1.35 * math.ceil(total / size)
    assert bestfit.pack(nothing, WORD_BPE).collect() == []


def test_ids_are_the_tokenizers(spark):
    coder, ours = Tokenizer.from_file(WORD_BPE), bestfit.Encoder(WORD_BPE)
    texts = ["", " ", "a <|endoftext|> b", "x<|startoftext|>y", "é ́e Z q", "İI ΣΑΣ it's", "\x00퟿ \n\t", "a" * 3000]
    for text in texts:
        assert ours.ids(text) == array("I", coder.encode(text, add_special_tokens=False).ids).tobytes(), text


# --- resampling


def plain_resampling(rows, target, percent, least_words, buckets):
    def features(text):
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text)[1])
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for doc_id, text in rows:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((len(words) >= least_words, doc_id, len(found), weight, score))
    able = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    drawn = percent * len(able) // 100
    ranked = [(*r[1:], n + 1 if n < drawn else None) for n, r in enumerate(able)]
    return ranked + [(*r[1:], None) for r in out if not r[0]]


def test_draw_is_the_plain_one(spark, docs, rows, nothing):
    target = [rows[17][1][:400], rows[4][1], None, ""]
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    texts = [(i, t) for i, t, *_ in rows] + [(None, rows[4][1]), (None, "ÀB c")]
    given = spark.createDataFrame(texts, "doc_id long, text string").withColumn("rank", F.lit("x")).repartition(3)
    for percent, buckets in ((25, 10_000), (60, 1000)):
        got = importance.resampled(given, aim, percent=percent, least_words=20, buckets=buckets).collect()
        assert by_text(got) == by_text(plain_resampling(texts, target, percent, 20, buckets))
    assert importance.resampled(nothing, aim).collect() == []
    alone = importance.resampled(given, aim.limit(0), buckets=100).collect()
    assert by_text(alone) == by_text(plain_resampling(texts, [], 25, 20, 100))


def test_planes_add_up_to_products():
    rng = np.random.default_rng(9)
    counts, gains = rng.integers(0, 70_000, 1000), rng.integers(-9000, 9000, 1000)
    planes, worth = importance.gain_planes(gains)
    sums = importance.plane_sums(importance.count_planes(counts), planes, worth)
    assert sum(int(v) << j for j, v in enumerate(sums)) == int(counts @ gains)


def test_a_text_over_several_blocks_loses_no_pair(monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    whole = importance.bucket_counts(text, 100)[1]
    monkeypatch.setattr(importance, "_BLOCK", 7)
    assert (importance.bucket_counts(text, 100)[1] == whole).all()
