"""Each corpus operator against a plain version on a small table of odd cases."""

from __future__ import annotations

import hashlib
import io
import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import (
    components,
    exact,
    hashed,
    lookup_sketch,
    mixing,
    packing,
    passages,
    quality,
    repeats,
    simhash,
    surroundings,
    toxicity,
    warc,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- mixing


def test_mix_meets_targets(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target, left = {}, 1.5 * sum(sizes.values())
    open_ = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    while True:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w >= 2 * sizes[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    target |= {s: level * w for s, w in open_.items()}
    taken = defaultdict(int)
    for r in got:
        assert r.mix_size == len(words(r.text)) and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(target[r.source])
        assert 0 <= r.mix_taken <= 2 * r.mix_size
        assert all(0 <= t <= 1 for t in r.mix_times)
        taken[r.source] += r.mix_taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_schedules_invert_to_their_integral():
    for schedule in mixing.RAMPS:
        segments = mixing.integrated(schedule)
        start, rate, slope, before = segments[-1]
        span = 1 - start
        assert before + rate * span + slope * span * span / 2 == pytest.approx(1)


def test_training_order_repeats_and_sorts(docs, nothing):
    ordered = mixing.in_training_order(docs)
    assert ordered.columns == docs.columns
    counts = Counter(r.doc_id for r in ordered.collect())
    expected = Counter()
    for r in mixing.mix(docs).collect():
        expected[r.doc_id] += len(r.mix_times)
    assert counts == Counter({k: v for k, v in expected.items() if v})
    assert mixing.mix(nothing).count() == 0


# --- simhash


def plain_fingerprint(text):
    data = (text or "").encode()
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    found = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("errors", [4, 9])
def test_simhash_components(docs, rows, nothing, errors):
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= errors:
                    label[i] = label[j] = min(label[i], label[j])
    smallest = defaultdict(lambda: 10**9)
    for (doc_id, *_), k in zip(rows, label):
        smallest[k] = min(smallest[k], doc_id)
    expected = Counter((r[0], p, smallest[k]) for r, p, k in zip(rows, prints, label))
    got = simhash.near_duplicates(docs, errors).collect()
    assert Counter((r.doc_id, r.simhash % (1 << 64), r.component_id) for r in got) == expected
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_row_of_each_near_group_stays(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in range(40):
        one = [f"w{x}" for x in rng.integers(0, 9999, 300)]
        rows.append((2 * n, " ".join(one)))
        # One word changed, or many.
        rows.append((2 * n + 1, " ".join(one[: 299 - n] + ["x"] + (one[300 - n :] if n % 2 else []))))
    # An id that two texts share, rows that repeat, rows without an id.
    rows += [(7, rows[10][1]), (7, "quite another text of its own"), (3, "quite another text of its own")]
    rows += [(200, "said once more"), (200, "said once more"), (None, "said once more"), (None, None), (None, None), (201, "")]
    prints = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
    groups = defaultdict(list)
    for row, k in zip(rows, label):
        groups[k].append(row)
    # Texts of a group that share the smallest id may each be the one that stays.
    left = [{r for r in g if (r[0] is None, r[0] or 0) == min((x[0] is None, x[0] or 0) for x in g)} for g in groups.values()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit(c) for c in ("t1", "root", "first", "id", "copies", "simhash", "dropped_id")})
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and {r.root for r in kept.collect()} == {"root"}
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(kept) == len(groups) and 40 < len(groups) < len(rows)
    for group in left:
        assert sum((d, t) in group or (d, t or None) in group for d, t in set(kept)) == 1
    assert simhash.deduplicated(docs.limit(0)).collect() == []


def test_reserved_names_are_given_back(spark, rows):
    names = ("keep_id", "exact_sha", "owner_sha", "mix_size", "mix_time", "mix_times", "toxicity", "given_0", "source_size")
    docs = spark.createDataFrame([r[:2] + r[3:4] for r in rows], "doc_id long, text string, source string")
    docs = docs.withColumns({name: F.lit(name) for name in names})
    for found in (exact.deduplicated(docs), mixing.in_training_order(docs), simhash.deduplicated(docs)):
        assert found.columns == docs.columns
        assert {tuple(r[n] for n in names) for r in found.collect()} == {names}
    mixed = mixing.mix(docs)
    assert {r.mix_size for r in mixed.collect()} != {"mix_size"} and mixed.columns.count("mix_size") == 1


@pytest.mark.parametrize("depth", [0, 3])
def test_trie_walk_finds_all_close_pairs(depth):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64) >> np.uint64(depth)
    flips = np.uint64(1) << rng.integers(0, 60, 400).astype(np.uint64)
    keys = np.unique(np.concatenate([base, base ^ flips]))
    keys = keys & np.uint64((1 << (64 - depth)) - 1)
    keys = np.unique(keys)
    got = set()
    for i, j in simhash.near_pairs(keys, keys, depth, 4, 2):
        got |= {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a < b}
    expected = {
        (a, b)
        for a in range(len(keys))
        for b in range(a + 1, len(keys))
        if int(keys[a] ^ keys[b]).bit_count() <= 4 and int((keys[a] ^ keys[b]) >> np.uint64(32)).bit_count() <= 2
    }
    assert got == expected and len(expected) > 100


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id AS src", "id + 1 AS dst").union(spark.createDataFrame([(100, 90)], "src long, dst long"))
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 90, 90: 90}


# --- packing


def test_pack_covers_every_id_once(docs, rows, nothing):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    got = packing.pack(docs, BYTE_BPE, size=256).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        body = np.array(ids[r.doc_id][r.start : r.start + r.length], np.uint32)
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(body.tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    copies = Counter(r[0] for r in rows)
    for doc_id, found in pieces.items():
        assert Counter(range(len(ids[doc_id]))) == Counter(
            {k: v // copies[doc_id] for k, v in Counter(i for s, n in found for i in range(s, s + n)).items()}
        )
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(nothing, BYTE_BPE).count() == 0


def test_special_tokens_keep_their_ids():
    ours, tokenizer = packing.Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endof", "  a  b ", "é\u00a0中\U0001f600 "]
    for text in texts:
        assert np.frombuffer(ours.ids(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ours.ids(texts[0]), np.uint32).tolist() == [64, 220, 50256, 275]


def test_a_text_is_encoded_in_one_call():
    ours, tokenizer, calls = packing.Encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE), []
    encode = ours.encode
    ours.encode = lambda text: calls.append(text) or encode(text)
    text = "".join(f"w{n} é{n % 7}.\n" for n in range(400)) + " end "
    assert np.frombuffer(ours.ids(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert calls == [text]


def test_sequences_follow_the_stored_order_over_files(spark, tmp_path):
    rng = np.random.default_rng(4)
    # A few words in the first rows and many in the last: the last file is largest.
    rows = [(n, " ".join(f"w{x}" for x in rng.integers(0, 999, 3 + n // 4))) for n in range(400)]
    for at, stop in ((0, 150), (150, 160), (160, 400)):
        part = spark.createDataFrame(rows[at:stop], "doc_id long, text string").coalesce(1)
        part.write.parquet(str(tmp_path / "t" / f"part-{at:05d}"))
    table = spark.read.parquet(*[str(tmp_path / "t" / f"part-{at:05d}") for at in (0, 150, 160)])
    got = packing.pack(table, BYTE_BPE, size=256).orderBy("sequence_id", "offset").collect()
    order = [r.doc_id for r in got]
    assert order == sorted(order) and set(order) == set(range(400))


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(5)
    for _ in range(30):
        places = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 9, 12))]))
        costs = rng.integers(0, 6, len(places)).astype(float)
        costs[0] = 0
        size = 16
        best = [0.0] + [1e9] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                n = int(places[j] - places[i])
                if n <= size:
                    best[j] = min(best[j], best[i] + costs[j] + (0 if n & (n - 1) == 0 else size - n))
        cuts = packing.choose_cuts(places, costs, size)
        total = 0.0
        for i, j in zip(cuts, cuts[1:]):
            n = int(places[j] - places[i])
            assert n <= size
            total += costs[j] + (0 if n & (n - 1) == 0 else size - n)
        assert total == pytest.approx(best[-1])


# --- classifiers


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        bad = i % 5 == 0
        body = " ".join(f"w{rng.integers(300)}" for _ in range(40)) + (" vile rubbish" if bad else "")
        rows.append((i, body, "en", "junk" if i % 4 == 0 else "fine", int(bad), int(i % 4 != 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, toxic int, quality int")
    return df.select("doc_id", "text", "lang", "source"), df.select("doc_id", "toxic", "quality")


def test_toxicity_learns_and_is_total(labelled, docs, nothing, spark):
    texts, labels = labelled
    model = toxicity.fit(texts, labels)
    assert len(model.slots) < 100
    got = toxicity.scored(texts, model, "s").join(labels, "doc_id").where(toxicity.held_out()).collect()
    assert np.mean([(r.s >= 0.5) == bool(r.toxic) for r in got]) > 0.97
    odd = toxicity.scored(docs, model, "s").collect()
    assert all(0 <= r.s <= 1 for r in odd) and "key" in odd[0].asDict()
    assert toxicity.scored(nothing, model).count() == 0
    none = toxicity.fit(texts, labels.where("toxic = 0"))
    assert len(none.slots) == 0 and none.bias < -3
    assert toxicity.fit(texts, labels.limit(0)).bias == -35.0


def test_toxicity_is_a_plain_ftrl_loop(labelled):
    texts, labels = labelled
    settings = toxicity.Settings()
    model = toxicity.fit(texts, labels, settings)
    rows = sorted(
        toxicity.training_sample(texts, labels, "toxic", settings.max_rows).collect(),
        key=lambda r: (r.doc_id * -7046029254386353131 + (1 << 63)) % (1 << 64) - (1 << 63),
    )
    positive = sum(r.label for r in rows)
    bias, bias_n = math.log((positive + 0.5) / (len(rows) - positive + 0.5)), 0.0
    z, n = defaultdict(float), defaultdict(float)
    l1 = toxicity.Ftrl(settings, 0.0, len(rows)).l1

    def weight(slot):
        if abs(z[slot]) <= l1:
            return 0.0
        rate = (settings.beta + math.sqrt(n[slot])) / settings.alpha + settings.l2
        return -(z[slot] - math.copysign(l1, z[slot])) / rate

    sets = hashed.gram_sets([r.text for r in rows], settings.bits)
    for _ in range(settings.rounds):
        for row, slots in zip(rows, sets):
            slots = slots.tolist()
            weights = [weight(s) for s in slots]
            g = 1 / (1 + math.exp(-(bias + sum(weights)))) - row.label
            for s, w in zip(slots, weights):
                z[s] += g - (math.sqrt(n[s] + g * g) - math.sqrt(n[s])) / settings.alpha * w
                n[s] += g * g
            bias_n += g * g
            bias -= settings.alpha / (settings.beta + math.sqrt(bias_n)) * g
    assert model.bias == pytest.approx(bias, abs=1e-9)
    expected = {s: weight(s) for s in z if weight(s)}
    assert dict(zip(model.slots.tolist(), model.weights.tolist())) == pytest.approx(expected, abs=1e-9)


def test_surest_rows_come_from_the_whole_pool(spark):
    values = [((i * 37) % 101 - 50.5) for i in range(300)]
    odds = spark.createDataFrame(list(enumerate(values)), "doc_id long, quality_text double")
    got = dict(quality.surest(odds.repartition(7), "quality_text", 20, 0.25))
    order = sorted(range(300), key=lambda i: (values[i], i))
    assert {i for i, label in got.items() if label == 0} == set(order[:15])
    order = sorted(range(300), key=lambda i: (-values[i], i))
    assert {i for i, label in got.items() if label == 1} == set(order[:5])
    few = spark.createDataFrame([(1, -2.0), (2, 3.0)], odds.schema)
    assert quality.surest(few, "quality_text", 20, 0.5) == [(1, 0.0), (2, 1.0)]
    assert quality.surest(odds.limit(0), "quality_text", 20, 0.5) == []


def test_layout_figures_match_patterns_that_are_not_run(spark):
    texts = ["", None, "A1b2\n\nÉ３ x.", "| # 5 % {a}\U0001f600 .!?\t", "NO end" * 40, "１２ ä\u0301\u2003b\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    given = df.select("doc_id", quality.figures(df)["quality_figures"].alias("f"))
    for r in given.collect():
        text = texts[r.doc_id] or ""
        n = max(1, len(text))
        for at, pattern, times in ((3, "[0-9]", 1), (5, "\n", 10), (6, "[A-Z]", 1), (7, r"[|#%&*$<>{}]", 5), (8, "[.!?]", 10)):
            assert r.f[at] == len(re.findall(pattern, text)) / n * times
    assert given._jdf.queryExecution().analyzed().toString().count("regexp_replace(") == 1


def test_quality_combines_views(labelled, docs, nothing):
    texts, labels = labelled
    model = quality.fit(texts, labels.where("doc_id < 400"))
    truth = labels.select("doc_id", F.col("quality").alias("label"))
    got = quality.scored(texts, model).join(truth, "doc_id").where(toxicity.held_out()).collect()
    assert np.mean([(r.quality >= 0.5) == bool(r.label) for r in got]) > 0.95
    odd = quality.scored(docs, model).collect()
    assert all(0 <= r.quality <= 1 for r in odd)
    assert quality.scored(nothing, model).count() == 0
    flat = quality.fit(texts, labels.limit(0))
    assert {round(r.quality, 6) for r in quality.scored(texts, flat).collect()} == {0.0}


def test_quality_shuffles_no_texts_to_leave_out_labelled_rows(labelled, spark, tmp_path, monkeypatch):
    for df, name in zip(labelled, ("texts", "labels")):
        df.write.parquet(str(tmp_path / name))
    texts, labels = (spark.read.parquet(str(tmp_path / name)) for name in ("texts", "labels"))
    plans, write = [], quality.written

    def recorded(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(quality, "written", recorded)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        quality.fit(texts, labels.where("doc_id < 400"), quality.Settings(rounds=1))
    finally:
        spark.conf.set(threshold, before)
    joins = [plan for plan in plans if "SortMergeJoin" in plan]
    assert joins and not any(re.search(r"\btext#", plan) for plan in joins)


# --- exact


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


def test_exact_owners(docs, rows, nothing):
    expected = Counter()
    for body, ids in plain_groups(rows).items():
        for i in ids:
            digest = hashlib.sha256(body.encode()).hexdigest()
            expected[(i, min(ids), len(ids), i == min(ids), digest)] += 1
    assert Counter(tuple(r) for r in exact.owned(docs).collect()) == expected
    left = exact.deduplicated(docs)
    assert sorted(r.doc_id for r in left.collect()) == sorted(min(i) for i in plain_groups(rows).values())
    assert left.columns == docs.columns and exact.owned(nothing).count() == 0


def test_trie_spills_by_subtree():
    rng = np.random.default_rng(2)
    bodies = [bytes(rng.integers(97, 100, int(rng.integers(0, 30))).tolist()) for _ in range(3000)]
    expected = {}
    for i, b in enumerate(bodies):
        least, rows = expected.get(b, (i, 0))
        expected[b] = (min(least, i), rows + 1)
    got = list(exact.merged(((b, i, 1, 1) for i, b in enumerate(bodies)), limit=2000))
    assert len(got) == len(expected)
    assert {b: (least, rows) for b, least, _, rows in got} == expected


# --- repeats


def plain_repeats(rows, width):
    bodies = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[i : i + width] for b in bodies for i in range(len(b) - width + 1))
    out = Counter()
    for (doc_id, *_), b in zip(rows, bodies):
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                mask[i : i + width] = True
        spans = int(np.diff(np.concatenate([[0], mask.astype(int), [0]])).clip(0).sum())
        kept = bytes(x for x, m in zip(b, mask) if not m)
        out[(doc_id, len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("busy", [2048, 1])
def test_repeated_bytes(docs, rows, nothing, busy):
    got = repeats.without_repeats(docs, 64, busy).collect()
    assert Counter(tuple(r) for r in got) == plain_repeats(rows, 64)
    assert repeats.without_repeats(nothing).count() == 0


def test_suffix_ranges_match_plain():
    rng = np.random.default_rng(4)
    for _ in range(20):
        pool = [bytes(rng.integers(97, 99, 60).tolist()) for _ in range(3)]
        segments = []
        for _ in range(8):
            a = pool[rng.integers(3)]
            segments.append(a[rng.integers(10) : 40 + rng.integers(20)])
        got = repeats.covered(segments, 12)
        seen = Counter(s[i : i + 12] for s in segments for i in range(len(s) - 11))
        for k, s in enumerate(segments):
            mask = np.zeros(len(s), bool)
            for i in range(len(s) - 11):
                if seen[s[i : i + 12]] > 1:
                    mask[i : i + 12] = True
            mine = np.zeros(len(s), bool)
            for a, b in got.get(k, []):
                mine[a:b] = True
            assert (mask == mine).all()


# --- fingerprints


def test_sketches_give_exact_likeness(docs, rows, nothing, spark):
    pieces = re.compile(lookup_sketch.PIECE)
    distinct = sorted({(r[0], r[1] or "") for r in rows}, reverse=True)
    following = dict(zip([d for d, _ in distinct], [t for _, t in distinct[1:] + distinct[:1]]))
    got = lookup_sketch.fingerprints(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    texts, prints = dict(distinct), defaultdict(set)

    def likeness(a, b):
        a, b = set(pieces.findall(a)), set(pieces.findall(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for r in got:
        text, after = texts[r.doc_id], following[r.doc_id]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(text, edited))
        assert r.near_next == pytest.approx(likeness(text, after))
        prints[text].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert lookup_sketch.fingerprints(nothing).count() == 0
    alone = lookup_sketch.fingerprints(spark.createDataFrame([(None, "One. Two.")], "doc_id long, text string")).first()
    assert alone.doc_id is None and alone.near_next == 1.0


# --- warc


def test_archives_round_trip(spark):
    long = "<p>é" + "x" * 1200 + "\r\nWARC/1.1\r\n\r\n"
    pages = [
        (1, "http://a/ b", long), (2, None, long), (7, "u", long), (3, "u", None), (4, "", ""),
        (5, "u", "short"), (6, "u", "short"), (None, "u", "no id"), (8, "u", "\r\n\r\n"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("head", F.lit(1))
    got = {r.page_id: r for r in warc.archived(df).collect()}
    assert len(got) == len(pages)
    for page_id, _, html in pages:
        body = (html or "").encode()
        again = len(body) >= 1000 and page_id != 7
        r = got[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 7) if again else ("response", None))
    assert warc.archived(df.limit(0)).count() == 0


def test_arc_versions_in_one_stream():
    def block(version):
        body = f"{version} 0 x\n{warc.ARC_FIELDS[version]}\n"
        return f"filedesc://f 0 20000101000000 text/plain {'200 - - 0 f ' if version == 2 else ''}{len(body)}\n{body}\n"

    data = block(1) + "http://a 1.2.3.4 20010203040506 text/html 3\nab\n\n" + block(2)
    data += "http://b 1.2.3.4 20010203040506 text/html 200 - - 9 f 2\nxy\n"
    got = list(warc.arc_records(io.BytesIO(data.encode())))
    assert [(a["URL"], b) for a, b in got] == [("http://a", b"ab\n"), ("http://b", b"xy")]
    with pytest.raises(ValueError):
        list(warc.arc_records(io.BytesIO(data[:-2].encode())))


# --- passages


def test_passages_are_found_and_clean_texts_left_alone(docs, rows, nothing):
    got = defaultdict(list)
    for r in passages.repeated_passages(docs).collect():
        got[r.doc_id].append(r)
    for a, b in ((6, 8), (10, 11), (4, 5)):
        if len(words(rows[a][1])) >= 60:
            assert got[a][0].class_id == got[b][0].class_id, (a, b)
    assert got[6][0].n_repeated >= 60 and got[8][0].n_repeated >= 60
    assert got[20][0].n_repeated == 0 and got[20][0].class_id == 20
    assert passages.repeated_passages(nothing).count() == 0


def test_chains_and_alignment_match_plain():
    s = passages.Settings(seeds=2)
    a = np.array([0, 6, 12, 20, 400])
    b = np.array([100, 106, 113, 121, 3])
    assert passages.chains(a, b, s)[0] == (0, 25, 100, 126)
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.integers(0, 5, 30), rng.integers(0, 5, 25)
        table = np.zeros((31, 26), int)
        for i in range(30):
            for j in range(25):
                table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
        assert passages.common_words(x, y) == table[-1, -1]


def made_words(rng, n, size=30_000):
    return [f"w{x}" for x in rng.integers(0, size, n)]


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_seeds_are_split_like_plain_groups(size):
    rng = np.random.default_rng(size)
    s = passages.Settings(pairs_upto=5)
    rows = [(int(k), int(t), int(p)) for k, t, p in zip(rng.zipf(1.5, 600) % 50 - 9, rng.integers(0, 9, 600), rng.integers(0, 99, 600))]
    rows = sorted(set(rows + [(90, 3, p) for p in range(12)] + [(91, 3, 1)]))
    batches = [pd.DataFrame(rows[at : at + size], columns=["seed", "tid", "place"]) for at in range(0, len(rows), size)]
    got = pd.concat(list(passages._split(iter(batches), s)))
    groups, pairs, many = defaultdict(list), Counter(), Counter()
    for k, t, p in rows:
        groups[k].append((t, p))
    for k, places in groups.items():
        if len({t for t, _ in places}) < 2:
            continue
        if len(places) > 5:
            many.update((k, t, p) for t, p in places)
        else:
            pairs.update((t, u, p, q) for n, (t, p) in enumerate(places) for u, q in places[n + 1 :] if t != u)
    hot = got[got.frequent.astype(bool)]
    rest = got[~got.frequent.astype(bool)]
    assert Counter(hot[["seed", "tid", "a"]].itertuples(index=False, name=None)) == many
    assert Counter(rest[["tid", "other", "a", "b"]].itertuples(index=False, name=None)) == pairs
    assert many and pairs


def test_passage_of_frequent_lines_is_found(spark):
    rng = np.random.default_rng(5)
    lines = [made_words(rng, 25) for _ in range(3)]
    texts = [made_words(rng, 30) + sum(lines, []) + made_words(rng, 30)]
    texts += [made_words(rng, 40) + lines[n % 3] + made_words(rng, 40) for n in range(300)]
    texts += [made_words(rng, 50) + sum(lines, []) + made_words(rng, 10)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    last = len(texts) - 1
    assert got[0].class_id == got[last].class_id == 0
    assert got[0].n_links == got[last].n_links == 1
    assert got[0].n_repeated >= 75 and got[last].n_repeated >= 75
    assert all(got[n].n_links == 0 for n in range(1, last))


def test_all_holders_of_a_frequent_passage_are_linked(spark):
    rng = np.random.default_rng(7)
    body = made_words(rng, 60)
    # More holders than the sorted pass pairs.
    texts = [made_words(rng, 30) + body + made_words(rng, 30) for _ in range(90)]
    texts += [made_words(rng, 60) for _ in range(5)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in passages.repeated_passages(df).collect()}
    assert all(got[n].n_links == 89 and got[n].class_id == 0 for n in range(90))
    assert all(got[n].n_links == 0 and got[n].class_id == n for n in range(90, 95))


def test_frequent_seeds_pair_all_places_in_any_parts(spark):
    rng = np.random.default_rng(8)
    rows = sorted({(int(k), int(t), int(p)) for k, t, p in zip(rng.integers(0, 3, 300), rng.integers(0, 40, 300), rng.integers(0, 9, 300))})
    want = Counter((t, u, p, q) for k, t, p in rows for l, u, q in rows if k == l and t < u)
    df = spark.createDataFrame(rows, "seed long, tid long, place int")
    for share in (7, 1_000):
        assert Counter(tuple(r) for r in passages.frequent_pairs(df, share).collect()) == want


def test_rounds_and_parts_give_the_same_passages(spark, monkeypatch):
    rng = np.random.default_rng(9)
    line, body = made_words(rng, 12), made_words(rng, 60)
    # All hold a common line, some of them a passage too.
    texts = [made_words(rng, 40) + line + (body if n % 40 == 0 else []) + made_words(rng, 40) for n in range(200)]
    df = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    paths = []
    plain_added = passages.added
    monkeypatch.setattr(passages, "added", lambda rows, path: (paths.append(path), plain_added(rows, path)))
    whole = sorted(map(repr, passages.repeated_passages(df).collect()))
    assert len(paths) == 1
    small = passages.Settings(k=3, gap_cost=0.1, seeds=2, round_pairs=1, round_chains=1_000, round_windows=20)
    for s in (small, replace(small, round_windows=2)):
        paths.clear()
        rows = passages.repeated_passages(df, s).collect()
        assert sorted(map(repr, rows)) == whole
        assert len(paths) > 10 and len(set(paths)) == 1
    assert {r.doc_id for r in rows if r.n_links} == set(range(0, 200, 40))
    assert all(r.n_links in (0, 4) for r in rows)


def test_chains_of_many_pairs_match_plain():
    rng = np.random.default_rng(10)
    s = replace(passages.FUZZY, spread=1)
    for _ in range(20):
        pairs = []
        for n in range(40):
            a = np.cumsum(rng.integers(1, 20, rng.integers(2, 9)))
            b = a + 50 if n % 2 else rng.permutation(a + rng.integers(0, 9, len(a)))
            # Some matches come twice.
            pairs.append([{"a": int(x), "b": int(y)} for x, y in [*zip(a, b), (a[0], b[0])]])
        batch = pa.record_batch({
            "tid": pa.array(range(40), pa.int64()), "other": pa.array(range(40, 80), pa.int64()),
            "pairs": pa.array(pairs, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
        })
        got = pd.concat([b.to_pandas() for b in passages._chained(iter([batch.slice(0, 11), batch.slice(11)]), s)])
        want = Counter()
        for n, places in enumerate(pairs):
            ab = np.array(sorted({(p["a"], p["b"]) for p in places}))
            want.update((n, n + 40, *c) for c in passages.chains(ab[:, 0], ab[:, 1], s))
        assert Counter(got.itertuples(index=False, name=None)) == want


def test_no_passage_is_left_out_before_alignment():
    rng = np.random.default_rng(11)
    s, kept, xs, ys = passages.FUZZY, [], [], []
    for n in range(1_500):
        x = rng.integers(0, 50_000, int(rng.integers(40, 260)))
        y = x.copy()
        # Words replaced, left out or put in, up to beyond what a passage allows.
        share = rng.uniform(0, 0.3)
        edits = rng.random(len(y)) < share
        if n % 3 == 0:
            y[edits] = rng.integers(50_000, 99_000, edits.sum())
        elif n % 3 == 1:
            y = np.insert(y[~edits], rng.integers(0, len(y) - edits.sum() + 1, edits.sum()), 99_999)
        else:
            y = np.concatenate([rng.integers(0, 50_000, 30), y[~edits]])
        xs.append(x)
        ys.append(y)
        kept.append(bool(passages.align({"words": x, "low": 0}, {"words": y, "low": 0}, s)))
    lists = [pa.array([w.tolist() for w in side], pa.list_(pa.int64())) for side in (xs, ys)]
    found = np.concatenate([passages.may_share(*(side.slice(at, 400) for side in lists), s) for at in range(0, 1_500, 400)])
    assert sum(kept) > 500 and not (np.array(kept) & ~found).any()
    line = rng.integers(0, 50_000, 12)
    apart = [[*rng.integers(0, 50_000, 60), *line, *rng.integers(0, 50_000, 60)] for _ in range(200)]
    lists = [pa.array([[int(w) for w in t] for t in side], pa.list_(pa.int64())) for side in (apart[::2], apart[1::2])]
    assert not passages.may_share(*lists, s).any()


@pytest.mark.parametrize("small", [0, 24, 10_000])
def test_places_with_common_surroundings_match_plain(small):
    rng = np.random.default_rng(12)
    width, least, rows = 30, 12, []
    for seed, (size, cross) in enumerate([(2, 0), (30, 0), (9, 1), (3, 0), (60, 1), (1, 0)]):
        core = rng.integers(0, 65_535, 14)
        for n in range(size):
            steps = np.concatenate([core[: rng.integers(0, 15)], rng.integers(0, 9, 12)])
            steps = np.sort(np.concatenate([steps, np.full(width - len(steps), 65_535)])).astype(np.uint16)
            rows.append((seed - 3, 0, cross, bool(cross and n % 2), int(rng.integers(0, 40)), int(rng.integers(0, 4)), steps))
    want = set()
    for n, (seed, _, cross, side, tid, prev, steps) in enumerate(rows):
        for seed2, _, _, side2, tid2, prev2, steps2 in rows[n + 1 :]:
            common = Counter(steps[steps < 65_535].tolist()) & Counter(steps2[steps2 < 65_535].tolist())
            apart = tid != tid2 and (prev != prev2 or prev == 0) and (not cross or side != side2)
            if seed == seed2 and apart and common.total() >= least:
                want.add((seed, min(tid, tid2), max(tid, tid2)))
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int32())
    columns = [pa.array([r[n] for r in rows], kind) for n, kind in enumerate(kinds)]
    columns.append(pa.array([r[6].tobytes() for r in rows], pa.binary()))
    batch = pa.record_batch(columns, ["seed", "one", "two", "side", "tid", "prev", "steps"])
    parts = [batch.slice(at, 13) for at in range(0, len(rows), 13)]
    got = [
        (r["label"], r["tid"], other)
        for b in surroundings.close(iter(parts), width, least, small) for r in b.to_pylist() for other in r["others"]
    ]
    assert set(got) == want and len(got) == len(want) > 50


def test_texts_with_a_common_line_alone_are_not_paired(spark):
    rng = np.random.default_rng(13)
    line, body = made_words(rng, 12), made_words(rng, 60)
    texts = [made_words(rng, 50) + line + made_words(rng, 50) for _ in range(400)]
    texts += [made_words(rng, 50) + body + made_words(rng, 50) + line for _ in range(5)]
    hashed_words = [(n, passages.text_words(" ".join(t)).view(np.int64).tolist(), len(t)) for n, t in enumerate(texts)]
    df = spark.createDataFrame(hashed_words, "tid long, words array<long>, n_words int")
    # Cells of one part, and of many.
    for s in (passages.FUZZY, replace(passages.FUZZY, round_windows=50)):
        got = {(r.tid, other) for r in passages._close_texts(df, s).collect() for other in r.others}
        assert got == {(a, b) for a in range(400, 405) for b in range(a + 1, 405)}


def test_common_places_are_those_of_the_whole_table():
    rng = np.random.default_rng(14)
    for n in range(200):
        x = rng.integers(0, int(rng.integers(2, 40)), int(rng.integers(1, 50)))
        y = np.concatenate([rng.integers(0, 40, 5), x[rng.random(len(x)) > 0.2]]) if n % 2 else rng.integers(0, 12, 30)
        best = np.zeros((len(x) + 1, len(y) + 1), int)
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1, j + 1] = best[i, j] + 1 if x[i] == y[j] else max(best[i, j + 1], best[i + 1, j])
        i, j, want = len(x), len(y), []
        while i and j:
            if best[i - 1, j] == best[i, j]:
                i -= 1
            elif best[i, j - 1] == best[i, j]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                want.append((i, j))
        p, q = passages.common_places(x, y)
        assert list(zip(p.tolist(), q.tolist())) == want[::-1]


def test_edited_passages_are_found_at_the_promised_similarity(spark):
    rng = np.random.default_rng(6)
    texts = []
    for n in range(60):
        one = made_words(rng, 60)
        # Each fifth word replaced: 48 of 60 in common, and no five in a row.
        two = [w if i % 5 != 4 else f"x{n}y{i}" for i, w in enumerate(one)]
        for body in (one, two):
            texts.append(made_words(rng, 50) + body + made_words(rng, 50))
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = sum(got[n].class_id == got[n + 1].class_id == n for n in range(0, 120, 2))
    assert found >= 57
    assert all(r.class_id // 2 == r.doc_id // 2 for r in got.values())


def test_common_places_and_stretches_match_plain():
    rng = np.random.default_rng(3)
    for _ in range(30):
        x, y = rng.integers(0, 6, 40), rng.integers(0, 6, 35)
        p, q = passages.common_places(x, y)
        assert (x[p] == y[q]).all() and (np.diff(p) > 0).all() and (np.diff(q) > 0).all()
        assert len(p) == passages.common_words(x, y)
    s = passages.Settings(least_words=4)
    for _ in range(30):
        p, q = (np.cumsum(rng.integers(1, 3, 20)) for _ in range(2))
        best = max(
            [v - u + 1 for u in range(20) for v in range(u + 3, 20)
             if v - u + 1 >= 0.8 * (max(p[v] - p[u], q[v] - q[u]) + 1) - 1e-9], default=0,
        )
        u, v = passages.longest_similar(p, q, s)
        assert v - u + 1 == best


def test_frequent_keys_pair_across_batches():

    s = passages.Settings(pairs_upto=4, reach=2)
    rng = np.random.default_rng(1)
    sizes = [1, 4, 9, 2, 12, 3, 5]
    rows = [(k, b"", int(t), 7, 7) for k, n in enumerate(sizes) for t in rng.permutation(100)[:n]]
    want = Counter()
    for k, n in enumerate(sizes):
        tids = [r[2] for r in rows if r[0] == k]
        for i in range(n):
            for j in range(i + 1, n if n <= 4 else min(n, i + 3)):
                want[tuple(sorted((tids[i], tids[j])))] += 1
    table = pd.DataFrame(rows, columns=["key", "ctx", "tid", "place", "place2"])
    for step in (3, 6, 100):
        parts = [table[at : at + step] for at in range(0, len(table), step)]
        got = pd.concat(list(passages.paired(iter(parts), s)))
        assert Counter(zip(got.tid, got.other)) == want, step


# --- words in blocks


def test_text_that_starts_without_words():
    blank = "--- " * (3 << 18)
    for texts in ([blank + "one two three"], ["a b c " * 60_000, blank + "one two"]):
        got = [(r, w) for rows, values in hashed.word_blocks(texts) for r, w in zip(rows.tolist(), values.tolist())]
        plain = [(n, xxhash.xxh64_intdigest(w)) for n, t in enumerate(texts) for w in re.findall(r"\w+", t)]
        assert got == plain
    # A block ended by an earlier text leaves nothing to the next one.
    texts = ["a b " * 140_000, "-" * (1 << 20) + " one two " * 3]
    rows = np.concatenate([r for r, _ in hashed.word_blocks(texts)])
    assert (rows == 1).sum() == 6
