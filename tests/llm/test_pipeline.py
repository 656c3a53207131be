"""The pipeline against a plain Python run of its five stages."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from millrace.llm import toxicity
from millrace.llm.common import table
from tests.llm.test_operators import plain_fingerprint, words


def plain_scores(spark, folder, rows):
    """Scores by the fitted weights (tests compare the fit with a plain loop), gram by gram."""
    from millrace.llm.hashed import gram_sets

    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    weights = dict(zip(model.slots.tolist(), model.weights.tolist()))
    sets = gram_sets([r.text for r in rows], model.bits)
    return [1 / (1 + math.exp(-(model.bias + sum(weights.get(s, 0) for s in slots.tolist())))) for slots in sets]


def once(rows, key):
    kept = {}
    for row in rows:
        k = key(row)
        if k not in kept or row.doc_id < kept[k].doc_id:
            kept[k] = row
    return list(kept.values())


def plain_near(rows):
    prints = [plain_fingerprint(r.text) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if label[i] != label[j] and (a ^ prints[j]).bit_count() <= 4:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    groups = {id(r): k for r, k in zip(rows, label)}
    return once(rows, lambda r: groups[id(r)])


def plain_mix(rows):
    """(time, doc_id) of every pass, by halving the interval for the integral of the rates."""
    ramps = [[(0, 1.5), (1, 0.5)], [(0, 1), (1, 1)], None]
    from millrace.llm.mixing import RAMPS

    ramps[2] = RAMPS[2]
    size = {id(r): len(words(r.text)) for r in rows}
    sources = defaultdict(list)
    for r in rows:
        sources[r.source].append(r)
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[id(r)] for r in sources[s]) for s in order}
    target, left, open_ = {}, 1.5 * sum(total.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w >= 2 * total[s]]
        for s in full or list(open_):
            target[s] = 2.0 * total[s] if full else level * open_[s]
            if full:
                left -= target[s]
            open_.pop(s)

    def demand(ramp, time):
        done = 0.0
        for (t0, r0), (t1, r1) in zip(ramp, ramp[1:]):
            at = min(max(time, t0), t1)
            done += (at - t0) * (r0 + (r0 + (r1 - r0) * (at - t0) / (t1 - t0))) / 2
        return done

    out = []
    for turn, s in enumerate(order):
        begin = 0
        for r in sorted(sources[s], key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
            for n in range(2):
                at = begin + n * total[s]
                if min(size[id(r)], math.floor(target[s]) - at) > 0:
                    low, high = 0.0, 1.0
                    for _ in range(60):
                        middle = (low + high) / 2
                        low, high = (middle, high) if demand(ramps[turn % 3], middle) < at / target[s] else (low, middle)
                    out.append((high, r.doc_id))
            begin += size[id(r)]
    return sorted(out)


def test_the_pipeline_equals_a_plain_run(spark, folder):
    docs = table(spark, folder, "documents")
    rows = docs.collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    clean = [r for r, s in zip(rows, plain_scores(spark, folder, rows)) if s < 0.5]
    assert 0 < len(clean) < len(rows)
    distinct = once(clean, lambda r: re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""))
    near = plain_near(distinct)
    assert len(near) < len(distinct) < len(clean)
    mixed = plain_mix(near)

    found = [spark.read.parquet(f"{folder}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found.append(corpus_pipeline.written(stage(spark, found[-1], folder), "stage-test"))
        assert found[-1].columns == docs.columns
    for stage, plain in zip(found[1:], (clean, distinct, near)):
        assert sorted(map(tuple, stage.collect())) == sorted(map(tuple, plain))
    assert [r.doc_id for r in found[-1].orderBy("_metadata.file_path", F.monotonically_increasing_id()).collect()] == [
        d for _, d in mixed
    ]

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: coder.encode(texts[d], add_special_tokens=False).ids + [1] for d in {d for _, d in mixed}}
    stream = [(d, n) for _, d in mixed for n in range(len(ids[d]))]
    got, sequences = [], defaultdict(int)
    for r in corpus_pipeline.run(spark, folder).orderBy("sequence_id", "offset").collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(array("I", part).tobytes())
        assert r.offset == sequences[r.sequence_id]
        sequences[r.sequence_id] += r.length
        got += [(r.doc_id, r.start + n) for n in range(r.length)]
    # The tokens of all sequences, in their order, are those of the mixed documents in theirs.
    assert got == stream
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sequences.values())
    assert max(sequences.values()) <= 2048 and padding <= 0.1 * len(stream) + 2048


def test_every_operator_is_registered_once():
    found = [q for q in queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in found) == list(range(1, 14))
    assert "pipeline" in queries() and set(oracle_sql()) <= set(queries())
