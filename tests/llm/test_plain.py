"""Order MinHash and the FTRL classifier against plain Python, one number at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import order_minhash as omh
from changelake.llm import quality_classifier as qc
from changelake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
WORD64 = (1 << 64) - 1
M1, M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mixed(x):
    x = (x ^ x >> 31) * M1 & WORD64
    return x ^ x >> 29


def plain_fingerprint(text):
    """Occurrence-numbered k-mers, the smallest of each order, their tuple in text order."""
    if not text:
        return "0" * (8 * omh.SIZE)
    k = min(omh.K, len(text))
    seen, members = Counter(), []
    for at in range(len(text) - k + 1):
        gram = text[at : at + k]
        h = k
        for c in gram:
            h = (h * M2 + ord(c)) & WORD64
        members.append(mixed(mixed(h) + seen[gram] * M1 & WORD64) >> 32)
        seen[gram] += 1
    out = []
    for flip, factor in zip(omh._XOR.tolist(), omh._MUL.tolist()):
        ranked = sorted(((m ^ flip) * factor & 0xFFFFFFFF, at) for at, m in enumerate(members))
        picked = sorted(at for _, at in ranked[: omh.PICKS])
        t = len(picked)
        for at in picked:
            t = mixed((t * M2 + members[at]) & WORD64)
        out.append(f"{t >> 32:08x}")
    return "".join(out)


def alike(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 8 * omh.SIZE, 8)) / omh.SIZE


@pytest.mark.parametrize("text", ["", "a", "abcdefgh", "abcdefghi", "ab" * 40, "日本語のテキスト" * 3, "x" * 5000 + "y"])
def test_one_fingerprint(text):
    assert omh.shown(omh.fingerprint(text)) == plain_fingerprint(text)


def test_order_and_occurrences_matter():
    a, b = "the first half of it, ", "and the other half of it. "
    assert omh.shown(omh.fingerprint(a + b)) != omh.shown(omh.fingerprint(b + a))
    assert omh.shown(omh.fingerprint(a * 3)) != omh.shown(omh.fingerprint(a * 4))


def test_every_document_equals_plain_python(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in queries.queries()["op5_order_minhash"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    for at, i in enumerate(order):
        following = order[(at + 1) % len(order)]
        third = len(texts[i]) // 3
        changed = texts[i][: len(texts[i]) - third] + texts[following][:third]
        changed_print = plain_fingerprint(changed)
        assert got[i].n_chars == len(texts[i]) and got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (prints[i], changed_print)
        assert got[i].near_edited == alike(prints[i], changed_print) and got[i].near_next == alike(prints[i], prints[following])


def plain_vector(text):
    """Slots of words, word pairs, shapes and shape pairs; each kind has a total of ``SCALE``."""
    words = text.split()
    if not words:
        return {}

    def coded(b):
        return zlib.crc32(b) | zlib.crc32(b, 0x5BD1E995) << 32

    def shape(w):
        run = re.sub(r"[^\W\d_]+", lambda m: "A" if len(m[0]) > 1 and m[0].isupper() else "a", w)
        return coded(b"\1" + re.sub(r"\d+", "0", run).encode())

    names, shapes = [coded(w.lower().encode()) for w in words], [shape(w) for w in words]
    out = defaultdict(float)
    n = len(words)
    for i in range(n):
        for h in (names[i], shapes[i]):
            out[(h * M2 & WORD64) >> 44] += qc.SCALE / n
    for i in range(n - 1):
        same = int(names[i] == names[i + 1])
        for h in (names[i] * M1 + names[i + 1], (shapes[i] * M1 + shapes[i + 1]) * M2 + same):
            out[(h * M2 & WORD64) >> 44] += qc.SCALE / (n - 1)
    return out


def probability(x):
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def plain_ftrl(rows):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= qc.L1:
            return 0.0
        return -(z[i] - math.copysign(qc.L1, z[i])) / ((qc.BETA + math.sqrt(n[i])) / qc.ALPHA + qc.L2)

    for text, label in rows:
        x = {i: float(np.float32(v)) for i, v in plain_vector(text).items()} | {qc.SLOTS: 1.0}
        w = {i: weight(i) for i in x}
        p = probability(sum(w[i] * v for i, v in x.items()))
        for i, v in x.items():
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / qc.ALPHA * w[i]
            n[i] += g * g
    return {i: weight(i) for i in z}


def test_weights_and_scores_equal_plain_ftrl(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    # A null id or label teaches nothing; of labels under one id the largest counts.
    more = spark.createDataFrame([(None, 1), (labels.first().doc_id, 0), (10**12, None)], labels.schema)
    known = labels.union(more)
    got = qc.fit(docs, known)
    label = {r.doc_id: r.quality for r in labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).collect()}
    ordered = docs.orderBy(F.xxhash64("doc_id")).collect()
    want = plain_ftrl([(r.text or "", label[r.doc_id]) for r in ordered if label.get(r.doc_id) is not None])
    dense = np.zeros(qc.SLOTS + 1)
    for i, w in want.items():
        dense[i] = w
    assert np.count_nonzero(dense) > 1000
    assert np.allclose(got, dense, rtol=1e-6, atol=1e-9)
    scores = {r.doc_id: r.score for r in qc.score(docs, got).collect()}
    for r in ordered:
        x = plain_vector(r.text or "")
        assert scores[r.doc_id] == pytest.approx(probability(dense[qc.SLOTS] + sum(dense[i] * v for i, v in x.items())), abs=1e-5)
