"""Corpus operators against brute force, the libraries, and odd tables."""

import hashlib
import itertools
import time
import zlib

import numpy as np
import pytest

import corpus_pipeline
from changelake.llm import line_dedup, near_dedup, order_minhash, packing, ppm, quality_classifier, quality_rules, queries, sentence_pieces, suffix_dedup, warc
from changelake.workdir import fresh
from oracle import connect, oracle_table, spark_table

SF_DIR = "/root/testdata/sf0.001"
A = " ".join(f"w{i}x{i * i % 97}" for i in range(120))
B = A.replace("w60x", "edited").replace("w7x", "changed")
SCHEMA = "doc_id long, text string, start string, kept string"
ODD = [
    (1, A, "a", "b"),
    (2, B, None, "c"),
    (3, A, "a", None),
    (3, A, "a", None),
    (4, "one\ntwo\nthree\nfour\n" + A[:200], None, None),
    (5, "zero\none\ntwo\nthree\nfour", None, None),
    (6, None, None, None),
    (None, "", None, None),
    (None, A + " tail", None, None),
    (7, "日本 é " * 400, None, None),
    (8, "word " * 30_000, None, None),
    (8, "another text under the same id " + A[100:300], None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = spark_table(queries.queries()[name](spark, SF_DIR))
    assert got == oracle_table(connect(SF_DIR), queries.oracle_sql()[name])


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "x" * 2000), (2, "http://b/\r\nEvil: 1", "x" * 2000), (3, None, None), (4, "u", "small"), (5, "u", "small"), (2, "again", "x" * 2000)]
    folder = fresh(spark, "warc-test")
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, "page_id", "url", "html")
    got = sorted((r.key, r.record_type, r.refers_to, r.payload_bytes, r.digest) for r in warc.fetch(index, folder).collect())
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    big = sha("x" * 2000)
    assert got == [(1, "revisit", 2, 2000, big)] + [(2, "response", None, 2000, big)] * 2 + [(3, "response", None, 0, sha(""))] + [(i, "response", None, 5, sha("small")) for i in (4, 5)]
    none = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), fresh(spark, "warc-none"), "page_id", "url", "html")
    assert none.count() == 0


def test_line_dedup_odd_rows(odd, empty):
    got = {(r.doc_id, r.text): r for r in line_dedup.dedup(odd).collect()}
    assert got[(5, "zero")].n_removed == 4 and got[(5, "zero")].n_spans == 1
    assert got[(6, None)].n_lines == 0
    assert got[(4, ODD[4][1])].n_removed == 0
    assert line_dedup.dedup(odd).columns[:4] == odd.columns
    assert line_dedup.dedup(empty).count() == 0


def test_quality_rules_odd_rows_and_order(odd, empty):
    rows = sorted(quality_rules.judge(odd).collect(), key=str)
    again = sorted(quality_rules.judge(odd, order=list(quality_rules.rules())[::-1]).collect(), key=str)
    assert rows == again
    assert {r.doc_id: r.n_repeat_words for r in rows if r.n_words == 30_000} == {8: 30_000}
    assert all(r.base_failed for r in rows if not r.text)
    assert quality_rules.judge(empty).count() == 0


def test_ppm_probabilities_sum_to_one_and_match_counts(spark, odd, empty):
    trie = ppm.fit(spark.createDataFrame([("abracadabra",), ("abba",)], "text string"))
    for before in ("", "a", "abr", "zz", "abracadab"):
        data = [ppm._PAD + before.encode() + bytes([b]) for b in range(256) if b != ppm.START]
        keys = np.array([ppm.symbols(d)[0][0] for d in data])
        order = np.argsort(keys)
        total = np.exp(trie.log_probabilities(keys[order])).sum()
        assert 0.9 < total <= 1 + 1e-9  # the start sign's share is never coded
    got = ppm.score(odd, odd.filter("doc_id < 5")).collect()
    assert len(got) == len(ODD)
    train = [t for i, t, *_ in ODD if i is not None and i < 5]
    words = [w for t in train for w in [*t.lower().split(), ""]]
    for r in got:
        text = [t for i, t, s, k in ODD if (i, s, k) == (r.doc_id, r.start, r.kept) and len((t or "").split()) + 1 == r.n_tokens][0] or ""
        found = [*text.lower().split(), ""]
        want = sum(np.log10((words.count(w) + 0.1) / (len(words) + 0.1 * (len(set(words)) + 1))) for w in found) if len(found) < 1000 else r.base_score
        assert r.train_tokens == len(words) and abs(r.base_score - want) < 1e-6
    assert ppm.score(empty, empty).count() == 0
    blank = ppm.score(odd, empty).filter("doc_id = 6").first()
    assert abs(blank.score + np.log10(256)) < 1e-9


def test_ppm_learns_every_branch_whatever_the_size(spark):
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(400)]
    texts = [" ".join(words[i] for i in rng.integers(0, 400, 4000)) for _ in range(100)] + ["Zyxwvu seen once"]  # 2.4 million symbols
    probes = ["Zyxwvu seen once", "Zyxwvu", "unseen ÿ", "", texts[0], None]
    counts = {}
    for _, _, data in ppm.blocks(texts):
        for key, n in zip(*np.unique(ppm.symbols(data)[0], return_counts=True)):
            counts[int(key)] = counts.get(int(key), 0) + int(n)
    branches = {}  # per context (a number and its length): the symbols' counts
    for key, n in counts.items():
        for k in range(ppm.ORDER + 1):
            symbol, context = key >> 40, (key & (1 << 40) - 1) >> 8 * (ppm.ORDER - k)
            node = branches.setdefault((k, context), {})
            node[symbol] = node.get(symbol, 0) + n

    def log10(key):
        symbol, gone, total = key >> 40, set(), 0.0
        for k in range(ppm.ORDER, -1, -1):
            node = {s: n for s, n in branches.get((k, (key & (1 << 40) - 1) >> 8 * (ppm.ORDER - k)), {}).items() if s not in gone}
            if node:
                total += np.log10((node.get(symbol) or len(node)) / (sum(node.values()) + len(node)))
                if symbol in node:
                    return total
                gone |= set(node)
        return total - np.log10(256 - len(gone))

    want = [sum(log10(int(key)) for key in ppm.symbols(next(ppm.blocks([p or ""]))[2])[0]) for p in probes]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    got = ppm.score(spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string"), train)
    assert [r.score for r in got.orderBy("doc_id").collect()] == pytest.approx(want, abs=1e-6)


def test_fingerprints(odd, empty):
    got = order_minhash.beside_next(odd).collect()
    assert len(got) == len(ODD)
    order = sorted([(i if i is not None else -(1 << 63), t or "") for i, t, *_ in ODD], key=lambda x: (-x[0], x[1]))
    want = sorted(order_minhash.edited(t, order[(k + 1) % len(order)][1]) for k, (_, t) in enumerate(order))
    assert sorted(r.edited for r in got) == want
    assert {r.fingerprint for r in got if r.key in (1, 3)} == {order_minhash.shown(order_minhash.fingerprint(A))}
    assert order_minhash.beside_next(empty).count() == 0


def _components(rows, words):
    sets = [set(near_dedup.shingles(t or "", words).tolist()) for _, t, *_ in rows]
    label = list(range(len(rows)))
    for a, b in itertools.product(range(len(rows)), repeat=2):
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            label = [label[a] if x == label[b] else x for x in label]
    return label


def test_near_dedup_odd_rows(odd, empty):
    label = _components(ODD, 4)
    least = {}
    for x, (i, *_) in zip(label, ODD):
        least[x] = min(least.get(x, near_dedup.LAST), near_dedup.LAST if i is None else i)
    want = sorted((str(i), str(None if least[x] == near_dedup.LAST else least[x])) for x, (i, *_) in zip(label, ODD))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in near_dedup.mark(odd, words=4).collect()) == want
    kept = near_dedup.representatives(odd, words=4)
    assert kept.columns == odd.columns and kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 3").count() == 0
    assert near_dedup.mark(empty).count() == 0 and near_dedup.representatives(empty).count() == 0


def test_near_dedup_keeps_one_of_each_component(spark):
    other = " ".join(f"v{i}y{i * i % 89}" for i in range(120))
    third = " ".join(f"u{i}z{i * i % 83}" for i in range(120))
    rows = [(None, A), (None, A.upper()), (None, A + " tail"), (None, other), (7, third), (7, third + " tail"), (7, third.replace(" ", "  ")), (7, "quite another text of this id")]
    kept = [(r.doc_id, r.text) for r in near_dedup.representatives(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()]
    label = _components(rows, 4)
    assert sorted(label[rows.index(k)] for k in kept) == sorted(set(label)) and len(kept) == 4


def test_near_dedup_pairs_only_what_size_and_rank_allow(spark):
    rng = np.random.default_rng(6)
    rows = [(v, int(k), int(n), int(r), int(k) % 50) for v in (1, 2) for k, n, r in zip(range(300), rng.integers(1, 130, 300), rng.integers(0, 12, 300))]
    columns = "__value long, __k long, __size int, __rank int, __label long"
    want = set()
    for (v, a, n, r, x), (w, b, m, q, y) in itertools.combinations(rows, 2):
        if v == w and x != y and 100 * min(n, m) >= 80 * max(n, m) and 180 * min(n - r, m - q) >= 80 * (n + m):
            want.add((min(a, b), max(a, b)))
    assert {tuple(r) for r in near_dedup._pairs(spark.createDataFrame(rows, columns), 80).collect()} == want and want
    # 85 per cent of one template each: no pair of them may be linked, so none may be formed.
    hot = spark.createDataFrame([(1, k, 1000 + k % 7, 150, k) for k in range(400)], columns)
    one, two = near_dedup._roles(hot, 80)
    assert one.join(two, ["__value", "__low", "__high"]).count() == 0


def test_suffix_dedup_odd_rows(odd, empty):
    got = sorted((str(r.doc_id), bytes(r.text)) for r in suffix_dedup.dedup(odd, as_bytes=True).collect())
    key = lambda i: suffix_dedup.LAST if i is None else i
    want = []
    for i, t, *_ in ODD:
        data = (t or "").encode()
        seen = {d[s : s + 50] for j, u, *_ in ODD if key(j) < key(i) for d in [(u or "").encode()] for s in range(len(d) - 49)}
        gone = {s + k for s in range(len(data) - 49) if data[s : s + 50] in seen for k in range(50)}
        want.append((str(i), bytes(c for n, c in enumerate(data) if n not in gone)))
    assert got == sorted(want)
    text = suffix_dedup.dedup(odd)
    assert text.columns[: len(odd.columns)] != [] and text.filter("text is null").count() == 0
    assert suffix_dedup.dedup(empty).count() == 0


def test_line_dedup_takes_time_in_proportion_to_lines(spark):
    lines = [f"line {i}" for i in range(200_000)]
    docs = [(1, "\n".join(lines)), (2, "\n".join(["a", "b", "c", *lines[100:103], "d"])), (None, "\n".join(lines[5:8]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS n_lines", "'y' AS n_spans")
    line_dedup.dedup(df.filter("doc_id = 2")).collect()
    began = time.monotonic()
    found = {r.doc_id: r for r in line_dedup.dedup(df).collect()}
    assert time.monotonic() - began < 20
    assert found[None].text == docs[2][1] and found[2].text == "a\nb\nc\nd" and (found[2].n_lines, found[2].n_removed, found[2].n_spans) == (7, 3, 1)
    assert found[1].text == "\n".join(lines[:5] + lines[8:]) and (found[1].n_lines, found[1].n_removed) == (200_000, 3)


def brute_spans(docs, length=suffix_dedup.LENGTH):
    """What every document keeps: bytes outside all strings that also start in a smaller id."""
    least = {}
    for i, text in docs:
        for at in range(len(text) - length + 1):
            s = text[at : at + length]
            least[s] = min(i, least.get(s, i))
    kept = {}
    for i, text in docs:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - length + 1):
            if least[text[at : at + length]] < i:
                gone[at : at + length] = True
        kept[i] = bytes(np.frombuffer(text, np.uint8)[~gone])
    return kept


def noise_of(seed):
    rng = np.random.default_rng(seed)
    return lambda n: "".join(map(chr, rng.integers(97, 123, n)))


def test_suffix_dedup_of_many_contexts_under_one_anchor(spark):
    noise = noise_of(7)
    passage = noise(80)
    docs = [(i, noise(60) + passage + noise(60)) for i in range(3000)]
    docs += [(i, "ab" * 40 + noise(i % 50) + "ab" * 60) for i in range(3000, 3040)]
    expected = brute_spans([(i, t.encode()) for i, t in docs])
    found = suffix_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), as_bytes=True).collect()
    assert {r.doc_id: bytes(r.text) for r in found} == expected
    assert all(r.n_removed >= 80 for r in found if 0 < r.doc_id < 3000)


def test_suffix_dedup_of_long_texts_is_cut_where_it_does_not_show(spark):
    noise, block = noise_of(8), suffix_dedup.BLOCK_BYTES
    passages = [noise(200) for _ in range(6)]
    long = bytearray(noise(5 * block + 77).encode())
    for k, (passage, shift) in enumerate(zip(passages, (-199, -100, -50, -49, -1, 0))):
        at = (k % 5 + 1) * block + shift - 1000 * (k // 5)
        long[at : at + 200] = passage.encode()
    docs = [(1, " ".join(passages)), (2, long.decode()), (3, noise(10) + long.decode())]
    found = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), as_bytes=True).collect()}
    assert (found[2].n_removed, found[2].n_spans) == (1200, 6)
    assert bytes(found[3].text).decode() == docs[2][1][:10] and found[3].n_spans == 1


def test_suffix_runs_hold_equal_bytes_only():
    import pyarrow as pa

    noise = noise_of(9)
    shared = noise(60)
    contexts = [(noise(5) + shared + noise(5)).encode() for _ in range(40)]
    rows = pa.table({"__hash": [1] * 40, "__digest": list(range(40)), "__context": contexts, "__least": list(range(40))})
    everything = np.full(1 << (suffix_dedup.CODE_BITS - 6), np.uint64(2**64 - 1))
    runs = suffix_dedup._runs(rows, everything).to_pylist()
    assert sum(len(r["__members"]) for r in runs) == 40 * 21
    for r in runs:
        assert {contexts[m["digest"]][m["start"] : m["start"] + 50] for m in r["__members"]} == {r["__string"]}
        assert r["__low"] == min(m["least"] for m in r["__members"]) and r["__high"] == max(m["least"] for m in r["__members"])
    assert len({r["__string"] for r in runs}) == len(runs)
    assert suffix_dedup._runs(rows, np.zeros_like(everything)).num_rows == 0


def test_suffix_sort():
    rng = np.random.default_rng(1)
    for _ in range(30):
        data = rng.choice(np.frombuffer(b"ab", np.uint8), 300)
        starts = rng.permutation(250)[:120]
        groups = rng.integers(0, 3, 120)
        order, equal = suffix_dedup.sort_suffixes(data, starts, groups)
        keys = [(groups[i], bytes(data[starts[i] : starts[i] + 50])) for i in order]
        assert keys == sorted(keys)
        assert [bool(e) for e in equal[1:]] == [a == b for a, b in zip(keys, keys[1:])]


def test_packing(odd, empty):
    path = queries.tokenizer_path(queries.PACK_TOKENIZER)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack(packing.pieces(odd, path, 64), 64).toPandas()
    want = []
    for i, t, *_ in ODD:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(str(i), k // 64, zlib.crc32(ids[k : k + 64].tobytes())) for k in range(0, len(ids), 64)]
    assert sorted((str(None if np.isnan(i) else int(i)), p, zlib.crc32(x)) for i, p, x in zip(rows.doc_id, rows.piece, rows.ids)) == sorted(want)
    ordered = rows.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id")["length"].cumsum()
    assert (ends - ordered["length"] == ordered["offset"]).all() and ends.max() <= 64
    assert rows.sequence_id.nunique() <= packing.least_bins(rows.length.to_numpy(), 64) + 1
    assert packing.pack(packing.pieces(empty, path, 64), 64).count() == 0


def test_packing_keeps_words_that_recur(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.PACK_TOKENIZER)
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    tokenizer, words, asked = Tokenizer.from_file(path), packing.WordIds(path), []
    learn = words._learn
    words._learn = lambda missing: (asked.extend(missing), learn(missing))
    often = ["plain", "Plain,", "heat***", "it's", "\u00e9t\u00e9!?", "12%"]
    for k in range(30):
        texts = [" ".join([*often, *(f"rare{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i)}" for i in range(8))]), None]
        ids, counts = words.encode(pa.array(texts))
        assert ids.tolist() == tokenizer.encode(texts[0], add_special_tokens=False).ids and counts.tolist() == [len(ids), 0]
        assert len(words.words) + len(words.older) <= 60
    assert all(asked.count(w.encode().lower()) == 1 for w in often)


def test_packing_marks_and_letters_equal_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.PACK_TOKENIZER)
    tokenizer, words = Tokenizer.from_file(path), packing.WordIds(path)
    texts = [
        "left out", "Heat*** word. a$$$ x#%& \u00e9! \u00c9!! \u0130? it's $$$ ..\n\nA  b", None, "", " ", "&&&", "na\u00efve,;: don't*** can't. 12%% a1! \u01c6&",
        "<|endoftext|>! a<|endoftext|>", "tab\there\r.  e\u0301! \u00df$ \u65e5\u672c. a\u0338! WORD WORD, (word) word's# 's s't",
    ]
    ids, counts = words.encode(pa.array(texts).slice(1))
    found = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]


def test_sentence_pieces_equal_the_library(odd, empty):
    import sentencepiece

    path = queries.tokenizer_path(queries.PIECE_MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [t or "" for _, t, *_ in ODD] + ["▁ a▁▁b", "\x00é😀\n\n x  ", "<s></s> ﷺ", "  "]
    model = sentence_pieces.model(path)
    for t in texts:
        assert model.encode(t) == lib.encode(t) and model.decode(lib.encode(t)) == lib.decode(lib.encode(t))
    for ids in ([200, 1, 153], [230, 153], [28705, 259, 3], [0, 28705]):
        assert model.decode(ids) == lib.decode(ids)
    assert sentence_pieces.decode(sentence_pieces.encode(odd, path), path).count() == len(ODD)
    assert sentence_pieces.encode(empty, path).count() == 0


def test_classifier_learns_held_out_labels(spark, odd, empty):
    import pandas as pd

    dir_ = "/root/testdata/sf0.1"
    got = queries.op10_quality_classifier(spark, dir_).toPandas().merge(pd.read_parquet(f"{dir_}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.98
    weights = quality_classifier.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_classifier.score(odd, weights).collect()} == {0.5}
    assert quality_classifier.score(empty, weights).count() == 0


def test_pipeline_stages(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.columns == docs.columns, name
        assert 0 < left.count() <= docs.count()
        docs = corpus_pipeline.stored(left, "test")
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
