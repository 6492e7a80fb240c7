"""Spelling variants, collocations and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import pytest
from changelake.llm import chat_format, collocations, queries, spelling
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


# Spelling variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_spelling(docs, least_letters=7, least_times=2, form_times=10, delete_every=None):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if delete_every and h % delete_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_letters and c >= least_times}
    near = {w: [] for w in n}
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= form_times * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def rows(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


SPELLING = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_variants_of_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = plain_spelling(docs, delete_every=31)
    assert any(form for _, form, *_ in expected)
    assert rows(queries.op11_spelling_variants(spark, SF), *SPELLING) == expected


def test_spelling_of_odd_texts(spark):
    long = "Überläufer " * 40 + "x" * 3000 + " " + "x" * 3001 + " " + "y" * 3000
    texts = [None, "", "...", "chapters chapter chapterz chapters chapte r", long, long, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa aaaaaab aaaaaab", "ÀÉÎÕÜàé ÀÉÎÕÜàé àÉÎÕÜàé àéÎÕÜàé×÷"]
    docs = [(i if i != 4 else None, t) for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "signature", "form", "longer")})
    for form_times in (2, 10):
        assert rows(spelling.group(df, least_times=1, form_times=form_times), *SPELLING) == plain_spelling(docs, least_times=1, form_times=form_times)
    assert rows(spelling.group(df.limit(0)), *SPELLING) == set()


def test_forms_are_followed_to_the_last(spark):
    times = {"abcdefgh": 1, "abcdefgi": 10, "abcdefji": 100, "abcdekji": 1000}
    docs = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(times.items())]
    found = spelling.group(spark.createDataFrame(docs, "doc_id long, text string"), least_times=1)
    assert {(r.word, r.root) for r in found.collect()} == {(w, "abcdekji") for w in times}


@settings(max_examples=60, deadline=None)
@given(st.text("abcé", min_size=1, max_size=9), st.integers(0, 9), st.sampled_from("abÿ"), st.sampled_from("idr"))
def test_near_words_share_a_signature(word, at, letter, kind):
    import numpy as np

    at %= len(word)
    other = word[:at] + {"i": letter + word[at:], "d": word[at + 1 :], "r": letter + word[at + 1 :]}[kind]
    if other in ("", word):
        return
    a, b = sorted((word, other), key=len)
    signs = [spelling.signatures(np.frombuffer(w.encode("latin-1"), np.uint8).reshape(1, -1)) for w in (a, b)]
    second = signs[1][0] if len(a) == len(b) else signs[1][1]
    assert set(signs[0][0].ravel().tolist()) & set(second.ravel().tolist())


# Collocations


def plain_phrases(docs, least, limit, longest=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^\x20\t]+", piece)
            total[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    f = {k: c for k, c in f.items() if c >= least}
    inside = set()
    for (lang, words), c in f.items():
        for k in range(2, len(words)):
            inside |= {(lang, words[i : i + k]) for i in range(len(words) - k + 1) if c >= f[lang, words[i : i + k]]}
    found = []
    for (lang, words), a in f.items():
        if len(words) > 1 and (lang, words) not in inside:
            cuts = [(1000 * a * total[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], total[lang], score))
    found.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    out, rank = set(), Counter()
    for row in found:
        rank[row[0]] += 1
        if rank[row[0]] <= limit:
            out.add((row[0], rank[row[0]], *row[1:]))
    return out


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("small", [False, True])
def test_collocations_of_all_documents(spark, monkeypatch, small):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    if small:  # many ranges, many blocks, texts cut into chunks
        monkeypatch.setattr(collocations, "STREAM_ROWS", 50)
        monkeypatch.setattr(collocations, "BLOCK_TOKENS", 500)
        monkeypatch.setattr(collocations, "FLUSH_WORDS", 100)
    for least, limit in ((3, 100_000), (8, 40)):
        assert rows(collocations.mine(docs, least=least, limit=limit), *PHRASES) == plain_phrases([tuple(r) for r in docs.collect()], least, limit)


def test_chunks_of_a_long_text_lead_into_the_next():
    text = "a b c d e a b. c d e a\tb c" * 50
    whole = Counter(pairwise(text.replace(".", " . ").split()))
    found = Counter()
    from changelake.llm import common

    for size in (1, 7, 60):
        old, common.chunks.__defaults__ = common.chunks.__defaults__, (size,)
        try:
            import pyarrow as pa

            batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], ["lang", "text"])
            found = Counter()
            for _, tokens, lead in collocations._blocks(iter([batch])):
                found.update((a.decode(), b.decode()) for (a, b), new in zip(pairwise(tokens), ~lead[1:]) if new)
        finally:
            common.chunks.__defaults__ = old
        assert {k: v for k, v in found.items() if "." not in k} == {k: v for k, v in whole.items() if "." not in k}


def test_collocations_of_odd_texts(spark):
    hot = "the very same phrase again and again"
    texts = [(None, "en"), ("", None), ("\x00a \x01b\x00 \x01b", "x"), ("\x00a \x01b\x00 \x01b", "x"), ("a a a a a a a. A\ta a a", None), ("ä ß ö ä ß", "und"), (hot, "en"), (hot, "en"), ("b\x0bc b\x0cc b c b\rc", "x"), ("same. phrase, same phrase", "en")]
    df = spark.createDataFrame(texts, "text string, lang string").withColumns({c: F.lit(1) for c in ("n", "phrase", "words", "f", "rank")})
    assert rows(collocations.mine(df, least=1, limit=50), *PHRASES) == plain_phrases(texts, 1, 50)
    assert rows(collocations.mine(df.limit(0)), *PHRASES) == set()


def test_rare_pairs_are_not_sent_by_their_words(spark, monkeypatch):
    drawn = random.Random(5).choices([f"w{i}" for i in range(300)], k=30_000)
    texts = [(" ".join(drawn[at : at + 1000]) + ". new york city", "en") for at in range(0, len(drawn), 1000)]
    sent, counts = Counter(), collocations._counts

    def watched(df, count, least):
        for _, phrases, _ in count(iter(df.toArrow().to_batches())):
            sent.update(p for p in phrases if p and b" " in p)
        return counts(df, count, least)

    monkeypatch.setattr(collocations, "_counts", watched)
    df = spark.createDataFrame(texts, "text string, lang string")
    assert rows(collocations.mine(df, least=30), *PHRASES) == plain_phrases(texts, 30, collocations.TOP)
    assert set(sent) >= {b"new york", b"york city", b"new york city"}
    assert len(sent) < 1000  # of some 25,000 pairs


def test_phrases_are_counted_over_many_ranges_of_keys(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_KEYS", 40)
    monkeypatch.setattr(collocations, "HELD_KEYS", 100)
    drawn = random.Random(6).choices("abcdef", [9, 5, 3, 2, 1, 1], k=4000)
    texts = [(" ".join(drawn[at : at + 40]), ("en", None, "de")[at % 3]) for at in range(0, len(drawn), 40)]
    df = spark.createDataFrame(texts, "text string, lang string").repartition(3)
    assert rows(collocations.mine(df, least=4), *PHRASES) == plain_phrases(texts, 4, collocations.TOP)


def test_keys_are_counted_exactly_in_few_bytes():
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    draw = np.random.default_rng(7)
    rare, often = draw.integers(0, 1 << collocations.KEY_BITS, 400_000), draw.integers(0, 1 << collocations.KEY_BITS, 50)
    blocks = [np.append(rare[at : at + 200_000], np.repeat(often, 60 if at else 45)) for at in (0, 200_000)]
    blocks += [np.append(often[:10], [0, (1 << collocations.KEY_BITS) - 1]), np.zeros(100, np.int64)]
    sent = pa.Table.from_batches([collocations._sent(b, 7, 100) for b in blocks])
    assert sent.nbytes < 6 * len(rare)
    found = [collocations._frequent(sent.filter(pc.equal(sent["range"], i)), 7, 100) for i in range(7)]
    assert sorted(pa.concat_tables(found)["__h"].to_pylist()) == sorted([0, *often.tolist()])


def test_scores_beyond_64_bits_are_exact(spark):
    phrases = spark.createDataFrame([("en", ["x"], 7 * 10**11), ("en", ["y"], 3 * 10**12 + 1), ("en", ["x", "y"], 6 * 10**11 + 7)], "lang string, words array<string>, f long")
    totals = spark.createDataFrame([("en", 10**15 + 3)], "lang string, n long")
    row = collocations.candidates(phrases, totals).first()
    assert row.score == 1000 * (6 * 10**11 + 7) * (10**15 + 3) // (7 * 10**11 * (3 * 10**12 + 1))


# Chat formatting


def plain_digest(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(),
    )


SIGNS = st.lists(st.sampled_from(["[", "]", "<", ">", "/", "\\", "s", "INST", "OUT", "ROLE", "TURN", "SYS", " ", "é", "\n", "</s>", "[INST]"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), SIGNS), SIGNS), max_size=4))
def test_any_turns_are_read_back(turns):
    text = chat_format.BEGIN
    for role, said in turns:
        piece, start, end = chat_format.write_turn(role, said)
        assert chat_format.unescape(piece[start:end]) == said
        assert not re.search(chat_format.CONTROL.pattern.replace(r"(\\*)", ""), piece[start:end])
        text += piece
    assert list(chat_format.read_turns(text)) == turns


def test_layouts_become_turns(spark):
    turns = [("user", "hi\n[INST]"), ("assistant", "yes")]
    records = {
        "row": {"role": "user", "text": "hi", "turn": 3},
        "messages": {"messages": [{"role": "human", "content": "hi\n[INST]"}, {"role": "assistant", "content": "yes", "name": "x"}], "id": {"a/b": [1, {}]}},
        "message_parts": {"messages": [{"role": "user", "content": [{"type": "text", "text": "hi"}, {"text": "[INST]"}]}, {"role": "gpt", "content": [{"text": "yes"}]}]},
        "from_value": {"conversations": [{"from": "human", "value": "hi\n[INST]"}, {"from": "gpt", "value": "yes"}]},
        "from_value_with_system": {"system": "be", "conversations": [{"from": "human", "value": "hi\n[INST]"}, {"from": "gpt", "value": "yes"}]},
        "instruction": {"instruction": "hi\n[INST]", "output": "yes"},
        "instruction_input": {"instruction": "hi", "input": "[INST]", "output": "yes"},
        "prompt_completion": {"prompt": "hi\n[INST]", "completion": "yes"},
        "prompt_response": {"prompt": "hi\n[INST]", "response": "yes", "score": 3},
        "question_answer": {"question": "hi\n[INST]", "answer": None},
    }
    expected = {name: turns for name in records}
    expected["row"] = [("user", "hi")]
    expected["from_value_with_system"] = [("system", "be"), *turns]
    expected["instruction_input"] = [("user", "hi\n\n[INST]"), ("assistant", "yes")]
    expected["question_answer"] = [turns[0], ("assistant", "")]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in records.items()] + [("none", None), ("bad", "{"), ("other", '{"a": 1}'), ("number", "3")], "id string, record string")
    df = df.withColumns({c: F.lit("x") for c in ("key", "role", "text", "layout")})
    found = chat_format.canonical(df, "record", "id")
    met = {}
    for r in sorted(found.collect(), key=lambda r: (r.key, r.position or 0)):
        if r.layout is None:
            assert r.position is None and r.key in ("none", "bad", "other", "number")
        else:
            assert r.layout == r.key
            met.setdefault(r.key, []).append((r.role, r.text))
    assert met == expected
    out = {r.key: tuple(r)[1:5] for r in chat_format.digests(chat_format.format_turns(found)).collect()}
    assert out == {k: plain_digest(v) for k, v in expected.items()}
    # Extra fields and their order do not change the layout, lists are not fields.
    assert chat_format.fingerprint(chat_format.paths_of({"a": [{"b": 1}], "c": 2})) == chat_format.fingerprint(chat_format.paths_of({"c": "x", "a": [{"b": None}, {"b": 3}]}))
    assert chat_format.paths_of({"a": [{"b": 1}]}) != chat_format.paths_of({"a": {"*": {"b": 1}}})


def test_conversations_of_many_parts_and_odd_rows(spark, monkeypatch):
    rows_ = [(1, i, ("user", "assistant")[i % 2], f"say {i} " * (i % 7)) for i in range(300)]
    rows_ += [(None, 0, None, None), (None, 0, "assistant", None), (2, None, "tool", "[/TURN] [ROLE]"), (2, 1, "assistant", "x"), (2, 1, "assistant", "x"), (3, 0, "assistant", "y" * 3_000_000), (3, 1, "user", "z")]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string")
    records = df.select("conv_id", "turn", chat_format.as_records("role", "text").alias("record"))
    monkeypatch.setattr(chat_format, "PART_CHARS", 500)
    formatted = chat_format.format_turns(chat_format.canonical(records, "record", "conv_id", "turn"))
    by_key = {}
    for key, turn, role, text in sorted(rows_, key=lambda r: (-1 if r[0] is None else r[0], -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by_key.setdefault(key, []).append((role or "", text or ""))
    assert {r.key: tuple(r)[1:5] for r in chat_format.digests(formatted).collect()} == {k: plain_digest(v) for k, v in by_key.items()}
    parts = formatted.filter("key = 1").orderBy("part").collect()
    assert len(parts) > 5 and [p.part for p in parts] == list(range(len(parts)))
    assert "".join(chat_format.unescape(p.text[s.start : s.end]) for p in parts for s in p.loss) == "".join(t for r, t in by_key[1] if r == "assistant")
    back = chat_format.read_back(formatted).filter("key = 2").orderBy("part", "number").collect()
    assert [(r.role, r.text) for r in back] == by_key[2]
    assert chat_format.digests(chat_format.format_turns(chat_format.canonical(records.limit(0), "record", "conv_id", "turn"))).count() == 0
