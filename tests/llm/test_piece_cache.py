"""Words that recur are kept when a worker's memory of words is full, and ids are decoded where they are made."""

from changelake.llm import queries, sentence_pieces


def test_recurring_chunks_are_not_made_again(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "CACHED_CHUNKS", 60)
    model = sentence_pieces.PieceModel(queries.tokenizer_path(queries.PIECE_MODEL))
    made, plain = [], model.chunk_ids
    monkeypatch.setattr(model, "chunk_ids", lambda chunk: made.append(chunk) or plain(chunk))
    common = [f"common{chr(97 + i)}" for i in range(20)]
    for k in range(40):
        model.encode_batch([" ".join([*common, *(f"rare{k}x{i}" for i in range(10))])])
        assert len(model.chunks) <= 60 and len(model.older) <= 60
    assert len(made) == len(set(made)) == 20 + 40 * 10


def test_ids_and_their_text_in_one_pass(spark):
    path = queries.tokenizer_path(queries.PIECE_MODEL)
    rows = [(1, "a b", "x"), (2, None, "y"), (None, "日本 <s> \n\x00", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    both = sentence_pieces.encode(df, path, decoded="decoded")
    apart = sentence_pieces.decode(sentence_pieces.encode(df, path), path)
    assert both.schema == apart.schema and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    plan = queries.op9_sentence_pieces(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
