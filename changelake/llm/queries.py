"""One query per corpus operator, over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from changelake.llm import chat_format, collocations, line_dedup, near_dedup, order_minhash, packing, ppm, quality_classifier, quality_rules, sentence_pieces, spelling, suffix_dedup, warc
from changelake.llm.common import fold_of, read, whole
from changelake.workdir import fresh
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPACITY = 2048  # tokens of a packed sequence
PREDICTED = 0.3  # least score of a predicted 1
PACK_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file lies on this and every other machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as web archives, then read back through the index."""
    folder = fresh(spark, "warc")
    index = warc.write(read(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    found = warc.fetch(index, folder)
    return found.select(F.col("key").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


OP1_SQL = """WITH p AS (SELECT page_id, COALESCE(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
l AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS newest FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN newest END AS refers_to
FROM l"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the lines left after later occurrences of three-line windows went."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2(whole(), 256).alias("kept_sha256"))


OP2_SQL = """WITH lines AS (
  SELECT doc_id, text, t.line, t.pos FROM documents,
  LATERAL (SELECT UNNEST(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos) t),
wins AS (
  SELECT doc_id, pos, line, LEAD(line, 1) OVER d AS l2, LEAD(line, 2) OVER d AS l3 FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
full_wins AS (SELECT * FROM wins WHERE l3 IS NOT NULL AND regexp_matches(line || l2 || l3, '[^\\x20\\x09-\\x0D]')),
ranked AS (SELECT doc_id, pos, ROW_NUMBER() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) AS nth FROM full_wins),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (VALUES (0), (1), (2)) s(k) WHERE nth > 1),
marked AS (SELECT l.doc_id, l.pos, l.line, g.pos IS NOT NULL AS dropped FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos),
runs AS (SELECT *, dropped AND NOT COALESCE(LAG(dropped) OVER (PARTITION BY doc_id ORDER BY pos), FALSE) AS starts FROM marked)
SELECT d.doc_id, COUNT(r.pos) AS n_lines, COUNT(*) FILTER (r.dropped) AS n_removed, COUNT(*) FILTER (r.starts) AS n_spans,
       sha256(COALESCE(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (NOT r.dropped), '')) AS kept_sha256
FROM documents d LEFT JOIN runs r ON d.doc_id = r.doc_id GROUP BY d.doc_id"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", *quality_rules.FIGURES, "base_failed", "kept")


OP3_SQL = """WITH t AS (SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, len(words) AS n, UNNEST(words) AS word, generate_subscripts(words, 1) AS pos FROM t),
wins AS (SELECT doc_id, pos, word, LEAD(word, 1) OVER d AS w2, LEAD(word, 2) OVER d AS w3, LEAD(word, 3) OVER d AS w4, LEAD(word, 4) OVER d AS w5
         FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (SELECT doc_id, pos, COUNT(*) OVER (PARTITION BY doc_id, word, w2, w3, w4, w5) AS times FROM wins WHERE w5 IS NOT NULL),
reps AS (SELECT doc_id, COUNT(DISTINCT pos + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2), (3), (4)) s(k) WHERE times > 1 GROUP BY doc_id),
f AS (SELECT t.doc_id, text, words, len(words) AS n_words, COALESCE(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
  len(regexp_extract_all(text, '\\p{L}')) AS letters, len(regexp_extract_all(text, '\\p{Lu}')) AS capitals,
  len(list_filter(words, lambda x: x LIKE '%!')) AS shouted, COALESCE(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN reps r ON t.doc_id = r.doc_id),
g AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.3 * n_words OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
    OR n_dup_lines > 0.5 * len(string_split(text, chr(10))) OR shouted > 0.3 * n_words OR capitals > 0.6 * letters
    OR letters < 0.5 * word_chars OR (n_words >= 50 AND len(list_distinct(words)) < 0.1 * n_words)) AS kept
FROM g"""


def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability, learnt from nine folds of ten."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ppm.score(docs, docs.filter(fold_of("doc_id", 10) != 0))
    return scored.select("doc_id", (fold_of("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and its neighbour's."""
    found = order_minhash.beside_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("key").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies, over four-word shingles."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.mark(docs, words=4, percent=80)


OP6_SQL = """WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, UNNEST(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w] ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS sh FROM t),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * COUNT(*) >= 80 * (na.n + nb.n - COUNT(*))),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
c AS (SELECT doc_id, MIN(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, COALESCE(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its packed place."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    made = packing.pieces(docs, tokenizer_path(PACK_TOKENIZER), CAPACITY)
    return packing.pack(made.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), CAPACITY)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 50 bytes that smaller ids have."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.dedup(docs, as_bytes=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    path = tokenizer_path(PIECE_MODEL)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentence_pieces.encode(docs, path, decoded="decoded")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability of label 1, learnt from four folds of five."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    training = fold_of("doc_id", 5) != 0
    weights = quality_classifier.fit(docs.filter(training), read(spark, sf_dir, "labels").filter(training))
    scored = quality_classifier.score(docs, weights)
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its more frequent near word and the end of such forms."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group(docs, delete_every=31)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of two to five words."""
    return collocations.mine(read(spark, sf_dir, "documents").select("text", "lang"))


OP12_SQL = r"""WITH t AS (SELECT COALESCE(lang, 'und') AS lang, translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, UNNEST(regexp_split_to_array(text, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p),
totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, UNNEST(flatten(list_transform(range(1, 6), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS words FROM w),
f AS (SELECT lang, words, CAST(COUNT(*) AS BIGINT) AS f FROM g GROUP BY lang, words HAVING COUNT(*) >= 100),
c AS (SELECT * FROM f WHERE len(words) > 1),
covered AS (SELECT DISTINCT lang, part FROM (SELECT lang, f, UNNEST([words[1:len(words) - 1], words[2:len(words)]]) AS part FROM c WHERE len(words) > 2) x
  WHERE EXISTS (SELECT 1 FROM c WHERE c.lang = x.lang AND c.words = x.part AND x.f >= c.f)),
o AS (SELECT c.* FROM c LEFT JOIN covered v ON c.lang = v.lang AND c.words = v.part WHERE v.part IS NULL),
k AS (SELECT lang, words, f, UNNEST(range(1, len(words))) AS k FROM o),
s AS (SELECT k.lang, k.words, k.f AS a, k.k, x.f AS l, y.f AS r, n, (CAST(1000 AS HUGEINT) * k.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM k JOIN totals ON totals.lang = k.lang JOIN f x ON x.lang = k.lang AND x.words = k.words[1:k.k] JOIN f y ON y.lang = k.lang AND y.words = k.words[k.k + 1:len(k.words)]),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang, words ORDER BY score, k) AS nth FROM s),
q AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM b WHERE nth = 1)
SELECT * FROM (SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM q) WHERE rank <= 2000"""


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted and read back from the formatted text."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    records = rows.unionByName(more).select("conv_id", "turn", chat_format.as_records("role", "text").alias("record"))
    found = chat_format.digests(chat_format.format_turns(chat_format.canonical(records, "record", "conv_id", "turn")))
    return found.withColumnRenamed("key", "conv_id")


OP13_SQL = r"""WITH c AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
m AS (SELECT *, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|OUT\]|/?ROLE\]|/TURN\])' AS marks FROM c),
e AS (SELECT *, length(regexp_replace(text, marks, '\1\\\2\3', 'g')) AS size, length(regexp_replace(role, marks, '\1\\\2\3', 'g')) AS role_size FROM m)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + SUM(size + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 11 ELSE 22 + role_size END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": op1_warc,
        "op2_line_dedup": op2_line_dedup,
        "op3_quality_rules": op3_quality_rules,
        "op4_ppm": op4_ppm,
        "op5_order_minhash": op5_order_minhash,
        "op6_near_dedup": op6_near_dedup,
        "op7_packing": op7_packing,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_sentence_pieces": op9_sentence_pieces,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_collocations": op12_collocations,
        "op13_chat_format": op13_chat_format,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op2_line_dedup": OP2_SQL, "op3_quality_rules": OP3_SQL, "op6_near_dedup": OP6_SQL, "op12_collocations": OP12_SQL, "op13_chat_format": OP13_SQL}
