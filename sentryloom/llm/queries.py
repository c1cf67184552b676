"""The corpus queries by name, each over its whole table, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import table
from .collocations import collocations
from .decontamination import contained_items
from .exact_dedup import exact_dedup, normalised
from .katz import score_texts
from .language_id import fold, identify_language
from .min_slack import pack_min_slack
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .packing import pack_tokens
from .sharding import shard_rows
from .spelling import document_words, spelling_variants
from .token_counts import count_tokens
from .toxicity import score_toxicity


#: The tokenizer of the counting and packing queries.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
sets AS (SELECT doc_id, sha256(string_agg(sh, chr(10) ORDER BY sh)) AS name FROM s GROUP BY 1),
rep AS (SELECT name, min(doc_id) AS rep FROM sets GROUP BY 1),
r AS (SELECT s.doc_id, hash(s.sh) AS h FROM s JOIN rep ON rep.rep = s.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM r a JOIN r b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(x, y) AS (SELECT rep, rep FROM rep UNION SELECT reach.x, edges.b FROM reach JOIN edges ON edges.a = reach.y),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id, w.doc_id = coalesce(c.component_id, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN sets USING (doc_id) LEFT JOIN rep USING (name) LEFT JOIN comp c ON c.x = rep.rep
"""


def op2_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, TOKENIZER).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op3_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM t),
s AS (
  SELECT DISTINCT kind, id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w),
n AS (SELECT id AS item_id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY 1),
p AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM s d JOIN s i ON d.sh = i.sh AND d.kind = 'd' AND i.kind = 'i' GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM p JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(normalised(F.col("text")), 256))
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def op5_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 3) == 1)
    out = identify_language(docs.drop("lang"), docs.filter("NOT held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 4) == 2)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold("doc_id", 4) != 2)
    out = score_toxicity(docs, docs.filter("NOT held_out"), labels)
    return out.select("doc_id", "held_out", "score", "predicted")


def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 7) == 2)
    out = score_texts(docs.withColumn("_train", ~F.col("held_out")))
    return out.select("doc_id", (~F.col("_train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = shard_rows(docs, 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"), TOKENIZER, pad_id=50256)


def op11_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_min_slack(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(document_words(table(spark, sf_dir, "documents").select("doc_id", "text")))


OP12_SQL = r"""
WITH RECURSIVE bytes AS (SELECT unnest(range(256)) AS b),
steps AS (SELECT b, list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v FROM bytes),
tab AS (SELECT list(v ORDER BY b) AS t FROM steps),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY 1, 2),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::UBIGINT)),
    lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM low, tab),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word, sum(n)::BIGINT AS n FROM hashed GROUP BY 1),
v AS (SELECT word, n FROM words WHERE length(word) >= 7 AND n >= 2),
cuts AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
half AS (
  SELECT a.word AS word, a.n AS n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT a.word, a.n, v.word, v.n FROM cuts a JOIN v ON a.cut = v.word),
pairs AS (SELECT * FROM half UNION SELECT near, near_n, word, n FROM half),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS near FROM pairs GROUP BY 1),
f AS (
  SELECT v.word, CASE WHEN most >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN most END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk(word, root) AS (SELECT word, word FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.root FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP13_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, phrase, count(*) AS n
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)
  GROUP BY 1, 2, 3),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, n AS a FROM g WHERE k > 1 AND n >= 100),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k))
  GROUP BY 1, 2),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT lang, phrase, a, i, array_to_string(ws[1:i], ' ') AS x, array_to_string(ws[i + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS i FROM kept)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, i, x.n AS l, y.n AS r, totals.n AS n, (1000::HUGEINT * a * totals.n // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts JOIN totals USING (lang) JOIN g x ON x.lang = cuts.lang AND x.phrase = cuts.x JOIN g y ON y.lang = cuts.lang AND y.phrase = cuts.y),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best QUALIFY rank <= 2000
"""


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_count_tokens, op3_contained_items, op4_exact_dedup, op5_identify_language, op6_mix_sources, op7_score_toxicity, op8_katz_scores, op9_shard_documents, op10_pack_tokens, op11_min_bin_slack, op12_spelling_variants, op13_phrase_collocations)}
ORACLE_SQL = {"op1_near_duplicates": OP1_SQL, "op3_contained_items": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op12_spelling_variants": OP12_SQL, "op13_phrase_collocations": OP13_SQL}
