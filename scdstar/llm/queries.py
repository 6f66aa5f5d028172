"""Registered queries of the operators, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scdstar.llm import (
    chat, contain, importance, infill, jaccard, languages, maintext, mixing, quality, sharding, tokencounts,
    tokenfiles, toxicity,
)
from scdstar.llm.common import table
from scdstar.session import stage

#: Follows every document in token files.
END_ID = 2


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencounts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counted.select(
        "doc_id", F.col("section").alias("line"), "start", "end",
        F.expr(f"units div {tokencounts.UNITS}").alias("n_tokens"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    return toxicity.score(table(spark, sf_dir, "documents"), labels).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contain.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    domains = sorted(mixing.TARGETS)
    return mixed.select(
        "doc_id", "n_tokens", *[mixed["p"][k].alias(f"p_{d}") for k, d in enumerate(domains)],
        "rate", "copies",
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfiles.new_folder(spark, "token-files")
    tokenfiles.write_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, END_ID
    )
    return tokenfiles.read_tokens(spark, folder)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "piece",
    )


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.sql(
        r"SELECT -7L AS conv_id, turn, role, r'\### Assistant: </turn> ok' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = stage(chat.chains(rows.unionByName(hard)), "chat-messages")
    read = chat.parsed(stage(chat.formatted(messages), "chat-formatted"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n")
    )), "")
    loss = chat.loss_text(F.col("formatted"), F.col("loss"))
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5
    found = languages.predict(documents, documents.filter(remainder != 0))
    return found.select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_sharding": op6_sharding,
    "op7_main_text": op7_main_text,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_files": op9_token_files,
    "op10_reply_trees": op10_reply_trees,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_importance": op12_importance,
    "op13_languages": op13_languages,
}


def _shingles(table: str, key: str, size: int) -> str:
    """SQL for distinct (key, shingle) of a table's texts."""
    return f"""
    SELECT {key}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}),
        lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END) AS g
    FROM (SELECT {key}, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> '') AS w FROM {table})"""


SQL: dict[str, str] = {
    "op1_jaccard_join": f"""
WITH RECURSIVE s AS ({_shingles("documents", "doc_id", 4)}),
n AS (SELECT d.doc_id, count(s.g) AS n FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY 1),
both_in AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT n.doc_id, n.n AS n_shingles, min(r) AS component_id
FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY 1, 2
""",
    "op4_decontamination": f"""
WITH d AS ({_shingles("documents", "doc_id", 5)}),
b AS ({_shingles("benchmark", "item_id", 5)}),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1),
long AS (SELECT item_id, g FROM b WHERE len(string_split(g, ' ')) = 5),
short AS (SELECT item_id, g FROM b WHERE len(string_split(g, ' ')) < 5),
spaced AS (
  SELECT doc_id, ' ' || trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) || ' ' AS t
  FROM documents WHERE text IS NOT NULL
)
SELECT doc_id, long.item_id, n.n AS n_shingles, count(*) AS n_shared
FROM long JOIN d ON d.g = long.g JOIN n ON n.item_id = long.item_id
GROUP BY 1, 2, 3 HAVING 100 * count(*) >= 80 * n.n
UNION
SELECT doc_id, item_id, 1, 1 FROM short JOIN spaced ON contains(t, ' ' || g || ' ')
""",
    "op10_reply_trees": r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    replace(replace(coalesce(text, ''), '\', '\\'), '<|', '<\|') AS e,
    replace(replace(replace(coalesce(role, ''), '\', '\\'), '<|', '<\|'), chr(10), '\n') AS r
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(e) + length(r) + 17)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op11_fill_in_middle": r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents
),
h AS (
  SELECT doc_id, text, w, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS a,
    ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS b, ('0x' || h[17:24])::BIGINT AS c, ('0x' || h[25:32])::BIGINT AS d
  FROM t
),
parts AS (
  SELECT doc_id, text, n, array_to_string(w[1:least(a, b)], '') AS p,
    array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(w[greatest(a, b) + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c % 100 >= 50
      THEN 'plain' WHEN d % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
    "op12_importance": r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, text, TRUE AS source FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text, FALSE FROM benchmark
),
words AS (
  SELECT r, doc_id, source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
),
features AS (
  SELECT r, source, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM words
),
crc AS (  -- the table of CRC-32
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS cells
),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(f))),
    lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, cells[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crc
),
held AS (SELECT r, source, bucket, count(*) AS n FROM features JOIN buckets USING (f) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (source), 0) AS s, coalesce(sum(n) FILTER (NOT source), 0) AS t
  FROM held GROUP BY 1
),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM held JOIN gains USING (bucket) GROUP BY 1
),
scores AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE source
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND row_number() OVER w <= 5 * sum((n_words >= 20)::INT) OVER () // 100
  THEN row_number() OVER w END AS rank
FROM scores WINDOW w AS (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id)
""",
    # All documents are learned from here: exact as long as no language has more than LABELLED.
    "op13_languages": r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS cells
),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, nfc_normalize(text) AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda i: unicode(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, cells[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS held_out
  FROM documents, crc
),
words AS (
  SELECT r, list_transform(range(1, length(w) + 1), lambda i: unicode(substr(w, i, 1))::BIGINT) AS c, count(*) AS times
  FROM (SELECT r, lower(unnest(regexp_extract_all(text, '[\p{L}\p{M}]+'))) AS w FROM docs WHERE regexp_matches(text, '\p{L}'))
  GROUP BY ALL
),
runs AS (SELECT r, times, c, list_append(list_prepend(0::BIGINT, c), 0::BIGINT) AS e FROM words),
grams AS (
  SELECT r, g, sum(times)::BIGINT AS n FROM (
    SELECT r, times, unnest(list_concat(c,
      list_transform(range(1, len(e)), lambda i: (1::BIGINT << 61) + (e[i] << 21) + e[i + 1]),
      list_transform(range(1, len(e) - 1), lambda i: (1::BIGINT << 62) + (e[i] << 42) + (e[i + 1] << 21) + e[i + 2]))) AS g
    FROM runs) GROUP BY ALL
),
profiles AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, g) - 1 AS rank
  FROM (SELECT lang, g, sum(n) AS n FROM grams JOIN docs USING (r) WHERE lang IS NOT NULL AND NOT held_out GROUP BY ALL)
  QUALIFY rank < 300
),
own AS (
  SELECT r, g, avg(k) OVER (PARTITION BY r, n) AS rank FROM (
    SELECT r, g, n, row_number() OVER (PARTITION BY r ORDER BY n DESC, g) - 1 AS k FROM grams QUALIFY k < 300)
),
apart AS (
  SELECT own.r, l.lang, sum(coalesce(abs(p.rank - own.rank), 300))::DOUBLE AS d
  FROM own CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN profiles p ON p.lang = l.lang AND p.g = own.g
  GROUP BY ALL
),
nearest AS (
  SELECT r, list(lang ORDER BY d, lang) AS langs, list(d ORDER BY d, lang) AS ds FROM apart GROUP BY 1
)
SELECT doc_id, held_out, coalesce(langs[1], 'und') AS lang_pred,
  coalesce(CASE WHEN ds[2] = 0 THEN 0 ELSE 1 - ds[1] / ds[2] END, 0)::DOUBLE AS score
FROM docs LEFT JOIN nearest USING (r)
""",
}
