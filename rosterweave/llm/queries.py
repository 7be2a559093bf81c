"""One query per operator, over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterweave.llm import (
    alignment,
    bpe,
    chat,
    decontaminate,
    quality,
    sharding,
    simhash,
    substrings,
    token_counts,
    token_files,
    topk,
    toxicity,
    vector_codes,
)
from rosterweave.llm.common import table
from rosterweave.llm.samples import remainder
from rosterweave.plans.staging import Stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Stage(spark))


@query
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.without_repeats(
        table(spark, sf_dir, "documents"), ["doc_id"], Stage(spark)
    )
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL["op5_substrings"] = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), p AS (
  SELECT r, i, sha256(array_to_string(list_slice(w, i, i + 34), ' ')) AS k
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), hit AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS j
  FROM p WHERE k IN (SELECT k FROM p GROUP BY k HAVING count(*) > 1)
), gone AS (
  SELECT r, list(j) AS js FROM hit GROUP BY r
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY j) AS t
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d)
  ANTI JOIN hit USING (r, j)
  GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, Stage(spark))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE_SQL["op8_decontaminate"] = """
WITH t AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), s AS (
  SELECT kind, r, id, list_filter(
    regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM t
), win AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM s WHERE kind = 'b' AND len(w) > 0)
), places AS (
  SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM s, (SELECT DISTINCT n FROM win) WHERE kind = 'd' AND len(w) >= n)
), m AS (
  SELECT r, i, n, item_id FROM places JOIN win USING (n, k)
), hit AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) FROM m) GROUP BY r
), names AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY r
)
SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM s LEFT JOIN hit USING (r) LEFT JOIN names USING (r) WHERE kind = 'd'
"""


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.encoded(table(spark, sf_dir, "documents"), ["doc_id"], decode=True)
    spelled = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(spelled, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    path = f"{stage.folder}/tokens"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.summary(spark, path, stage)


def _judged(scores: DataFrame, held_out: Column, cut: float) -> DataFrame:
    return scores.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(docs, labels, Stage(spark))
    held_out = remainder("doc_id", toxicity.FOLDS) == 1
    return _judged(toxicity.scored(docs, model), held_out, toxicity.CUT)


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    forest = quality.train(docs, labels, Stage(spark))
    held_out = remainder("doc_id", quality.FOLDS) == 0
    return _judged(quality.scored(docs, forest, ["doc_id"]), held_out, quality.CUT)


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", odd), (-7, 1, "assistant", odd)], told.schema.simpleString()[7:-1]
    )
    return chat.read_back(chat.messages(chat.events_of_turns(told.union(added))))


_CONTROL = "|".join(re.escape(c) for c in chat.CONTROLS)
_FIXED = " ".join(
    f"WHEN '{role}' THEN {len(head) + len(tail)}" for role, (head, tail) in chat.TEMPLATE.items()
)
_OTHER = len(chat.ROLE_OPEN + chat.ROLE_CLOSE + chat.OTHER_CLOSE)
ORACLE_SQL["op1_chat"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '(\\*)({_CONTROL})', '\1\1\\\2', 'g')) AS body,
         length(regexp_replace(role, '(\\*)({_CONTROL})', '\1\1\\\2', 'g')) AS name
  FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text)
                  FILTER (WHERE role = '{chat.TRAINED}'), '') AS loss,
         sum(body + CASE role {_FIXED} ELSE name + {_OTHER} END) AS chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM c
"""


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.col("vec_id") % 20 == 0
    return topk.top_k(table(spark, sf_dir, "embeddings"), asked, Stage(spark))


ORACLE_SQL["op4_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assigned(table(spark, sf_dir, "documents"), Stage(spark))


ORACLE_SQL["op11_sharding"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text
  FROM documents
), h1 AS (
  SELECT r, CASE WHEN doc_id IS NULL THEN NULL
            WHEN doc_id < 0 THEN CAST(18446744073709551616 + doc_id::HUGEINT AS UBIGINT)
            ELSE CAST(doc_id AS UBIGINT) END AS k
  FROM d
), h2 AS (
  SELECT r, CAST(xor(k, k >> 33)::UHUGEINT * {sharding.MIX[0]}::UHUGEINT
                 % 18446744073709551616::UHUGEINT AS UBIGINT) AS k FROM h1
), h3 AS (
  SELECT r, CAST(xor(k, k >> 33)::UHUGEINT * {sharding.MIX[1]}::UHUGEINT
                 % 18446744073709551616::UHUGEINT AS UBIGINT) AS k FROM h2
), h4 AS (
  SELECT r, coalesce(xor(k, k >> 33), {sharding.NO_ID}::UBIGINT) AS k FROM h3
), j AS (
  SELECT r, n, k, CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS nxt
  FROM h4, (VALUES ({sharding.SHARDS}), ({sharding.SHARDS + 1})) AS s(n)
  UNION ALL
  SELECT r, n, k2, nxt, CAST(floor((nxt + 1) * (2147483648.0::DOUBLE
         / CAST((k2 >> 33) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, CAST((k::UHUGEINT * {sharding.JUMP}::UHUGEINT + 1::UHUGEINT)
                       % 18446744073709551616::UHUGEINT AS UBIGINT) AS k2 FROM j WHERE nxt < n)
), s AS (
  SELECT r, max(shard) FILTER (WHERE n = {sharding.SHARDS}) AS shard,
         max(shard) FILTER (WHERE n = {sharding.SHARDS + 1}) AS grown
  FROM j GROUP BY r
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(9), lambda c, b: CASE WHEN b = 0 THEN c WHEN c & 1 = 1
           THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) AS x(i))
), bytes AS (
  SELECT r, list_transform(regexp_extract_all(hex(encode(text)), '..'),
                           lambda h: CAST('0x' || h AS BIGINT)) AS b FROM d
), sums AS (
  SELECT r, len(b) + {sharding.OVERHEAD} AS size,
         xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]),
                                     4294967295)) AS text_crc32
  FROM bytes, crc
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32,
       '{sharding.LAW}' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       CAST(grown AS INTEGER) AS grown_shard
FROM d JOIN s USING (r) JOIN sums USING (r)
"""


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(table(spark, sf_dir, "embeddings"), Stage(spark))


def _round_sql(turn: int) -> str:
    """Assignment to the entries ``c{turn}`` and, before the last one, the entries that follow."""
    assigned = f"""a{turn} AS MATERIALIZED (
  SELECT r, p, arg_min(i, (c2 - 2 * list_inner_product(x, c), i)) AS i,
         min(x2 - 2 * list_inner_product(x, c) + c2) AS d
  FROM x JOIN c{turn} USING (p) GROUP BY r, p
)"""
    if turn == vector_codes.ROUNDS:
        return assigned
    return f"""{assigned}, m{turn} AS (
  SELECT p, i, list(floor(s / n) ORDER BY k) AS c FROM (
    SELECT p, i, k, sum(v) AS s, count(*) AS n
    FROM (SELECT p, i, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS k
          FROM x JOIN a{turn} USING (r, p)) GROUP BY p, i, k
  ) GROUP BY p, i
), c{turn + 1} AS MATERIALIZED (
  SELECT p, i, c, list_inner_product(c, c) AS c2
  FROM (SELECT p, i, coalesce(m.c, o.c) AS c FROM c{turn} AS o LEFT JOIN m{turn} AS m USING (p, i))
), {_round_sql(turn + 1)}"""


ORACLE_SQL["op12_vector_codes"] = f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT r, p, x, list_inner_product(x, x) AS x2 FROM (
    SELECT r, p, list_slice(e, p * len(e) // {vector_codes.PARTS} + 1,
                            (p + 1) * len(e) // {vector_codes.PARTS}) AS x
    FROM v, range({vector_codes.PARTS}) AS t(p))
), c0 AS MATERIALIZED (
  SELECT p, r - 1 AS i, x AS c, x2 AS c2 FROM x WHERE r <= {vector_codes.ENTRIES}
), {_round_sql(0)}, f AS (
  SELECT r, string_agg(lower(printf('%02x', i)), '' ORDER BY p) AS code,
         CAST(sum(d) AS BIGINT) AS error
  FROM a{vector_codes.ROUNDS} GROUP BY r
), h AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, i, k)) AS h
  FROM (SELECT p, i, unnest(c) AS y, unnest(range(1, len(c) + 1)) AS k
        FROM c{vector_codes.ROUNDS})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       h AS codebooks_sha256
FROM v JOIN f USING (r), h
"""


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(table(spark, sf_dir, "documents"), Stage(spark))
