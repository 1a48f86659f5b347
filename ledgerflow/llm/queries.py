"""Registered queries of this subpackage and their DuckDB statements.

Each ``opN`` query applies its operator with production parameters to the
whole of its table and derives the contract's columns from the real output.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (chat_format, content_sort, crf_quality, decontam, lang_zstd, line_dedup, minhash, piece_codec, token_align,
                            turn_repair, warc_store, wavelet, wrappers)
from ledgerflow.llm.common import crc_mod, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = crc_mod(F.col("doc_id"), 3) != 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = crf_quality.fit(docs, table(spark, sf_dir, "labels").filter(learn))
    return crf_quality.score_column(docs, field).select(
        "doc_id", (~learn).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = piece_codec.encode_column(docs, model).drop("text")
    return piece_codec.digest(piece_codec.decode_column(ids, model))


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.content_groups(table(spark, sf_dir, "documents"), keep="largest")


ORACLE["op3_exact_dedup"] = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = lang_zstd.fit(docs.filter(~held_out))
    got = lang_zstd.predict(docs, model)
    return got.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score",
                      "margin", "accepted")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
ORACLE["op5_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, k, w[i:i + k - 1] AS gram
      FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
            FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, k, x.pos AS pos, x.gram AS gram FROM (
        SELECT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
                                                lambda i: struct_pack(pos := i, gram := w[i:i + k - 1]))) AS x
        FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
h AS (SELECT doc_id, pos, k, item_id FROM p JOIN g USING (k, gram)),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit
      FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS x FROM (SELECT DISTINCT doc_id, pos, k FROM h)) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""


#: A conversation whose texts hold control strings.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    by_turn = chat_format.canonical_turns(rows.select("conv_id", "turn", F.struct("role", "text").alias("record")))
    message = json.dumps({"messages": [{"role": r, "content": CONTROL_TEXT} for r in ("user", "assistant")]})
    extra = spark.range(1).select(F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"), F.lit(0).alias("turn"),
                                  F.lit(message).alias("record"))
    turns = by_turn.unionByName(chat_format.canonical_turns(extra))
    formatted = stored(chat_format.format_chats(turns), "chats")
    return chat_format.digest(chat_format.read_back(formatted))


def _op6_sql() -> str:
    t = chat_format.Template()

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def size(column: str, role: bool) -> str:
        for sign, code in t.codes.items():
            if role or sign != t.after_role:
                column = f"replace({column}, {quoted(sign)}, {quoted(code)})"
        return f"length({column})"

    marks = len(t.open + t.after_role + t.close)
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT {CONTROL_CONVERSATION}, 0, 'user', {quoted(CONTROL_TEXT)}
           UNION ALL SELECT {CONTROL_CONVERSATION}, 1, 'assistant', {quoted(CONTROL_TEXT)}),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             CAST(sum({marks} + {size('role', True)} + {size('text', False)}) AS BIGINT) AS formatted_chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g
"""


ORACLE["op6_chat_format"] = _op6_sql()


@query
def op4_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return wavelet.read_documents(spark, wavelet.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


ORACLE["op8_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
o AS (SELECT doc_id, pos, list_distinct(list_filter(regexp_split_to_array(lower(lines[pos + 1]), '[ \t\x0B\f\r]+'),
                                                    lambda w: w <> '')) AS s
      FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS pos FROM d)),
c AS (SELECT row_number() OVER (ORDER BY min((doc_id, pos))) AS c, list_sort(s) AS s, len(s) AS n, min((doc_id, pos)) AS first
      FROM o WHERE len(s) > 0 GROUP BY 2, 3),
w AS (SELECT c, n, unnest(s) AS word FROM c),
f AS (SELECT word, count(*) AS df FROM w GROUP BY word),
r AS (SELECT c, n, word, row_number() OVER (PARTITION BY c ORDER BY df, word) AS k FROM w JOIN f USING (word)),
p AS (SELECT c, n, word FROM r WHERE k <= n - CAST(ceil(n * 0.8) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT x.c AS x, y.c AS y FROM p x JOIN p y USING (word)
          WHERE y.c < x.c AND 100 * x.n >= 80 * y.n AND 100 * y.n >= 80 * x.n),
gone AS (SELECT DISTINCT x FROM (SELECT pairs.x, len(list_intersect(a.s, b.s)) AS i, a.n AS n, b.n AS m
                                 FROM pairs JOIN c a ON a.c = pairs.x JOIN c b ON b.c = pairs.y)
         WHERE 100 * i >= 80 * (n + m - i)),
k AS (SELECT first[1] AS doc_id, count(*) AS n, string_agg(CAST(first[2] AS VARCHAR), ',' ORDER BY first[2]) AS kept_lines
      FROM c WHERE c NOT IN (SELECT x FROM gone) GROUP BY 1),
e AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (len(s) > 0) AS n_worded FROM o GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines - n_worded + coalesce(n, 0), 0) AS n_kept,
       coalesce(n_worded - coalesce(n, 0), 0) AS n_removed, coalesce(kept_lines, '') AS kept_lines
FROM d LEFT JOIN e USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.listing(spark, warc_store.archive_pages(table(spark, sf_dir, "pages")))


ORACLE["op12_warc_store"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest, strlen(h) >= 1000 AND page_id <> max(page_id) OVER (PARTITION BY h) AS again,
             max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN last END AS refers_to
FROM w
"""


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.damaged(chats), chats)


def _op13_sql() -> str:
    """Forward DP over rows: for each role last said (0 none, 1 system, 2 user, 3 assistant) the least
    (cost, audit, repaired rows) so far."""
    def grown(x: str, cost, edit: str, line: str | None) -> str:
        out = f"list_append({x}.o, {line})" if line else f"{x}.o"
        return f"CASE WHEN {x} IS NOT NULL THEN struct_pack(c := {x}.c + {cost}, a := {x}.a || '{edit}', o := {out}) END"

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def may(condition: str, option: str) -> str:
        return f"CASE WHEN {condition} THEN {option} END"

    def keep(x: str, initial: str) -> str:
        return may(f"fault NOT IN (1, 2) AND initial = '{initial}'", grown(x, "CASE WHEN fault = 3 THEN 5 ELSE 0 END", "K", "role || ':' || text"))

    def rerole(x: str, role: str) -> str:
        return may("fault NOT IN (1, 2)", grown(x, "CASE WHEN fault = 3 THEN 6 ELSE 1 END", "R", f"'{role}:' || text"))

    def speaks(x: str, role: str) -> tuple[str, str]:
        return keep(x, role[0]), rerole(x, role)

    user = least("x2", *(grown(x, 5, "I", "'user:'") for x in ("x0", "x1", "x3")))
    rows = {"x0": grown("x0", 2, "D", None), "x1": least(grown("x1", 2, "D", None), keep("x0", "s")),
            "x2": least(grown("y2", 2, "D", None), *speaks("x0", "user"), *speaks("x1", "user"), *speaks("y3", "user")),
            "x3": least(grown("y3", 2, "D", None), *speaks("y2", "assistant"))}
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)), "
           "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
           "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    return rf"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS fate
  FROM (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations)),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM k, (SELECT unnest([1, 2]) AS n) WHERE fate <> 0 AND (n = 1 OR fate = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM d),
f AS (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial,
             coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1), 'ua') AS met,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM o),
r AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, struct_pack(c := CAST(0 AS BIGINT), a := '', o := CAST([] AS VARCHAR[])) AS x0,
             CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS x1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS x2,
             CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])) AS x3 FROM conversations
      UNION ALL
      SELECT conv_id, n + 1, {', '.join(f'{v} AS {k}' for k, v in rows.items())}
      FROM (SELECT *, {least("x3", grown("y2", 5, "I", "'assistant:'"))} AS y3
            FROM (SELECT r.*, f.role, f.text, f.initial, f.fault, {user} AS y2
                  FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.n + 1))),
g AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank, max(i) AS rows,
             count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
             count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
e AS (SELECT r.conv_id, gaps, blank, duplicate, truncated, illegal, x0, {grown("x2", 5, "I", "'assistant:'")} AS x2, x3,
             {grown("x1", 10, "II", "'user:'")} AS x1
      FROM r LEFT JOIN g ON r.conv_id IS NOT DISTINCT FROM g.conv_id WHERE r.n = coalesce(g.rows, 0)),
b AS (SELECT *, list_min([x0, x2, x3, CASE WHEN x1 IS NOT NULL THEN struct_pack(c := x1.c, a := x1.a, o := list_append(x1.o, 'assistant:')) END]) AS x FROM e)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, x.c AS cost, x.a AS audit, sha256(coalesce(array_to_string(x.o, chr(10)), '')) AS repaired_sha256
FROM b
"""


ORACLE["op13_turn_repair"] = _op13_sql()
