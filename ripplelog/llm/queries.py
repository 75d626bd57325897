"""The queries op1_ to op13_ and their SQL: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplelog.llm.byte_bpe import Vocabulary, decode, encode
from ripplelog.llm.conversations import repair_damaged
from ripplelog.llm.divergence import divergences
from ripplelog.llm.language_id import identify_language
from ripplelog.llm.line_dedup import drop_repeated_lines
from ripplelog.llm.lm_scoring import score_texts
from ripplelog.llm.mixing import taken_words
from ripplelog.llm.nearest import nearest
from ripplelog.llm.ngram_join import jaccard_components
from ripplelog.llm.quality import judge
from ripplelog.llm.secrets import scan
from ripplelog.llm.substring_dedup import drop_repeated_strings
from ripplelog.llm.url_filter import ALLOW, BLOCK, Rule, filter_urls

SPACE_CLASS = r"[\x20\x09-\x0D]"
A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda vec_id: vec_id % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / (q.norm * c.norm) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, trained=crc() % 10 != 0, held_out=crc() % 10 == 0, deleted=crc() % 10 == 1)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


OP3_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^{SPACE_CLASS}+', ''), '{SPACE_CLASS}+$', ''), {A_Z}) AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT keyed.*, shared.last IS NOT NULL AND keyed.doc_id <> shared.last AS lost FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN)
    return decode(encoded.select("doc_id", "ids"), vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def crc(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(crc() % 3 == 1, F.lit(False)))
    return identify_language(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"), n=4, percent=85)


OP7_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS grams FROM w
), sized AS (
  SELECT doc_id, len(grams) AS n FROM s
), e AS (
  SELECT doc_id, unnest(grams) AS g FROM s
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), both_ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT both_ways.b, reached.other FROM reached JOIN both_ways ON both_ways.a = reached.doc_id
)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id FROM sized JOIN reached USING (doc_id) GROUP BY doc_id
"""


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def line(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = line(F.filter("spans", lambda x: x["kind"] != "tagged"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken_words(docs).select(F.col("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = drop_repeated_strings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(read(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, {A_Z}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), here AS (
  SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN kept ON kept.lang = w.lang AND kept.term = w.term GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, lang_n FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN here ON here.lang = g.lang AND here.source = g.source AND here.term = kept.term
), sized AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS terms FROM dense
), p AS (
  SELECT *, CAST(1 + (1000000000 * CAST(n + 2 AS HUGEINT)) // (total + 2 * terms) AS BIGINT) AS p,
         CAST(1 + (1000000000 * CAST(lang_n + 2 AS HUGEINT)) // (lang_total + 2 * terms) AS BIGINT) AS q FROM sized
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, (
    SELECT coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) FROM p x JOIN p y ON x.term = y.term WHERE x.lang = a.lang AND y.lang = a.lang AND x.source = a.source AND y.source = b.source
  ) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read(spark, sf_dir, "conversations"))


def _way(before: str, edit: str, cost: str, add: str, where: str = "true") -> str:
    """A step of OP12_SQL: the best way so far, {cost, audit, output}, with an edit more; null if there is none."""
    return f"CASE WHEN {before}.c IS NOT NULL AND {where} THEN {{'c': CAST({before}.c + {cost} AS INTEGER), 'a': {before}.a || '{edit}', 'o': list_concat({before}.o, {add})}} END"


def _steps(state: str, made: str | None, initial: str, sources: tuple[str, ...]) -> str:
    kept = [_way(x, "K", "more", "[role || ':' || text]", f"fine AND initial = '{initial}'") for x in sources]
    given = [_way(x, "R", "2 + more", f"['{made}:' || text]", "fine") for x in sources if made]
    return f"list_min([{', '.join([_way(state, 'D', '3', '[]'), *kept, *given])}])"


#: crc32 of an ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split({}, ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce(range(8), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(3988292384, y >> 1) ELSE y >> 1 END, xor(c, b)), 4294967295), 4294967295)"""
#: Best ways after each row: n with nothing yet, s behind the system, u behind the user, a behind the assistant.
OP12_SQL = rf"""
WITH RECURSIVE damaged AS (
  SELECT conv_id, turn, CASE part WHEN 4 THEN 'user' ELSE role END AS role,
         CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE part WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS part FROM conversations
  ) WHERE part <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN seen > 1 THEN 'd'
         WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE '' END AS fault FROM placed
), faults AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS walked, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS n, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, o VARCHAR[])) AS s,
         {{'c': 2, 'a': 'I', 'o': ['user:']}} AS u, {{'c': 4, 'a': 'II', 'o': ['user:', 'assistant:']}} AS a FROM faults
  UNION ALL
  SELECT conv_id, walked, n, s, list_min([u, {_way("n", "I", "2", "['user:']")}, {_way("s", "I", "2", "['user:']")}, {_way("a", "I", "2", "['user:']")}]) AS u,
         list_min([a, {_way("u", "I", "2", "['assistant:']")}, {_way("n", "II", "4", "['user:', 'assistant:']")}, {_way("s", "II", "4", "['user:', 'assistant:']")}]) AS a
  FROM (
    SELECT conv_id, i AS walked, {_way("n", "D", "3", "[]")} AS n, {_steps("s", None, "s", ("n",))} AS s, {_steps("u", "user", "u", ("n", "s", "a"))} AS u, {_steps("a", "assistant", "a", ("u",))} AS a
    FROM (SELECT w.*, i, role, text, initial, fault NOT IN ('b', 'd') AS fine, CAST(fault = 't' AS INTEGER) AS more FROM walk w JOIN judged ON judged.conv_id IS NOT DISTINCT FROM w.conv_id AND i = walked + 1) x
  ) y
), ended AS (
  SELECT f.*, list_min([w.n, w.a]) AS best FROM faults f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.walked = f.n
), named AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT named.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM named LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM named.conv_id
"""


#: The rules of op13's query.
OP13_RULES = (Rule(BLOCK, "net/"), Rule(ALLOW, "example.net/en/"), Rule(BLOCK, "example.com/de/"), Rule(ALLOW, "org/fr/"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), OP13_RULES)


QUERIES = {"op1_nearest": op1_nearest, "op2_lm_scoring": op2_lm_scoring, "op3_line_dedup": op3_line_dedup, "op4_byte_bpe": op4_byte_bpe, "op5_quality": op5_quality, "op6_language_id": op6_language_id, "op7_ngram_join": op7_ngram_join, "op8_secrets": op8_secrets, "op9_mixing": op9_mixing, "op10_substring_dedup": op10_substring_dedup, "op11_divergence": op11_divergence, "op12_conversations": op12_conversations, "op13_url_filter": op13_url_filter}
ORACLE_SQL = {"op1_nearest": OP1_SQL, "op3_line_dedup": OP3_SQL, "op7_ngram_join": OP7_SQL, "op11_divergence": OP11_SQL, "op12_conversations": OP12_SQL}
