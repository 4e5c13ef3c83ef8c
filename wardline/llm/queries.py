"""One thin query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, exact_dedup, grid_join, licenses, mixing, negatives, pieces, quality, simhash, spelling, substring_dedup, tool_chat, url_rules
from wardline.llm.common import read

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# Host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of a third of the ids are held out."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    out = quality.classify(docs, labels)
    predicted = (F.col("score") >= 0.5).cast("int")
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links at 4 or fewer differing bits."""
    out = simhash.simhash_groups(read(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


TOOLS = {"reply": {"properties": {"prompt": {"type": "string", "minLength": 1}}, "required": ["prompt"], "additionalProperties": False}}


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as linked calls and results.

    The table has no tool calls of its own, so each user turn is stated as a
    call of the tool ``reply`` with its text as the argument, and each
    assistant turn as the result of the call one turn before.
    """
    chats = read(spark, sf_dir, "conversations")
    call = F.struct(F.col("turn").cast("string").alias("id"), F.lit("reply").alias("name"), F.struct(F.col("text").alias("prompt")).alias("arguments"))
    asked = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    answer = F.to_json(F.struct((F.col("turn") - 1).cast("string").alias("tool_call_id"), F.col("text").alias("content")))
    stated = chats.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", asked).when(F.col("role") == "assistant", answer).otherwise(F.col("text")).alias("text"),
    )
    out = tool_chat.format_chats(stated, TOOLS)
    return out.select(F.col("conv").alias("conv_id"), "turn", "kind", "call_id", "status", "error", "position", "json")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page; the longest of five rules decides, else allow."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.apply_rules(read(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by a mix of 150% of all words, sources weighing 5, 2, 1 in turn."""
    return mixing.mixed_words(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector: cosine of at least 0.93 within a label."""
    out = grid_join.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)
    return out.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.expr("id = component").alias("kept")
    )


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again with the multi-language ranks."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences, rules and licences of every document."""
    out = licenses.scan(read(spark, sf_dir, "documents"))
    line = lambda c: F.array_join(c, ",").alias(c)
    return out.select(F.col("id").alias("doc_id"), line("sentences"), line("rules"), line("licences"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document by its text after A-Z lower-casing; the largest doc_id stays."""
    out = exact_dedup.exact_groups(read(spark, sf_dir, "documents"), keep="largest")
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without the 50-byte strings that start in a document with a smaller doc_id."""
    out = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded with an end id and decoded again with the 32k piece model."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trip(read(spark, sf_dir, "documents"), model).withColumnRenamed("id", "doc_id")


def _one_lost(run: Column) -> Column:
    """A run without one code point, for every 31st pair of document and run, told by a checksum."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven and more letters with the more frequent spellings that they lead to."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(spelling.count_words(docs, change=_one_lost), ratio=10)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector: five positives each, five negatives of 80 to 100 percent of each one's score."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_simhash_near_dedup,
        op3_chat_format,
        op4_url_filter,
        op5_source_mixing,
        op6_embedding_near_dedup,
        op7_bpe_round_trip,
        op8_license_scan,
        op9_exact_dedup,
        op10_substring_dedup,
        op11_piece_round_trip,
        op12_spelling_variants,
        op13_hard_negatives,
    )
}


def _licence_sql() -> str:
    """Known sentences found one by one, rules by comparing places, not by a pattern over the identifier line."""
    known = ", ".join(f"('{name}', '{s}')" for name, s in licenses.SENTENCES.items())
    steps = ", ".join(f"('{rule}', '{lic}', {i}, '{s}')" for rule, lic, parts in licenses.RULES for i, s in enumerate(parts))
    most = max(len(parts) for _, _, parts in licenses.RULES)
    return rf"""
        WITH RECURSIVE known(name, sentence) AS (VALUES {known}),
        step(rule, licence, i, name) AS (VALUES {steps}),
        cut AS (
            SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS s
            FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?:;]+(?:\s+|$)|[\r\n]+') AS a FROM documents WHERE text ILIKE '%licen%'
                  OR text ILIKE '%copyright%' OR text ILIKE '%redistribut%' OR text ILIKE '%warrant%')),
        hit AS (
            SELECT doc_id, pos, name FROM cut JOIN known ON sentence = trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))),
        walk(doc_id, rule, licence, i, pos) AS (
            SELECT doc_id, rule, licence, 0, min(pos) FROM hit JOIN step USING (name) WHERE i = 0 GROUP BY ALL
            UNION ALL
            SELECT w.doc_id, w.rule, w.licence, w.i + 1,
                   (SELECT min(h.pos) FROM hit h WHERE h.doc_id = w.doc_id AND h.pos > w.pos AND h.name = s.name) AS nxt
            FROM walk w JOIN step s ON s.rule = w.rule AND s.i = w.i + 1
            WHERE w.pos IS NOT NULL AND w.i < {most}),
        done AS (
            SELECT w.doc_id, w.rule, w.licence FROM walk w
            WHERE w.pos IS NOT NULL AND w.i = (SELECT max(i) FROM step s WHERE s.rule = w.rule)),
        r AS (SELECT doc_id, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules,
                     string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM done GROUP BY doc_id),
        q AS (SELECT doc_id, string_agg(name, ',' ORDER BY pos) AS sentences FROM hit GROUP BY doc_id)
        SELECT d.doc_id, coalesce(q.sentences, '') AS sentences, coalesce(r.rules, '') AS rules, coalesce(r.licences, '') AS licences
        FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id"""


ORACLE_SQL = {
    # turns are distinct within a conversation here, so a call's place is its turn's
    "op3_chat_format": """
        WITH c AS (SELECT *, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
                          CASE role WHEN 'user' THEN turn WHEN 'assistant' THEN turn - 1 END::VARCHAR AS call_id FROM conversations),
        s AS (SELECT *, CASE
                 WHEN kind = 'call' AND EXISTS (SELECT 1 FROM c r WHERE r.conv_id = c.conv_id AND r.kind = 'result' AND r.call_id = c.call_id) THEN 'answered'
                 WHEN kind = 'call' THEN 'open'
                 WHEN kind = 'result' AND EXISTS (SELECT 1 FROM c r WHERE r.conv_id = c.conv_id AND r.kind = 'call' AND r.call_id = c.call_id) THEN 'linked'
                 WHEN kind = 'result' THEN 'orphan' ELSE 'plain' END AS status,
                 CASE WHEN kind = 'call' AND text = '' THEN '$.prompt: too short'
                      WHEN kind = 'call' AND text IS NULL THEN '$.prompt: missing' END AS error FROM c)
        SELECT conv_id, turn, kind, call_id, status, error,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
               CASE kind
                 WHEN 'call' THEN '{"arguments":{"prompt":' || to_json(text) || '},"error":' || coalesce(to_json(error), 'null')
                      || ',"id":"' || call_id || '","kind":"call","name":"reply","role":"assistant","status":"' || status || '"}'
                 WHEN 'result' THEN '{"content":' || to_json(text) || ',"id":"' || call_id || '","kind":"result","role":"tool","status":"' || status || '"}'
                 ELSE '{"kind":"message","role":' || to_json(role) || ',"status":"plain","text":' || to_json(text) || '}' END AS json
        FROM s""",
    "op4_url_filter": """
        WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
        SELECT page_id, any_value(host) AS host, any_value(path) AS path,
               max_by(h || p, length(h || p)) AS rule, coalesce(max_by(v, length(h || p)), 'allow') AS verdict
        FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        GROUP BY page_id""",
    "op8_license_scan": _licence_sql(),
    # the taken words in closed form: a document's stretch of its source's line, twice, below the quota; slots by mirrored bits
    "op5_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('17|' || doc_id) AS h FROM documents),
        s AS (
            SELECT source, sum(size) AS source_size,
                   [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w
            FROM d GROUP BY source),
        r AS (
            SELECT *, 2.0 * source_size::DOUBLE AS cap, 1.5 * (sum(source_size) OVER ())::DOUBLE AS goal,
                   row_number() OVER (ORDER BY 2.0 * source_size::DOUBLE / w, source) AS k FROM s),
        c AS (
            SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM r),
        l AS (SELECT min_by((goal - before) / weight_left, k) AS level FROM c WHERE cap >= w * ((goal - before) / weight_left)),
        t AS (SELECT source, source_size, least(cap, w * level) AS target FROM c, l),
        p AS (
            SELECT d.doc_id, d.source, d.size, t.source_size::BIGINT AS source_size, t.target, floor(t.target)::BIGINT AS quota,
                   (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size, d.doc_id) - d.size)::BIGINT AS a
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        b AS (SELECT source, ceil(floor(target) / 1024.0)::BIGINT AS blocks, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM t),
        e AS (SELECT *, sum(blocks) OVER (ORDER BY k) AS stop, (sum(blocks) OVER ())::BIGINT AS total FROM b),
        w AS (SELECT any_value(total) AS total, greatest(1, length(ltrim(bin(greatest(any_value(total), 1) - 1), '0'))) AS bits FROM e),
        i AS (SELECT slot, sum(((slot >> j) & 1) << (bits - 1 - j)) AS point FROM w, range(1::BIGINT << bits) AS r(slot), range(bits) AS m(j) GROUP BY slot),
        o AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS nth FROM i JOIN e ON point >= stop - blocks AND point < stop)
        SELECT doc_id, size, source_size, target,
               (greatest(least(a + size, quota) - a, 0) + greatest(least(a + source_size + size, quota) - a - source_size, 0))::BIGINT AS taken, o.slot AS first_slot
        FROM p LEFT JOIN o ON o.source IS NOT DISTINCT FROM p.source AND o.nth = a // 1024 AND size > 0 AND a < quota""",
    "op9_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {LOWER} AS txt FROM documents),
        g AS (SELECT txt, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY txt)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.txt) AS text_sha256
        FROM t JOIN g ON t.txt = g.txt""",
}
