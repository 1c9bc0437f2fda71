"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import (
    chat, chat_repair, decontaminate, exact_dedup, fixity, html_text, jaccard_join, language_id, mixing, near_dedup, runs,
    sharding, token_counts,
)
from doclake.runtime import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op4_chat_formatting", r"""
WITH once AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (SELECT *, row_number() OVER w AS pos,
    string_agg(concat(length(role), ':', role, length(text), ':', text), '|') OVER w AS prefix
  FROM once WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
lasts AS (SELECT conv_id, max(pos) AS n_turns, arg_max(prefix, pos) AS whole FROM placed GROUP BY conv_id),
inner_prefixes AS (SELECT DISTINCT p.prefix FROM placed p JOIN lasts l USING (conv_id) WHERE p.pos < l.n_turns),
kept AS (SELECT min(conv_id) AS conv_id, max(n_turns) AS n_turns, count(*) AS n_copies FROM lasts
  WHERE NOT EXISTS (SELECT 1 FROM inner_prefixes i WHERE i.prefix = whole) GROUP BY whole)
SELECT k.conv_id, CAST((pos - 1) // 64 AS INTEGER) AS part, k.n_turns, k.n_copies,
  string_agg('<|im_start|>' || role || chr(10)
    || replace(replace(text, '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>') || '<|im_end|>' || chr(10),
    '' ORDER BY pos) AS text
FROM kept k JOIN placed p ON p.conv_id = k.conv_id GROUP BY ALL
""")
def op4_chat_formatting(spark, sf):
    return chat.format_chats(table(spark, sf, "conversations"))


@query("op10_token_counts")
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept,
  sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
""")
def op7_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


@query("op5_language_id")
def op5_language_id(spark, sf):
    return language_id.identify(table(spark, sf, "documents"))


@query("op2_decontamination", r"""
WITH words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
item_words AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark),
item_shingles AS (SELECT DISTINCT item_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s
  FROM item_words WHERE len(w) >= 5),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id),
doc_shingles AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s
  FROM words WHERE len(w) >= 5)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, CAST(count(*) AS DOUBLE) / n_shingles AS containment
FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
""")
def op2_decontamination(spark, sf):
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op9_near_dedup")
def op9_near_dedup(spark, sf):
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


@query("op1_sharding")
def op1_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents"), 16)


@query("op6_mixing")
def op6_mixing(spark, sf):
    return mixing.mix_weights(table(spark, sf, "documents"))


@query("op3_html_extraction")
def op3_html_extraction(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


@query("op11_jaccard_join", r"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+3], ' ') FOR i IN range(1, greatest(2, len(w) - 2))]) AS s
  FROM texts WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach AS (SELECT doc_id AS root, doc_id FROM texts UNION SELECT root, b FROM reach JOIN links ON a = doc_id)
SELECT t.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id
FROM texts t LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.doc_id = t.doc_id GROUP BY t.doc_id
""")
def op11_jaccard_join(spark, sf):
    return jaccard_join.jaccard_components(table(spark, sf, "documents"))


#: crc32 of a short ASCII text in SQL: the table by eight shifts a byte, then a step a byte.
_CRC = """crc_bits AS (
  SELECT 0 AS k, i AS b, CAST(i AS BIGINT) AS c FROM range(256) t(i)
  UNION ALL SELECT k + 1, b, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS crc FROM crc_bits WHERE k = 8)"""


def _crc(text: str) -> str:
    return (
        f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
        f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
        f"lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1])))"
    )


@query("op12_periodic_runs", rf"""
WITH RECURSIVE {_CRC},
texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
coded AS (SELECT *, len(w) AS n, {_crc("CAST(doc_id AS VARCHAR)")} AS h FROM texts, crc_table),
ruled AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM coded),
periods AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM ruled),
words AS (SELECT doc_id, n, CAST(i AS BIGINT) AS i, CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM periods)),
same AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b USING (doc_id, word)
  WHERE b.i > a.i AND 4 * (b.i - a.i) <= a.n),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretches r WHERE NOT EXISTS (SELECT 1 FROM stretches s WHERE s.doc_id = r.doc_id
  AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
best AS (SELECT doc_id, start, length, q FROM runs r QUALIFY row_number() OVER (PARTITION BY doc_id
  ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) = 1),
lines AS (SELECT doc_id, count(*) AS n_runs,
  sha256(string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q)) AS digest FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, CAST(1000 * length // q AS BIGINT) AS exponent_milli,
  coalesce(digest, sha256('')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN kept k USING (doc_id)
""")
def op12_periodic_runs(spark, sf):
    return runs.run_report(table(spark, sf, "documents"), prepare=runs.planted)


def _finish(state: int) -> str:
    """The best of deleting, keeping and changing one row in a state, without insertions before it."""
    to, fill = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[state]
    legal = {0: "WHEN 's' THEN s1 WHEN 'u' THEN s2", 1: "WHEN 'u' THEN s2", 2: "WHEN 'a' THEN s3", 3: "WHEN 'u' THEN s2"}[state]
    kept = f"CASE left(role, 1) {legal} END"
    return (
        f"list_min([{{c: s{state}.c + 3, a: 'D' || s{state}.a, t: s{state}.t}}, CASE WHEN NOT forced AND {kept} IS NOT NULL THEN "
        f"{{c: ({kept}).c + late, a: 'K' || ({kept}).a, t: list_prepend(role || ':' || text, ({kept}).t)}} END, "
        f"CASE WHEN NOT forced THEN {{c: s{to}.c + 2 + late, a: 'R' || s{to}.a, t: list_prepend('{fill}:' || text, s{to}.t)}} END])"
    )


def _insert(option: str, *fills: str) -> str:
    lines = ", ".join(f"'{f}:'" for f in fills)
    return f"{{c: {option}.c + {2 * len(fills)}, a: '{'I' * len(fills)}' || {option}.a, t: list_concat([{lines}], {option}.t)}}"


_SOLID = r"[^\x20\x09-\x0D]"


@query("op13_chat_repair", rf"""
WITH RECURSIVE {_CRC},
hurt AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS harm
  FROM conversations, crc_table),
rows_left AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM hurt WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n FROM rows_left),
faulty AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{_SOLID}') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY pos), 1) || left(role, 1) AS pair FROM placed),
coded AS (SELECT conv_id, pos, n, role, text, coalesce(fault IN ('blank', 'duplicate'), false) AS forced,
    CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late FROM faulty),
solved AS (
  SELECT DISTINCT conv_id, n + 1 AS pos, {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS s0,
    {{c: 4, a: 'II', t: ['user:', 'assistant:']}} AS s1, {{c: 2, a: 'I', t: ['assistant:']}} AS s2,
    {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS s3 FROM coded
  UNION ALL
  SELECT conv_id, pos, list_min([e0, {_insert("e2", "user")}, {_insert("e3", "user", "assistant")}]),
    list_min([e1, {_insert("e2", "user")}, {_insert("e3", "user", "assistant")}]),
    list_min([e2, {_insert("e3", "assistant")}]), list_min([e3, {_insert("e2", "user")}])
  FROM (SELECT s.conv_id, r.pos, {_finish(0)} AS e0, {_finish(1)} AS e1, {_finish(2)} AS e2, {_finish(3)} AS e3
    FROM solved s JOIN coded r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.pos = s.pos - 1)),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost,
  coalesce(s0.a, '') AS audit, sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
FROM every e LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND s.pos = 1
""")
def op13_chat_repair(spark, sf):
    return chat_repair.repair_report(table(spark, sf, "conversations"))


_RECORD = """'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:page:' || page_id || '>' || nl ||
  'WARC-Target-URI: ' || url || nl || 'Content-Type: text/html' || nl || 'Content-Length: ' || strlen(html) || nl || nl ||
  html || nl || nl"""


@query("op8_warc_fixity", f"""
WITH lines AS (SELECT *, chr(13) || chr(10) AS nl FROM pages),
good AS (SELECT page_id, url, {_RECORD} AS r FROM lines),
bad AS (SELECT page_id, url, CASE page_id % 101 WHEN 7 THEN replace(r, '<article>', '<article >')
  WHEN 8 THEN left(r, length(r) // 2) WHEN 9 THEN NULL ELSE r END AS r FROM good),
placed AS (SELECT *, CAST(sum(strlen(r)) OVER (ORDER BY page_id, url, sha256(r)) - strlen(r) AS BIGINT) AS pos FROM good)
SELECT pos // 8388608 AS file, pos % 8388608 AS "offset", page_id,
  CASE WHEN b.r IS NULL THEN 'missing' ELSE 'changed' END AS status,
  strlen(p.r) AS length_a, strlen(b.r) AS length_b, sha256(p.r) AS digest_a, sha256(b.r) AS digest_b
FROM placed p JOIN bad b USING (page_id, url) WHERE p.r IS DISTINCT FROM b.r
""")
def op8_warc_fixity(spark, sf):
    """All pages as WARC records, against a replica that lost some of them and holds others changed or cut short."""
    pages = table(spark, sf, "pages")
    whole = fixity.warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    harm = F.col("page_id") % 101
    harmed = (
        F.when(harm == 7, F.replace(whole, F.lit("<article>"), F.lit("<article >")))
        .when(harm == 8, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
        .when(harm == 9, F.lit(None)).otherwise(whole)
    )
    found = {"length_2": F.octet_length(harmed).cast("long"), "digest_2": F.sha2(harmed.cast("binary"), 256)}
    records = stored(fixity.warc_records(pages, file_bytes=8 << 20, more=found), "warc")
    replica = records.filter("digest_2 IS NOT NULL").select(
        "page_id", "file", "offset", F.col("length_2").alias("length"), F.col("digest_2").alias("digest")
    )
    return fixity.audit(records.drop("length_2", "digest_2"), replica)
