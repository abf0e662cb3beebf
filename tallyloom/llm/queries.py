"""Queries over the dealt operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import byte_bpe, chat, chat_repair, divergence, exact_dedup, jaccard_join, licenses, lm_score, mixing, quality_rules, secrets, sharding, suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD_LIST = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_suffix_dedup")
def op1(spark, folder):
    return suffix_dedup.removal_digests(documents(spark, folder))


@query("op2_license_scan")
def op2(spark, folder):
    return licenses.detect(documents(spark, folder))


@query("op3_secret_scan")
def op3(spark, folder):
    return secrets.scan(documents(spark, folder))


@query(
    "op4_quality_rules",
    rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORD_LIST} AS words FROM documents),
lines AS (SELECT doc_id, source, md5(text) AS text_md5, unnest(string_split(text, chr(10))) AS raw FROM t),
worded AS (SELECT doc_id, source, text_md5, raw,
    trim(regexp_replace(lower(raw), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line FROM lines
    WHERE regexp_matches(raw, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM worded GROUP BY doc_id),
windows AS (SELECT doc_id, i, words[i:i + 7] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t)),
twice AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, sum(least(8, coalesce(next - i, 8))) AS n FROM twice GROUP BY doc_id),
common AS (SELECT source, line FROM (SELECT DISTINCT source, line, text_md5 FROM worded) GROUP BY source, line HAVING count(*) >= 50),
removed AS (SELECT doc_id, sum(len(string_split(w.line, ' '))) AS n FROM worded w
    JOIN common c ON w.line = c.line AND w.source IS NOT DISTINCT FROM c.source GROUP BY doc_id),
f AS (SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(m.n, 0) AS BIGINT) AS common_words
    FROM t LEFT JOIN dups USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN removed m USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT (n_words - common_words < 20 OR n_words - common_words < 0.3 * n_words) AS kept FROM f
""",
)
def op4(spark, folder):
    return quality_rules.judge(documents(spark, folder)).drop("text_hash")


@query("op5_jaccard_join")
def op5(spark, folder):
    return jaccard_join.near_duplicates(documents(spark, folder)).drop("text_hash")


@query(
    "op6_weighted_mix",
    rf"""
WITH t AS (SELECT doc_id, source, CAST(len({WORD_LIST}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) AS no FROM t GROUP BY source),
w AS (SELECT *, [5, 2, 1][(no - 1) % 3 + 1] AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w),
level AS (SELECT arg_min(level, (cap / w, no)) AS level FROM l WHERE CAST(cap AS DOUBLE) >= level * CAST(w AS DOUBLE)),
target AS (SELECT source, no, source_size, least(CAST(cap AS DOUBLE), level.level * CAST(w AS DOUBLE)) AS target FROM w, level),
q AS (SELECT doc_id, size, no, source_size, target, md5(concat('mix', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS place,
    CAST(sum(size) OVER (PARTITION BY no ORDER BY md5(concat('mix', coalesce(CAST(doc_id AS VARCHAR), 'null'))), doc_id
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM t JOIN target ON t.source IS NOT DISTINCT FROM target.source),
turns AS (SELECT *, CAST(r * source_size + upto AS DOUBLE) / target AS finish
    FROM q, (SELECT unnest([0, 1, 2]) AS r) WHERE size > 0 AND CAST(r * source_size + upto - size AS DOUBLE) < target),
spent AS (SELECT *, sum(size) OVER (ORDER BY finish, no, place, upto ROWS UNBOUNDED PRECEDING) AS spent FROM turns),
rounds AS (SELECT doc_id, count(*) AS copies FROM spent WHERE spent <= (SELECT sum(size) FROM t) GROUP BY doc_id)
SELECT q.doc_id, size, source_size, target, CAST(coalesce(copies, 0) * size AS BIGINT) AS taken
FROM q LEFT JOIN rounds USING (doc_id)
""",
)
def op6(spark, folder):
    return mixing.mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op7_exact_dedup",
    f"""
WITH t AS (SELECT doc_id, sha256({FOLDED}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""",
)
def op7(spark, folder):
    return exact_dedup.exact_groups(documents(spark, folder), hash_all=True).drop("text_hash")


@query("op8_lm_score")
def op8(spark, folder):
    return lm_score.score(documents(spark, folder))


# A conversation whose texts are control strings, beside those of the table.
CONTROL_TALK = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op9_chat_format")
def op9(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_TALK, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_trees(chat.linked_turns(turns.unionByName(extra))))


@query("op10_byte_bpe")
def op10(spark, folder):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(documents(spark, folder), path, public_tokenizers.PATTERN)


# CRC-32 of a blob, byte by byte: the table by its rule, then one look-up a byte.
CRC_TABLE = """SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM (SELECT unnest(range(256)) AS i))"""


def crc_sql(text: str, table: str) -> str:
    digits = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce({digits}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


@query(
    "op11_sharding",
    f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
    CAST({crc_sql("coalesce(text, '')", "crc.t")} AS BIGINT) AS text_crc32 FROM documents, crc),
v AS (SELECT *, CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', text_crc32)), 1, 8) AS BIGINT)
    % {sharding.SLOTS} AS vslot FROM d),
loads AS (SELECT vslot, sum(size) AS bytes, count(*) AS rows FROM v GROUP BY vslot),
known AS (SELECT s.vslot, s.vslot % {sharding.SHARDS} AS shard, CAST(coalesce(bytes, 0) AS BIGINT) AS bytes
    FROM (SELECT unnest(range({sharding.SLOTS})) AS vslot) s LEFT JOIN loads USING (vslot)),
judged AS (SELECT *, bytes = 0 OR row_number() OVER w = 1
    OR sum(bytes) OVER w <= ceil(sum(bytes) OVER () / {sharding.SHARDS}) AS keep FROM known
    WINDOW w AS (PARTITION BY shard ORDER BY bytes DESC, vslot ROWS UNBOUNDED PRECEDING)),
start AS (SELECT list(bytes ORDER BY shard) AS loads FROM (SELECT shard, CAST(sum(bytes) FILTER (keep) AS BIGINT) AS bytes FROM judged GROUP BY shard)),
freed AS (SELECT vslot, bytes, row_number() OVER (ORDER BY bytes DESC, vslot) AS n FROM judged WHERE NOT keep),
deal AS (SELECT CAST(0 AS BIGINT) AS n, loads, CAST(NULL AS BIGINT) AS vslot, CAST(NULL AS BIGINT) AS shard FROM start
    UNION ALL SELECT f.n, list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + bytes ELSE x END),
    f.vslot, CAST(list_position(loads, list_min(loads)) - 1 AS BIGINT) FROM deal JOIN freed f ON f.n = deal.n + 1),
edited AS (SELECT vslot, shard FROM judged WHERE keep UNION ALL SELECT vslot, shard FROM deal WHERE n > 0)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
    row_number() OVER (PARTITION BY shard ORDER BY vslot, doc_id, text_crc32, size) - 1 AS slot,
    CAST(NULL AS INTEGER) AS grown_shard, vslot, CAST(1 AS INTEGER) AS map_version FROM v JOIN edited USING (vslot)
""",
)
def op11(spark, folder):
    return sharding.shard_documents(documents(spark, folder))


@query(
    "op12_source_divergence",
    r"""
WITH t AS (SELECT row_number() OVER () AS d, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM t),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS HUGEINT) AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY lang, source),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM t) LEFT JOIN totals USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // (g.total + v) AS p
    FROM g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
q AS (SELECT k.lang, k.term, 1 + (1000000000 * CAST(n + 1 AS HUGEINT)) // (total + v) AS q FROM kept k JOIN langs l ON k.lang = l.lang),
found AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(value, 0) AS value
    FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN pairs x ON x.lang = g.lang AND x.source = g.source AND x.item = o.source
    UNION ALL SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // q FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found) WHERE part = 'pair' OR rank <= 200
""",
)
def op12(spark, folder):
    return divergence.divergence(documents(spark, folder))


def _inserted(inner: str) -> str:
    """Rows (conv_id, i, s, cost, audit, body) with none, one or two empty turns put in behind them."""
    return f"""SELECT conv_id, i, CASE m WHEN 0 THEN s WHEN 1 THEN t ELSE 5 - t END AS s, cost + 5 * m AS cost, audit || repeat('I', m) AS audit,
        body || CASE WHEN m > 0 THEN chr(10) || names[t - 1] || ':' ELSE '' END || CASE WHEN m > 1 THEN chr(10) || names[4 - t] || ':' ELSE '' END AS body
        FROM (SELECT *, CASE WHEN s = 2 THEN 3 ELSE 2 END AS t, unnest([0, 1, 2]) AS m, ['user', 'assistant'] AS names FROM {inner})"""


@query(
    "op13_chat_repair",
    rf"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS key FROM conversations),
k AS (SELECT c.*, {crc_sql("key", "crc.t")} % 20 AS kind FROM c, crc),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS step FROM o),
best AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {{'cost': 0, 'audit': '', 'body': ''}} AS b FROM (SELECT DISTINCT conv_id FROM f)
    UNION ALL SELECT conv_id, i, s, min(b) AS b FROM (
        SELECT p.conv_id, p.i + 1 AS i,
            CASE e WHEN 'D' THEN p.s WHEN 'R' THEN t WHEN 'K' THEN CASE WHEN left(role, 1) = 's' AND p.s = 0 THEN 1 WHEN left(role, 1) = names[t - 1][1] THEN t END END AS s,
            {{'cost': p.cost + CASE e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END,
              'audit': p.audit || e,
              'body': p.body || CASE e WHEN 'D' THEN '' WHEN 'R' THEN chr(10) || names[t - 1] || ':' || text ELSE chr(10) || role || ':' || text END}} AS b
        FROM (SELECT *, CASE WHEN s = 2 THEN 3 ELSE 2 END AS t, ['user', 'assistant'] AS names, unnest(['D', 'K', 'R']) AS e FROM (
            {_inserted("(SELECT conv_id, i, s, b.cost AS cost, b.audit AS audit, b.body AS body FROM best)")})) p
        JOIN f ON f.conv_id = p.conv_id AND f.i = p.i + 1 WHERE e = 'D' OR fault IN ('', 'truncated'))
    WHERE s IS NOT NULL GROUP BY conv_id, i, s),
n AS (SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
done AS (SELECT conv_id, min({{'cost': cost, 'audit': audit, 'body': body}}) AS b FROM (
    {_inserted("(SELECT best.conv_id, i, s, b.cost AS cost, b.audit AS audit, b.body AS body FROM best JOIN n USING (conv_id, i))")})
    WHERE s IN (0, 3) GROUP BY conv_id)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost, coalesce(b.audit, '') AS audit,
    sha256(coalesce(substr(b.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN n USING (conv_id) LEFT JOIN done USING (conv_id)
""",
)
def op13(spark, folder):
    return chat_repair.repair(spark.read.parquet(f"{folder}/conversations.parquet"))
