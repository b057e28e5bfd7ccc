"""Registered queries of the corpus operators and their DuckDB SQL.

Each query reads its whole tables and calls its operator with production
parameters; the contract's digest columns are derived from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwise.llm import decontaminate as DC
from ledgerwise.llm import importance as IM
from ledgerwise.llm import line_dedup as LD
from ledgerwise.llm import lm_scoring as LM
from ledgerwise.llm import mixing as MX
from ledgerwise.llm import quality_lines as QL
from ledgerwise.llm import simhash_neardup as SH
from ledgerwise.llm import substring_dedup as SD
from ledgerwise.llm import token_alignment as TA
from ledgerwise.llm import token_counts as TC
from ledgerwise.llm import toxicity as TX
from ledgerwise.llm import url_lists as UL
from ledgerwise.llm import warc as WA

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = SD.substring_dedup(_table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return UL.judge(UL.page_captures(pages), UL.host_events(pages))


def op3_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return QL.quality_rules(docs, QL.train(docs, _table(spark, sf_dir, "labels")))


def op4_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = SH.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", SH.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WA.derivatives(WA.page_responses(_table(spark, sf_dir, "pages")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return TX.score(docs, TX.train(docs, _table(spark, sf_dir, "labels")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = TC.token_counts(_table(spark, sf_dir, "documents"), TOKENIZER)
    return n.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return MX.poisson_mix(docs, MX.square_root_weights(docs.select("source")), seed=11)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), min_similarity=0.8)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = LD.drop_repeated_lines(docs, min_chars=40, min_docs=5)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = IM.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), shortest=1, longest=1,
                        buckets=10_000, min_words=20, percent=10, seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LM.score(_table(spark, sf_dir, "documents"), folds=10)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TA.align(_table(spark, sf_dir, "documents"), *ALIGNED)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_lists": op2_url_lists,
    "op3_quality_lines": op3_quality_lines,
    "op4_simhash_neardup": op4_simhash_neardup,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_poisson_mix": op8_poisson_mix,
    "op9_decontaminate": op9_decontaminate,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resample": op11_importance_resample,
    "op12_lm_scores": op12_lm_scores,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_LOWER_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[^\x20\x09-\x0D]+')")

_IMPORTANCE_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                     f"'{IM.WORD_PATTERN}')")


def _sql_text(html: str) -> str:
    """``warc.plain_text`` with the same fixed patterns."""
    def steps(out: str, pairs) -> str:
        for pattern, to in pairs:
            out = f"regexp_replace({out}, '{pattern}', {'chr(10)' if to == chr(10) else repr(to)}, 'g')"
        return out

    out = steps(html, WA.TEXT_STEPS)
    for entity, char in WA.ENTITIES:
        out = f"replace({out}, '{entity}', chr({ord(char)}))"
    number = "(CASE WHEN e[3] IN ('x', 'X') THEN ('0x' || e[4:-2])::BIGINT ELSE e[3:-2]::BIGINT END)"
    char = f"CASE WHEN {number} = 38 THEN chr(1) ELSE chr((CASE WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN {number} ELSE 65533 END)::INT) END"
    out = (f"list_reduce(list_prepend({out}, list_distinct(regexp_extract_all(html, '{WA.NUMERIC}'))), "
           f"lambda t, e: replace(t, e, {char}))")
    out = f"replace({out}, chr(1), '&')"
    return f"trim({steps(out, WA.SPACE_STEPS)}, chr(32) || chr(10))"


def _sql_urn(text: str) -> str:
    cuts = " || '-' || ".join(f"substr(md5({text}), {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'<urn:uuid:' || {cuts} || '>'"


_CRLF = "chr(13) || chr(10)"
_HOST = ("regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1), "
         "'\\.$', ''), '^www\\.', '')")
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"


def _hex(i: int) -> str:
    return f"('0x' || substr(md5(pattern), {i}, 2))::INT"


ORACLE = {
    "op2_url_lists": f"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + ((page_id * 37) % 731)::INT AS fetched_on,
                  {_HOST} AS host, [x FOR x IN string_split({_PATH}, '/') IF x <> ''] AS parts FROM pages),
hosts AS (SELECT DISTINCT host AS pattern FROM p WHERE host <> '' AND {_hex(1).replace('pattern', 'host')} < 128),
langs AS (SELECT DISTINCT pattern FROM (
            SELECT host || '/' || regexp_extract({_PATH}, '^/([a-z]+)', 1) AS pattern FROM p
            WHERE host <> '' AND regexp_extract({_PATH}, '^/([a-z]+)', 1) <> '') WHERE {_hex(1)} < 32),
events AS (
  SELECT 'domain' AS kind, 'block' AS verb, pattern, {_hex(5)} AS day, 'add' AS action FROM hosts
  UNION ALL SELECT 'domain', 'block', pattern, {_hex(5)} + {_hex(7)}, 'remove' FROM hosts WHERE {_hex(9)} < 192
  UNION ALL SELECT 'domain', 'block', pattern, {_hex(5)} + {_hex(7)} + 60, 'add' FROM hosts WHERE {_hex(9)} < 96
  UNION ALL SELECT 'prefix', 'allow', pattern, {_hex(5)}, 'add' FROM langs),
days AS (SELECT kind, verb, pattern, day, max(action) AS action FROM events GROUP BY ALL),
spans AS (
  SELECT a.kind, a.verb, a.pattern, a.day AS valid_from,
         (SELECT min(r.day) FROM days r WHERE r.kind = a.kind AND r.pattern = a.pattern AND r.action = 'remove' AND r.day > a.day) AS valid_to
  FROM days a WHERE a.action = 'add' AND NOT EXISTS (
    SELECT 1 FROM days e WHERE e.kind = a.kind AND e.pattern = a.pattern AND e.action = 'add' AND e.day < a.day
      AND NOT EXISTS (SELECT 1 FROM days r WHERE r.kind = a.kind AND r.pattern = a.pattern AND r.action = 'remove'
                      AND r.day > e.day AND r.day < a.day))),
hits AS (
  SELECT p.page_id, p.url, s.verb, s.pattern, CASE WHEN {_hex(3)} < 128 THEN 'spam' ELSE 'ads' END AS list
  FROM p JOIN spans s ON
    ((s.kind = 'domain' AND (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern)))
     OR (s.kind = 'prefix' AND starts_with(p.host || '/' || array_to_string(p.parts, '/') || '/', s.pattern || '/')))
    AND p.fetched_on >= DATE '2024-01-01' + s.valid_from
    AND (s.valid_to IS NULL OR p.fetched_on < DATE '2024-01-01' + s.valid_to)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY length(pattern) DESC, verb, list, pattern) AS nr,
         count(*) OVER (PARTITION BY page_id, url) AS n_active FROM hits)
SELECT p.page_id, p.url, p.fetched_on, coalesce(r.verb = 'block', false) AS blocked, r.list, r.pattern,
       coalesce(r.n_active, 0) AS n_active
FROM p LEFT JOIN ranked r ON r.nr = 1 AND p.page_id = r.page_id AND p.url = r.url
""",
    "op5_warc_derivatives": f"""
WITH src AS (
  SELECT {_sql_urn("concat_ws('|', page_id::VARCHAR, url, 'response')")} AS source_id, url AS target_uri,
         (DATE '2024-01-01' + ((page_id * 37) % 731)::INT)::VARCHAR || 'T00:00:00Z' AS warc_date, coalesce(html, '') AS html
  FROM pages),
read AS (
  SELECT source_id, target_uri, warc_date, 'sha256:' || sha256(html) AS source_digest,
         {_sql_urn("source_id || '|conversion'")} AS text_id, {_sql_urn("source_id || '|metadata'")} AS meta_id,
         {_sql_text("html")} AS text, trim(regexp_replace(regexp_extract(html, '{WA.TITLE}', 1), '{WA.TITLE_FOLD}', ' ', 'g')) AS title,
         [replace(trim(regexp_replace(CASE WHEN x[1] IN ('"', chr(39)) THEN x[2:-2] ELSE x END, '{WA.LINK_DROP}', '', 'g')), ' ', '%20')
          FOR x IN regexp_extract_all(html, '{WA.LINK.replace("'", "''")}', 1)] AS links, strlen(html) AS size
  FROM src),
filled AS (
  SELECT *, CASE WHEN title <> '' THEN 'title: ' || title || {_CRLF} ELSE '' END
            || coalesce(array_to_string(['outlink: ' || x || {_CRLF} FOR x IN links], ''), '')
            || 'source-header: HTTP/1.1 200 OK' || {_CRLF} || 'source-header: Content-Type: text/html; charset=utf-8' || {_CRLF}
            || 'source-header: Content-Length: ' || size || {_CRLF} AS fields
  FROM read),
both_kinds AS (
  SELECT 'conversion' AS record_type, text_id AS record_id, NULL AS concurrent_to, 'text/plain' AS content_type, text AS block,
         source_id AS refers_to, target_uri, warc_date, source_digest FROM filled
  UNION ALL SELECT 'metadata', meta_id, text_id, 'application/warc-fields', fields, source_id, target_uri, warc_date, source_digest FROM filled)
SELECT *, strlen(block) AS content_length, 'sha256:' || sha256(block) AS block_digest FROM both_kinds
""",
    "op1_substring_dedup": f"""
WITH words AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM words),
windows AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM spots),
firsts AS (SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM windows JOIN firsts USING (h) WHERE first_doc < doc_id),
each AS (SELECT doc_id, w[j] AS word, j FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM words)),
kept AS (
  SELECT e.doc_id, count(*) AS n_words, count(g.j) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY e.j) FILTER (g.j IS NULL), '') AS kept
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
""",
    "op9_decontaminate": f"""
WITH items AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM (SELECT item_id, {_LOWER_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_shingles AS (
  SELECT item_id, n, k, sh, count(*) AS c
  FROM (SELECT item_id, n, k, array_to_string(w[i:i + k - 1], ' ') AS sh
        FROM (SELECT *, unnest(range(1, n - k + 2)) AS i FROM items))
  GROUP BY ALL),
docs AS (SELECT doc_id, w, len(w) AS m FROM (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents)),
doc_shingles AS (
  SELECT doc_id, m, k, i - 1 AS pos, array_to_string(w[i:i + k - 1], ' ') AS sh
  FROM (SELECT doc_id, w, m, k, unnest(range(1, m - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM items) WHERE m >= k)),
hits AS (SELECT d.doc_id, m, pos, t.* FROM doc_shingles d JOIN item_shingles t ON d.k = t.k AND d.sh = t.sh),
windows AS (
  SELECT doc_id, item_id, n, k, least(n, m) AS size, sh, c,
         unnest(range(greatest(0, pos - (least(n, m) - k)), least(pos, m - least(n, m)) + 1)) AS s
  FROM hits),
common AS (
  SELECT doc_id, item_id, n, k, size, s, sum(least(c, cw)) AS shared
  FROM (SELECT doc_id, item_id, n, k, size, s, sh, c, count(*) AS cw FROM windows GROUP BY ALL) GROUP BY ALL),
scored AS (
  SELECT doc_id, item_id, s, shared::DOUBLE / ((size - k + 1) + (n - k + 1) - shared)::DOUBLE AS similarity FROM common)
SELECT doc_id, item_id, arg_min(s, (-similarity, s)) AS start_word, count(*) AS n_windows, max(similarity) AS similarity
FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
""",
    "op8_poisson_mix": """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, sqrt(n::DOUBLE) AS weight FROM n),
rates AS (
  SELECT n.source, w.weight / (SELECT sum(weight) FROM w) * (SELECT sum(n)::DOUBLE FROM n) / n.n AS rate
  FROM n JOIN w ON n.source IS NOT DISTINCT FROM w.source),
terms AS (
  SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
  FROM rates, range(0, 4000) AS t(k) WHERE k <= rate + 12 * sqrt(rate) + 40),
steps AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS step FROM terms),
draws AS (
  SELECT d.*, ('0x' || substr(md5('11:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents d),
times AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.step <= d.u) AS times
  FROM draws d),
copies AS (
  SELECT doc_id, text, lang, source, n_chars, unnest(range(1, times + 1)) AS copy FROM times)
SELECT *, substr(md5('order:11:' || doc_id || ':' || copy), 1, 16) AS shuffle_key FROM copies
""",
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last_doc AS gone
  FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    # CRC-32 by its table of 256 remainders, which the reversed polynomial gives bit by bit
    "op11_importance_resample": f"""
WITH RECURSIVE steps AS (
  SELECT i::UBIGINT AS i, i::UBIGINT AS r, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(r ORDER BY i) AS t FROM steps WHERE k = 8),
docs AS (SELECT doc_id, coalesce({_IMPORTANCE_WORDS}, []) AS w FROM documents),
doc_words AS (SELECT doc_id, unnest(w) AS word FROM docs),
target_words AS (SELECT unnest(coalesce({_IMPORTANCE_WORDS}, [])) AS word FROM benchmark),
vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION ALL SELECT word FROM target_words)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::UBIGINT,
           list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM vocabulary, crc),
raw AS (SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw)::BIGINT AS big_s, (SELECT coalesce(sum(t), 0) FROM target)::BIGINT AS big_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000) / ((s + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
  FROM raw LEFT JOIN target USING (bucket), totals),
sums AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM doc_words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM docs d LEFT JOIN sums USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM ranked
""",
}
