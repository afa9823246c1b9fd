"""The registered queries of this folder, with production parameters, and their SQL."""

from __future__ import annotations

from .conversation_repair import repair_report
from .decontamination import find_leaks
from .html_extraction import extract_main_text
from .importance_resampling import resample
from .packing import pack_documents
from .quality_classifier import score_quality
from .quality_rules import judge_quality
from .recurrent_lm import score_documents
from .secret_scan import scan_secrets
from .simhash_dedup import simhash_components
from .support import table
from .token_counts import count_tokens
from .toxicity import score_toxicity
from .warc import archive_pages


def tokenizer_path(name):
    """Where a vocabulary lies; imported here, since only two operators need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark, folder):
    return count_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_packing(spark, folder):
    return pack_documents(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_decontamination(spark, folder):
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality_rules(spark, folder):
    return judge_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_simhash_dedup(spark, folder):
    return simhash_components(table(spark, folder, "documents"))


def op6_recurrent_lm(spark, folder):
    return score_documents(table(spark, folder, "documents"))


def op7_toxicity(spark, folder):
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_warc(spark, folder):
    return archive_pages(table(spark, folder, "pages"))


def op9_secret_scan(spark, folder):
    return scan_secrets(table(spark, folder, "documents"))


def op10_quality_classifier(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_conversation_repair(spark, folder):
    return repair_report(table(spark, folder, "conversations"))


def op12_html_extraction(spark, folder):
    return extract_main_text(table(spark, folder, "pages"))


def op13_importance_resampling(spark, folder):
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


#: The same base counts and tests; a document's windows are compared as text.
QUALITY_SQL = r"""
WITH docs AS (
    SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM docs
), placed AS (
    SELECT doc_id, i, list_slice(words, i, i + 4) AS w
    FROM split, unnest(range(1, len(words) - 3)) AS r(i)
), again AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM placed
), spread AS (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM again WHERE n > 1
), repeated AS (
    SELECT doc_id, sum(least(5, coalesce(j - i, 5))) AS n FROM spread GROUP BY doc_id
), counted AS (
    SELECT s.doc_id, lang, len(words)::BIGINT AS n_words,
           len(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_replace(array_to_string(words, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           len(regexp_replace(array_to_string(words, ''), '[^\p{Lu}]', '', 'g'))::BIGINT AS capitals,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id
), shares AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        CASE WHEN word_chars > 0 THEN least(100, ceil(((1000 * n_symbols) // word_chars) / 10.0)) ELSE 0 END AS symbols,
        CASE WHEN word_chars > 0 THEN least(100, ceil(((1000 * capitals) // word_chars) / 10.0)) ELSE 0 END AS capitals_level,
        CASE WHEN n_lines > 0 THEN least(100, ceil(((1000 * n_dup_lines) // n_lines) / 10.0)) ELSE 0 END AS lines_level,
        CASE WHEN n_words > 0 THEN least(100, ceil(((1000 * n_repeat_words) // n_words) / 10.0)) ELSE 0 END AS repeats
    FROM counted
), good AS (
    SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1
), holdout AS (
    SELECT s.lang, u.rule, u.level
    FROM shares s SEMI JOIN good USING (doc_id),
         unnest([{'rule': 'symbols', 'level': symbols}, {'rule': 'capitals', 'level': capitals_level},
                 {'rule': 'lines', 'level': lines_level}, {'rule': 'repeats', 'level': repeats}]) AS x(u)
), families AS (
    SELECT lang, rule, count(*) AS n, list(level) AS levels FROM holdout GROUP BY lang, rule
), tested AS (
    SELECT lang, rule, n, k, len(list_filter(levels, lambda v: v > k)) AS x, (SELECT count(*) FROM families) AS m
    FROM families, unnest(range(0, 100)) AS g(k)
), verdicts AS (
    SELECT lang, rule, k, CASE WHEN x > n * 0.005 THEN 1.0 ELSE list_sum(list_transform(range(0, x + 1),
        lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.005) + (n - i) * ln(0.995)))) END > 0.05 / m AS failed
    FROM tested
), cutoffs AS (
    SELECT lang, rule, coalesce(max(k) FILTER (failed), -1) + 1 AS cutoff FROM verdicts GROUP BY lang, rule
), cuts AS (
    SELECT lang, max(cutoff) FILTER (rule = 'symbols') AS c1, max(cutoff) FILTER (rule = 'capitals') AS c2,
           max(cutoff) FILTER (rule = 'lines') AS c3, max(cutoff) FILTER (rule = 'repeats') AS c4
    FROM cutoffs WHERE cutoff < 100 GROUP BY lang
)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(symbols > c1, false) OR coalesce(capitals_level > c2, false)
           OR coalesce(lines_level > c3, false) OR coalesce(repeats > c4, false)) AS kept
FROM shares s LEFT JOIN cuts ON cuts.lang IS NOT DISTINCT FROM s.lang
"""

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_recurrent_lm": op6_recurrent_lm,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_html_extraction": op12_html_extraction,
    "op13_importance_resampling": op13_importance_resampling,
}
WARC_SQL = """
WITH pages_read AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, max(page_id) AS original FROM pages_read WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM pages_read p LEFT JOIN firsts f ON f.payload_digest = p.payload_digest
"""

#: Words by a pattern, CRC-32 bit by bit once for each distinct word.
RESAMPLING_SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), aims AS (
    SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), vocabulary AS (
    SELECT DISTINCT word FROM (SELECT unnest(words) AS word FROM docs UNION ALL SELECT unnest(words) FROM aims) AS w
), spelled AS (
    SELECT word, list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::BIGINT, 2))::BIGINT) AS bytes
    FROM vocabulary
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, byte:
        list_reduce(list_prepend(xor(crc, byte), range(0, 8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 10000 AS bucket
    FROM spelled
), features AS (
    SELECT row, doc_id, len(words)::BIGINT AS n_features, unnest(CASE WHEN len(words) > 0 THEN words ELSE [NULL] END) AS word
    FROM (SELECT row_number() OVER () AS row, * FROM docs) AS d
), s AS (SELECT bucket, count(*) AS s FROM features JOIN hashed USING (word) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(words) AS word FROM aims) AS w JOIN hashed USING (word) GROUP BY bucket
), gains AS (
    SELECT b.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM range(0, 10000) AS b(bucket) LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket
), weights AS (
    SELECT row, any_value(doc_id) AS doc_id, any_value(n_features) AS n_features,
           CASE WHEN any_value(n_features) = 0 THEN 0 ELSE floor(sum(gain)::DOUBLE / any_value(n_features))::BIGINT END AS weight
    FROM features LEFT JOIN hashed USING (word) LEFT JOIN gains USING (bucket) GROUP BY row
), scores AS (
    SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT)
        + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM weights
), ranked AS (
    SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * (SELECT count(*) FROM scores WHERE n_features >= 20) // 100 THEN place END AS rank
FROM ranked
"""

ORACLES: dict[str, str] = {"op4_quality_rules": QUALITY_SQL, "op8_warc": WARC_SQL, "op13_importance_resampling": RESAMPLING_SQL}
