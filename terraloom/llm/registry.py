"""The queries of this package: thin uses of the operators on the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import alignment_digests
from .common import table
from .katz import katz_scores
from .nearest import nearest
from .packing import pack
from .phrases import collocations
from .quality_model import fit_quality, quality_scores
from .quality_rules import quality_rules
from .sentence_pieces import sentence_piece_digests
from .sharding import sharded
from .simhash import simhash_groups
from .token_counts import token_counts
from .toxicity import fit_toxicity, toxicity
from .warc import warc_round_trip


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, text = sharded(table(spark, sf_dir, "documents")), F.coalesce("text", F.lit(""))
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentence_pieces, op2_packing, op3_quality_rules, op4_toxicity, op5_katz, op6_token_counts, op7_nearest, op8_simhash, op9_warc, op10_quality_classifier, op11_shards, op12_alignment, op13_collocations)}


#: Where SQL has no form (tokens, fitted models, XXH64, approximate search), tests hold the
#: operator against a plain version instead.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
r AS (SELECT p.*, CASE WHEN n >= 1000 AND page_id IS NOT NULL THEN max(page_id) OVER (PARTITION BY digest) END AS top FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to FROM r
"""
QUALITY_SQL = """
WITH t AS (SELECT doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
m AS (SELECT doc_id, lang, text, words, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
  [length(regexp_replace(text, '[^A-Z]+', '', 'g')), length(regexp_replace(text, '[^0-9]+', '', 'g')), length(regexp_replace(text, '[^.,;:!?''"()-]+', '', 'g')), length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')), length(regexp_replace(text, '[\\x00-\\x7F]+', '', 'g')),
   length(text) - coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)] AS named,
  list_transform(words, lambda w: lower(w)) AS short,
  list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') AS lines FROM t),
c AS (SELECT *, list_append(named, length(text) - list_sum(named)) AS classes FROM m),
sums AS (SELECT lang, sum(n_words) AS all_words, list_transform(range(1, 8), lambda i: i) AS places, [sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]), sum(classes[5]), sum(classes[6]), sum(classes[7])] AS total FROM c GROUP BY lang),
counted AS (SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(short) AS w FROM c) GROUP BY lang, w),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS r FROM counted),
refs AS (SELECT s.lang, list_transform(total, lambda x: CAST(x AS DOUBLE) / greatest(1, list_sum(total))) AS char_ref, top.common, list_append(list_transform(top.ns, lambda n: CAST(n AS DOUBLE) / all_words), 1.0 - list_sum(list_transform(top.ns, lambda n: CAST(n AS DOUBLE) / all_words))) AS word_ref
  FROM sums s JOIN (SELECT lang, list(w ORDER BY r) AS common, list(n ORDER BY r) AS ns FROM ranked WHERE r <= 24 GROUP BY lang) top USING (lang) WHERE all_words >= 1000),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, n_words - 6)) AS i FROM c WHERE n_words >= 8)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again CROSS JOIN range(8) AS o(k) GROUP BY doc_id),
joined AS (SELECT c.*, refs.char_ref, refs.common, refs.word_ref, coalesce(n_repeat_words, 0) AS n_repeat_words, refs.common IS NOT NULL AND n_words >= 40 AS judged FROM c LEFT JOIN refs USING (lang) LEFT JOIN repeats USING (doc_id)),
shared AS (SELECT *, list_transform(classes, lambda x: CAST(x AS DOUBLE) / greatest(1, list_sum(classes))) AS p, list_transform(common, lambda w: CAST(len(list_filter(short, lambda x: x = w)) AS DOUBLE) / greatest(1, n_words)) AS q0 FROM joined),
full_ AS (SELECT *, list_append(q0, 1.0 - coalesce(list_sum(q0), 0)) AS q FROM shared),
scored AS (SELECT *, CASE WHEN judged THEN round(sqrt(greatest(0, list_sum(list_transform(range(1, 8), lambda i: CASE WHEN p[i] > 0 THEN p[i] * log2(2 * p[i] / (p[i] + char_ref[i])) ELSE 0 END + CASE WHEN char_ref[i] > 0 THEN char_ref[i] * log2(2 * char_ref[i] / (p[i] + char_ref[i])) ELSE 0 END)) / 2)), 6) END AS char_distance,
  CASE WHEN judged THEN round(sqrt(greatest(0, list_sum(list_transform(range(1, len(q) + 1), lambda i: CASE WHEN q[i] > 0 THEN q[i] * log2(2 * q[i] / (q[i] + word_ref[i])) ELSE 0 END + CASE WHEN word_ref[i] > 0 THEN word_ref[i] * log2(2 * word_ref[i] / (greatest(q[i], 0) + word_ref[i])) ELSE 0 END)) / 2)), 6) END AS word_distance FROM full_)
SELECT doc_id, n_words, word_chars, CAST(classes[4] AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT coalesce(char_distance > round(0.14 + 1.2 / sqrt(n_words), 6) OR word_distance > round(0.15 + 1.8 / sqrt(n_words), 6), false) AS kept, char_distance, word_distance FROM scored
"""


COLLOCATION_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM split GROUP BY lang),
numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS piece_no FROM split WHERE len(words) > 0),
flat AS MATERIALIZED (SELECT lang, piece_no, unnest(words) AS w, unnest(range(len(words))) AS i FROM numbered),
runs AS MATERIALIZED (SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4 FROM flat WINDOW p AS (PARTITION BY piece_no ORDER BY i)),
counts AS MATERIALIZED (SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM runs GROUP BY lang, w1 HAVING count(*) >= 30
  UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2), count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3), count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4), count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30),
cut AS (SELECT c.lang, c.k, c.phrase, c.a, x.a AS l, y.a AS r, row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a), j) AS place, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
  FROM counts c JOIN range(1, 4) AS t(j) ON j < c.k JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[1 : j], ' ') JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1 :], ' ')),
inner_ AS (SELECT DISTINCT c.lang, c.phrase FROM counts c JOIN (SELECT lang, a, array_to_string(string_split(phrase, ' ')[i : i + m - 1], ' ') AS part FROM (SELECT lang, phrase, a, m, unnest(range(1, k - m + 2)) AS i FROM counts JOIN range(2, 4) AS t(m) ON m < k)) h ON h.lang = c.lang AND h.part = c.phrase AND 100 * h.a >= 80 * c.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score FROM cut WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = cut.lang AND i.phrase = cut.phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": QUALITY_SQL, "op9_warc": WARC_SQL, "op13_collocations": COLLOCATION_SQL}
