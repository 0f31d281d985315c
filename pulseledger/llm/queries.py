"""The registered queries of the operators, ``(spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulseledger.llm import (
    decontamination,
    disclosure,
    embedding_dedup,
    importance_sampling,
    jaccard_join,
    merkle_manifest,
    mixing,
    paragraph_dedup,
    quality,
    secret_scan,
    substring_dedup,
    token_counts,
    vector_search,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


@_query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data_report(_table(spark, sf_dir, "documents"))


@_query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


@_query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("removed")


@_query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_paragraphs(_table(spark, sf_dir, "documents"))


@_query
def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest_vectors(_table(spark, sf_dir, "embeddings"))


@_query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(_table(spark, sf_dir, "documents"))


@_query
def op13_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sampling.importance_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE["op7_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[n : n + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS n FROM words WHERE len(w) > 0)),
sized AS (
    SELECT d.doc_id, count(s.s) AS n_shingles
    FROM documents d LEFT JOIN shingle s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM shared
    JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)),
reach AS (
    SELECT doc_id, doc_id AS other FROM sized
    UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT s.doc_id, s.n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = s.doc_id) AS component_id
FROM sized s"""


# The unsigned crc32 of the list "bytes", bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda a, b:
        list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""
_BYTES = """list_transform(range(octet_length(encode({text}))), lambda i:
        ('0x' || substr(hex(encode({text})), (2 * i + 1)::BIGINT, 2))::BIGINT)"""


def _crc32(text: str) -> str:
    return _CRC32.format(bytes=_BYTES.format(text=text))


def _leaf(n_chars: str) -> str:
    parts = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({p})::VARCHAR || ':' || {p}, '-')" for p in parts) + ")"


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + 1")} AS changed,
        coalesce({_crc32("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL, false) AS touched
    FROM documents),
numbered AS (
    SELECT *, CASE WHEN touched THEN changed ELSE leaf END AS start,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY lang) AS width
    FROM hashed),
low AS (
    SELECT lang, 0 AS level, place, width, leaf AS h FROM numbered
    UNION ALL
    SELECT lang, level + 1, place // 2, (any_value(width) + 1) // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM low WHERE width > 1 GROUP BY lang, level, place // 2),
sub AS (
    SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS width
    FROM low WHERE width = 1),
high AS (
    SELECT 0 AS level, place, width, h FROM sub
    UNION ALL
    SELECT level + 1, place // 2, (any_value(width) + 1) // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM high WHERE width > 1 GROUP BY level, place // 2),
first_climb AS (
    SELECT doc_id, leaf, lang, 0 AS level, place, width, '' AS proof, start AS folded FROM numbered
    UNION ALL
    SELECT c.doc_id, c.leaf, c.lang, c.level + 1, c.place // 2, (c.width + 1) // 2, c.proof || coalesce(s.h, ''),
        sha256(CASE WHEN c.place % 2 = 0 THEN c.folded || coalesce(s.h, '') ELSE s.h || c.folded END)
    FROM first_climb c LEFT JOIN low s
      ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.place = xor(c.place, 1)
    WHERE c.width > 1),
second_climb AS (
    SELECT c.doc_id, c.leaf, sub.h AS subroot, 0 AS level, sub.place, sub.width, c.proof, c.folded
    FROM first_climb c JOIN sub ON sub.lang IS NOT DISTINCT FROM c.lang WHERE c.width = 1
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.place // 2, (c.width + 1) // 2, c.proof || coalesce(s.h, ''),
        sha256(CASE WHEN c.place % 2 = 0 THEN c.folded || coalesce(s.h, '') ELSE s.h || c.folded END)
    FROM second_climb c LEFT JOIN high s ON s.level = c.level AND s.place = xor(c.place, 1)
    WHERE c.width > 1)
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM second_climb, (SELECT h FROM high WHERE width = 1) WHERE second_climb.width = 1"""


def _words(table: str) -> str:
    return f"""SELECT id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM {table}"""


ORACLE["op13_importance_sampling"] = f"""
WITH own AS (SELECT row_number() OVER () AS id, doc_id, text FROM documents),
theirs AS (SELECT item_id AS id, text FROM benchmark),
own_words AS ({_words("own")}),
target_words AS ({_words("theirs")}),
hashed AS (
    SELECT w, {_crc32("w")} % 10000 AS bucket
    FROM (SELECT DISTINCT w FROM (SELECT w FROM own_words UNION ALL SELECT w FROM target_words))),
own_counts AS (SELECT bucket, count(*)::DOUBLE AS s FROM own_words JOIN hashed USING (w) GROUP BY bucket),
target_counts AS (SELECT bucket, count(*)::DOUBLE AS t FROM target_words JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM own_counts) AS s_all, (SELECT coalesce(sum(t), 0) FROM target_counts) AS t_all),
gains AS (
    SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000)) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain
    FROM own_counts LEFT JOIN target_counts USING (bucket), totals),
weighed AS (
    SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM own_words JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY id),
scored AS (
    SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM own LEFT JOIN weighed USING (id)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS n,
        count(*) OVER (PARTITION BY n_features >= 20) AS eligible
    FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND n <= eligible * 10 // 100 THEN n END AS rank
FROM ranked"""
