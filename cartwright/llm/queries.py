"""One registered query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    chunk_dedup,
    decontaminate,
    fill_middle,
    hard_negatives,
    jaccard_join,
    line_dedup,
    mixing,
    quality_gam,
    quality_rules,
    span_dedup,
    suffix_dedup,
    url_filter,
    warc,
)
from cartwright.llm.common import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the contract.
URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
SOURCE_WEIGHTS = (3, 1, 2)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_warc(spark: SparkSession, directory: str) -> DataFrame:
    read = warc.round_trip(table(spark, directory, "pages"), fresh_folder(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    documents, items = table(spark, directory, "documents"), table(spark, directory, "benchmark")
    return decontaminate.contaminated(documents, items)


def op3_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeated_strings(table(spark, directory, "documents"))
    return cleaned.drop("kept")


def op4_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    cleaned = line_dedup.remove_repeated_lines(table(spark, directory, "documents"))
    return cleaned.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", "text")


def op5_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    cleaned = span_dedup.remove_repeated_spans(table(spark, directory, "documents"))
    return cleaned.select("doc_id", "span_dedup.*", "text")


def op6_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    rated = quality_rules.rate(table(spark, directory, "documents"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    return quality_gam.classify(table(spark, directory, "documents"), table(spark, directory, "labels"))


def op8_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, directory, "documents"))


def op9_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, directory, "pages"), URL_RULES)


def op10_mixing(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mixing.mix(table(spark, directory, "documents"), SOURCE_WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    embeddings = table(spark, directory, "embeddings")
    label = F.col("label").cast("long")
    changed = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(embeddings.withColumn("label", changed))


def op12_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return chunk_dedup.find_copies(table(spark, directory, "documents"))


def op13_fill_in_middle(spark: SparkSession, directory: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, directory, "documents").select("doc_id", "text"))
    output, form = F.col("fill_middle.output"), F.col("fill_middle.form")
    return made.select(
        "doc_id",
        "fill_middle.n",
        form,
        "fill_middle.prefix_chars",
        "fill_middle.middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(output, form), 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Query]:
    registered = (
        op1_warc,
        op2_decontamination,
        op3_suffix_dedup,
        op4_line_dedup,
        op5_substring_dedup,
        op6_quality_rules,
        op7_quality_classifier,
        op8_jaccard_join,
        op9_url_filters,
        op10_mixing,
        op11_hard_negatives,
        op12_exact_dedup,
        op13_fill_in_middle,
    )
    return {query.__name__: query for query in registered}


# The base32 digits of a SHA-1 are read off its hex form, four of them from every five.
OP1_SQL = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sum FROM pages),
digits AS (
  SELECT page_id, strlen(payload) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
      (CAST('0x' || substr(sum, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '')
      AS payload_digest, max(page_id) OVER (PARTITION BY payload) AS latest
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM digits
"""


# Bytes are pairs of hex digits; what no repeated string covers is joined again.
OP3_SQL = r"""
WITH coded AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
strings AS (
  SELECT doc_id, pos, md5(substr(h, 2 * pos + 1, 200)) AS string
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS pos FROM coded WHERE n >= 100)),
later AS (
  SELECT doc_id, pos FROM strings QUALIFY row_number() OVER (PARTITION BY string ORDER BY doc_id, pos) > 1),
begun AS (
  SELECT doc_id, pos,
    CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100 THEN 0 ELSE 1 END AS is_new
  FROM later),
numbered AS (
  SELECT doc_id, pos, sum(is_new) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM begun),
gone AS (SELECT doc_id, run, min(pos) AS low, max(pos) + 100 AS high FROM numbered GROUP BY doc_id, run),
edges AS (
  SELECT c.doc_id, c.h, c.n, g.low, g.high,
    coalesce(lag(g.high) OVER (PARTITION BY c.doc_id ORDER BY g.low), 0) AS since
  FROM coded c LEFT JOIN gone g ON g.doc_id = c.doc_id),
cut AS (
  SELECT doc_id, any_value(n) AS n, any_value(h) AS h, CAST(coalesce(sum(high - low), 0) AS BIGINT) AS n_removed,
    count(low) AS n_spans, max(high) AS last,
    coalesce(string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low), '') AS kept
  FROM edges GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, n_removed, n_spans,
  sha256(unhex(kept || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM cut
"""


# Of equal pairs of lines the first stays; one that shares a line with it isn't a repeat.
OP4_SQL = r"""
WITH cut AS MATERIALIZED (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
pairs AS (
  SELECT doc_id, pos, lines[pos] || chr(10) || lines[pos + 1] AS pair
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - CAST(lines[-1] = '' AS INTEGER))) AS pos FROM cut)
  WHERE regexp_matches(lines[pos] || lines[pos + 1], '[^\s]')),
placed AS (
  SELECT doc_id, pos, first_value(doc_id) OVER same AS first_id, first_value(pos) OVER same AS first_at
  FROM pairs WINDOW same AS (PARTITION BY pair ORDER BY doc_id, pos)),
gone AS (
  SELECT doc_id, list(DISTINCT line) AS gone
  FROM (SELECT doc_id, unnest([pos, pos + 1]) AS line FROM placed WHERE doc_id <> first_id OR pos > first_at + 1)
  GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]),
    chr(10)) END AS text
FROM cut c LEFT JOIN gone g ON g.doc_id = c.doc_id
"""


# Items of fewer than eight shingles need no case of their own here: the join is exact.
OP2_SQL = r"""
WITH split AS (
  SELECT true AS is_item, item_id AS id, text FROM benchmark
  UNION ALL SELECT false, doc_id, text FROM documents),
listed AS (
  SELECT is_item, id,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS words
  FROM split),
shingled AS (
  SELECT DISTINCT is_item, id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [list_aggregate(words, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: list_aggregate(words[i:i+4], 'string_agg', ' ')) END) AS shingle
  FROM listed),
sizes AS (SELECT id, count(*) AS item_shingles FROM shingled WHERE is_item GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, any_value(item_shingles) AS item_shingles, count(*) AS shared,
  count(*) / any_value(item_shingles)::DOUBLE AS containment
FROM shingled i JOIN shingled d ON d.shingle = i.shingle AND i.is_item AND NOT d.is_item
JOIN sizes s ON s.id = i.id
GROUP BY d.id, i.id HAVING count(*) / any_value(item_shingles)::DOUBLE >= 0.8
"""


OP9_SQL = """
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fitting AS (
  SELECT page_id, rhost||rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost||rpath) DESC) AS place
  FROM split JOIN rules
    ON (host = rhost OR ends_with(host, '.'||rhost)) AND starts_with(path, rpath))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM split s LEFT JOIN fitting f ON f.page_id = s.page_id AND f.place = 1
"""

OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes),
levelled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    coalesce(least(cap, weight * max(CASE WHEN level * weight <= cap THEN level END) OVER ()), cap) AS target
  FROM levelled),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS rate,
    CAST('0x'||substr(md5('mix'||(source IS NULL)::VARCHAR||coalesce(source, '')), 1, 6) AS BIGINT) AS start
  FROM targets),
numbered AS (
  SELECT s.*, row_number() OVER (PARTITION BY source
    ORDER BY size, md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) AS at
  FROM sized s)
SELECT n.doc_id, n.size, r.source_size, r.target,
  ((r.rate * n.at + r.start) // 16777216 - (r.rate * (n.at - 1) + r.start) // 16777216) * n.size AS taken
FROM numbered n JOIN rated r ON n.source IS NOT DISTINCT FROM r.source
"""


OP8_SQL = r"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingled AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [list_aggregate(words, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i]||' '||words[i+1]||' '||words[i+2]) END) AS shingle
  FROM listed),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS common
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT one, two FROM met JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = two
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
edges AS MATERIALIZED (SELECT one, two FROM links UNION SELECT two, one FROM links),
reached AS MATERIALIZED (
  WITH RECURSIVE walk(one, two) AS (
    SELECT one, two FROM edges UNION SELECT w.one, e.two FROM walk w JOIN edges e ON e.one = w.two)
  SELECT one, min(two) AS least FROM walk GROUP BY one)
SELECT l.doc_id, coalesce(s.n, 0) AS n_shingles, least(l.doc_id, coalesce(r.least, l.doc_id)) AS component_id
FROM listed l LEFT JOIN sizes s ON s.doc_id = l.doc_id LEFT JOIN reached r ON r.one = l.doc_id
"""


OP11_SQL = r"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS MATERIALIZED (
  SELECT vec_id, label, unnest(range(len(embedding))) AS at,
    CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x
  FROM usable),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor, r.vec_id AS other, a.label = r.label AS same, CAST(sum(a.x * r.x) AS BIGINT) AS score
  FROM flat a JOIN flat r ON a.at = r.at AND a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
  GROUP BY ALL),
positives AS (
  SELECT anchor, other AS positive, score AS limit_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
ranked AS (
  SELECT p.anchor, p.positive, p.limit_score, s.other, s.score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other) AS place
  FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
    AND 80 * p.limit_score <= 100 * s.score AND s.score <= p.limit_score)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(place AS INTEGER) AS rank, other AS negative_id,
  limit_score AS positive_score, score AS negative_score
FROM ranked WHERE place <= 5
"""


OP12_SQL = r"""
WITH listed AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM listed WINDOW same AS (PARTITION BY t)
"""


OP13_SQL = r"""
WITH lined AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS is_plain
  FROM lined),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS one, greatest(h1 % (n + 1), h2 % (n + 1)) AS two FROM drawn),
parts AS (
  SELECT *, array_to_string(lines[1:one], '') AS p, array_to_string(lines[one + 1:two], '') AS m,
    array_to_string(lines[two + 1:], '') AS s,
    CASE WHEN is_plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut)
SELECT doc_id, n, form, CASE WHEN NOT is_plain THEN length(p) END AS prefix_chars,
  CASE WHEN NOT is_plain THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>'||p||'<S>'||s||'<M>'||m
    ELSE '<S>'||s||'<P>'||p||'<M>'||m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op2_decontamination": OP2_SQL, "op3_suffix_dedup": OP3_SQL,
        "op4_line_dedup": OP4_SQL, "op8_jaccard_join": OP8_SQL,
        "op9_url_filters": OP9_SQL, "op10_mixing": OP10_SQL,
        "op11_hard_negatives": OP11_SQL, "op12_exact_dedup": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
