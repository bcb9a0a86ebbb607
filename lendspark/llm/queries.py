"""One query for each operator, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op2_mix_sources"] = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS h
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS n FROM docs GROUP BY source),
ranked AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS w, 2.0::DOUBLE * n AS cap FROM src),
ordered AS (SELECT *, row_number() OVER (ORDER BY cap / w, source IS NULL, encode(source)) AS k FROM ranked),
run AS (
  SELECT *, (1.5::DOUBLE * sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ordered),
first AS (SELECT min(k) AS k FROM run WHERE level <= cap / w),
tgt AS (
  SELECT run.source, n, CASE WHEN run.k < first.k THEN cap ELSE (SELECT level FROM run r WHERE r.k = first.k) * w END AS target
  FROM run, first),
rest AS (
  SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM tgt),
run2 AS (
  SELECT d.*, r.n, r.target, r.whole, r.target - r.whole * r.n AS room,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM docs d JOIN rest r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, n AS source_size, target, (size * (whole + (2 * upto - own <= 2 * room)::INT))::BIGINT AS taken FROM run2
"""


@query
def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from .tokencount import count_tokens

    counted = count_tokens(table(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > 4096).alias("over_limit"))


@query
def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode

    rule = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = encode(table(spark, sf, "documents").select("doc_id", "text"), *rule, decoded="decoded")
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


@query
def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    from .urlfilter import judge

    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    labels = table(spark, sf, "labels").select("doc_id", good.alias("good"))
    return judge(table(spark, sf, "pages"), labels, URL_RULES).withColumn("purity", F.round("purity", 9))


def _op6_sql() -> str:
    from .urlfilter import judge_sql

    return judge_sql(URL_RULES)


ORACLES["op6_url_filter"] = _op6_sql()


@query
def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from .langid import identify, train

    docs = table(spark, sf, "documents")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = train(docs.where(remainder != 2))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), F.col("language").alias("lang_pred"), "score", "bits_per_byte")


@query
def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    from .quality import score, train

    docs = table(spark, sf, "documents")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = train(docs, table(spark, sf, "labels").where(remainder != 1).select("doc_id", F.col("quality").alias("label")))
    return score(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf, "documents")).select("doc_id", "group_id", "kept", "n_shingles")


@query
def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from .linededup import dedup_lines

    done = dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_cut", F.octet_length("text").cast("long").alias("n_bytes_left"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def op1_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from .embeddup import near_vectors

    return near_vectors(table(spark, sf, "embeddings"))


ORACLES["op1_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query
def op8_nearest_vectors(spark: SparkSession, sf: str) -> DataFrame:
    from .ann import search

    rows = table(spark, sf, "embeddings")
    asked = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search(rows, asked, k=20)


ORACLES["op9_near_duplicates"] = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, greatest(len(w) - 4, 1) AS size, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
      FROM w WHERE len(w) > 0),
c AS (SELECT doc_id, size, g, count(*) AS n FROM s GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.size AS na, b.size AS nb, sum(least(a.n, b.n)) AS common
      FROM c a JOIN c b ON a.g = b.g AND a.doc_id <> b.doc_id AND least(a.size, b.size) >= 0.8 * greatest(a.size, b.size) GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE common >= 0.8 * (na + nb - common)),
r AS (SELECT doc_id, doc_id AS g FROM documents UNION SELECT l.b, r.g FROM r JOIN l ON l.a = r.doc_id),
d AS (SELECT doc_id, min(g) AS group_id FROM r GROUP BY doc_id)
SELECT doc_id, group_id, doc_id = group_id AS kept, coalesce(size, 0)::BIGINT AS n_shingles
FROM d LEFT JOIN (SELECT DISTINCT doc_id, size FROM s) USING (doc_id)
"""


# windows from a line on (f) and up to a line (t), their first occurrences, and the lines that later occurrences cover
ORACLES["op10_line_dedup"] = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, len(lines) AS total, list_filter(list_transform(lines, lambda x, i:
        {'k': i - 1, 'n': len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')), 'x': trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))}),
        lambda s: s.n > 0) AS s FROM d),
c AS (SELECT doc_id, total, list_transform(s, lambda e: e.k) AS k, list_transform(s, lambda e: e.x) AS x,
        list_transform(range(0, len(s) + 1), lambda i: coalesce(list_sum(list_transform(s[1:i], lambda e: e.n)), 0)) AS c FROM w WHERE len(s) > 0),
e AS (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM c),
r AS (
  SELECT doc_id, total, k, x, i AS f, list_filter(range(i, len(k) + 1), lambda j: c[j + 1] - c[i] >= 5)[1] AS t FROM e
  UNION
  SELECT doc_id, total, k, x, list_filter(range(1, i + 1), lambda j: c[i + 1] - c[j] >= 5)[-1] AS f, i AS t FROM e),
o AS (SELECT doc_id, k[f] AS a, coalesce(k[t + 1], total) - 1 AS b, array_to_string(x[f:t], chr(10)) AS body FROM r WHERE f IS NOT NULL AND t IS NOT NULL),
m AS (SELECT body, arg_min({'doc': doc_id, 'b': b}, (doc_id, a, b)) AS m FROM o GROUP BY body HAVING count(*) > 1),
g AS (SELECT doc_id, list(DISTINCT l) AS gone FROM (
        SELECT doc_id, unnest(range(a, b + 1)) AS l FROM o JOIN m USING (body) WHERE doc_id <> m.doc OR a > m.b) GROUP BY doc_id),
z AS (SELECT doc_id, coalesce(len(gone), 0)::INT AS n_cut, CASE WHEN gone IS NULL THEN text ELSE
        array_to_string(list_filter(lines, lambda l, i: NOT list_contains(gone, i - 1)), chr(10)) END AS t FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n_cut, strlen(u)::BIGINT AS n_bytes_left, md5(u) AS text_md5
FROM (SELECT *, CASE WHEN n_cut > 0 AND NOT regexp_matches(t, '[^\\x20\\x09-\\x0D]') THEN '' ELSE t END AS u FROM z)
"""


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    from .hardneg import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings"), F.col("id") % 100 == 0, label=label)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT::HUGEINT) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER w)::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 5
"""


@query
def op12_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from .substrings import remove_repeats

    done = remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op12_substring_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
o AS (SELECT r, doc_id, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50 AND doc_id IS NOT NULL),
g AS (SELECT o.r, o.doc_id, p, array_to_string(w[p:p + 49], ' ') AS g FROM o JOIN d USING (r)),
m AS (SELECT g, min(doc_id) AS low FROM g GROUP BY g HAVING low < max(doc_id)),
x AS (SELECT DISTINCT r, unnest(range(p, p + 50)) AS k FROM g JOIN m USING (g) WHERE doc_id > low),
c AS (SELECT r, list(k) AS gone, count(*) AS n FROM x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN c USING (r)
"""


@query
def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    from .prefixtrie import rebuilt, trie

    return trie(rebuilt(table(spark, sf, "conversations")))


# crc32 by its bits: a byte is mixed in at every eighth step
ORACLES["op11_prefix_trie"] = """
WITH t AS (SELECT conv_id, turn, length(coalesce(text, ''))::BIGINT AS n,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'id': id, 'n': n} ORDER BY turn NULLS FIRST, id) AS turns,
    (xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295) % 6)::BIGINT AS h FROM t GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
u AS (SELECT conv_id, list_transform(turns, lambda x: x.id) AS ids, turns, len(turns) AS total FROM r),
e AS (SELECT conv_id, ids, total, turns, unnest(range(0, total + 1)) AS d FROM u),
n AS (SELECT ids[1:d] AS p, d, count(*) AS n_convs, min(conv_id) AS conv_id, any_value(CASE WHEN d > 0 THEN turns[d].n ELSE 0 END) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = total), '')) AS ends_sha256 FROM e GROUP BY ALL),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (p)),
a AS (SELECT p, n_convs, chars, n_children, unnest(range(0, d + 1)) AS upto FROM x),
s AS (SELECT p[1:upto] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens FROM a GROUP BY ALL)
SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
FROM x JOIN s USING (p) LEFT JOIN x y ON x.d > 0 AND y.d = x.d - 1 AND y.p = x.p[1:x.d - 1]
"""
