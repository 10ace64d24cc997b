"""The registered query of each operator, with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloomlm, bpe, jaccard, langid, media, mixing, neardup, packing, pii, spelling, toxicity, trie, webtext
from .common import crc_bucket, table

Query = Callable[[SparkSession, str], DataFrame]


#: A production job takes its key from a secret store; results here must be reproducible.
PSEUDONYM_KEY = "tapeloom"


def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    name = next(x for k in range(len(docs.columns) + 1) if (x := "n_candidates" + "_" * k) not in docs.columns)
    return pii.pseudonymise(docs.withColumn(name, pii.occurrences(F.col("text"))), PSEUDONYM_KEY)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard.join(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = neardup.find(table(spark, sf_dir, "embeddings"))
    return members


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(table(spark, sf_dir, "pages"))


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = crc_bucket("doc_id", 7) != 2
    out = bloomlm.score(table(spark, sf_dir, "documents"), training)
    return out.select("doc_id", (~training).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.features(media.store(table(spark, sf_dir, "documents")))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(crc_bucket("doc_id", 5) != 0))
    return toxicity.score(docs, model).select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language_guess")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_bucket("doc_id", 4) != 2))
    return langid.predict(docs, model).select("doc_id", (crc_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, documents = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return mixing.taken(mixed, documents).select("doc_id", "size", "source_size", "target", "taken")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = trie.with_shared_heads(trie.sequences(table(spark, sf_dir, "conversations")), family=5, most=9)
    return trie.build(seqs).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"), least_length=6, least_n=5, times=5, drop_one_in=199)


def queries() -> dict[str, Query]:
    every = (op1_pseudonyms, op2_packing, op3_ngram_jaccard, op4_embedding_neardup, op5_html_text, op6_bloom_lm, op7_media, op8_byte_bpe, op9_toxicity, op10_language_id, op11_mixing, op12_prefix_trie, op13_spelling)
    return {f.__name__: f for f in every}


_REACHED = """
  e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reached(id, least_id) AS (SELECT id, id FROM ids UNION SELECT e.b, r.least_id FROM reached r JOIN e ON e.a = r.id),
  part AS (SELECT id, min(least_id) AS component_id FROM reached GROUP BY id)"""

JACCARD_SQL = f"""
WITH RECURSIVE
  d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
  c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  both_have AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM both_have JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * o >= 75 * (ca.n + cb.n - o)),
  ids AS (SELECT doc_id AS id FROM d),{_REACHED}
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, part.component_id FROM d LEFT JOIN c USING (doc_id) JOIN part ON part.id = d.doc_id
"""

NEARDUP_SQL = f"""
WITH RECURSIVE
  v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x)
            WHERE list_dot_product(p.x, q.x) / sqrt(list_dot_product(p.x, p.x) * list_dot_product(q.x, q.x)) >= 0.93),
  ids AS (SELECT vec_id AS id FROM embeddings),{_REACHED}
SELECT id AS vec_id, (SELECT count(*) FROM e WHERE e.a = part.id) AS n_links, component_id, id = component_id AS kept FROM part
"""


def _crc32(octets: str) -> str:
    """The unsigned crc32 of a list of bytes, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295::BIGINT)"


#: Targets by filling sources up in the order of size over weight; ranks of slots by sorting them.
MIXING_SQL = f"""
WITH
  d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
          md5(concat_ws('|', 'tapeloom', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS shuffle FROM documents),
  s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM d GROUP BY source),
  w AS (SELECT *, [3, 1, 2][(number % 3 + 1)::INT] AS weight FROM s),
  f AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER up, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level FROM w
        WINDOW up AS (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  t AS (SELECT *, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT min_by(level, source_size / weight) FROM f WHERE 2 * source_size > level * weight), 0)) AS target FROM w),
  q AS (SELECT *, least(2 * source_size, floor(target + 0.5))::BIGINT AS words FROM t),
  quotas AS (SELECT *, (ceil(words / 1024))::BIGINT AS quota FROM q),
  starts AS (SELECT number, quota, coalesce(sum(quota) OVER (ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM quotas),
  k AS (SELECT greatest(1, ceil(log2(greatest(sum(quota), 1))))::BIGINT AS bits FROM quotas),
  points AS (SELECT number, unnest(range(start, start + quota)) AS v FROM starts),
  slots AS (SELECT number, row_number() OVER (PARTITION BY number ORDER BY list_sum(list_transform(range(bits), lambda b: ((v >> b) & 1) << (bits - 1 - b)))) - 1 AS nth_block FROM points, k),
  placed AS (SELECT d.*, q.number, q.source_size, q.target, q.words, row_number() OVER o AS nth, coalesce(sum(size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
             FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WINDOW o AS (PARTITION BY number ORDER BY shuffle, d.doc_id)),
  spans AS (SELECT number, nth, epoch * source_size + pos AS a, least(epoch * source_size + pos + size, words) AS b FROM placed, range(2) e(epoch)),
  pieces AS (SELECT *, unnest(range(a // 1024, (b - 1) // 1024 + 1)) AS nth_block FROM spans WHERE b > a),
  taken AS (SELECT number, nth, sum(least(b, (nth_block + 1) * 1024) - greatest(a, nth_block * 1024))::BIGINT AS taken FROM pieces JOIN slots USING (number, nth_block) GROUP BY 1, 2)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed LEFT JOIN taken USING (number, nth)
"""

#: Nodes by whole prefixes; subtrees by each node's owner's path to the root.
TRIE_SQL = f"""
WITH
  t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
          left(sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))), 32)) AS k FROM conversations WHERE conv_id IS NOT NULL),
  ids AS (SELECT conv_id, {_crc32("list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
  parts AS (SELECT ids.conv_id, 0 AS part, k, role, text FROM ids JOIN t ON t.conv_id = ids.conv_id - ids.conv_id % 5 AND k <= h UNION ALL SELECT conv_id, 1, k, role, text FROM ids JOIN t USING (conv_id) WHERE k > h),
  paths AS (SELECT conv_id, row_number() OVER o AS depth, list({{'role': role, 'text': text}}) OVER o AS path, strlen(text) AS size FROM parts WINDOW o AS (PARTITION BY conv_id ORDER BY part, k)),
  m AS (SELECT * FROM paths UNION ALL SELECT conv_id, 0, [], 0 FROM ids),
  member AS (SELECT *, min(conv_id) OVER n AS owner, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM m WINDOW n AS (PARTITION BY depth, path)),
  node AS (SELECT owner, depth, count(*) AS n_convs, any_value(size) AS size, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM member GROUP BY 1, 2),
  up AS (SELECT node.*, p.owner AS parent FROM node LEFT JOIN member p ON p.conv_id = node.owner AND p.depth = node.depth - 1),
  children AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY 1, 2),
  sub AS (SELECT a.owner, a.depth, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.size) AS saved
          FROM node x JOIN member a ON a.conv_id = x.owner AND a.depth <= x.depth LEFT JOIN children c ON c.parent = x.owner AND c.depth = x.depth GROUP BY 1, 2)
SELECT owner AS conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(n, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM up JOIN sub USING (owner, depth) LEFT JOIN (SELECT parent AS owner, depth, n FROM children) USING (owner, depth)
"""

#: Near words by equal texts with one code point left out.
SPELLING_SQL = f"""
WITH RECURSIVE
  r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents) GROUP BY 1, 2),
  h AS (SELECT run, n, {_crc32("flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda s: CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [(192 | (ord(s) >> 6))::BIGINT, (128 | (ord(s) & 63))::BIGINT] END))")} AS h FROM r WHERE length(run) >= 6),
  w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN concat(left(run, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2)) ELSE run END AS word, n FROM h) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  cut AS (SELECT word, i, concat(left(word, i), substr(word, i + 2)) AS rest FROM (SELECT word, unnest(range(length(word)))::INT AS i FROM w)),
  pair AS (SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y USING (i, rest) WHERE x.word <> y.word UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM w) UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM w)),
  best AS (SELECT a AS word, count(*) AS n_near, max(n) AS most, min(struct_pack(rest := -n, b := b)).b AS b FROM pair JOIN w ON w.word = b GROUP BY a),
  f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN b END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM w LEFT JOIN best USING (word)),
  step(word, last) AS (SELECT word, word FROM f UNION ALL SELECT step.word, f.form FROM step JOIN f ON f.word = step.last WHERE f.form IS NOT NULL),
  ends AS (SELECT step.word, last AS root FROM step JOIN f ON f.word = step.last WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    """Each by another way than its operator's; the other operators rest on models, tokenizers or formats that SQL has not."""
    return {"op3_ngram_jaccard": JACCARD_SQL, "op4_embedding_neardup": NEARDUP_SQL, "op11_mixing": MIXING_SQL, "op12_prefix_trie": TRIE_SQL, "op13_spelling": SPELLING_SQL}
