"""The registered queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.llm import (centroids, decontaminate, divergence, exact_dedup, language_id, mixing, near_dedup, quality, substring_dedup,
                          suffix_dedup, token_counts, token_ids, warc)
from leadtime.llm.common import table
from leadtime.llm.registry import QUERIES, SQL, register  # noqa: F401
from leadtime.plans.lineage import materialize

#: The tokenizer file that ids are made with; another one is a parameter of the operator.
TOKENIZER = "word_bpe_49k.json"

OP1_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


@register("op1_exact_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies by the cuckoo index."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(doc_id || ':mix') AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
        coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent,
        (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights_left,
        row_number() OVER o AS place
      FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
f AS (SELECT place AS p, total - spent AS rest, weights_left AS among FROM l WHERE NOT most * weights_left < weight * (total - spent) ORDER BY place LIMIT 1),
g AS (SELECT source, source_size, CASE WHEN place < p THEN most::DOUBLE ELSE (weight * rest)::DOUBLE / among::DOUBLE END AS target,
        CASE WHEN place < p THEN most ELSE (weight * rest) // among END AS budget FROM l, f),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken
FROM r
"""


@register("op2_mixing", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to the weights 5, 2, 1."""
    return mixing.mix(materialize(mixing.word_sizes(table(spark, sf_dir, "documents")), "sizes"))


OP3_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, translate(lpad(to_base(('0x' || h[1:10])::BIGINT, 32), 8, '0') || lpad(to_base(('0x' || h[11:20])::BIGINT, 32), 8, '0')
                       || lpad(to_base(('0x' || h[21:30])::BIGINT, 32), 8, '0') || lpad(to_base(('0x' || h[31:40])::BIGINT, 32), 8, '0'),
                       '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
             min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM d
"""


@register("op3_warc", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through monolithic archives, the normaliser and the offset index."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("target_uri")


@register("op8_token_ids")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text in grammar-compressed shards, reported from the files."""
    return token_ids.token_ids(table(spark, sf_dir, "documents"), TOKENIZER)


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by naive Bayes."""
    return language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS m FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM b) WHERE len(w) >= m)),
h AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@register("op9_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows searched in suffix arrays of all documents."""
    return decontaminate.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by the rule ensemble."""
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.c + y.c - shared)),
r AS (SELECT doc_id AS id, doc_id AS reach FROM d UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach),
m AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.id = d.doc_id
"""


@register("op10_near_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies over four-word shingles."""
    return near_dedup.near_components(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@register("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 400-byte strings, found by the suffix-array family."""
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), width=400, texts=False)
    return found.select(F.col("id").alias("doc_id"), F.col("n_items").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
t AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM x JOIN t USING (g)),
a AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""


@register("op7_substring_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word passages, found by recompression."""
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), width=35, texts=False)
    return found.select(F.col("id").alias("doc_id"), F.col("n_items").alias("n_words"), "n_removed", "kept_sha256")


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
w AS (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (n + v)::HUGEINT AS p
      FROM n JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (any_value(t) + any_value(v))::HUGEINT AS q
      FROM p JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS t FROM n GROUP BY lang) USING (lang) GROUP BY lang, term),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s, 0)::BIGINT AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS s
                 FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) z
      ON z.lang = x.lang AND z.source = x.source AND z.other = y.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM a)
WHERE part = 'pair' OR rank <= 200
"""


@register("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources compared by their words, in all languages."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


def _rounds_sql(rounds: int = 3) -> str:
    """Assignments and moves of the centroids, one common table expression each."""
    nearest = """SELECT i, c AS cluster, d AS distance FROM (SELECT i, c, sum((x.v - y.v) * (x.v - y.v)) AS d
      FROM x JOIN {0} y USING (j) GROUP BY i, c) QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, c) = 1"""
    parts = []
    for r in range(rounds):
        parts.append(f"a{r} AS ({nearest.format(f'c{r}')})")
        parts.append(f"""c{r + 1} AS (SELECT o.c, o.j, coalesce(m, o.v) AS v FROM c{r} o LEFT JOIN (SELECT cluster AS c, j, (s - ((s % n) + n) % n) // n AS m FROM (
      SELECT cluster, j, sum(v) AS s, count(*) AS n FROM a{r} JOIN x USING (i) GROUP BY ALL)) USING (c, j))""")
    return ",\n".join([*parts, f"a AS ({nearest.format(f'c{rounds}')})"]), f"c{rounds}"


_ROUNDS, _LAST = _rounds_sql()
OP12_SQL = f"""
WITH r AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
x AS (SELECT i, unnest(v) AS v, generate_subscripts(v, 1) AS j FROM r),
c0 AS (SELECT c, unnest(v) AS v, generate_subscripts(v, 1) AS j FROM (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM r QUALIFY c < 16)),
{_ROUNDS},
h AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM {_LAST} GROUP BY c)
SELECT vec_id, cluster::INT AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a JOIN r USING (i) JOIN h ON h.c = cluster
"""


@register("op12_centroid_clustering", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen centroids, three rounds."""
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


@register("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)
