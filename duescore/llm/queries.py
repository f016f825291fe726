"""The registered query of each operator: the operator over its whole table with
production parameters, and the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duescore.llm.archives import archived
from duescore.llm.common import table
from duescore.llm.decontaminate import contamination
from duescore.llm.fill_middle import fill_in_middle, restored
from duescore.llm.hard_negatives import hard_negatives
from duescore.llm.language_model import scores
from duescore.llm.licenses import license_scan
from duescore.llm.neighbours import nearest
from duescore.llm.packing import packed
from duescore.llm.quality import classified
from duescore.llm.sharding import document_shards
from duescore.llm.simhash import simhash_components
from duescore.llm.token_files import document_token_counts
from duescore.llm.vector_dedup import embedding_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence tags, expressions and notice phrases of every document."""
    return license_scan(table(spark, sf_dir, "documents"))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and context-mixing log probabilities of every document."""
    return scores(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by a scan of flat token streams."""
    return document_token_counts(table(spark, sf_dir, "documents"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weights of every document and the sample that is kept."""
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_nearest_neighbours")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vector whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT page_id, n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM d
"""


@query("op6_arc_to_warc", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC records, converted to WARC files and read back."""
    return archived(table(spark, sf_dir, "pages")).drop("record_id")


@query("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 of all documents along the Hilbert curve of their metadata."""
    return document_shards(table(spark, sf_dir, "documents"), 24)


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, at most 3 bits)."""
    return simhash_components(table(spark, sf_dir, "documents"), 3, 3).select("doc_id", "fingerprint", "component_id")


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2,048 tokens."""
    return packed(table(spark, sf_dir, "documents"))


LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = "regexp_extract_all(" + LOWER_SQL.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, {WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, w, len(w) AS n FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (
  SELECT DISTINCT item_id, least(n, 10) AS k, array_to_string(list_slice(w, p + 1, p + least(n, 10)), ' ') AS win
  FROM (SELECT *, unnest(range(greatest(n - 9, 1))) AS p FROM i)),
sizes AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT uid, p, k, array_to_string(list_slice(w, p + 1, p + k), ' ') AS win
  FROM (SELECT uid, w, k, unnest(range(greatest(len(w) - k + 1, 0))) AS p FROM d, sizes)),
occ AS (SELECT dw.uid, dw.p, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
hit AS (SELECT uid, count(DISTINCT h) AS n_hit FROM (SELECT uid, unnest(range(p, p + k)) AS h FROM occ) GROUP BY uid),
its AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT uid, CAST(item_id AS VARCHAR) AS item FROM occ WHERE item_id IS NOT NULL) GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (uid) LEFT JOIN its USING (uid)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP11_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.uid AS anchor_uid, a.vec_id AS anchor_id, r.uid, r.vec_id, r.label = a.label AS same,
    CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.uid <> r.uid WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_uid ORDER BY score DESC, vec_id, uid) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_uid, p.uid ORDER BY s.score DESC, s.vec_id, s.uid) AS rank
  FROM p JOIN s ON p.anchor_uid = s.anchor_uid AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100, for its five positives."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("id") % 100 == 0)


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT *, len(w) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(list_slice(w, 1, i), '') AS prefix, array_to_string(list_slice(w, i + 1, j), '') AS middle,
    array_to_string(list_slice(w, j + 1, n), '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@query("op12_fill_in_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-middle form and what is restored from it."""
    done = fill_in_middle(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH RECURSIVE u AS (
  SELECT row_number() OVER () AS uid, vec_id, CAST(embedding AS DOUBLE[]) AS e,
    coalesce(vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0, false) AS usable
  FROM embeddings),
v AS (
  SELECT uid, vec_id, e FROM u
  WHERE usable AND len(e) = (SELECT len(e) FROM u WHERE usable GROUP BY len(e) ORDER BY count(*) DESC, len(e) LIMIT 1)),
p AS (SELECT a.uid AS a, b.uid AS b FROM v AS a JOIN v AS b ON a.uid <> b.uid AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(uid, seen) AS (SELECT uid, uid FROM v UNION SELECT reach.uid, p.b FROM reach JOIN p ON p.a = reach.seen),
c AS (SELECT reach.uid, min(v.vec_id) AS component_id FROM reach JOIN v ON v.uid = reach.seen GROUP BY reach.uid),
n AS (SELECT a AS uid, count(*) AS n_links FROM p GROUP BY a)
SELECT u.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, u.vec_id) AS component_id,
  u.vec_id IS NOT DISTINCT FROM coalesce(component_id, u.vec_id) AS kept
FROM u LEFT JOIN n USING (uid) LEFT JOIN c USING (uid)
"""


@query("op13_embedding_near_dedup", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95 or more."""
    return embedding_dedup(table(spark, sf_dir, "embeddings"), 0.95).withColumnRenamed("id", "vec_id")
