"""The queries ``opN_<name>`` and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverloom.llm import (
    alignment, automata, blocks, cap_filters, language_model, leaks, lexical, line_runs, minhash, mixing, records, toxicity, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_kneser_ney_scores(spark, sf_dir):
    """Every document under a model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = every_nth("doc_id", 10)
    model = language_model.train(docs.where(~held_out))
    scores = language_model.score(docs, model)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


@query
def op2_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of all pages, as read back from their WARC files."""
    derived = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    back = warc.read_warc(warc.write_warc(derived))
    return back.select(
        F.col("source").alias("page_id"), "type", "record_id", "refers_to", "uri", "content_type", "block_digest",
        F.octet_length("block").cast("long").alias("content_length"),
        F.col("headers")["WARC-Source-Payload-Digest"].alias("payload_digest"),
        F.col("headers")["WARC-Concurrent-To"].alias("concurrent_to"),
    )


@query
def op3_latent_benchmark_leaks(spark, sf_dir):
    """Documents that hold benchmark items, with the item and how it was recognised."""
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_cap_filter_links(spark, sf_dir):
    """Links and components of vectors of a label at a cosine of 0.93 or more."""
    return cap_filters.linked_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def every_nth(column: str, n: int):
    """Whether the id's checksum has remainder 0; a null id's has not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n == 0, F.lit(False))


def toxicity_model(spark, docs: DataFrame, sf_dir: str) -> toxicity.Classifier:
    """Fitted on the labelled rows that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~every_nth("doc_id", 5))
    return toxicity.fit(docs, labels)


@query
def op5_counterfactual_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scores.select("doc_id", every_nth("doc_id", 5).alias("held_out"), "score", predicted)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op6_binary_records(spark, sf_dir):
    """The records of all documents, as read back from the files."""
    manifest = records.write_records(table(spark, sf_dir, "documents"), vocabulary(), end_id=1)
    return records.checksums(records.read_records(manifest))


@query
def op7_block_rules(spark, sf_dir):
    """Main text of every page."""
    found = blocks.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op8_source_mixing(spark, sf_dir):
    """What a mix of all documents takes of each, at sources' weights 5, 2, 1, 5, ..."""
    sizes = mixing.sized(table(spark, sf_dir, "documents"))
    taken = (F.col("reps") * F.col("size")).alias("taken")
    return mixing.mixture(sizes, mixing.plan_mix(sizes)).select("doc_id", "size", "source_size", "target", taken)


ORACLES["op8_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || SUBSTR(MD5(CONCAT_WS(':', '11', doc_id, text)), 1, 5))::BIGINT AS spot FROM documents),
s AS (
  SELECT *, CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3.0::DOUBLE AS cap
  FROM (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source)),
r AS (SELECT *, cap / weight AS r FROM s WHERE source_size > 0),
levels AS (
  SELECT a.r, SUM(CASE WHEN b.r < a.r THEN b.cap ELSE 0 END) AS held,
    SUM(CASE WHEN b.r >= a.r THEN b.weight ELSE 0 END) AS open_weight,
    SUM(CASE WHEN b.r <= a.r THEN b.cap ELSE a.r * b.weight END) AS reached
  FROM r a, r b GROUP BY a.source, a.r),
level AS (
  SELECT (t.total - held) / open_weight AS level FROM levels,
    (SELECT SUM(source_size)::DOUBLE AS total FROM s) t WHERE reached >= t.total ORDER BY levels.r LIMIT 1),
p AS (
  SELECT *, FLOOR(target / source_size + 1e-12)::BIGINT AS whole FROM (
    SELECT source, source_size, LEAST(cap, weight * level) AS target FROM s, level WHERE source_size > 0)),
g AS (SELECT *, GREATEST(0.0::DOUBLE, target - whole * source_size) AS goal FROM p),
coarse AS (
  SELECT *, SUM(size) OVER (PARTITION BY source ORDER BY high) AS upto FROM (
    SELECT source, spot // 1024 AS high, SUM(size) AS size FROM d GROUP BY ALL)),
picked AS (
  SELECT c.source, c.high, g.goal - c.upto + c.size AS rest,
    ROW_NUMBER() OVER (PARTITION BY c.source ORDER BY c.high) AS k
  FROM coarse c JOIN g ON c.source IS NOT DISTINCT FROM g.source WHERE c.upto > g.goal),
fine AS (
  SELECT *, SUM(size) OVER (PARTITION BY source ORDER BY low) AS upto FROM (
    SELECT d.source, a.high, a.rest, d.spot % 1024 AS low, SUM(d.size) AS size FROM d
    JOIN picked a ON a.k = 1 AND d.source IS NOT DISTINCT FROM a.source AND d.spot // 1024 = a.high GROUP BY ALL)),
cuts AS (
  SELECT source, MAX(high * 1024 + CASE WHEN upto - size / 2 < rest THEN low + 1 ELSE 0 END) AS cut FROM fine GROUP BY source)
SELECT d.doc_id, d.size, s.source_size, COALESCE(g.target, 0.0::DOUBLE) AS target,
  (d.size * (COALESCE(g.whole, 0) + CASE WHEN g.goal > 0 AND d.spot < COALESCE(c.cut, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source
LEFT JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""


@query
def op10_minhash_near_duplicates(spark, sf_dir):
    """Classes of documents linked by 85 % of their five-word shingles or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_repeated_passages(spark, sf_dir):
    """What is left of each document without words that 50-word windows of earlier ones hold."""
    found = automata.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op11_line_runs(spark, sf_dir):
    """What is left of each document without lines that an earlier one holds."""
    found = line_runs.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op11_line_runs"] = r"""
WITH s AS (SELECT doc_id, STRING_SPLIT(COALESCE(text, ''), CHR(10)) AS lines FROM documents),
l AS (SELECT doc_id, UNNEST(lines) AS line, GENERATE_SUBSCRIPTS(lines, 1) AS pos FROM s),
k AS (
  SELECT *, TRANSLATE(TRIM(line, CHR(32) || CHR(9) || CHR(10) || CHR(11) || CHR(12) || CHR(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, MIN(doc_id) AS holder FROM k WHERE LENGTH(key) >= 10 GROUP BY key HAVING COUNT(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, pos, line, COALESCE(k.doc_id <> r.holder, FALSE) AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
  SHA256(COALESCE(STRING_AGG(line, CHR(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op12_hybrid_ranked_search(spark, sf_dir):
    """The ten documents that rank highest for each benchmark item."""
    shards = lexical.index(table(spark, sf_dir, "documents"))
    return lexical.rank(shards, table(spark, sf_dir, "benchmark"), k=10)


ORACLES["op12_hybrid_ranked_search"] = r"""
WITH t AS (
  SELECT doc_id, ROW_NUMBER() OVER () AS row, UNNEST(REGEXP_EXTRACT_ALL(
    TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
f AS (SELECT row, doc_id, term, COUNT(*) AS tf FROM t GROUP BY ALL),
s AS (SELECT row, SUM(tf)::BIGINT AS n FROM f GROUP BY row),
c AS (SELECT COUNT(*) AS n_docs, SUM(n)::BIGINT AS n_terms FROM s),
w AS (
  SELECT term, FLOOR(1000 * LN((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term, n_docs),
q AS (
  SELECT item_id, UNNEST(REGEXP_EXTRACT_ALL(
    TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
x AS (SELECT item_id, term, COUNT(*) AS times FROM q GROUP BY ALL),
scored AS (
  SELECT item_id, row, doc_id,
    SUM(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM x JOIN w USING (term) JOIN f USING (term) JOIN s USING (row), c GROUP BY ALL),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query
def op13_token_alignment(spark, sf_dir):
    """How the ids of two tokenizers align over every document."""
    return alignment.aligned(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )
