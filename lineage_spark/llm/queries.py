"""One registered query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.llm import (
    decontaminate, exact_dedup, html_extract, jaccard, lexical, license_scan, line_dedup, lm, mixing, quality, secrets, token_files, vector_codes)
from lineage_spark.llm.common import id_remainder
from lineage_spark.session import load

QUERIES, ORACLE = {}, {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150% of all documents takes of each document."""
    mix = mixing.Mix(load(spark, sf_dir, "documents"), total=1.5, cap=2.0)
    return mix.per_document().select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "n_draws", "n_shards")


@_query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the base patterns and the random strings that the Markov models add."""
    docs = load(spark, sf_dir, "documents")
    model = secrets.train(secrets.random_strings(spark).union(secrets.ordinary_identifiers(docs)))
    found = secrets.find_secrets(docs.select("doc_id", "text"), model)
    base, spans = F.col("base_spans"), F.col("all_spans")
    return found.select(
        "doc_id", *[secrets.count_of(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"), secrets.as_text(spans).alias("spans"))


@_query
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    join = jaccard.JaccardJoin(load(spark, sf_dir, "documents"), n=4, percent=85)
    return join.per_document().withColumnRenamed("key", "doc_id")


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose key is in at least 10 documents."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE["op4_line_dedup"] = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), split AS (
  SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM split
), gone AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10
), flagged AS (
  SELECT keyed.*, gone.k IS NOT NULL AS dropped FROM keyed LEFT JOIN gone ON keyed.k = gone.k
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM flagged GROUP BY r
"""


@_query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document; those with crc32 mod 7 = 2 are held out of training."""
    docs = load(spark, sf_dir, "documents")
    remainder = id_remainder(docs["doc_id"], 7)
    trie = lm.train(docs.where(remainder != 2))
    rows = docs.select(F.struct("doc_id", (remainder == 2).alias("held_out")).alias("id"), "text")
    return lm.scored(rows, trie, key="id").select("id.*", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document: one row per line that carries one."""
    docs, notices = load(spark, sf_dir, "documents"), license_scan.templates(spark)
    model = license_scan.train(license_scan.samples(spark, docs), notices)
    return license_scan.find_licenses(docs, model, notices).withColumnRenamed("key", "doc_id")


@_query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of ids with crc32 mod 5 = 0 are held out of training."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(id_remainder(labels["doc_id"], 5) != 0))
    held = (id_remainder(docs["doc_id"], 5) == 0).alias("held_out")
    return quality.scored(docs.select("doc_id", held, "text"), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@_query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of every document; the largest doc_id of a group stays."""
    return exact_dedup.exact_duplicates(load(spark, sf_dir, "documents"), keep="max")


ORACLE["op8_exact_dedup"] = """
WITH digests AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS d
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY d) AS keep_id, count(*) OVER (PARTITION BY d) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY d) AS kept, d AS text_sha256
FROM digests
"""


@_query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = load(spark, sf_dir, "pages")
    labeller = html_extract.train(pages)
    return html_extract.extracted(pages.select("page_id", "url", "html"), labeller, out="text").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: one row per document and item."""
    found = decontaminate.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "cosine", "lcs_share", "answer_share")


@_query
def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item by the words they share."""
    index = lexical.build(load(spark, sf_dir, "documents"))
    return lexical.search(index, load(spark, sf_dir, "benchmark"), k=10)


ORACLE["op11_search"] = r"""
WITH terms AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), postings AS (
  SELECT r, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM terms GROUP BY r, term
), lens AS (
  SELECT r, sum(tf)::BIGINT AS n FROM postings GROUP BY r
), totals AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lens
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, totals GROUP BY term
), items AS (
  SELECT row_number() OVER () AS q, item_id, text FROM benchmark
), asked AS (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM items
), scored AS (
  SELECT q, item_id, r, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lens USING (r), totals GROUP BY q, item_id, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def word_tokenizer() -> str:
    """The tokenizer file of the query; it is installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files in ascending doc_id order, and what is read back from them."""
    files = token_files.write(load(spark, sf_dir, "documents"), word_tokenizer(), end_id=1)
    return files.documents()


@_query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings after four rounds, their errors and the codebooks' digest."""
    codes = vector_codes.compress(load(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    rows = vector_codes.with_label_error(codes.rows).withColumn("codebooks_sha256", F.lit(codes.sha256()))
    return rows.select(F.col("key").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """Lloyd rounds spelt out, one after another; only for lengths that ``parts`` divides."""
    ctes = [f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS (
  SELECT r, p, v[(p * (len(v) // {parts}) + 1):((p + 1) * (len(v) // {parts}))] AS x FROM kept, unnest(range({parts})) AS t(p)
), b0 AS (
  SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {entries}
)"""]
    for t in range(rounds + 1):
        ctes.append(f"""a{t} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT * {entries} + e) AS k
  FROM cut JOIN b{t} USING (p) GROUP BY r, p
)""")
        if t < rounds:
            ctes.append(f"""m{t} AS (
  SELECT p, k % {entries} AS e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{t}
), n{t} AS (
  SELECT p, e, list(y ORDER BY i) AS c FROM (SELECT p, e, i, floor(sum(y) / count(*))::BIGINT AS y FROM m{t} GROUP BY p, e, i) GROUP BY p, e
), b{t + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n{t}.c, b{t}.c) AS c FROM b{t} LEFT JOIN n{t} USING (p, e)
)""")
    return "WITH " + ", ".join(ctes) + f""", coded AS (
  SELECT r, string_agg(printf('%02x', k % {entries}), '' ORDER BY p) AS code, sum(k // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


ORACLE["op13_vector_codes"] = _codes_sql(4, 256, 4)
