"""The numbered queries, one per operator, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltchurn.llm import ann, bpe, byte_bpe, filter_audit, fingerprints, jaccard, lines, packing, ranked_search, secret_scan, sql, tokens, toxicity, urls
from voltchurn.session import bound_batches, put_on_worker_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocab_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    put_on_worker_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_edited(docs, fingerprints.corpus_ranks(docs))


@query
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, then by its host's reputation.

    A labelled outcome is bad where ``labels.quality`` is 0 for the document of
    the page's id.
    """
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return urls.judge_urls(table(spark, sf_dir, "pages"), outcomes)


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over all documents, as counts and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.dedup_lines(docs, min_chars=10)
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, and the sentences (start:end) to blame."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, limit=0.3)
    blamed = F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
                         F.col("toxic").cast("int").alias("predicted"), F.array_join(blamed, ",").alias("offending"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked at a Jaccard similarity of 0.9 on 3-word shingles."""
    bound_batches(spark)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), num=90, den=100, words=3)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base, all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs).select("doc_id", "secret_spans")
    of = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secret_spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"),
                        secret_scan.span_list(F.col("secret_spans")).alias("spans"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over 512 tokens."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocab_path(), limit=512)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocab_path(), window=2048, end_id=1)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocab_path())


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the ranks of a many-language vocabulary and decoded again, as digests."""
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), vocab_path("byte_bpe_multi_50k.tiktoken"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from the documents of each language, under every order."""
    return filter_audit.audit_filters(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


ORACLES.update(op3_url_filter=sql.URL_FILTER, op4_line_dedup=sql.LINE_DEDUP, op12_filter_audit=sql.FILTER_AUDIT,
               op13_ranked_search=sql.RANKED_SEARCH)
