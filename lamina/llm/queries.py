"""One query per operator on the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lamina.llm import bpe, langid, lattice, pq, secrets, sharding, simhash, spelling, templates, tokenbin, toxicity, trie, warc
from lamina.llm.common import ROW_KEY, id_bucket, row_key
from lamina.session import scratch_dir

SHARDS = 40
END_ID = 2

# Of documents, a fifth is held out from the language profiles and the toxicity models, and a tenth from the language model.
LANGUAGE_FOLDS = 5
TOXICITY_FOLDS = 5
MODEL_FOLDS = 10

# Turns of a conversation that its base replaces are counted modulo this number.
HEAD_FOLDS = 4


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles_of(docs: DataFrame) -> langid.Profiles:
    """Language profiles of the labelled documents that are not held out."""
    return langid.train(docs.filter(id_bucket("doc_id", LANGUAGE_FOLDS) != 0))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by hyperdimensional profiles."""
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, profiles_of(docs), ["doc_id"])
    return found.select(
        "doc_id", (id_bucket("doc_id", LANGUAGE_FOLDS) == 0).alias("held_out"), "lang_pred", "score"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document."""
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return pq.near_vectors(_table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, from the files."""
    docs = _table(spark, sf_dir, "documents")
    files = tokenbin.write_tokens(docs, _vocabulary("word_bpe_49k.json"), END_ID)
    return tokenbin.read_tokens(spark, files)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    docs = _table(spark, sf_dir, "documents")
    found = secrets.secret_spans(docs.select("doc_id", "text"))
    base = [rule.kind for rule in secrets.RULES if rule.base]
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in base]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select("doc_id", *counts, F.sha2(line(own), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row per document and item; texts that share an id are documents of their own."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    named = docs.withColumns(row_key("doc_id", "text"))
    return templates.contaminated(named, benchmark, ["doc_id", *ROW_KEY]).drop(*ROW_KEY)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, from the archives it was written to."""
    path = scratch_dir(spark, "warc")
    warc.write_warc(warc.as_records(_table(spark, sf_dir, "pages")), path)
    # The records that describe the archives are skipped, and payloads are checked where they are read, not handed on.
    read = warc.read_warc(spark, path, where={"warc_type": ("response", "revisit")}, payload=False)
    number = lambda c: F.element_at(F.split(c, ":"), -1).try_cast("long")
    return read.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.element_at(F.split("payload_digest", ":"), -1).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def round_trip(docs: DataFrame) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    vocabulary = _vocabulary("byte_bpe_50k.json")
    back = bpe.encode(docs, vocabulary, ["doc_id"], decoded=True)
    line = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(line, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return round_trip(_table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document."""
    docs = _table(spark, sf_dir, "documents")
    learn = id_bucket("doc_id", MODEL_FOLDS) != 0
    return lattice.score_texts(docs, learn, _vocabulary("piece_bpe_32k.model"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"), id_bucket("conv_id", HEAD_FOLDS))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(id_bucket("doc_id", TOXICITY_FOLDS) != 0))
    found = toxicity.score_toxicity(docs, model, ["doc_id"])
    return found.select("doc_id", (id_bucket("doc_id", TOXICITY_FOLDS) == 0).alias("held_out"), "score", "predicted")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that are one edit apart, and the frequent form of each rare one."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_sharding": op3_sharding,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_token_files": op5_token_files,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_bpe": op9_bpe,
    "op10_lm_score": op10_lm_score,
    "op11_trie": op11_trie,
    "op12_toxicity": op12_toxicity,
    "op13_spelling": op13_spelling,
    "pipeline": pipeline,
}

# Base32 has four letters for each five hexadecimal digits.
_BASE32 = "list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) % 32, 1)), 'string_agg', '')"

ORACLE: dict[str, str] = {
    "op8_warc": f"""
WITH pages_read AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first_id FROM pages_read)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
""",
    "op4_embedding_dedup": """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
least AS (SELECT u, min(v) AS component_id FROM reached GROUP BY u),
counted AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, least.component_id, e.vec_id = least.component_id AS kept
FROM embeddings e JOIN least ON least.u = e.vec_id LEFT JOIN counted c ON c.u = e.vec_id
""",
}
