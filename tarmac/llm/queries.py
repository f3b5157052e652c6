"""Registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (
    embedding_whitening,
    exact_dedup,
    language_id,
    language_model,
    ngram_join,
    packing,
    secrets,
    sentencepiece_scan,
    sharding,
    token_alignment,
    toxicity,
    vector_forest,
    warc_revisits,
)
from tarmac.llm.common import fold, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


@_query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentencepiece_scan.encode(table(spark, sf_dir, "documents"), model)
    digests = encoded.withColumn("n_ids", (F.octet_length("ids") / 4).cast("long")).withColumn("ids_crc32", F.crc32("ids"))
    return sentencepiece_scan.decode(digests, model).select(
        "doc_id", "chunks", "n_ids", "ids_crc32", (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("round_trip")
    )


@_query()
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@_query(
    """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents"))


@_query()
def op4_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_forest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def toxicity_model(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """The model that the query and the pipeline use: rows of fold 0 are held out."""
    return toxicity.train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))


@_query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("_row.doc_id").alias("doc_id"),
        (fold(F.col("_row.doc_id"), 5) == 0).alias("held_out"),
        "score",
        "predicted",
        F.size("offending").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("offending"),
    )


@_query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.joined("base"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"),
    )


# The end id after every document, as the packed format fixes it.
END_ID = 2


def packed_documents(docs: DataFrame) -> DataFrame:
    """Pieces of all documents with their places; ids are reduced to their checksum."""
    import public_tokenizers

    pieces = packing.tokenised_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@_query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Capture records of the pages: a full response of each, and a later not-modified revisit.

    Times follow the page ids.  Every fifth revisit names another entity tag, every seventh
    none at all.
    """
    html = F.coalesce("html", F.lit(""))
    tag, page = F.md5(html.cast("binary")), F.col("page_id")
    full = F.concat(
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html),
        F.lit('\r\nETag: "'), tag, F.lit('"\r\nServer: origin\r\nCache-Control: max-age=60'),
    )
    new_tag = F.when(page % 7 == 0, F.lit("")).when(page % 5 == 0, F.lit('ETag: "new"\r\n')).otherwise(
        F.concat(F.lit('ETag: W/"'), tag, F.lit('"\r\n'))
    )
    fresh = F.concat(F.lit("Content-Length: 0\r\n"), new_tag, F.lit("Cache-Control: max-age=3600\r\nAge: "), page % 50)
    start = F.lit(1_600_000_000) + page * 60
    digest = F.sha1(html.cast("binary"))
    columns = ("record_id", "url", "ts", "kind", "headers", "payload_digest")
    response = pages.select(*[c.alias(n) for n, c in zip(columns, (page * 2, F.col("url"), start, F.lit("response"), full, digest))])
    revisit = pages.select(
        *[c.alias(n) for n, c in zip(columns, (page * 2 + 1, F.col("url"), start + 30 + 86_400 * (page % 3), F.lit("revisit"), fresh, digest))]
    )
    return response.unionByName(revisit)


@_query(
    r"""
    WITH p AS (
      SELECT page_id, regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1) AS h,
             regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2) AS path,
             regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3) AS q,
             md5(coalesce(html, '')) AS tag, strlen(coalesce(html, '')) AS size,
             1600000000 + page_id * 60 AS t
      FROM pages),
    c AS (
      SELECT *, regexp_replace(regexp_replace(lower(h), '^([^@]*@)?(www\.)?', ''), ':(80|443)$', '')
                || regexp_replace(path, '/+$', '')
                || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(q, '&'),
                     lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|$)'))), '&'), ''), '')
                AS canonical_url
      FROM p),
    v AS (
      SELECT page_id * 2 + 1 AS record_id, canonical_url, tag, t + 30 + 86400 * (page_id % 3) AS ts, page_id,
             CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"new"' ELSE 'W/"' || tag || '"' END AS etag
      FROM c),
    j AS (
      SELECT v.*, c.page_id AS old, c.tag AS old_tag, c.size AS old_size
      FROM v ASOF LEFT JOIN c ON v.canonical_url = c.canonical_url AND v.ts > c.t),
    s AS (
      SELECT *, CASE WHEN old IS NULL THEN 'orphan'
                     WHEN etag IS NULL THEN CASE WHEN tag = old_tag THEN 'resolved' ELSE 'mismatch' END
                     WHEN replace(etag, 'W/', '') = '"' || old_tag || '"' THEN 'resolved' ELSE 'mismatch' END AS status
      FROM j)
    SELECT record_id, canonical_url, old * 2 AS resolved_id, status,
           CASE WHEN status = 'resolved' THEN
             'age: ' || (page_id % 50) || chr(10) || 'cache-control: max-age=3600' || chr(10) || 'content-length: ' || old_size
             || chr(10) || 'content-type: text/html; charset=utf-8' || chr(10) || 'etag: ' || coalesce(etag, '"' || old_tag || '"')
             || chr(10) || 'server: origin'
           ELSE
             'age: ' || (page_id % 50) || chr(10) || 'cache-control: max-age=3600' || chr(10) || 'content-length: 0'
             || coalesce(chr(10) || 'etag: ' || etag, '')
           END AS headers
    FROM s
    """
)
def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc_revisits.resolve(page_captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolved.withColumn("headers", F.array_join(lines, "\n"))


@_query()
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = language_model.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("trained_on")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language_id.train(docs.where(~held_out))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        F.col("_row.doc_id").alias("doc_id"),
        (fold(F.col("_row.doc_id"), 3) == 1).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


@_query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), *paths, digest=True)
    return aligned.select(
        F.col("_row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


@_query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = embedding_whitening.fit(rows)
    whitened = embedding_whitening.transform(rows.select("vec_id", "embedding"), model)
    error = embedding_whitening.identity_error(whitened, len(model.eigenvalues))
    explained = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    return whitened.select("_row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.rows).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
