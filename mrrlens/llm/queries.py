"""The operators with their production parameters, over the test tables in a folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.llm.dart_minhash import near_duplicates
from mrrlens.llm.decontamination import contaminated
from mrrlens.llm.divergence import source_divergence
from mrrlens.llm.inner_product_search import inner_product_search
from mrrlens.llm.kd_shards import kd_shards
from mrrlens.llm.labelled import id_remainder
from mrrlens.llm.language_cnn import fit_languages, identify_languages
from mrrlens.llm.line_dedup import dedup_lines
from mrrlens.llm.packing import pack_documents
from mrrlens.llm.quality_fm import fit_quality, score_quality
from mrrlens.llm.ranked_search import ranked_search
from mrrlens.llm.secret_ledger import RULES, SecretLedger, scan_secrets
from mrrlens.llm.simhash import simhash_components
from mrrlens.llm.storage import Scratch
from mrrlens.llm.toxicity_mil import fit_toxicity, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a document is kept from training; one without an id is."""
    return F.coalesce(id_remainder(F.col("doc_id"), modulus) == remainder, F.lit(True))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(4, 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit_quality(docs, table(spark, sf_dir, "labels").where(~out), metadata=("n_chars",))
    scored = score_quality(docs, model, score_column="score")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", out.alias("held_out"), "score", predicted)


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, keep_ids=False)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "found", "changed_slots")


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty ledger, so every content is new."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, SecretLedger(spark, Scratch(spark).folder))
    words = F.transform("secrets", lambda span: F.concat_ws(":", span["kind"], span["start"], span["end"]))
    kinds = F.transform("secrets", lambda span: span["kind"])

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda one: one == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in RULES]
    spans = F.array_join(words, ",")
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


def op7_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = fit_languages(docs.where(~held_out(5, 0)))
    found = identify_languages(docs.select("doc_id", "text"), network, score_column="score")
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op8_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(5, 0)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(~out))
    scored = score_toxicity(docs, model, score_column="score", spans_column="spans")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", out.alias("held_out"), "score", predicted, "spans")


def op9_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return inner_product_search(vectors, F.col("vec_id") % 20 == 0, best=20)


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = kd_shards(table(spark, sf_dir, "documents"), shards=16)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), best=10)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_fm": op2_quality_fm,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_language_cnn": op7_language_cnn,
    "op8_toxicity_mil": op8_toxicity_mil,
    "op9_inner_products": op9_inner_products,
    "op10_kd_shards": op10_kd_shards,
    "op11_divergence": op11_divergence,
    "op12_ranked_search": op12_ranked_search,
    "op13_simhash": op13_simhash,
}

ASSIGN = """(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

ORACLES: dict[str, str] = {
    "op6_secret_ledger": f"""
        WITH rules(place, kind, pattern, least) AS (
            VALUES (0, 'assign', '{ASSIGN}', 6), (1, 'access', '(AKIA[A-Z0-9]+)', 20), (2, 'hex', '([0-9a-f]{{24,}})', 24)
        ), texts AS (
            SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
        ), each AS (
            SELECT row_id, place, kind, least,
                unnest(list_transform(string_split_regex(text, pattern), lambda gap: length(gap))) AS gap,
                unnest(list_transform(regexp_extract_all(text, pattern, 0), lambda hit: length(hit))) AS width,
                unnest(list_transform(regexp_extract_all(text, pattern, 1), lambda key: length(key))) AS size,
                unnest(range(1, 1 + len(regexp_extract_all(text, pattern, 0)))) AS n
            FROM texts, rules
        ), spans AS (
            SELECT row_id, place, kind, least, size, width, sum(gap + width) OVER run - width AS start
            FROM each WHERE n IS NOT NULL WINDOW run AS (PARTITION BY row_id, place ORDER BY n)
        ), joined AS (
            SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                count(*) FILTER (kind = 'hex') AS n_hex,
                string_agg(kind || ':' || start::BIGINT || ':' || (start + width)::BIGINT, ',' ORDER BY start, place) AS spans
            FROM spans WHERE size >= least GROUP BY row_id
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
            coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN joined USING (row_id)
    """,
    "op9_inner_products": """
        WITH vectors AS (
            SELECT row_number() OVER () AS row_id, vec_id,
                list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.row_id AS query_row, q.vec_id AS query_id, c.vec_id, c.row_id,
                list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.row_id <> c.row_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, row_id) AS rank
            FROM scored
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op11_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                coalesce(text, '') AS text
            FROM documents
        ), words AS (
            SELECT row_id, lang, source, translate(
                unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ) AS term
            FROM docs
        ), kept AS (
            SELECT lang, term, count(*)::HUGEINT AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3
        ), counts AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), langs AS (
            SELECT lang, coalesce(sum(total), 0)::HUGEINT AS size, count(term)::HUGEINT AS v
            FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
        ), groups AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS size
            FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
        ), cells AS (
            SELECT lang, source, term, coalesce(n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (g.size + l.v) AS p,
                1 + (1000000000::HUGEINT * (k.total + 1)) // (l.size + l.v) AS q
            FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM cells WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        WHERE part = 'pair' OR rank <= 200
    """,
    "op12_ranked_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
            FROM documents
        ), held AS (
            SELECT row_id, doc_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term,
                count(*) AS tf
            FROM docs GROUP BY ALL
        ), lengths AS (
            SELECT row_id, sum(tf)::BIGINT AS n FROM held GROUP BY row_id
        ), everything AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths
        ), terms AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM held, everything GROUP BY term
        ), items AS (
            SELECT DISTINCT item_id, text, translate(
                unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ) AS term
            FROM benchmark
        ), scored AS (
            SELECT item_id, text, row_id, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length))))::BIGINT AS score
            FROM items JOIN terms USING (term) JOIN held USING (term) JOIN lengths USING (row_id), everything
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, row_id) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
