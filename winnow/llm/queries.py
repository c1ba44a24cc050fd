"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import (
    crf,
    dart,
    heap_clusters,
    hmm,
    langid,
    means_tree,
    nbest,
    packing,
    quality,
    reversed_search,
    tokens,
    topk,
    winnowing,
)
from winnow.llm.shared import crc_mod, kept, table, whole_text, work_path

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    folder = work_path(spark, "token-files")
    documents = table(spark, sf_dir, "documents")
    tokens.write_tokens(documents, tokenizer_file("byte_bpe_50k.json"), folder)
    return tokens.digest(tokens.read_tokens(spark, folder))


def op6_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four best piece segmentations of every document, encoded and decoded."""
    return nbest.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op7_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the labels of a third of the keys are kept out."""
    documents = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = crf.score(documents, learn_toxicity(documents, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"), "spans"
    )


def learn_toxicity(documents: DataFrame, labels: DataFrame) -> crf.Field:
    return crf.fit(
        *crf.labelled_sample(documents, labels, "toxic", crf.SAMPLE_TOXIC, crf.SAMPLE_CLEAN)
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    documents = table(spark, sf_dir, "documents")
    pieces = packing.pieces_of(documents, tokenizer_file("word_bpe_49k.json"))
    return packing.pack(kept(pieces, "pieces"))


def op2_compression_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of the keys is kept out of the dictionaries."""
    documents = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    dictionaries = langid.learn_dictionaries(documents.where(~held_out))
    found = langid.identify(documents, dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document."""
    return dart.near_duplicates(table(spark, sf_dir, "documents"))


def op4_hidden_markov_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents; a seventh of the keys is held out."""
    documents = whole_text(table(spark, sf_dir, "documents"))
    documents = documents.withColumn("held_out", crc_mod("doc_id", 7) == 2)
    counts = kept(hmm.token_counts(documents.where("NOT held_out")), "counts")
    vocabulary = hmm.vocabulary(counts)
    blocks = hmm.token_blocks(documents, vocabulary)
    model = hmm.train(blocks, vocabulary)
    return hmm.score(blocks, counts, vocabulary, model)


def op5_segment_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best inner products of every fiftieth vector with all others."""
    return topk.top_of(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op9_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; the labels of a quarter of the keys are kept out."""
    documents = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    labels = table(spark, sf_dir, "labels").where(~held_out)
    vectors = quality.random_indexing(documents)
    net = quality.learn(documents, labels, "quality", vectors)
    scored = quality.score(documents, vectors, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return winnowing.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_means_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest found neighbours of every twentieth vector."""
    return means_tree.search(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op12_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all vectors after three rounds."""
    return heap_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty best documents for every benchmark item."""
    return reversed_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_compression_language_id": op2_compression_language_id,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_hidden_markov_model": op4_hidden_markov_model,
    "op5_segment_top_k": op5_segment_top_k,
    "op6_nbest_pieces": op6_nbest_pieces,
    "op7_crf_toxicity": op7_crf_toxicity,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_random_indexing_quality": op9_random_indexing_quality,
    "op10_winnowing": op10_winnowing,
    "op11_means_tree_neighbours": op11_means_tree_neighbours,
    "op12_heap_clusters": op12_heap_clusters,
    "op13_reversed_search": op13_reversed_search,
}


def _cluster_rounds(rounds: int) -> str:
    """The rounds of ``op12_heap_clusters`` as common table expressions."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS (
            SELECT v.row, v.vec_id, v.x, arg_min(c.cluster, (d, c.cluster)) AS cluster, min(d) AS distance
            FROM v, c{r} c, LATERAL (SELECT list_sum(list_transform(list_zip(v.x, c.x),
                lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d)
            GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""sums{r} AS (
            SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
            FROM near{r}, range(1, 65) AS t(i) GROUP BY ALL
        ), c{r + 1} AS (
            SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
                SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM sums{r} GROUP BY cluster
            ) m USING (cluster))""")
    return ", ".join(steps)


ORACLES: dict[str, str] = {
    "op3_dart_minhash": """
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'),
                lambda x: x <> '') AS words
            FROM documents WHERE doc_id IS NOT NULL
        ), grams AS (
            SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
            FROM split WHERE len(words) > 0
        ), bags AS (
            SELECT doc_id, array_to_string(words[i : i + 4], ' ') AS gram, count(*) AS n
            FROM grams GROUP BY ALL
        ), sizes AS (SELECT doc_id, sum(n) AS total FROM bags GROUP BY 1
        ), pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS common
            FROM bags x JOIN bags y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
            WHERE common >= 0.8 * (s.total + t.total - common) - 1e-9
            UNION ALL
            SELECT (SELECT min(doc_id) FROM split WHERE len(words) = 0), doc_id
            FROM split WHERE len(words) = 0
        ), reach AS (
            SELECT doc_id AS id, doc_id AS root FROM split
            UNION
            SELECT e.b, r.root FROM reach r
            JOIN (SELECT a, b FROM links UNION SELECT b, a FROM links) e ON e.a = r.id
        )
        SELECT id AS doc_id, min(root) AS group_id FROM reach GROUP BY 1
    """,
    "op5_segment_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                   AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_heap_clusters": f"""
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS (
            SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS INTEGER) AS cluster, x
            FROM v ORDER BY sha256('1:' || vec_id), x LIMIT 16
        ), {_cluster_rounds(heap_clusters.ROUNDS)}
        SELECT n.vec_id, n.cluster, n.distance,
               CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(n.distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM near{heap_clusters.ROUNDS} n JOIN c{heap_clusters.ROUNDS} c USING (cluster)
    """,
    "op13_reversed_search": r"""
        WITH words AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL
        ), sized AS (SELECT row, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0
        ), whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sized
        ), asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text,
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark) GROUP BY ALL
        ), held AS (
            SELECT row, doc_id, n, term, count(*) AS tf
            FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM sized)
            WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weighed AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole
        ), scored AS (
            SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf
                + 12 * (75 + (25 * n * docs) // all_terms)))) AS BIGINT) AS score
            FROM held JOIN weighed USING (term) JOIN asked USING (term), whole
            GROUP BY item_id, row, doc_id
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
