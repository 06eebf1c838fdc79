"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm.common import table

SHARDS = [f"shard-{i:03d}" for i in range(256)]


def op1_near_duplicates(spark, sf_dir):
    from millrace.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    from millrace.llm.sharding import assign

    return assign(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], SHARDS)


def op3_substring_dedup(spark, sf_dir):
    from millrace.llm.substring import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


def op4_packing(spark, sf_dir):
    from millrace.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark, sf_dir):
    from millrace.llm.quality import classify, fit

    docs = table(spark, sf_dir, "documents")
    return classify(fit(docs, table(spark, sf_dir, "labels")), docs).select("doc_id", "lang", "perplexity", "threshold", "kept")


def op6_embedding_near_duplicates(spark, sf_dir):
    from millrace.llm.embeddings import embedding_near_duplicates

    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_pii(spark, sf_dir):
    from millrace.llm.pii import pii_report

    return pii_report(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark, sf_dir):
    from millrace.llm.secrets import secret_scan

    return secret_scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark, sf_dir):
    from millrace.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark, sf_dir):
    from millrace.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op11_byte_bpe(spark, sf_dir):
    """Every whole text of documents (null: empty) encoded by the public ranks, and its ids decoded."""
    import public_tokenizers

    from millrace.llm.bpe import digests, read_ranks

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op12_whitening(spark, sf_dir):
    """The first eight whitened components of every valid vector."""
    from millrace.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of the anchors (id divisible by 50) and their positives, over all valid vectors."""
    from millrace.llm.hardneg import mine, valid_rows

    rows = valid_rows(table(spark, sf_dir, "embeddings"), scale=256)
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % 50 == 0)


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_sharding, op3_substring_dedup, op4_packing, op5_quality_classifier, op6_embedding_near_duplicates, op7_pii, op8_secret_scan, op9_decontamination, op10_html_extraction,
                                op11_byte_bpe, op12_whitening, op13_hard_negatives)}

# Words in lower case, distinct five-word shingles (all words of a shorter item), exact containment.
_CONTAINED = """
WITH iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ish AS (SELECT DISTINCT item_id, least(len(w), 5) AS width, list_aggregate(w[i:i + least(len(w), 5) - 1], 'string_agg', ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM iw WHERE len(w) > 0)),
isz AS (SELECT item_id, count(*) AS n_item FROM ish GROUP BY item_id),
widths AS (SELECT DISTINCT width FROM ish),
dw AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents),
dsh AS (SELECT DISTINCT doc_id, text, width, list_aggregate(w[i:i + width - 1], 'string_agg', ' ') AS s
        FROM (SELECT doc_id, text, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM dw, widths WHERE len(w) >= width)),
m AS (SELECT doc_id, text, item_id, count(*) AS n_shared FROM dsh JOIN ish USING (width, s) GROUP BY doc_id, text, item_id)
SELECT doc_id, item_id, max(n_shared) AS n_shared, n_item, max(n_shared) / n_item AS containment
FROM m JOIN isz USING (item_id) WHERE n_shared >= 0.8 * n_item - 1e-9 GROUP BY doc_id, item_id, n_item
"""

_HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id AS other_id, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
      FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
h AS (SELECT anchor_id, positive_id, positive_score, s.other_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM h WHERE rank <= 3
"""

ORACLE_SQL: dict[str, str] = {"op9_decontamination": _CONTAINED, "op13_hard_negatives": _HARD_NEGATIVES}
