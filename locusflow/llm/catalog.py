"""Registered queries of the operators over the test tables."""

from __future__ import annotations

import hashlib
import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from locusflow.llm import chat, codes, language, middle, mixing, neighbours, ngram_join, packing, paragraphs, pii, quality, tokens, topk
from locusflow.llm.shipping import ship
from locusflow.session import shared_dir

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word shingles and a Jaccard similarity of 0.9."""
    return ngram_join.document_components(table(spark, sf_dir, "documents"), 3, 90)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every 100th vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 98 % of the greatest entropy, within as many estimated tokens as there are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    size = mixing_size()
    whole = docs.agg(F.sum(size)).first()[0] or 0
    mixed = mixing.mix(docs.withColumn("n_tokens", size).drop("text"), F.col("n_tokens"), entropy=0.98, max_passes=4.0, budget=float(whole))
    return mixed.select("doc_id", "source", "n_tokens", "mix_pass", F.round("mix_at", 9).alias("mix_at"))


def mixing_size() -> Column:
    """Estimated tokens of a text: a quarter of its bytes, and one for its end."""
    return F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / 4) + 1


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every 20th vector over all vectors."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.train(docs)).drop("text")


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with an assistant's turn as the chosen one; rejected is the same with the last reply of the next id."""
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    formatted = chat.format_swapped(table(spark, sf_dir, "conversations"), F.col("conv_id") - 1)
    return formatted.withColumns({c: spans(c) for c in ("chosen_mask", "rejected_mask")})


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by a model of the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of paragraphs in all documents that repeat earlier ones."""
    found = paragraphs.repeated_passages(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_doc_ids", F.array_join("kept_doc_ids", ","))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, by a cache that begins empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cache = f"{shared_dir(spark)}/locusflow/token-cache-{uuid.uuid4().hex}"
    return tokens.count_tokens(docs, WORD_BPE, cache)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by codebooks of 256 entries for each of four parts."""
    made = codes.compress(table(spark, sf_dir, "embeddings"))
    entries = ",".join(str(c) for book in made.codebooks for entry in book for c in entry)
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.with_label_error(made.rows).select(
        F.col("id").alias("vec_id"), digits.alias("code"), "error", "label_error",
        F.lit(hashlib.sha256(entries.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at lines and rearranged, half of them suffix first."""
    made = middle.rearrange(table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    back = middle.restored(F.col("output"), F.col("form"))
    return made.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"),
    )


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs)
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _codes_sql(rounds: int = 4) -> str:
    """Codebooks of the vectors in SQL: the same steps, every part against every entry."""
    gap = "list_inner_product(x.e, x.e) - 2 * list_inner_product(x.e, c.e) + list_inner_product(c.e, c.e)"
    assign = f"SELECT x.p, x.vec_id, any_value(x.e) AS e, min(({gap})::BIGINT * 256 + c.k) AS best FROM parts x JOIN c{{0}} c ON x.p = c.p GROUP BY x.p, x.vec_id"
    steps = "".join(
        f"""a{r} AS MATERIALIZED ({assign.format(r)}),
        m{r} AS (SELECT p, best % 256 AS k, i, count(*) AS n, sum(e[i]::BIGINT)::BIGINT AS s FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM a{r}) GROUP BY ALL),
        n{r} AS (SELECT p, k, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY i) AS e FROM m{r} GROUP BY p, k),
        c{r + 1} AS MATERIALIZED (SELECT c.p, c.k, coalesce(n.e, c.e) AS e FROM c{r} c LEFT JOIN n{r} n USING (p, k)),
        """
        for r in range(rounds)
    )
    return f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
            SELECT vec_id, p, e[p * (len(e) // 4) + 1 : (p + 1) * (len(e) // 4)] AS e FROM v, range(4) t(p)
        ), c0 AS MATERIALIZED (
            SELECT p, k, e FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v ORDER BY vec_id LIMIT 256) USING (vec_id)
        ), {steps}last AS MATERIALIZED ({assign.format(rounds)}),
        rows AS (
            SELECT v.vec_id, any_value(v.label) AS label, string_agg(lpad(lower(hex(best % 256)), 2, '0'), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error
            FROM last JOIN v USING (vec_id) GROUP BY v.vec_id
        ), book AS (
            SELECT sha256(string_agg(x, ',' ORDER BY p, k)) AS codebooks_sha256 FROM (SELECT p, k, array_to_string(list_transform(e, lambda x: x::BIGINT), ',') AS x FROM c{rounds})
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM rows, book
    """


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_source_mixing": op4_source_mixing,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_pii": op6_pii,
    "op7_preferences": op7_preferences,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_language": op13_language,
}
ORACLE = {
    "op7_preferences": r"""
        WITH t AS (
            SELECT conv_id, list(struct_pack(role := r, text := t) ORDER BY turn NULLS FIRST, r, t) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id
        ), l AS (
            SELECT *, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS pos FROM t
        ), u AS (
            SELECT a.conv_id, g.conv_id AS giver, list_transform(range(1, len(a.turns) + 1), lambda i: struct_pack(role := a.turns[i].role,
                text := CASE WHEN i <> a.pos THEN a.turns[i].text ELSE coalesce(g.turns[g.pos].text, '') END)) AS turns
            FROM l a LEFT JOIN l g ON g.conv_id = a.conv_id + 1 AND g.pos IS NOT NULL WHERE a.pos IS NOT NULL
        ), p AS (
            SELECT a.conv_id AS chosen_id, b.giver AS rejected_id, a.turns AS a, b.turns AS b,
                coalesce(list_min(list_filter(range(1, least(len(a.turns), len(b.turns)) + 1), lambda i: a.turns[i] <> b.turns[i])) - 1,
                    least(len(a.turns), len(b.turns)))::INTEGER AS prefix_turns
            FROM t a JOIN u b USING (conv_id)
        ), q AS (
            SELECT chosen_id, rejected_id, prefix_turns, unnest([0, 1, 2]) AS kind, a, b FROM p
        ), turns AS (
            SELECT chosen_id, rejected_id, kind, i, u.role AS role,
                '<|im_start|>' || replace(u.role, '<|im_', '<| im_') || chr(10) AS head, replace(u.text, '<|im_', '<| im_') || '<|im_end|>' || chr(10) AS tail
            FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS u FROM (
                SELECT *, CASE kind WHEN 0 THEN a[1:prefix_turns] WHEN 1 THEN a[prefix_turns + 1:] ELSE b[prefix_turns + 1:] END AS x FROM q))
        ), placed AS (
            SELECT *, coalesce(sum(length(head) + length(tail)) OVER (PARTITION BY chosen_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM turns
        ), made AS (
            SELECT chosen_id, kind, string_agg(head || tail, '' ORDER BY i) AS text,
                string_agg((place + length(head)) || ':' || (place + length(head) + length(tail)), ',' ORDER BY i) FILTER (WHERE role = 'assistant') AS mask
            FROM placed GROUP BY ALL
        )
        SELECT chosen_id, rejected_id, prefix_turns, coalesce(m0.text, '') AS prompt, coalesce(m1.text, '') AS chosen, coalesce(m2.text, '') AS rejected,
            coalesce(m1.mask, '') AS chosen_mask, coalesce(m2.mask, '') AS rejected_mask
        FROM p LEFT JOIN (FROM made WHERE kind = 0) m0 USING (chosen_id) LEFT JOIN (FROM made WHERE kind = 1) m1 USING (chosen_id)
            LEFT JOIN (FROM made WHERE kind = 2) m2 USING (chosen_id)
    """,
    "op1_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END) AS g FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
        ), reach(doc_id, seen) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.seen = l.a
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
        FROM documents d JOIN reach r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
    """,
    "op11_vector_codes": _codes_sql(),
    "op12_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), l AS (
            SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
        ), c AS (
            SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l
        ), p AS (
            SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
        FROM p
    """,
    "op5_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
}
