"""The ten operators' queries, with production parameters over whole tables."""

from __future__ import annotations

from textloom.llm import brown_lm, decontamination, exact_dedup, langid, mixing, pii, simhash, substring_dedup, tokenstore, toxicity
from textloom.llm.common import table

QUERIES = {
    "op1_language_id": lambda spark, d: langid.op1(table(spark, d, "documents")),
    "op2_substring_dedup": lambda spark, d: substring_dedup.op2(table(spark, d, "documents")),
    "op3_pii": lambda spark, d: pii.op3(table(spark, d, "documents")),
    "op4_decontamination": lambda spark, d: decontamination.op4(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op5_toxicity": lambda spark, d: toxicity.op5(table(spark, d, "documents"), table(spark, d, "labels")),
    "op6_token_store": lambda spark, d: tokenstore.op6(table(spark, d, "documents")),
    "op7_simhash": lambda spark, d: simhash.op7(table(spark, d, "documents")),
    "op8_exact_dedup": lambda spark, d: exact_dedup.op8(table(spark, d, "documents")),
    "op9_mixing": lambda spark, d: mixing.op9(table(spark, d, "documents")),
    "op10_brown_lm": lambda spark, d: brown_lm.op10(table(spark, d, "documents")),
}

ORACLE_SQL = {
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op4_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        p AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM p),
        x AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes)),
        m AS (SELECT doc_id, item_id, i, p.size FROM x JOIN p ON x.s = p.s AND x.size = p.size),
        h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM m) GROUP BY doc_id),
        k AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        x AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
        r AS (SELECT doc_id, i FROM x WHERE s IN (SELECT s FROM x GROUP BY s HAVING count(*) > 1)),
        g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
        v AS (SELECT doc_id, j, w[j] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d)),
        k AS (SELECT v.doc_id, count(*) AS n, string_agg(t, ' ' ORDER BY j) AS kept FROM v ANTI JOIN g ON v.doc_id = g.doc_id AND v.j = g.j GROUP BY v.doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
}
