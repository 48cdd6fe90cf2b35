"""Queries of the operators that gather something from the whole corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import divergence, lm_score, pii, ranked
from .common import LOWER, UPPER, table


def op9_stupid_backoff(spark, sf_dir):
    """Trigram stupid-backoff score of every document under counts over all documents."""
    scored = lm_score.scores(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 5).alias("mean_log_score"))


#: Stands in for the secret that a user gives.
DEMONSTRATION_KEY = b"not a secret: replace by your own"


def op6_pii_surrogates(spark, sf_dir):
    """Every document with its personal data replaced by keyed surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, DEMONSTRATION_KEY)


def op12_source_divergence(spark, sf_dir):
    """How far the sources of each language differ, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_pii_surrogates": op6_pii_surrogates, "op9_stupid_backoff": op9_stupid_backoff, "op12_source_divergence": op12_source_divergence, "op13_ranked_search": op13_ranked_search}

ORACLES = {
    "op9_stupid_backoff": f"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
            FROM documents),
        words AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
        grams AS (
            SELECT r, i, w, lag(w) OVER d AS p, lag(w, 2) OVER d AS q FROM words WINDOW d AS (PARTITION BY r ORDER BY i)),
        one AS (SELECT w, count(*) AS c FROM grams GROUP BY w),
        two AS (SELECT p, w, count(*) AS c FROM grams WHERE i > 1 GROUP BY p, w),
        three AS (SELECT q, p, w, count(*) AS c FROM grams WHERE i > 2 GROUP BY q, p, w),
        total AS (SELECT greatest(1, count(*)) AS n FROM grams),
        scored AS (
            SELECT r, i,
                   CASE WHEN three.c >= 2 THEN ln(three.c::DOUBLE) - ln(ctx.c::DOUBLE)
                        ELSE (CASE WHEN i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END)
                             + CASE WHEN two.c >= 2 THEN ln(two.c::DOUBLE) - ln(before.c::DOUBLE)
                                    ELSE (CASE WHEN i > 1 THEN ln(0.4::DOUBLE) ELSE 0 END) + ln(one.c::DOUBLE) - ln(n::DOUBLE) END END AS s
            FROM grams g CROSS JOIN total
            JOIN one ON one.w = g.w
            LEFT JOIN one AS before ON before.w = g.p
            LEFT JOIN two ON two.p = g.p AND two.w = g.w
            LEFT JOIN two AS ctx ON ctx.p = g.q AND ctx.w = g.p
            LEFT JOIN three ON three.q = g.q AND three.p = g.p AND three.w = g.w),
        sums AS (SELECT r, sum(s) AS s FROM scored GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(s, 0), 3) AS log_score, round(coalesce(s, 0) / greatest(1, len(ws)), 5) AS mean_log_score
        FROM split LEFT JOIN sums USING (r)""",
    "op12_source_divergence": f"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
        groups AS (SELECT DISTINCT lang, source FROM d),
        found AS (SELECT lang, source, r, t, count(*) AS n FROM (SELECT lang, source, r, unnest(regexp_extract_all(t, '{divergence.TERM}')) AS t FROM d) GROUP BY ALL),
        kept AS (SELECT lang, t, sum(n)::BIGINT AS lang_n FROM found GROUP BY lang, t HAVING count(*) >= {divergence.LEAST_DOCS}),
        langs AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
        own AS (SELECT lang, source, t, sum(n)::BIGINT AS n FROM found SEMI JOIN kept USING (lang, t) GROUP BY ALL),
        totals AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM groups LEFT JOIN own USING (lang, source) GROUP BY ALL),
        grid AS (
            SELECT lang, source, t, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p, 1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v) AS q
            FROM totals JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN own USING (lang, source, t)),
        pair AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
                       FROM grid x JOIN grid y ON x.lang = y.lang AND x.t = y.t GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        term AS (SELECT lang, source, t AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM grid WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pair
        UNION ALL
        SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM term QUALIFY rank <= {divergence.TOP}""",
    "op13_ranked_search": f"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ranked.TERM}') AS ts FROM documents),
        sizes AS (SELECT r, doc_id, len(ts) AS n FROM split),
        totals AS (SELECT count(*) FILTER (n > 0) AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
        found AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM split) GROUP BY r, t),
        held AS (SELECT t, count(*) AS df FROM found GROUP BY t),
        asked AS (
            SELECT item_id, t, count(*) AS often
            FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ranked.TERM}')) AS t FROM benchmark) GROUP BY item_id, t),
        weighed AS (SELECT item_id, t, often * floor(1000.0::DOUBLE * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM asked JOIN held USING (t) CROSS JOIN totals),
        scored AS (
            SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
            FROM weighed JOIN found USING (t) JOIN sizes USING (r) CROSS JOIN totals GROUP BY item_id, r, doc_id)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INT AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
