"""The operators as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from paywarden.llm import (
    bpe, decontam, manifest, neardup, pages, quality, repeats, rollup, rules, search, secrets, simhash, suffixtree)
from paywarden.llm.common import shared_folder, table


def op1_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))


def op2_neardup(spark, sf_dir):
    return neardup.classes(table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    """Spans after two batches, each of one half of the versions, and the second once more."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "ledger")
    half = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 2
    secrets.update(docs.filter(half == 0), folder, "0")
    for _ in range(2):
        ledger = secrets.update(docs.filter(half == 1), folder, "1")
    return secrets.digest(secrets.findings(docs, ledger))


def op4_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_rules(spark, sf_dir):
    return rules.verdicts(table(spark, sf_dir, "documents"))


def op6_decontam(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "benchmark"))


def op7_repeats(spark, sf_dir):
    return repeats.remove(table(spark, sf_dir, "documents"))


def op8_lm(spark, sf_dir):
    return suffixtree.language_model_scores(table(spark, sf_dir, "documents"))


def op9_pages(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


def op10_rollup(spark, sf_dir):
    """Token totals after a load, a recount of every document, and deletions.

    The load comes with a guess from the length; the recount revises it by the true count;
    documents without a token are deleted. The recount is committed twice, as after a crash.
    """
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "rollup")
    versions = F.array(*(F.struct(F.lit(v).alias("tokenizer"), rollup.n_tokens("text", v).alias("n"))
                         for v in rollup.TOKENIZERS))
    guess = F.coalesce(F.octet_length("text"), F.lit(0)) / 4
    counted = docs.select("source", "lang", F.floor(guess).alias("guess"),
                          F.explode(versions).alias("v"))
    counted = counted.select("source", "lang", "v.tokenizer", "guess", F.col("v.n").alias("n"))
    keys = list(rollup.KEYS)
    load = docs.select("source", "lang", F.floor(guess).alias("n_tokens"), F.lit("insert").alias("op"),
                       F.explode(F.array(*map(F.lit, rollup.TOKENIZERS))).alias("tokenizer"))
    rollup.commit(load.withColumn("old_n_tokens", F.lit(None).cast("long")), folder, "load")
    recount = counted.select(*keys, F.lit("revise").alias("op"), F.col("n").alias("n_tokens"),
                             F.col("guess").alias("old_n_tokens"))
    gone = counted.filter("n = 0").select(*keys, F.lit("delete").alias("op"),
                                          F.col("n").alias("n_tokens"),
                                          F.lit(None).cast("long").alias("old_n_tokens"))
    for _ in range(2):
        rollup.commit(recount.unionByName(gone), folder, "recount", replace=False)
    return rollup.totals(spark, folder)


def op11_simhash(spark, sf_dir):
    return simhash.classes(table(spark, sf_dir, "documents"))


def op12_search(spark, sf_dir):
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_manifest(spark, sf_dir):
    return manifest.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_neardup, op3_secrets, op4_quality, op5_rules, op6_decontam, op7_repeats, op8_lm, op9_pages,
    op10_rollup, op11_simhash, op12_search, op13_manifest)}

_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[""'']?\x20*[:=]\x20*[""'']?([A-Za-z0-9+/_.=-]+)""".replace('""', '"')


def _matches(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, {least} AS least,
        regexp_extract_all(t, '{pattern}', 0) AS w, regexp_extract_all(t, '{pattern}', {group}) AS g,
        regexp_split_to_array(t, '{pattern}') AS p FROM d"""


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# DuckDB SQL of those that SQL expresses.
ORACLE: dict[str, str] = {
    "op3_secrets": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({_matches("assign", 0, _ASSIGN, 2, 6)}
            UNION ALL {_matches("access", 1, "(AKIA[A-Z0-9]+)", 1, 20)}
            UNION ALL {_matches("hex", 2, "([0-9a-f]{{24,}})".replace("{{", "{").replace("}}", "}"), 1, 24)}),
        spans AS (SELECT doc_id, kind, rank, length(w[i]) AS n, length(g[i]) >= least AS good,
            CAST(list_sum(list_transform(p[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
            FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM found WHERE len(w) > 0)),
        per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
            count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
            string_agg(concat(kind, ':', s, ':', s + n), ',' ORDER BY s, rank) AS spans
            FROM spans WHERE good GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
            coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
            coalesce(spans, '') AS spans FROM d LEFT JOIN per USING (doc_id)""",
    "op6_decontam": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
        iw AS (SELECT DISTINCT item, least(len(w), 10) AS size,
            array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
        dw AS (SELECT doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k
                FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
        hit AS (SELECT doc_id, k, size, item FROM dw JOIN iw USING (size, win)),
        words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
            coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_rollup": r"""
        WITH counted AS (
          SELECT source, lang, 'words-1' AS tokenizer,
                 len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS n
          FROM documents
          UNION ALL
          SELECT source, lang, 'pieces-1',
                 len(regexp_extract_all(coalesce(text, ''), '\p{L}+|\p{N}+|[^ 	-
\p{L}\p{N}]+'))
          FROM documents)
        SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs,
               CAST(sum(n) AS BIGINT) AS n_tokens
        FROM counted WHERE n > 0 GROUP BY ALL""",
    "op12_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
        total AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
        wanted AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest(t) AS term FROM i) GROUP BY ALL),
        tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d)
            GROUP BY ALL),
        df AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, total GROUP BY term, n_docs),
        part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))
            AS value FROM tf JOIN df USING (term), total),
        score AS (SELECT item_id, doc_id, CAST(sum(k * value) AS BIGINT) AS score
            FROM wanted JOIN part USING (term) GROUP BY ALL)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM score WHERE score > 0) WHERE rank <= 10""",
    # The checksum by its polynomial, a bit at a time; trees level by level in runs of eight.
    "op13_manifest": r"""
        WITH RECURSIVE field AS (SELECT *, crc % 3 = 0 AS tampered FROM (
            SELECT doc_id, lang, text, concat(
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                xor(4294967295, list_reduce(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ord(c)::BIGINT),
                    lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0],
                        lambda x, y: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT)) AS crc
            FROM documents)),
        leaves AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS other
            FROM (SELECT *, CASE WHEN tampered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') ELSE text END AS t FROM field)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS n FROM leaves),
        tree AS (SELECT lang, 0 AS level, pos, n, leaf AS digest FROM placed
            UNION ALL
            SELECT lang, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
            FROM tree WHERE n > 1 GROUP BY lang, level, pos // 8, n),
        sub AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
            count(*) OVER () AS n FROM tree WHERE n = 1),
        top AS (SELECT 0 AS level, pos, n, subroot AS digest FROM sub
            UNION ALL
            SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
            FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
        height AS (SELECT lang, max(level) AS h FROM tree GROUP BY lang),
        -- One tree a language: its own levels, then those over the languages.
        node AS (SELECT lang, level, pos, digest FROM tree WHERE n > 1
            UNION ALL
            SELECT lang, h + level, pos, digest FROM height, top WHERE n > 1),
        way AS (SELECT p.doc_id, p.pos AS leaf_pos, p.lang, 0 AS level, p.pos, p.other AS mine, '' AS told FROM placed p
            UNION ALL
            SELECT w.doc_id, w.leaf_pos, w.lang, w.level + 1,
                CASE WHEN w.level + 1 = h.h THEN any_value(s.pos) ELSE w.pos // 8 END,
                sha256(string_agg(CASE WHEN x.pos = w.pos THEN w.mine ELSE x.digest END, '' ORDER BY x.pos)),
                w.told || coalesce(string_agg(x.digest, '' ORDER BY x.pos) FILTER (x.pos <> w.pos), '')
            FROM way w JOIN height h ON w.lang IS NOT DISTINCT FROM h.lang JOIN sub s ON w.lang IS NOT DISTINCT FROM s.lang
                JOIN node x ON w.lang IS NOT DISTINCT FROM x.lang AND w.level = x.level
                    AND x.pos // 8 = (CASE WHEN w.level = h.h THEN s.pos ELSE w.pos END) // 8
            GROUP BY w.doc_id, w.leaf_pos, w.lang, w.level, w.pos, w.mine, w.told, h.h)
        SELECT p.doc_id, p.leaf, s.subroot, t.digest AS root, sha256(w.told) AS proof_sha256,
            w.mine AS folded_root, w.mine = t.digest AS verified
        FROM placed p JOIN sub s ON p.lang IS NOT DISTINCT FROM s.lang, (SELECT digest FROM top WHERE n = 1) t, (
            SELECT lang, leaf_pos, arg_max(mine, level) AS mine, arg_max(told, level) AS told FROM way GROUP BY ALL) w
        WHERE w.lang IS NOT DISTINCT FROM p.lang AND w.leaf_pos = p.pos""",
}
