"""Queries that apply the operators to the test tables, with their settings for production, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytecnn, merkle, pii, rules, toxicity
from .bpe import round_trips
from .cluster import documents, frozen, prepare
from .exact import exact_duplicates, keyed, lowered
from .licenses import joined, licenses
from .minhash import near_duplicates
from .packing import packed
from .pagetext import extracted
from .urls import BLOCKED_WORDS, block_list, judge_urls
from .whitening import components


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.fit(docs, labels(spark, sf_dir))).drop("n_sentences")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(keyed(documents(spark, sf_dir))).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = frozen(rules.measured(documents(spark, sf_dir)))
    return rules.judged(found, rules.bands_of(found, labels(spark, sf_dir)))


def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return bytecnn.scored(docs, bytecnn.fit(docs, labels(spark, sf_dir)))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = frozen(pii.spans_of(docs, pii.trained(docs)))
    return pii.listed(found, pii.least_margins(found))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), blocked=block_list(spark)).drop("listed")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses(documents(spark, sf_dir))
    base, starts = F.col("base.label"), F.col("base.start")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.array_union(base, F.col("detections.label"))).alias("labels"),
        "score",
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all rows; rows in three by their id are checked against a text that was lower-cased after the manifest was made."""
    docs, rest = documents(spark, sf_dir), ("doc_id", "source", "lang", "n_chars")
    own, changed = (merkle.leaf(*map(F.col, rest), text) for text in (F.col("text"), lowered(F.col("text"))))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select(F.col("lang").alias("tree"), F.col("doc_id").alias("key"), own.alias("digest"), F.when(tampered, changed).otherwise(own).alias("claimed"))
    proofs = merkle.manifest(leaves).proofs()
    folded = proofs.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("steps")))
    return folded.select(F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_ALL = (
    op1_toxicity,
    op2_byte_bpe,
    op3_exact_dedup,
    op4_packing,
    op5_html,
    op6_quality_rules,
    op7_quality_cnn,
    op8_pii,
    op9_url_filters,
    op10_minhash,
    op11_licenses,
    op12_whitening,
    op13_merkle,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return f(spark, sf_dir)

        return run

    return {f.__name__: ready(f) for f in _ALL}


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""

#: The default list of words is a parameter of the query, so it is one of the SQL as well.
OP9_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
cut AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(host, path, says) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
                                   ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
fit AS (SELECT c.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.says, length(r.host || r.path)) AS says
        FROM cut c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path) GROUP BY 1)
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.says, CASE WHEN list_has_any(string_split_regex(c.host, '[^a-z0-9]+'), {list(BLOCKED_WORDS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM cut c LEFT JOIN fit f USING (page_id)
"""


#: Every page of the tables marks its article, so for them the main text is what stands between the marks, without scripts and
#: tags, character references decoded. The operator finds it by ratios, and without the mark as well (tests).
OP5_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?is)<article[^>]*>(.*)</article>', 1) AS t FROM pages),
plain AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(t, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
                 '(?i)</?(a|b|i|u|em|strong|span|code|small|sub|sup)(\s[^>]*)?>', '', 'g'), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g') AS t FROM a),
told AS (SELECT page_id, url, regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&nbsp;?', ' ', 'g'), '&#x27;', ''''), '&#39;', ''''), '&amp;?', '&', 'g') AS t FROM plain),
done AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM told)
SELECT page_id, url, text, length(text) AS n_chars FROM done
"""


#: All pairs of texts that share a shingle, compared on their whole sets, and everything reachable by links.
OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                   ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) END AS sh FROM w),
c AS MATERIALIZED (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
x AS MATERIALIZED (SELECT rep, n, unnest(sh) AS g FROM c),
l AS MATERIALIZED (SELECT a, b FROM (SELECT p.rep AS a, q.rep AS b, count(*) AS same, any_value(p.n) + any_value(q.n) AS n FROM x p JOIN x q ON p.g = q.g AND p.rep <> q.rep GROUP BY 1, 2) WHERE 100 * same >= 85 * (n - same)),
reach(rep, r) AS (SELECT rep, rep FROM c UNION SELECT reach.rep, l.b FROM reach JOIN l ON reach.r = l.a),
best AS (SELECT rep, min(r) AS component FROM reach GROUP BY 1),
of_class AS (SELECT sh, component FROM c JOIN best USING (rep))
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(o.component, s.doc_id) AS component_id, s.doc_id = coalesce(o.component, s.doc_id) AS kept FROM s LEFT JOIN of_class o ON s.sh = o.sh
"""


#: CRC-32 of a short text, bit by bit.
_CRC32 = "xor(list_reduce(list_transform(string_split({}, ''), lambda s: ord(s)::BIGINT), lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT)"

#: Trees and proofs level by level: nodes are grouped by eight, proofs and folded roots climb from the leaves.
OP13_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                       text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, coalesce({_CRC32.format('doc_id::VARCHAR')} % 3 = 0, FALSE) AS tampered FROM documents),
leaves AS MATERIALIZED (SELECT r, doc_id, lang, coalesce(lang, '') || CASE WHEN lang IS NULL THEN '0' ELSE '1' END AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                       sha256(head || coalesce(CASE WHEN tampered THEN strlen(low) || ':' || low ELSE strlen(text) || ':' || text END, '-')) AS claimed FROM d),
nodes AS (SELECT tree, lang, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest, r FROM leaves
          UNION ALL SELECT tree, any_value(lang), level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)), NULL FROM nodes WHERE n > 1 GROUP BY tree, level, i // 8),
subroots AS MATERIALIZED (SELECT tree, level AS height, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, i, n, digest FROM subroots UNION ALL SELECT level + 1, i // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 8),
runs AS MATERIALIZED (SELECT tree, level, i, i // 8 AS parent, digest FROM nodes WHERE n > 1 UNION ALL SELECT s.tree, s.height + t.level, t.i, t.i // 8, t.digest FROM subroots s CROSS JOIN tops t WHERE t.n > 1),
climb AS (SELECT n.r, n.tree, 0 AS level, n.i, l.claimed AS folded, '' AS proof FROM nodes n JOIN leaves l USING (r) WHERE n.level = 0
          UNION ALL SELECT c.r, c.tree, c.level + 1, CASE WHEN c.level + 1 = any_value(s.height) THEN any_value(s.i) ELSE any_value(u.parent) END,
                           sha256(string_agg(CASE WHEN u.i = x.i THEN c.folded ELSE u.digest END, '' ORDER BY u.i)), any_value(c.proof) || string_agg(CASE WHEN u.i = x.i THEN '' ELSE u.digest END, '' ORDER BY u.i)
          FROM climb c JOIN subroots s USING (tree), LATERAL (SELECT CASE WHEN s.height = c.level AND c.level = 0 THEN s.i ELSE c.i END AS i) x JOIN runs u ON u.tree = c.tree AND u.level = c.level AND u.parent = x.i // 8
          GROUP BY c.r, c.tree, c.level)
SELECT l.doc_id, l.leaf, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = (SELECT digest FROM tops WHERE n = 1) AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN (SELECT r, max_by(proof, level) AS proof, max_by(folded, level) AS folded FROM climb GROUP BY r) c USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op5_html": OP5_SQL, "op9_url_filters": OP9_SQL, "op10_minhash": OP10_SQL, "op13_merkle": OP13_SQL}
