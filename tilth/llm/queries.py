"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm import caps, centroids, cotrain, langid, line_rules, merkle, mixing, ngram_trie, notices, packing, suffix_dedup, token_files
from tilth.llm.common import table, written
from tilth.llm.simhash import simhash_classes

BPE, BPE_RANKS, MULTI = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"))


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = langid.held_out(F.col("doc_id"), 7, 2)
    docs = table(spark, sf_dir, "documents").withColumn("train", ~held_out)
    return ngram_trie.lm_scores(docs, "train").withColumn("held_out", held_out)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat token files, and each one's tokens counted between end marks."""
    store = written(token_files.write_tokens(table(spark, sf_dir, "documents"), BPE, BPE_RANKS), "token-files")
    return token_files.token_counts(store)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_rules.line_first(docs, furniture=line_rules.furniture_lines(docs)).drop("cleaned")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), BPE, BPE_RANKS))


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.cosine_classes(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"), 4, 2)
    models = langid.learn(docs.where(~held_out), MULTI)
    return langid.predict(docs, models, MULTI).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


def op11_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


def op13_licence_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.licence_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_trie": op1_ngram_trie,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_source_mix": op4_source_mix,
    "op5_cotraining": op5_cotraining,
    "op6_line_rules": op6_line_rules,
    "op7_packing": op7_packing,
    "op8_cap_filters": op8_cap_filters,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_bisector_clusters": op11_bisector_clusters,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_licence_notices": op13_licence_notices,
}
def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
      m{r} AS MATERIALIZED (SELECT vec_id, cluster, dist FROM (
          SELECT vec_id, cluster, sum((x - c) * (x - c)) AS dist FROM cells JOIN c{r} USING (d) GROUP BY vec_id, cluster)
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""
      c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, c{r}.d, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM c{r}
        LEFT JOIN (SELECT cluster, d, sum(x) AS s, count(*) AS n FROM cells JOIN m{r} USING (vec_id) GROUP BY cluster, d) t
        ON t.cluster = c{r}.cluster AND t.d = c{r}.d)""")
    return f"""
      WITH kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      cells AS MATERIALIZED (SELECT vec_id, generate_subscripts(e, 1) AS d, unnest(e) AS x FROM kept),
      c0 AS MATERIALIZED (SELECT cluster, generate_subscripts(e, 1) AS d, unnest(e) AS c FROM (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, e FROM kept QUALIFY cluster < {k})),
      {",".join(steps)},
      hashes AS (SELECT cluster, sha256(string_agg(CAST(c AS BIGINT), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
      SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
        CAST(sum(dist) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
      FROM m{rounds} JOIN hashes USING (cluster)"""


#: The runs of a level: n nodes of a group become n / 16 (rounded up) until one is left.
_LEVEL_SQL = """SELECT lvl + 1, grp, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM {0} WHERE n > 1 GROUP BY lvl, grp, idx // 16, n"""
_MERKLE_SQL = f"""
      WITH RECURSIVE docs AS (SELECT doc_id, source, text, lang, n_chars, list_reduce(
          list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)),
          lambda crc, b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, b)), 4294967295::BIGINT) AS crc FROM documents),
      claims AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim FROM docs),
      told AS (SELECT *, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM claims),
      leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
          sha256(head || coalesce(strlen(claim) || ':' || claim, '-')) AS claimed FROM told),
      placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
      trees(lvl, grp, idx, n, digest) AS (SELECT 0, grp, idx, n, leaf FROM placed UNION ALL {_LEVEL_SQL.format("trees")}),
      roots AS MATERIALIZED (SELECT grp, lvl AS top, digest, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM trees WHERE n = 1),
      tops(lvl, grp, idx, n, digest) AS (SELECT 0, '', idx, n, digest FROM roots UNION ALL {_LEVEL_SQL.format("tops")}),
      root AS (SELECT digest FROM tops WHERE n = 1),
      sides AS MATERIALIZED (SELECT upper, lvl, grp, idx, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
          coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM (SELECT false AS upper, * FROM trees WHERE n > 1 UNION ALL SELECT true, * FROM tops WHERE n > 1)
        WINDOW w AS (PARTITION BY upper, lvl, grp, idx // 16 ORDER BY idx)),
      steps AS MATERIALIZED (SELECT p.doc_id, s.lvl AS step, l, r FROM placed p JOIN sides s ON NOT s.upper AND s.grp = p.grp AND s.idx = p.idx // CAST(pow(16, s.lvl) AS BIGINT)
        UNION ALL SELECT p.doc_id, 100 + s.lvl, l, r FROM placed p JOIN roots q ON q.grp = p.grp JOIN sides s ON s.upper AND s.idx = q.idx // CAST(pow(16, s.lvl) AS BIGINT)),
      proofs AS (SELECT doc_id, list(l ORDER BY step) AS ls, list(r ORDER BY step) AS rs, string_agg(l || r, '' ORDER BY step) AS proof FROM steps GROUP BY doc_id),
      folds(doc_id, step, digest) AS (SELECT doc_id, 1, claimed FROM leaves
        UNION ALL SELECT f.doc_id, f.step + 1, sha256(ls[f.step] || f.digest || rs[f.step]) FROM folds f JOIN proofs p ON p.doc_id = f.doc_id WHERE f.step <= len(ls)),
      ends AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM folds GROUP BY doc_id)
      SELECT p.doc_id, p.leaf, q.digest AS subroot, root.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root.digest AS verified
      FROM placed p JOIN roots q ON q.grp = p.grp JOIN ends e ON e.doc_id = p.doc_id LEFT JOIN proofs f ON f.doc_id = p.doc_id, root"""

#: The others rest on learned models, tokenizers, hashes or on text work that is too slow in SQL; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op8_cap_filters": """
      WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL),
      sound AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
      links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
        AND CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END),
      reach AS (SELECT vec_id AS u, vec_id AS low FROM v UNION SELECT l.u, r.low FROM reach r JOIN links l ON l.w = r.u),
      found AS (SELECT u, min(low) AS component_id FROM reach GROUP BY u),
      counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
      SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
      FROM v JOIN found f ON f.u = vec_id LEFT JOIN counts c ON c.u = vec_id""",
    "op11_bisector_clusters": _clusters_sql(),
    "op12_merkle_manifest": _MERKLE_SQL,
}
