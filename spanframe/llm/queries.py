"""Queries that apply the operators, with production parameters, to the driver tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` holds
the DuckDB twin where SQL can express the whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, fill_middle, fingerprints, language, licenses, line_dedup, merkle, mixing, near_dedup, quality,
               secret_scan, substring_dedup, url_filter)
from .common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = [F.coalesce(r.rejects, F.lit(False)) for r in quality.base_rules()]
    return d.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"), F.col("_n_dup_lines").alias("n_dup_lines"),
        F.col("_n_repeat_words").alias("n_repeat_words"), (failed[0] | failed[1]).alias("base_failed"),
        F.col("_kept").alias("kept"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(*mixing.mix(table(spark, sf_dir, "documents"))) \
        .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    places = F.filter("_findings", lambda f: f["kind"] == "phrase")
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(found["label"])), ",")
    return d.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.size(places).cast("long").alias("n_base"),
        F.array_min(places["first_word"]).alias("first_word"), F.array_max(places["first_word"]).alias("last_word"),
        labels(places).alias("base_labels"), labels(F.col("_findings")).alias("labels"),
        F.coalesce(F.array_max(F.col("_findings")["score"]), F.lit(0.0)).alias("score"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_passages(table(spark, sf_dir, "documents")) \
        .select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.rule_table(spark, URL_RULES)).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.col("_verdict").alias("verdict"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "start", "length", F.sha2("token", 256).alias("token_sha256"), "score", "is_secret")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"))
    model = language.fit(docs.filter(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_margin").alias("margin"), F.col("_rejected").alias("rejected"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        "doc_id", F.col("_n_units").alias("n"), F.col("_form").alias("form"), F.col("_prefix_chars").alias("prefix_chars"),
        F.col("_middle_chars").alias("middle_chars"), F.sha2("_output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("_output"), F.col("_form")), 256).alias("restored_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_digest(changed))
    d = merkle.manifest(docs, tampered=tampered)
    d = d.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return d.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


# a run counts from three lines or from 20 words on
OP4_SQL = r"""
WITH line AS (
  SELECT doc_id, l, i, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
run AS (
  SELECT doc_id, i, n, l, lead(l, 1) OVER w AS l1, lead(l, 2) OVER w AS l2, n + lead(n, 1) OVER w AS n1
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
copy AS (
  SELECT doc_id, i, l2 IS NOT NULL AS three, n1 >= 20 AS two, n >= 20 AS one,
         row_number() OVER (PARTITION BY l, l1, l2 ORDER BY doc_id, i) > 1 AS later3,
         row_number() OVER (PARTITION BY l, l1 ORDER BY doc_id, i) > 1 AS later2,
         row_number() OVER (PARTITION BY l ORDER BY doc_id, i) > 1 AS later1 FROM run),
later AS (
  SELECT doc_id, i, CASE WHEN three AND later3 THEN 3 WHEN two AND later2 THEN 2 WHEN one AND later1 THEN 1 END AS k FROM copy),
cut AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM later WHERE k IS NOT NULL),
rest AS (
  SELECT doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
         string_agg(l, chr(10) ORDER BY i) FILTER (WHERE c.i IS NULL) AS kept
  FROM line LEFT JOIN cut c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN rest USING (doc_id)"""

# pages state no canonical link or refresh that joins two urls with different rules, so SQL needs no components
OP7_SQL = r"""
WITH part AS (
  SELECT page_id, translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM part JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM part LEFT JOIN fit USING (page_id)"""


OP12_SQL = """
WITH unit AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
draw AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS h2,
         ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM unit),
cut AS (
  SELECT *, array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
         array_to_string(u[greatest(h1, h2) + 1:], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90
              THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM draw)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""


def _tree_sql(name: str, depth: int) -> str:
    """CTEs that climb from ``{name}0`` (g, k, n, d: group, rank, nodes of the group, digest) ``depth`` levels up.

    ``{name}{l}`` holds the nodes with the digests to the left and right in
    their run; a group of one node stays as it is.
    """
    out = []
    for i in range(depth):
        run = "PARTITION BY g, k // 8 ORDER BY k ROWS BETWEEN"
        out.append(f"""{name}s{i} AS MATERIALIZED (
  SELECT *, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i}),
{name}{i + 1} AS MATERIALIZED (
  SELECT g, k // 8 AS k, (n + 7) // 8 AS n, sha256(string_agg(d, '' ORDER BY k)) AS d FROM {name}{i}
  WHERE n > 1 GROUP BY g, k // 8, n UNION ALL SELECT g, k, n, d FROM {name}{i} WHERE n = 1)""")
    return ",\n".join(out)


def _fold_sql(name: str, depth: int) -> str:
    """CTEs that fold ``{name}f0`` (id, g, k, node, proof, ...) along the tree ``name``."""
    return ",\n".join(f"""{name}f{i + 1} AS MATERIALIZED (
  SELECT f.* REPLACE (CASE WHEN n > 1 THEN f.k // 8 ELSE f.k END AS k,
    CASE WHEN n > 1 THEN sha256(l || node || r) ELSE node END AS node,
    CASE WHEN n > 1 THEN proof || l || r ELSE proof END AS proof)
  FROM {name}f{i} f JOIN {name}s{i} s ON f.g IS NOT DISTINCT FROM s.g AND f.k = s.k)""" for i in range(depth))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields) + ")"


# 8^10 rows a language and 8^5 languages; crc32 bit by bit
OP13_SQL = f"""
WITH leaf AS MATERIALIZED (
  SELECT doc_id, lang AS g, {_leaf_sql("text")} AS leaf,
    CASE WHEN xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
      string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b: list_reduce(
        list_concat([xor(crc, b)], range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 3 = 0
      THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY g) AS n
  FROM leaf),
a0 AS MATERIALIZED (SELECT g, k, n, leaf AS d FROM ranked),
{_tree_sql("a", 10)},
af0 AS (SELECT doc_id, leaf, g, k, coalesce(tampered, leaf) AS node, '' AS proof FROM ranked),
{_fold_sql("a", 10)},
tops AS MATERIALIZED (
  SELECT g AS lang, d AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM a10),
b0 AS MATERIALIZED (SELECT 0 AS g, k, n, subroot AS d FROM tops),
{_tree_sql("b", 5)},
bf0 AS (SELECT doc_id, leaf, subroot, 0 AS g, t.k, node, proof FROM af10 f JOIN tops t ON f.g IS NOT DISTINCT FROM t.lang),
{_fold_sql("b", 5)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = d AS verified
FROM bf5, b5"""


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_quality_rules, op3_mix_sources, op4_line_dedup, op5_license_scan, op6_substring_dedup,
    op7_url_filter, op8_near_dedup, op9_secret_scan, op10_language, op11_fingerprints, op12_fill_middle,
    op13_merkle_manifest)}
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": OP4_SQL, "op7_url_filter": OP7_SQL, "op12_fill_middle": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
