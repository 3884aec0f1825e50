"""Queries of this subpackage and, where SQL can express them, their equivalents."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def vocabulary_path() -> str:
    """The public tokenizer file: a parameter by way of METERLOOM_TOKENIZER, else the installed package's place."""
    named = os.environ.get("METERLOOM_TOKENIZER")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymised

    return pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_templates import judged

    got = judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return got.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .order_minhash import against_edits

    return against_edits(table(spark, sf_dir, "documents"))


def op6_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import cascade

    got = cascade(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "kept")


def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .length_buckets import packed

    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary=vocabulary_path())


def op8_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .weak_labels import classified

    return classified(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).drop("text")


def op9_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_tree_join import linked

    return linked(table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, num=90, den=100)


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .compact_windows import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_bpe_lexicon": op1_bpe_lexicon,
    "op2_language_id": op2_language_id,
    "op3_pii_feistel": op3_pii_feistel,
    "op4_url_templates": op4_url_templates,
    "op5_order_minhash": op5_order_minhash,
    "op6_rule_cascade": op6_rule_cascade,
    "op7_length_buckets": op7_length_buckets,
    "op8_weak_label_quality": op8_weak_label_quality,
    "op9_prefix_tree_join": op9_prefix_tree_join,
    "op10_compact_windows": op10_compact_windows,
}

ORACLE_SQL: dict[str, str] = {
    "op9_prefix_tree_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) >= 3 THEN list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]) WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS sh FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * both_ >= 90 * (p.n + q.n - both_)),
steps AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, steps.y FROM reach JOIN steps ON steps.x = reach.y)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c AS component_id FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id JOIN (SELECT x, min(y) AS c FROM reach GROUP BY 1) ON x = w.doc_id""",
    "op4_url_templates": r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
ruled AS (SELECT *, CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/' WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM hp),
seg AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS fit, list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
  lambda s: CASE WHEN regexp_matches(regexp_replace(lower(s), '\.[a-z]{1,5}$', ''), '^[0-9]+$') THEN '{n}'
  WHEN regexp_matches(regexp_replace(lower(s), '\.[a-z]{1,5}$', ''), '^[0-9a-f\-]{8,}$') AND regexp_matches(regexp_replace(lower(s), '\.[a-z]{1,5}$', ''), '[0-9]') THEN '{h}'
  WHEN regexp_matches(regexp_replace(lower(s), '\.[a-z]{1,5}$', ''), '[0-9]') THEN '{a}' ELSE regexp_replace(lower(s), '\.[a-z]{1,5}$', '') END || regexp_extract(lower(s), '(\.[a-z]{1,5})$', 1)) AS l FROM ruled),
flat AS (SELECT page_id, host, path, rule, fit, l AS p FROM seg),
g0 AS (SELECT host, p, p AS t, count(*) AS n, count_if(coalesce(fit = 'block', false)) AS bad, count_if(fit IS NOT NULL) AS labelled FROM flat GROUP BY ALL),
GENERALISED
tree AS (SELECT host, t, t AS g, sum(bad) AS bad, sum(labelled) AS labelled FROM gLEVELS GROUP BY ALL),
m0 AS (SELECT *, sum(bad) OVER (PARTITION BY t) AS ab, sum(labelled) OVER (PARTITION BY t) AS al FROM tree),
MERGED
own AS (SELECT *, CAST(ab + 1 AS DOUBLE) / (al + 2) AS prior, al > 0 AS seen FROM mLEVELS),
pooled AS (SELECT host AS ph, g AS pg, CASE WHEN max(seen) OR sum(labelled) > 0 THEN round((sum(bad) + 4e0 * avg(prior)) / (sum(labelled) + 4e0), 9) ELSE 0e0 END AS purity FROM own GROUP BY ALL),
known_ AS (SELECT host AS kh, t AS kt, purity FROM own JOIN pooled ON ph = host AND pg = g)
SELECT page_id, flat.host, path, rule, coalesce(fit, CASE WHEN purity > 0.5e0 THEN 'block' ELSE 'allow' END) AS verdict, '/' || array_to_string(t, '/') AS template, round(purity, 6) AS purity
FROM flat LEFT JOIN gLEVELS z ON z.host = flat.host AND z.p = flat.p LEFT JOIN known_ ON kh = z.host AND kt = z.t""",
    "op6_rule_cascade": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
wins AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
many AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM many, (SELECT unnest([0, 1, 2]) AS j) GROUP BY 1),
s AS (SELECT w.doc_id, text, CAST(len(words) AS BIGINT) AS n_words, CAST(length(list_aggregate(list_concat([''], words), 'string_agg', '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS upper_, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters
  FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR (n_lines > 4 AND 10 * n_dup_lines > 3 * n_lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words
  OR (upper_ > 0 AND 10 * upper_ > 4 * letters) OR 10 * letters < 6 * word_chars) AS kept FROM s""",
}


def _levels(sql: str, levels: int = 6) -> str:
    """The SQL for paths of so many segments, a few steps for each; the given tables have two."""
    wider, alike = [], []
    for i in range(1, levels + 1):
        above = f"t[1:{i - 1}]" if i > 1 else "CAST([] AS VARCHAR[])"
        wider.append(f"""lit{i} AS (SELECT *, {above} AS above, coalesce(len(t) >= {i} AND NOT contains(t[{i}], '{{'), false) AS literal FROM g{i - 1}),
wide{i} AS (SELECT host AS wh, above AS wa FROM (SELECT host, above, t[{i}] AS c, sum(n) AS n FROM lit{i} WHERE literal GROUP BY ALL) GROUP BY ALL HAVING count(*) > 30 AND sum(n) < 3 * count(*)),
g{i} AS (SELECT host, p, n, bad, labelled, CASE WHEN literal AND wh IS NOT NULL THEN list_concat(list_concat(above, ['{{*}}']), t[{i + 1}:]) ELSE t END AS t FROM lit{i} LEFT JOIN wide{i} ON wh = host AND wa = above),""")
        alike.append(f"""a{i} AS (SELECT *, {above.replace("t[", "g[")} AS above, t[{i}] AS child, array_to_string(t[{i + 1}:], '/') AS rest FROM m{i - 1}),
b{i} AS (SELECT host, above, child, CAST(CASE WHEN sum(labelled) > 0 THEN sum(bad) ELSE sum(ab) END AS DOUBLE) AS b, CAST(CASE WHEN sum(labelled) > 0 THEN sum(labelled) ELSE sum(al) END AS DOUBLE) AS n, list_sort(list(DISTINCT rest)) AS below FROM a{i} WHERE child IS NOT NULL GROUP BY ALL),
c{i} AS (SELECT *, sum(b) OVER k AS tb, sum(n) OVER k AS tn FROM b{i} WINDOW k AS (PARTITION BY host, above, below, n > 0)),
d{i} AS (SELECT host AS dh, above AS da, child AS dc, CASE WHEN (b * tn - tb * n) * (b * tn - tb * n) * tn <= 4e0 * tb * (tn - tb) * n * (tn - n) THEN CASE WHEN n > 0 THEN '~' ELSE '?' END || array_to_string(below, '|') ELSE child END AS mark FROM c{i}),
m{i} AS (SELECT host, t, CASE WHEN mark IS NOT NULL THEN list_concat(list_concat(above, [mark]), g[{i + 1}:]) ELSE g END AS g, bad, labelled, ab, al FROM a{i} LEFT JOIN d{i} ON dh = host AND da = above AND dc = child),""")
    return sql.replace("GENERALISED", "\n".join(wider)).replace("MERGED", "\n".join(alike)).replace("LEVELS", str(levels))


ORACLE_SQL["op4_url_templates"] = _levels(ORACLE_SQL["op4_url_templates"])
