"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import (
    decontamination,
    fingerprint,
    language,
    license_scan,
    merkle,
    minhash,
    near_dedup,
    packing,
    quality,
    sharding,
    toxicity,
    url_filter,
    whitening,
)
from .common import table
from .samples import fold

SHARDS = 8
QUERY_STEP = 100  # searches take every row whose id this number divides as a query
KEPT_FROM = 0.3  # least score that counts as label 1
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2
QUALITY_FOLDS, QUALITY_HELD_OUT = 5, 0
TAMPERED = 7  # rows whose crc32 this divides are checked with a changed count


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint.compare_with_edits(table(spark, sf_dir, "documents"), "doc_id", "text")
    prints = materialize(prints, "compared")
    asked = F.col("doc_id") % QUERY_STEP == 0
    return fingerprint.count_near(prints, asked).drop("_f0", "_f1")


def _judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD_OUT
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic", learn)
    scored = toxicity.score(docs.select("doc_id", "text"), "text", model)
    return _judged(scored, TOXIC_FOLDS, TOXIC_HELD_OUT)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.with_matches(docs.select("doc_id", "text"), "text", items, "item_id", "text", "found")
    return found.select("doc_id", F.inline("found"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD_OUT
    model = quality.train(docs, labels, "doc_id", "text", "quality", learn)
    scored = quality.score(docs.select("doc_id", "text"), "text", model)
    return _judged(scored, QUALITY_FOLDS, QUALITY_HELD_OUT)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("_text"),
    )
    rows = materialize(rows, "sizes")
    sharded = materialize(sharding.shard_groups(rows, "_text", "size", shards=SHARDS).drop("_text"), "sharded")
    return sharding.numbered(sharded, ["shard"], ["doc_id", "text_crc32"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(
        table(spark, sf_dir, "pages"), "page_id", "url", url_filter.PLACES + url_filter.LABELS
    )
    places = [r.name for r in url_filter.PLACES]
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("rule").isin(places), F.col("rule")).alias("rule"),
        "verdict",
        F.col("rule").alias("fitting"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark, table(spark, sf_dir, "documents"), "doc_id", "text").drop("spans")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return language.identify(table(spark, sf_dir, "pages"), "page_id", "url", "html", model)


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [F.col("n_chars").cast("decimal(20,0)") + 1 if c == 3 else f for c, f in enumerate(fields)]
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    leaf = merkle.leaf_digest(fields)
    changed = F.when(tampered, merkle.leaf_digest(more)).otherwise(leaf)
    return merkle.prove(table(spark, sf_dir, "documents"), "lang", "doc_id", leaf, changed)


REGISTRY = {
    "op1_fingerprints": op1_fingerprints,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_url_filter": op8_url_filter,
    "op9_license_scan": op9_license_scan,
    "op10_language": op10_language,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_whitening": op12_whitening,
    "op13_merkle": op13_merkle,
}

_HOST = "lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1))"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_RULES = ", ".join(
    f"('{r.name}', '{r.regex}', '{r.verdict}', {r.rank}, {r in url_filter.PLACES})"
    for r in url_filter.PLACES + url_filter.LABELS
)

_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({v}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda h, i: xor(h >> 1, (h & 1) * 3988292384))), 4294967295)"""
_FIELD = "coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
# levels of a tree: pairs of neighbours are hashed until one node is left
_LEVELS = """
SELECT {t}, 0 AS lvl, i, d, n FROM {leaves}
UNION ALL
SELECT {t}, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (max(n) + 1) // 2 FROM {levels}
WHERE n > 1 GROUP BY {t}, lvl, i // 2"""

ORACLE = {
    "op11_minhash_dedup": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
          ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 85 * (x.n + y.n - met)),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(r.other)) AS component_id,
       d.doc_id = least(d.doc_id, min(r.other)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach r USING (doc_id) GROUP BY d.doc_id
""",
    "op13_merkle": f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, lang, sha256({_LEAF}) AS leaf,
           CASE WHEN {_CRC.format(v='doc_id')} % {TAMPERED} = 0
                THEN sha256({_LEAF.replace('n_chars', '(n_chars + 1)')}) ELSE sha256({_LEAF}) END AS changed FROM documents),
leaves AS (SELECT doc_id, lang, changed, leaf AS d, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY lang) AS n FROM rows_),
levels AS ({_LEVELS.format(t='lang', leaves='leaves', levels='levels')}),
subs AS (SELECT 0 AS top, lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM levels WHERE n = 1),
tops AS ({_LEVELS.format(t='top', leaves='subs', levels='tops')}),
walk AS (
    SELECT doc_id, lang, i AS place, false AS over, 0 AS lvl, i, n, changed AS node, '' AS proof FROM leaves
    UNION ALL
    SELECT w.doc_id, w.lang, w.place, w.over OR w.n = 1, CASE WHEN w.n = 1 THEN 0 ELSE w.lvl + 1 END,
           CASE WHEN w.n = 1 THEN s.i ELSE w.i // 2 END, CASE WHEN w.n = 1 THEN s.n ELSE (w.n + 1) // 2 END,
           CASE WHEN w.n = 1 THEN w.node WHEN w.i % 2 = 1 THEN sha256(coalesce(l.d, t.d) || w.node)
                ELSE sha256(w.node || coalesce(l.d, t.d, '')) END,
           w.proof || CASE WHEN w.n = 1 THEN '' ELSE coalesce(l.d, t.d, '') END
    FROM walk w LEFT JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang
    LEFT JOIN levels l ON NOT w.over AND w.n > 1 AND l.lang IS NOT DISTINCT FROM w.lang AND l.lvl = w.lvl AND l.i = xor(w.i, 1)
    LEFT JOIN tops t ON w.over AND w.n > 1 AND t.lvl = w.lvl AND t.i = xor(w.i, 1)
    WHERE NOT (w.over AND w.n = 1))
SELECT w.doc_id, r.d AS leaf, s.d AS subroot, q.d AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root,
       w.node = q.d AS verified
FROM walk w JOIN leaves r ON r.lang IS NOT DISTINCT FROM w.lang AND r.i = w.place
JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang, (SELECT d FROM tops WHERE n = 1) q WHERE w.over AND w.n = 1
""",
    # the addresses of the table are plain ASCII, so lower() changes A-Z only
    "op8_url_filter": f"""
WITH a AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
r(name, regex, verdict, rank, place) AS (VALUES {_RULES}),
u AS (SELECT DISTINCT host, path FROM a),
b AS (
    SELECT host, path, arg_max(r, (rank, name)) AS best
    FROM u JOIN r ON regexp_matches(host || path, regex) GROUP BY host, path
)
SELECT page_id, a.host, a.path, CASE WHEN best.place THEN best.name END AS rule,
       coalesce(best.verdict, 'allow') AS verdict, best.name AS fitting
FROM a LEFT JOIN b ON a.host = b.host AND a.path = b.path
""",
}
