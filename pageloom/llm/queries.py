"""The operators over the given tables, one query each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import (
    bilinear,
    bpe,
    fingerprints,
    licenses,
    multi_index,
    near_vectors,
    packing,
    periodic,
    quality,
    similar,
    substrings,
    suffixes,
    whitening,
)
from pageloom.llm.common import materialize

CAPACITY = 4096
END_OF_DOCUMENT = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    top = F.array_max(F.transform("found", lambda x: x["score"]))
    return found.select(
        "doc_id",
        F.array_join(F.transform("found", lambda x: x["name"]), ",").alias("licenses"),
        F.size("found").cast("long").alias("n_licenses"),
        F.get(F.filter("found", lambda x: x["score"] == top), 0)["name"].alias("best_license"),
        F.coalesce(top, F.lit(0.0)).alias("best_score"),
    )


def op2_sql() -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.TEMPLATES)
    words = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = "CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE list_filter(w, lambda x: x <> '') END"
    t = licenses.THRESHOLD
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT DISTINCT doc_id, unnest(list_concat([text], regexp_split_to_array(text, '\n[ \t\r]*\n'), string_split(text, chr(10)))) AS u FROM texts
),
parts AS (SELECT doc_id, {pairs} AS b FROM (SELECT doc_id, {words.format("u")} AS w FROM units)),
templates AS (SELECT name, {pairs} AS t FROM (SELECT name, {words.format("text")} AS w FROM (VALUES {values}) v(name, text))),
scored AS (
  SELECT doc_id, name, 2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS score
  FROM parts JOIN templates ON len(t) BETWEEN ceil(len(b) * {t}::DOUBLE / {2 - t}::DOUBLE) AND floor(len(b) * {2 - t}::DOUBLE / {t}::DOUBLE)
),
best AS (SELECT doc_id, name, max(score) AS score FROM scored WHERE score >= {t} GROUP BY ALL),
tops AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY name) AS names, count(*) AS n, max(score) AS top,
    (array_agg(name ORDER BY score DESC, name))[1] AS first
  FROM best GROUP BY doc_id
)
SELECT doc_id, coalesce(names, '') AS licenses, coalesce(n, 0)::BIGINT AS n_licenses, first AS best_license, coalesce(top, 0.0)::DOUBLE AS best_score
FROM texts LEFT JOIN tops USING (doc_id)
"""


def op3_one_permutation_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("print")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op4_recompressed_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)
),
marked AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) < doc_id AS again FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM marked WHERE again),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def op5_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear.score(table(spark, sf_dir, "documents"), quality.part(10) == 0)


def op6_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), decode=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_deep_shallow_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


LEAST_QUALITY = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model | None:
    """Fitted on the labels of documents outside part 0 of 5."""
    learned = labels.where(quality.part(5) != 0).select("doc_id", F.col("quality").alias("label"))
    return quality.train(docs, learned)


def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(quality.part(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op9_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = similar.link(table(spark, sf_dir, "documents"), words=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""


def packed(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    pieces = packing.cut(bpe.encode(docs, tokenizer_path()), F.col("ids"), CAPACITY, END_OF_DOCUMENT)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    pieces = materialize(pieces, "pieces")
    return packing.pack(pieces, ["doc_id", "piece", "start", "ids_crc32"], CAPACITY)


def op10_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(periodic.with_looped_tails(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    by_place = F.array_sort("runs", lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    found = found.select("doc_id", by_place.alias("runs"), "collapsed_text", longest.alias("longest"))
    start, length, period = F.col("longest.start"), -F.col("longest.less"), F.col("longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(
        list_prepend(xor(c, b), range(8)), lambda d, ignored: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384::BIGINT) ELSE d // 2 END
      )
    ), 4294967295::BIGINT) AS h
  FROM documents
),
tails AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts),
loops AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM tails),
edited AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
  FROM loops
),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM edited),
same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same)
  GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l),
per_doc AS (
  SELECT doc_id, count(*) AS n_runs, min(struct_pack(less := -l, s := s, q := q)) AS best,
    string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, (-best.less)::BIGINT AS length, best.q::BIGINT AS period,
  ((-1000 * best.less) // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM texts LEFT JOIN per_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def op12_weighted_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(spark, sf_dir, "embeddings"))
    rows = done.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "whitened"))
    component = F.col("place") + 1
    return rows.select("vec_id", component.alias("component"), "n", "deviation", "whitened", F.get("explained", "place").alias("explained"), "identity_error")


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_multi_index,
        op2_license_scan,
        op3_one_permutation_minhash,
        op4_recompressed_passages,
        op5_log_bilinear,
        op6_tree_bpe,
        op7_deep_shallow_dedup,
        op8_attention_quality,
        op9_adaptive_prefix_join,
        op10_bin_slack_packing,
        op11_periodic_runs,
        op12_weighted_whitening,
        op13_near_vectors,
    )
}

ORACLE: dict[str, str] = {
    "op2_license_scan": op2_sql(),
    "op4_recompressed_passages": OP4_SQL,
    "op9_adaptive_prefix_join": OP9_SQL,
    "op11_periodic_runs": OP11_SQL,
}
