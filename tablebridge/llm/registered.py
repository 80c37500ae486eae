"""Queries of the operators over the driver tables, with production parameters, and SQL where it can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm.common import held_out, read
from tablebridge.llm.embedding_dups import embedding_duplicates
from tablebridge.llm.filter_audit import audit, text_filters
from tablebridge.llm.fingerprints import edited, fingerprint, fingerprints, likeness, sketch, with_next
from tablebridge.llm.langid import fit_languages, identify
from tablebridge.llm.licenses import scan
from tablebridge.llm.mixing import mix, mixture_plan, n_words
from tablebridge.llm.neardup import near_duplicates
from tablebridge.llm.packing import pack
from tablebridge.llm.quality import fit_quality, score_quality
from tablebridge.llm.top_inner import top_inner_products
from tablebridge.llm.toxicity import fit_toxicity, score_toxicity
from tablebridge.llm.url_filters import filter_urls
from tablebridge.llm.whitening import Whitening, whiten

LANGUAGE_PIECES = public_tokenizers.path("piece_bpe_32k.model")
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# Rules of the contract.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), URL_RULES).select("page_id", "url_filter.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    mixed = mix(docs, mixture_plan(docs))
    size = n_words(F.col("text"))
    return mixed.select(
        "doc_id",
        size.alias("size"),
        F.col("mix_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (size * F.col("mix_copies")).alias("taken"),
    )


OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM docs GROUP BY source),
weighted AS (
  SELECT source, source_size, CASE nth % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sources),
levels AS (
  SELECT *, ((sum(source_size) OVER ())
             - coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3)::DOUBLE
            / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM weighted),
level AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= source_size * 3),
targets AS (
  SELECT source, source_size, coalesce(least((source_size * 3)::DOUBLE, level.level * weight), (source_size * 3)::DOUBLE) AS target
  FROM weighted, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS copies FROM targets),
groups AS (
  SELECT source, hash, sum(size)::BIGINT AS group_size FROM docs GROUP BY source, hash),
running AS (
  SELECT *, sum(group_size) OVER (PARTITION BY source ORDER BY hash) AS up_to FROM groups)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.copies + CASE WHEN r.up_to <= p.target - p.copies * p.source_size THEN 1
                                  WHEN r.up_to - r.group_size <= p.target - p.copies * p.source_size
                                       AND (p.target - p.copies * p.source_size - r.up_to + r.group_size) * 2 >= r.group_size THEN 1
                                  ELSE 0 END))::BIGINT AS taken
FROM docs d
JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
JOIN running r ON d.source IS NOT DISTINCT FROM r.source AND d.hash = r.hash
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(fingerprints(docs).drop("fingerprint"), ["text", "sketch"])
    changed = paired.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sketched = changed.withColumn("edited_sketch", sketch(F.col("edited")))
    return sketched.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"), words=4)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l ON s.doc_id = l.x
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxicity.passages").alias("n_passages"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), PACKING_TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        F.col("quality.score").alias("score"),
        (F.col("quality.score") >= 0.3).cast("int").alias("predicted"),
        F.size("quality.lines").alias("n_lines"),
    )


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_duplicates(read(spark, sf_dir, "embeddings")).drop("steps", "measured_recall")
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


OP8_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION
  SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM edges GROUP BY x)
SELECT l.x AS vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, l.x = l.component_id AS kept
FROM least l LEFT JOIN counts c ON l.x = c.x
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(~held_out("doc_id", 4, 2)), LANGUAGE_PIECES)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    starts = F.transform("base", lambda x: x["place"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    best = F.array_max(F.transform("found", lambda x: x["share"]))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    return audit(docs, text_filters(F.col("text")), read(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again
  FROM documents),
marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, (len(w) < 100)::INT + (100 * len(list_distinct(w)) < 80 * len(w))::INT * 2
               + (100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(text))::INT * 4
               + regexp_matches(text, '[#$%&*|]')::INT * 8 + again::INT * 16 AS mask,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM docs LEFT JOIN marks USING (doc_id) GROUP BY ALL),
states AS (
  SELECT part, active, sum(CASE WHEN mask & active = 0 THEN n ELSE 0 END) AS n,
         sum(CASE WHEN mask & active = 0 THEN good ELSE 0 END) AS good, sum(CASE WHEN mask & active = 0 THEN toxic ELSE 0 END) AS toxic
  FROM cells, range(32) AS t(active) GROUP BY part, active),
letters AS (SELECT i::INT AS i, substr('ABCDE', i::INT + 1, 1) AS name FROM range(5) AS t(i)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS way
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE (1 << a.i) + (1 << b.i) + (1 << c.i) + (1 << d.i) + (1 << e.i) = 31
    AND len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT filter_order, k::INT AS step, way[k] AS i, coalesce(list_sum(list_transform(way[1:k - 1], lambda x: 1 << x)), 0)::BIGINT AS earlier
  FROM orders, range(1, 6) AS t(k)),
walked AS (
  SELECT x.part, s.filter_order, s.step, s.i, y.n AS kept, x.n - y.n AS removed, x.good - y.good AS good_lost, x.toxic - y.toxic AS toxic_lost
  FROM steps s JOIN states x ON x.active = s.earlier JOIN states y ON y.active = s.earlier + (1 << s.i) AND y.part = x.part),
single AS (
  SELECT z.part, l.i, z.n - a.n AS fails, b.n - f.n AS alone
  FROM letters l, states z JOIN states a ON a.part = z.part JOIN states b ON b.part = z.part JOIN states f ON f.part = z.part
  WHERE z.active = 0 AND a.active = 1 << l.i AND b.active = 31 - (1 << l.i) AND f.active = 31)
SELECT w.part, w.filter_order, w.step, w.kept::BIGINT AS kept, w.removed::BIGINT AS removed,
       (s.fails - w.removed)::BIGINT AS redundant, s.alone::BIGINT AS unique_fails,
       w.good_lost::BIGINT AS good_lost, w.toxic_lost::BIGINT AS toxic_lost,
       (sum(w.removed) OVER (PARTITION BY w.part, w.i))::BIGINT AS shapley
FROM walked w JOIN single s ON s.part = w.part AND s.i = w.i
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, models = whiten(read(spark, sf_dir, "embeddings"))
    # A few numbers for each length of vector, looked up in the plan itself.
    explained, error = ({size: f(m) for size, m in models.items()} for f in (_shares, lambda m: m.identity_error))
    size = F.col("size")
    shares = F.coalesce(*[F.when(size == s, F.array(*map(F.lit, values))) for s, values in explained.items()], F.lit(None).cast("array<double>"))
    errors = F.coalesce(*[F.when(size == s, F.lit(value)) for s, value in error.items()], F.lit(None).cast("double"))
    each = rows.select("vec_id", "n", "deviation", shares.alias("shares"), errors.alias("identity_error"), F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get("shares", "at").alias("explained"),
        "identity_error",
    )


def _shares(model: Whitening) -> list[float]:
    total = float(model.values.sum())
    return [float(e) / total if total else 0.0 for e in model.values[: model.directions.shape[1]]]


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(read(spark, sf_dir, "embeddings"))


OP13_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""


QUERIES = {
    "op1_urls": op1_urls,
    "op2_mixing": op2_mixing,
    "op3_fingerprints": op3_fingerprints,
    "op4_minhash": op4_minhash,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_embeddings": op8_embeddings,
    "op9_language": op9_language,
    "op10_licenses": op10_licenses,
    "op11_audit": op11_audit,
    "op12_whitening": op12_whitening,
    "op13_search": op13_search,
}
ORACLES = {"op2_mixing": OP2_SQL, "op4_minhash": OP4_SQL, "op8_embeddings": OP8_SQL, "op11_audit": OP11_SQL, "op13_search": OP13_SQL}
