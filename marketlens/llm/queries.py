"""The corpus queries over the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    centroids, decontaminate, digests, embedding_dedup, exact_dedup, jaccard_join, line_dedup, lm_scoring, pieces, quality, substring_dedup,
    token_alignment, token_output, toxicity,
)
from marketlens.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; all executors have the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


LINE_KEY = r"""translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@query(
    "op7_line_dedup",
    f"""WITH lines AS (
  SELECT doc_id, i, l, {LINE_KEY} AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r.k) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (r.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN repeated r USING (k) GROUP BY doc_id""",
)
def op7(spark, folder):
    found = line_dedup.drop_repeated_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
FOLDED = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op2_ngram_jaccard_join",
    f"""WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(text=FOLDED.format(text="coalesce(text, '')"))} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS c, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) GROUP BY s),
members AS (SELECT doc_id, c FROM (SELECT doc_id, list_sort(s) AS s FROM sets) JOIN classes USING (s) WHERE n > 0),
tokens AS (SELECT c, n, unnest(s) AS t FROM classes),
pairs AS (SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c < b.c
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT c, c FROM classes WHERE n > 0),
reach AS (SELECT a AS node, b AS reached FROM edges
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.reached = e.a),
least_of AS (SELECT node, min(reached) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN members m USING (doc_id) LEFT JOIN least_of l ON m.c = l.node""",
)
def op2(spark, folder):
    found = jaccard_join.near_duplicate_components(table(spark, folder, "documents"), width=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


TERMS = f"regexp_extract_all({FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op8_benchmark_decontamination",
    f"""WITH docs AS (SELECT doc_id, {TERMS.format(text="coalesce(text, '')")} AS w FROM documents),
items AS (SELECT item_id, {TERMS.format(text="coalesce(text, '')")} AS w FROM benchmark),
wanted AS (SELECT item_id, CASE WHEN len(w) < 10 THEN w ELSE w[i:i + 9] END AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(t) AS n FROM wanted),
found AS (SELECT d.doc_id, d.i, len(d.t) AS n, x.item_id
  FROM (SELECT doc_id, i, w[i:i + n - 1] AS t FROM (
      SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)) d
  JOIN wanted x ON d.t = x.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)""",
)
def op8(spark, folder):
    found = decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op4_token_binary_output")
def op4(spark, folder):
    out = Scratch(spark, "tokens").folder
    files = token_output.write_records(table(spark, folder, "documents"), out, vocabulary("byte_bpe_50k.json"))
    return token_output.read_records(files, out)


@query("op3_sentencepiece")
def op3(spark, folder):
    model = vocabulary("piece_bpe_32k.model")
    return pieces.encode_and_decode(table(spark, folder, "documents"), model, digests.pieces, digests.PIECES)


@query(
    "op9_embedding_near_dedup",
    """WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM e
  WHERE label IS NOT NULL AND v IS NOT NULL AND list_dot_product(v, v) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least_of AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least_of LEFT JOIN counted USING (vec_id)""",
)
def op9(spark, folder):
    return embedding_dedup.near_duplicate_vectors(table(spark, folder, "embeddings"))


@query("op1_quality_classifier")
def op1(spark, folder):
    found = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "lang", "n_words", "perplexity", "threshold", "kept")


@query("op5_toxicity")
def op5(spark, folder):
    found = toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "n_words", "evidence")


@query(
    "op6_substring_dedup",
    f"""WITH words AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
repeated AS (SELECT doc_id, i FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
listed AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.p) AS t FROM placed a ANTI JOIN gone g ON a.doc_id = g.doc_id AND a.p = g.p
  GROUP BY a.doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def op6(spark, folder):
    found = substring_dedup.remove_repeats(table(spark, folder, "documents"), width=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_lm_scoring")
def op10(spark, folder):
    found = lm_scoring.pseudo_likelihood(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "log_probability", F.when(F.col("n_words") > 0, F.col("log_probability") / F.col("n_words")).alias("per_word"))


@query(
    "op11_exact_dedup",
    r"""WITH contents AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS c FROM documents),
ranked AS (SELECT doc_id, c, count(*) OVER (PARTITION BY c) AS group_size,
    row_number() OVER same AS place, first_value(doc_id) OVER same AS keep_id
  FROM contents WINDOW same AS (PARTITION BY c ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(c) AS text_sha256 FROM ranked""",
)
def op11(spark, folder):
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


@query("op12_token_alignment")
def op12(spark, folder):
    vocabularies = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    found, _ = token_alignment.align_tokens(table(spark, folder, "documents"), *vocabularies, report=digests.sha256)
    return found.withColumnRenamed("groups", "groups_sha256")


def clustering_sql(k: int = 40, rounds: int = 5, seed: int = 2) -> str:
    """Each round as two steps: vectors to their nearest centroid, centroids to their vectors' mean."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS cluster, v AS c FROM v
  ORDER BY sha256('{seed}:' || vec_id), v LIMIT {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, min({{'distance': CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
    'cluster': cluster}}) AS m FROM v, c{n} GROUP BY r)""")
        if n < rounds:
            steps.append(f"""s{n} AS (SELECT m.cluster AS cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT m, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v JOIN a{n} USING (r)) GROUP BY ALL),
c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(moved.c, c{n}.c) AS c FROM c{n}
  LEFT JOIN (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS c FROM s{n} GROUP BY cluster) moved USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(m.cluster AS INTEGER) AS cluster, m.distance AS distance, CAST(sum(m.distance) OVER (PARTITION BY m.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} ON m.cluster = c{rounds}.cluster"""


@query("op13_centroid_clustering", clustering_sql())
def op13(spark, folder):
    return centroids.clusters_with_digests(table(spark, folder, "embeddings"))


@query("pipeline")
def pipeline(spark, folder):
    # The stages import this module for its tables.
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
