"""Registered queries that need more than one Spark plan: model fits, sink/source
round trips through the shared scratch folder, and streaming runs.

Writes go to fresh paths under ``spark.checkpoint.dir`` (``session.scratch_path``),
never to a machine-local folder. Streaming runs use ``availableNow`` so each
query processes every input file and stops; their result equals a batch answer,
which is what the SQL oracle states.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brandpulse.functions.text import clean_text_tokens, json_field
from brandpulse.operators.labels import label_split, parse_labeled
from brandpulse.operators.model import (
    SentimentModel,
    doc_vectors,
    fit_sentiment,
    sample_eval,
    stored,
    token_margins,
    train_and_report,
    word_scores,
)
from brandpulse.plans import sqlfrag as S
from brandpulse.plans.catalog import _SQL as _SQL_OF
from brandpulse.plans.catalog import TERMS, _docs, _labels, _score_sql, register
from brandpulse.plans.composites import run_score_job, score_mentions, training_rows
from brandpulse.session import scratch_path
from brandpulse.sinks.writers import (
    latest_scores,
    read_predictions,
    write_label_split,
    write_labeled_text,
    write_scores_version,
)
from brandpulse.sources.records import read_json_concat, read_reviews_csv_split
from brandpulse.sources.readers import literal_samples, read_json_lines, read_labeled_text, read_reviews_csv, read_table
from brandpulse.streaming.ingest import dedup_stream, ingest_stream, read_dedup_counts, route_stream
from brandpulse.streaming.scores import read_stream_scores, scores_stream

# Model settings of the reference (vector size 128, min count 0, 200 iterations), fixed seed.
FIT = dict(vector_size=128, min_count=0, iterations=200, seed=7)


def _reviews(spark, sf) -> DataFrame:
    return _docs(spark, sf).join(_labels(spark, sf), "doc_id").select(
        "doc_id", F.col("text").alias("content"), F.col("quality").cast("string").alias("recommended"))


def _comment_sql() -> str:
    return S.normalize_sql(S.ascii_sql("coalesce(d.text, 'None')"))


# ---------------------------------------------------------------------------
# Sources and sinks through files

_CSV_SQL = """
SELECT d.doc_id, d.text AS content, CAST(l.quality AS VARCHAR) AS recommended
FROM documents d JOIN labels l USING (doc_id)
"""


@register("csv_split_scan", _CSV_SQL)
def q_csv_split_scan(spark, sf):
    # Whole texts with their line breaks, read by byte ranges; as many files as the input has tasks.
    path = scratch_path(spark, "csv_split")
    (_reviews(spark, sf).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = read_reviews_csv_split(spark, path, schema="doc_id BIGINT, content STRING, recommended STRING")
    return back.select("doc_id", "content", "recommended")


@register("json_concat_scan", "SELECT doc_id, text, lang FROM documents")
def q_json_concat_scan(spark, sf):
    # Objects appended one after the other: nothing stands between them.
    path = scratch_path(spark, "json_concat")
    docs = _docs(spark, sf, "doc_id", "text", "lang")
    record = F.to_json(F.struct("doc_id", "text", "lang", F.struct(F.lit("}{").alias("name")).alias("user")))
    (docs.select(F.substr(record, F.lit(1), F.char_length(record) - 1).alias("value"))
     .write.option("lineSep", "}").text(path))
    back = read_json_concat(spark, path)
    return back.select(*[json_field("value", c, t).alias(c) for c, t in (("doc_id", "BIGINT"), ("text", "STRING"), ("lang", "STRING"))])


@register("csv_roundtrip", """
SELECT d.doc_id, d.text AS content, CAST(l.quality AS VARCHAR) AS recommended
FROM documents d JOIN labels l USING (doc_id)
""")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv_roundtrip")
    (_reviews(spark, sf).write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = read_reviews_csv(spark, path, schema="doc_id BIGINT, content STRING, recommended STRING")
    return back.select("doc_id", "content", "recommended")


@register("labeled_text_roundtrip", f"""
SELECT {S.normalize_sql(S.ascii_sql('d.text'))} AS comment, CAST(l.quality AS INTEGER) AS sentiment
FROM documents d JOIN labels l USING (doc_id)
WHERE NOT contains({S.ascii_sql('d.text')}, ':::') AND NOT ends_with({S.ascii_sql('d.text')}, ':')
""")
def q_labeled_text_roundtrip(spark, sf):
    # K2 then S3: every token of every whole review comes back (the oracle reads the reviews, not the lines).
    path = scratch_path(spark, "labeled_text")
    write_labeled_text(_reviews(spark, sf), path)
    return parse_labeled(read_labeled_text(spark, path))


@register("labeled_text_compat", f"""
SELECT comment, sentiment FROM (
  SELECT {S.normalize_sql('p[1]')} AS comment, {S.strict_int_sql('p[2]')} AS sentiment
  FROM (SELECT string_split({S.ascii_sql('line')}, ':::') AS p
        FROM (SELECT unnest(regexp_split_to_array(d.text || ':::' || l.quality, '\r\n|\r|\n')) AS line
              FROM documents d JOIN labels l USING (doc_id)))
  WHERE len(p) = 2) WHERE sentiment IS NOT NULL
""")
def q_labeled_text_compat(spark, sf):
    # Compat: raw line breaks, as the reference writes them; only lines that still hold
    # '<content>:::<label>' parse.
    path = scratch_path(spark, "labeled_text")
    write_labeled_text(_reviews(spark, sf), path, compat=True)
    return parse_labeled(read_labeled_text(spark, path))


@register("label_split_files", f"""
SELECT {S.split_sql('doc_id')} AS split, CAST(l.quality AS VARCHAR) AS label, d.text AS sentiment
FROM documents d JOIN labels l USING (doc_id)
""")
def q_label_split_files(spark, sf):
    path = scratch_path(spark, "label_split")
    # Text output is one value per line, so the written texts must not hold newlines:
    # the check writes parquet, which keeps whole texts with their line breaks.
    write_label_split(label_split(_reviews(spark, sf), "doc_id"), path, fmt="parquet")
    back = spark.read.parquet(path)
    return back.select("split", F.col("label").cast("string").alias("label"), "sentiment")


@register("scores_upsert", f"""
WITH r1 AS ({_score_sql('per_mention')}),
     r2 AS (SELECT * FROM ({_score_sql('distinct')}) WHERE term IN {S.in_list(TERMS[:3])})
SELECT term AS airline, score, total_comments, positive_comments FROM r2
UNION ALL
SELECT term AS airline, score, total_comments, positive_comments FROM r1 WHERE term NOT IN (SELECT term FROM r2)
""")
def q_scores_upsert(spark, sf):
    from brandpulse.plans.catalog import _scores

    root = scratch_path(spark, "scores")
    run1 = _scores(spark, sf, "per_mention").withColumnRenamed("term", "airline").withColumn("processing_id", F.lit("r1"))
    run2 = (_scores(spark, sf, "distinct").where(F.col("term").isin(TERMS[:3]))
            .withColumnRenamed("term", "airline").withColumn("processing_id", F.lit("r2")))
    cols = ["airline", "score", "processing_id", "total_comments", "positive_comments"]
    write_scores_version(spark, run1.select(*cols), root)
    write_scores_version(spark, run2.select(*cols), root)
    return latest_scores(spark, root).select("airline", "score", "total_comments", "positive_comments")


# ---------------------------------------------------------------------------
# Model (M1-M9)

@register("w2v_vocab", f"""
SELECT DISTINCT unnest(string_split(comment, ' ')) AS word
FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))
WHERE {S.split_sql('comment')} = 'train'
""")
def q_w2v_vocab(spark, sf):
    from brandpulse.operators.model import word2vec

    train = training_rows(_reviews(spark, sf)).where(F.col("split") == "train")
    model = word2vec(vector_size=8, min_count=0, seed=7).fit(train)
    return model.getVectors().select("word")


# M1 over partitioned tables: the pairs it learns from can be stated, each word with its window of five on either side
# (distance d counts 6 - d) inside runs of 1,000 words.
_NEAR_SQL = f"""
WITH toks AS (
  SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) - 1 AS pos FROM (SELECT doc_id, {S.tokens_sql('text')} AS t FROM documents)
), near AS (
  SELECT a.w AS a, b.w AS b, 6 - (b.pos - a.pos) AS n FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS d FROM toks) a
  JOIN toks b ON b.doc_id = a.doc_id AND b.pos = a.pos + a.d AND b.pos // 1000 = a.pos // 1000
), ends AS (
  SELECT word, other, sum(n) AS n FROM (SELECT a AS word, b AS other, n FROM near UNION ALL SELECT b, a, n FROM near) GROUP BY 1, 2
), per AS (SELECT word, count(*) AS contexts, sum(n) AS weight FROM ends GROUP BY word)
SELECT c.word, c.n, coalesce(contexts, 0) AS contexts, CAST(coalesce(weight, 0) AS BIGINT) AS weight
FROM (SELECT w AS word, count(*) AS n FROM toks GROUP BY w) c LEFT JOIN per USING (word)
"""


@register("w2v_pairs", _NEAR_SQL)
def q_w2v_pairs(spark, sf):
    from brandpulse.operators.word_table import context_counts, word_counts, word_pairs

    tokens = _docs(spark, sf).select(clean_text_tokens("text").alias("tokens"))
    return context_counts(word_counts(tokens, "tokens"), word_pairs(tokens, "tokens"))


@register("w2v_table", f"""
SELECT DISTINCT unnest(string_split(comment, ' ')) AS word, 16 AS dim, true AS finite
FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))
WHERE {S.split_sql('comment')} = 'train'
""")
def q_w2v_table(spark, sf):
    from brandpulse.operators.word_table import fit_word_table

    train = training_rows(_reviews(spark, sf)).where(F.col("split") == "train")
    vectors = fit_word_table(train, dim=16, epochs=1, seed=7).getVectors()
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("word", F.size("vector").alias("dim"), finite.alias("finite"))


@register("doc_vector", f"""
WITH vocab AS (
  SELECT DISTINCT unnest(string_split(comment, ' ')) AS w
  FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))
  WHERE {S.split_sql('comment')} = 'train'
), vec AS (SELECT w, CAST(length(w) AS DOUBLE) AS a, CAST(ascii(w) AS DOUBLE) AS b FROM vocab),
toks AS (SELECT doc_id, unnest(t) AS w, len(t) AS n FROM (SELECT doc_id, {S.tokens_sql('text')} AS t FROM documents))
SELECT doc_id, coalesce(sum(a), 0) / max(n) AS v0, coalesce(sum(b), 0) / max(n) AS v1
FROM toks LEFT JOIN vec USING (w) GROUP BY doc_id
""")
def q_doc_vector(spark, sf):
    train = training_rows(_reviews(spark, sf)).where(F.col("split") == "train")
    vocab = train.select(F.explode("comment").alias("word")).distinct()
    vectors = vocab.select("word", F.array(F.length("word").cast("double"), F.ascii("word").cast("double")).alias("vector"))
    docs = _docs(spark, sf).select("doc_id", clean_text_tokens("text").alias("tokens"))
    out = doc_vectors(docs, "tokens", vectors, ["doc_id"], dim=2)
    return out.select("doc_id", F.col("result")[0].alias("v0"), F.col("result")[1].alias("v1"))


def _fit(spark, sf) -> tuple[SentimentModel, DataFrame]:
    rows = training_rows(_reviews(spark, sf))
    return train_and_report(rows, **FIT)


# What SQL can state of a fitted model: the rows evaluated, and that its error is one and beats a guess.
_EVAL_SQL = f"""
SELECT split, count(*) AS n, true AS error_in_range, true AS train_no_worse_than_majority
FROM (SELECT {S.split_sql('comment')} AS split
      FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))) GROUP BY split
"""


def _eval_flags(report: DataFrame, rows: DataFrame) -> DataFrame:
    majority = rows.groupBy("split").agg(
        F.least(F.avg("sentiment"), 1.0 - F.avg("sentiment")).alias("guess"))
    return report.join(majority, "split").select(
        "split", "n", F.col("error").between(0.0, 1.0).alias("error_in_range"),
        ((F.col("split") != "train") | (F.col("error") <= F.col("guess"))).alias("train_no_worse_than_majority"))


@register("svm_eval", _EVAL_SQL)
def q_svm_eval(spark, sf):
    _, report = _fit(spark, sf)
    return _eval_flags(report, training_rows(_reviews(spark, sf)))


@register("svm_eval_sgd", _EVAL_SQL.replace(", true AS train_no_worse_than_majority", ""))
def q_svm_eval_sgd(spark, sf):
    rows = training_rows(_reviews(spark, sf))
    _, report = train_and_report(rows, trainer="sgd", **FIT)
    return _eval_flags(report, rows).drop("train_no_worse_than_majority")   # few steps promise less


# M5: five full-batch hinge-loss steps on the embeddings, label 1 for odd labels.
SGD_STEPS, SGD_DIM = 5, 64
_SGD_STEP_SQL = "".join(f""",
m{t} AS (SELECT d.x, d.y, list_inner_product(w{t - 1}.w, d.x) AS m FROM d, w{t - 1}),
g{t} AS (SELECT list(g ORDER BY i) AS g FROM (
  SELECT i, sum(CASE WHEN y * m < 1 THEN y * x[i] ELSE 0 END) / (SELECT count(*) FROM d) AS g
  FROM m{t}, range(1, {SGD_DIM + 1}) r(i) GROUP BY i)),
w{t} AS (SELECT [w{t - 1}.w[i] * (1 - {1.0 / t ** 0.5!r} * 0.01) + {1.0 / t ** 0.5!r} * g{t}.g[i] for i in range(1, {SGD_DIM + 1})] AS w
         FROM w{t - 1}, g{t})""" for t in range(1, SGD_STEPS + 1))


@register("hinge_sgd_steps", f"""
WITH d AS (SELECT CAST(embedding AS DOUBLE[]) AS x, CASE WHEN label % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM embeddings),
w0 AS (SELECT [0.0::DOUBLE for i in range(1, {SGD_DIM + 1})] AS w){_SGD_STEP_SQL}
SELECT CAST(i - 1 AS INTEGER) AS dim, round(w[i], 6) AS weight FROM w{SGD_STEPS}, range(1, {SGD_DIM + 1}) r(i)
""")
def q_hinge_sgd_steps(spark, sf):
    from brandpulse.operators.model import hinge_sgd

    rows = read_table(spark, sf, "embeddings", "embedding", "label").select(
        F.col("embedding").cast("array<double>").alias("x"), (F.col("label") % 2).cast("double").alias("y"))
    weights = hinge_sgd(rows, "x", "y", SGD_DIM, iterations=SGD_STEPS, tolerance=0.0)
    out = spark.createDataFrame(list(enumerate(weights)), "dim int, w double")
    return out.select("dim", F.round("w", 6).alias("weight"))


# M5 by dual ascent, one dimension of the embeddings at a time: there the optimum can be stated. The objective is
# convex and piecewise quadratic, so it lies at a breakpoint or where the slope between two breakpoints is zero.
DUAL_DIMS, DUAL_REG = (0, 1, 2), 0.01
_DUAL_SQL = "\nUNION ALL\n".join(f"""
SELECT {d} AS dim, round(objective, 4) AS objective FROM (
  WITH z AS (SELECT CAST(embedding[{d + 1}] AS DOUBLE) * (CASE WHEN label % 2 = 1 THEN 1 ELSE -1 END) AS z FROM embeddings),
  b AS (SELECT DISTINCT 1 / z AS w FROM z WHERE z <> 0),
  mids AS (SELECT (w + lead(w) OVER (ORDER BY w)) / 2 AS w FROM b
           UNION ALL SELECT min(w) - 1 FROM b UNION ALL SELECT max(w) + 1 FROM b),
  c AS (SELECT w FROM b UNION ALL
        SELECT sum(CASE WHEN z * w < 1 THEN z ELSE 0 END) / ({DUAL_REG} * count(*)) FROM mids, z WHERE w IS NOT NULL GROUP BY w)
  SELECT min(p) AS objective FROM (
    SELECT w, avg(greatest(0, 1 - z * w)) + {DUAL_REG} / 2 * w * w AS p FROM c, z GROUP BY w))""" for d in DUAL_DIMS)


@register("hinge_dual_objective", _DUAL_SQL)
def q_hinge_dual_objective(spark, sf):
    from brandpulse.operators.dual import hinge_dual

    rows = read_table(spark, sf, "embeddings", "embedding", "label").repartition(4, "embedding")
    out = []
    for d in DUAL_DIMS:
        points = rows.select(F.array(F.col("embedding")[d].cast("double")).alias("x"), (F.col("label") % 2).cast("double").alias("y"))
        out.append((d, hinge_dual(points, "x", "y", 1, DUAL_REG, tolerance=1e-7).objective))
    return spark.createDataFrame(out, "dim int, objective double").select("dim", F.round("objective", 4).alias("objective"))


@register("sample_eval", """
SELECT count(*) AS n, true AS error_in_range FROM benchmark
""")
def q_sample_eval(spark, sf):
    model, _ = _fit(spark, sf)
    # S4 feeds M9: the samples are a literal relation as well as a table.
    literal = literal_samples(spark, [("good flight",), ("bad service",)], "text string")
    samples = read_table(spark, sf, "benchmark", "text")
    both = sample_eval(model, samples.unionByName(literal), "text", label=1)
    return both.select((F.col("n") - 2).alias("n"), F.col("error").between(0.0, 1.0).alias("error_in_range"))


@register("model_roundtrip", f"""
SELECT split, count(*) AS n, count(*) AS same
FROM (SELECT {S.split_sql('comment')} AS split
      FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))) GROUP BY split
""")
def q_model_roundtrip(spark, sf):
    rows = stored(training_rows(_reviews(spark, sf)))
    model = fit_sentiment(rows.where(F.col("split") == "train"), **FIT)
    path = scratch_path(spark, "model")
    model.save(path)
    loaded = SentimentModel.load(spark, path)
    both = loaded.predict(model.predict(rows, "before"), "after")
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") == F.col("after")).alias("same"))


def _messages(spark, sf) -> DataFrame:
    docs = _docs(spark, sf)
    return docs.select(F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text"))).alias("value"))


# C1 with a trained model: SQL states everything but the classifier's verdict, which must be 0 or 1.
_MODEL_ROWS_SQL = f"""
WITH hits AS (SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM documents),
counted AS (SELECT text, {S.hits_sql(S.tokens_sql('text'), TERMS)} AS h, count(*) - 1 AS retweets FROM hits GROUP BY text),
m AS (SELECT text AS comment, retweets, unnest(h) AS airline, unnest(range(len(h))) AS mention_pos FROM counted)
"""


@register("brand_scores_model", _MODEL_ROWS_SQL + """
SELECT airline, 'run-model' AS processing_id, count(*) AS total_comments, true AS score_in_range FROM m GROUP BY airline
""")
def q_brand_scores_model(spark, sf):
    res = score_mentions(_messages(spark, sf), _reviews(spark, sf), TERMS, run_id="run-model", fit_kw=FIT)
    return res.scores.select("airline", "processing_id", "total_comments",
                             (F.round(F.col("score") * F.col("total_comments")) == F.col("positive_comments")).alias("score_in_range"))


def _without_verdict(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("prediction_is_0_or_1", F.col("prediction").isin(0, 1)).drop("prediction")


def _model_predictions_sql(run: str) -> str:
    return _MODEL_ROWS_SQL + f"""
SELECT airline, sha256(concat_ws('|', '{run}', airline, CAST(mention_pos AS VARCHAR), comment)) AS id,
       TIMESTAMP '2024-01-01 00:00:00' AS processing_time, '{run}' AS processing_id, comment, retweets,
       true AS prediction_is_0_or_1 FROM m"""


@register("brand_predictions_model", _model_predictions_sql("run-model"))
def q_brand_predictions_model(spark, sf):
    res = score_mentions(_messages(spark, sf), _reviews(spark, sf), TERMS, run_id="run-model", fit_kw=FIT,
                         processing_time=datetime.datetime(2024, 1, 1))
    return _without_verdict(res.predictions)


# ---------------------------------------------------------------------------
# Streaming (S7, X1-X3, K5, X4): conversations are the collected JSON-lines files.

# Input files of the streaming checks and how many of them a trigger takes: several micro-batches.
STREAM_FILES, FILES_PER_TRIGGER = 6, 2


def _stream_source(spark, sf) -> str:
    src = scratch_path(spark, "stream_src")
    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text", partitions=STREAM_FILES)
    conv.select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value")).write.text(src)
    return src


def _conv_sql_tokens() -> str:
    return S.tokens_sql(S.rt_sql(S.ascii_sql("text")))


@register("stream_route", f"""
SELECT conv_id, turn, 'stream_' || term || '.json' AS stream FROM (
  SELECT conv_id, turn, unnest(list_distinct({S.hits_sql(_conv_sql_tokens(), TERMS)})) AS term FROM conversations)
""")
def q_stream_route(spark, sf):
    src = _stream_source(spark, sf)
    out, ckpt = scratch_path(spark, "route_out"), scratch_path(spark, "route_ckpt")
    route_stream(spark, src, out, ckpt, TERMS, max_files_per_trigger=FILES_PER_TRIGGER).awaitTermination()
    back = spark.read.text(out)
    return back.select(json_field("value", "conv_id", "BIGINT").alias("conv_id"),
                       json_field("value", "turn", "BIGINT").alias("turn"), "stream")


@register("stream_ingest", f"""
SELECT conv_id, turn, text FROM conversations
WHERE len({S.hits_sql(_conv_sql_tokens(), TERMS)}) > 0
""")
def q_stream_ingest(spark, sf):
    src = _stream_source(spark, sf)
    out, ckpt = scratch_path(spark, "ingest_out"), scratch_path(spark, "ingest_ckpt")
    ingest_stream(spark, src, out, ckpt, TERMS, max_files_per_trigger=FILES_PER_TRIGGER).awaitTermination()
    back = spark.read.text(out)
    return back.select(json_field("value", "conv_id", "BIGINT").alias("conv_id"),
                       json_field("value", "turn", "BIGINT").alias("turn"),
                       json_field("value", "text", "STRING").alias("text"))


@register("stream_dedup_counts", f"""
SELECT text, count(*) AS n, count(*) - 1 AS retweets
FROM (SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM conversations) GROUP BY text
""")
def q_stream_dedup_counts(spark, sf):
    src = _stream_source(spark, sf)
    out, ckpt = scratch_path(spark, "dedup_out"), scratch_path(spark, "dedup_ckpt")
    dedup_stream(spark, src, out, ckpt, max_files_per_trigger=FILES_PER_TRIGGER).awaitTermination()
    return read_dedup_counts(spark, out)


__all__ = ["FIT"]


# ---------------------------------------------------------------------------
# Inspection and the remaining composite jobs

@register("head_json", """
SELECT event_id, '{' || chr(10) || '  "event_id" : ' || event_id || ',' || chr(10) || '  "event_type" : "' || event_type
       || '",' || chr(10) || '  "value" : ' || CAST(value AS VARCHAR) || chr(10) || '}' AS record
FROM events ORDER BY event_id LIMIT 4
""")
def q_head_json(spark, sf):
    from brandpulse.functions.text import to_json_record

    ev = read_table(spark, sf, "events", "event_id", "event_type", "value")
    first = ev.orderBy("event_id").limit(4)
    return first.select("event_id", to_json_record("event_id", "event_type", "value", pretty=True).alias("record"))


def _write_reviews_csv(spark, sf) -> str:
    path = scratch_path(spark, "reviews_csv")
    (_reviews(spark, sf).select("content", "recommended").write.option("header", True).option("escape", '"').option("compression", "gzip")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@register("prepare_reviews", """
SELECT regexp_replace(d.text, '\\r\\n|\\r|\\n', ' ', 'g') || ':::' || CAST(l.quality AS VARCHAR) AS value
FROM documents d JOIN labels l USING (doc_id)
""")
def q_prepare_reviews(spark, sf):
    from brandpulse.plans.composites import prepare_reviews

    out = scratch_path(spark, "labeled_out")
    prepare_reviews(spark, _write_reviews_csv(spark, sf), out)
    return spark.read.text(out)


@register("split_reviews", f"""
SELECT split, label, regexp_replace(content, '\\r\\n|\\r|\\n', ' ', 'g') AS value FROM (
  SELECT {S.split_sql('d.text')} AS split, CAST(l.quality AS VARCHAR) AS label, d.text AS content
  FROM documents d JOIN labels l USING (doc_id))
""")
def q_split_reviews(spark, sf):
    from brandpulse.plans.composites import split_reviews

    out = scratch_path(spark, "split_out")
    split_reviews(spark, _write_reviews_csv(spark, sf), out)
    back = spark.read.text(out)
    return back.select("split", F.col("label").cast("string").alias("label"), "value")


# The splits of labelled lines and, as one more, the benchmark texts.
_REPORT_SQL = f"""
SELECT split, count(*) AS n, true AS error_in_range FROM (
  SELECT {S.split_sql('comment')} AS split
  FROM (SELECT {S.normalize_sql(S.ascii_sql('d.text'))} AS comment FROM documents d JOIN labels l USING (doc_id)
        WHERE NOT contains({S.ascii_sql('d.text')}, ':::') AND NOT ends_with({S.ascii_sql('d.text')}, ':'))) GROUP BY split
UNION ALL SELECT 'samples', count(*), true FROM benchmark
"""


@register("train_report_text", _REPORT_SQL)
def q_train_report_text(spark, sf):
    from brandpulse.plans.composites import train_and_report_text

    path = scratch_path(spark, "labeled_in")
    write_labeled_text(_reviews(spark, sf), path)
    samples = read_table(spark, sf, "benchmark", "text")
    _, report = train_and_report_text(spark, path, samples=samples, **FIT)
    return report.select("split", "n", F.col("error").between(0.0, 1.0).alias("error_in_range"))


@register("score_from_saved_text", _model_predictions_sql("run-text"))
def q_score_from_saved_text(spark, sf):
    from brandpulse.plans.composites import score_from_saved_text

    path = scratch_path(spark, "labeled_in")
    write_labeled_text(_reviews(spark, sf), path)
    res = score_from_saved_text(spark, _messages(spark, sf), path, TERMS, run_id="run-text",
                                processing_time=datetime.datetime(2024, 1, 1), fit_kw=FIT)
    return _without_verdict(res.predictions)


# ---------------------------------------------------------------------------
# C1 end to end with a deterministic classifier, so the whole composite path
# (JSON records -> text -> hits before the shuffle -> repeat counts -> document
# vectors -> linear prediction -> mention rows -> scores) has an SQL oracle.
# Word vectors are a rule on the training vocabulary: [length, code of first char].

RULE_WEIGHTS = [0.0, 1.0]
RULE_INTERCEPT = -100.0


class RuleModel:
    """A stand-in for ``SentimentModel`` with fixed word vectors and weights (same ``predict`` contract)."""

    input_col = "comment"

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors

    def predict(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        scores = word_scores(self.vectors, RULE_WEIGHTS)
        out = token_margins(df, self.input_col, scores, RULE_INTERCEPT, "_margin")
        return out.withColumn(prediction_col, (F.col("_margin") > 0).cast("int")).drop("_margin")


def _rule_model(reviews: DataFrame) -> RuleModel:
    train = training_rows(reviews).where(F.col("split") == "train")
    vocab = train.select(F.explode("comment").alias("word")).distinct()
    return RuleModel(vocab.select("word", F.array(F.length("word").cast("double"),
                                                  F.ascii("word").cast("double")).alias("vector")))


_MSGS_SQL = f"SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM documents"
_INLINE_HITS_SQL = f"SELECT text, {S.hits_sql(S.tokens_sql('text'), TERMS)} AS h FROM msgs"


def _rule_sql(final: str, msgs: str = _MSGS_SQL, hits: str = _INLINE_HITS_SQL, mode: str = "per_mention") -> str:
    return f"""
WITH msgs AS ({msgs}),
hits AS ({hits}),
counted AS (SELECT text, h, count(*) - 1 AS retweets FROM hits WHERE len(h) > 0 GROUP BY text, h),
vocab AS (
  SELECT DISTINCT unnest(string_split(comment, ' ')) AS w
  FROM (SELECT {_comment_sql()} AS comment FROM documents d JOIN labels l USING (doc_id))
  WHERE {S.split_sql('comment')} = 'train'),
vec AS (SELECT w, CAST(length(w) AS DOUBLE) AS a, CAST(ascii(w) AS DOUBLE) AS b FROM vocab),
toks AS (SELECT text, unnest(t) AS w, len(t) AS n FROM (SELECT text, {S.tokens_sql('text')} AS t FROM counted)),
dv AS (SELECT text, coalesce(sum(a), 0) / max(n) AS v0, coalesce(sum(b), 0) / max(n) AS v1
       FROM toks LEFT JOIN vec USING (w) GROUP BY text),
pred AS (SELECT text, CAST(({RULE_INTERCEPT!r} + {RULE_WEIGHTS[0]!r} * v0) + {RULE_WEIGHTS[1]!r} * v1 > 0 AS INTEGER)
           AS prediction FROM dv),
m AS (SELECT c.text AS comment, c.retweets, p.prediction, unnest({S.mode_sql('c.h', mode)}) AS airline,
             unnest(range(len({S.mode_sql('c.h', mode)}))) AS mention_pos FROM counted c JOIN pred p USING (text))
{final}"""


_SCORES_SQL = """
SELECT airline, CAST(sum(prediction) AS DOUBLE) / count(*) AS score, 'run-rule' AS processing_id,
       count(*) AS total_comments, CAST(sum(prediction) AS BIGINT) AS positive_comments FROM m GROUP BY airline"""


@register("brand_scores_rule", _rule_sql(_SCORES_SQL))
def q_brand_scores_rule(spark, sf):
    res = score_mentions(_messages(spark, sf), None, TERMS, model=_rule_model(_reviews(spark, sf)), run_id="run-rule")
    return res.scores


@register("brand_predictions_rule", _rule_sql("""
SELECT airline, sha256(concat_ws('|', 'run-rule', airline, CAST(mention_pos AS VARCHAR), comment)) AS id,
       TIMESTAMP '2024-01-01 00:00:00' AS processing_time, 'run-rule' AS processing_id, comment,
       retweets, prediction FROM m"""))
def q_brand_predictions_rule(spark, sf):
    res = score_mentions(_messages(spark, sf), None, TERMS, model=_rule_model(_reviews(spark, sf)), run_id="run-rule",
                         processing_time=datetime.datetime(2024, 1, 1))
    return res.predictions


# Every document three times: as it is, in upper case and with doubled spaces. Many messages then clean to the
# same tokens; each must get the margin of its own tokens.
_AZ, _UP = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DUP_MSGS_SQL = f"""
SELECT {S.rt_sql(S.ascii_sql('v'))} AS text FROM (
  SELECT unnest([text, translate(text, '{_AZ}', '{_UP}'), replace(text, ' ', '  ')]) AS v FROM documents)"""


@register("brand_scores_rule_dups", _rule_sql(_SCORES_SQL, msgs=_DUP_MSGS_SQL))
def q_brand_scores_rule_dups(spark, sf):
    t = F.col("text")
    variants = F.array(t, F.translate(t, _AZ, _UP), F.replace(t, F.lit(" "), F.lit("  ")))
    messages = _docs(spark, sf).select(F.explode(variants).alias("text")).select(F.to_json(F.struct("text")).alias("value"))
    res = score_mentions(messages, None, TERMS, model=_rule_model(_reviews(spark, sf)), run_id="run-rule")
    return res.scores


# C1 with a term table (every distinct token of the benchmark texts) matched by the join, in all modes.
_TABLE_HITS_SQL = f"""
SELECT text, list(t ORDER BY pos) AS h FROM (
  SELECT r, text, unnest(t) AS t, unnest(range(len(t))) AS pos
  FROM (SELECT row_number() OVER () AS r, text, {S.tokens_sql('text')} AS t FROM msgs))
WHERE t IN (SELECT lower(unnest({S.tokens_sql('text')})) FROM benchmark) GROUP BY r, text"""
_MODES = ("per_mention", "last_mention", "distinct")


def _mode_rows_sql(mode: str) -> str:
    return "SELECT * FROM (" + _rule_sql(f"""
SELECT '{mode}' AS mode, airline, count(*) AS total_comments, CAST(sum(prediction) AS BIGINT) AS positive_comments,
       CAST(sum(retweets) AS BIGINT) AS retweets FROM m GROUP BY airline""", hits=_TABLE_HITS_SQL, mode=mode) + ")"


@register("brand_predictions_term_table", "\nUNION ALL\n".join(_mode_rows_sql(m) for m in _MODES))
def q_brand_predictions_term_table(spark, sf):
    terms = read_table(spark, sf, "benchmark", "text").select(F.explode(clean_text_tokens("text")).alias("term"))
    model = _rule_model(_reviews(spark, sf))
    out = None
    for mode in _MODES:
        res = score_mentions(_messages(spark, sf), None, terms, mode=mode, model=model, run_id="run-rule",
                             max_inline_terms=100)
        rows = res.predictions.groupBy("airline").agg(
            F.count(F.lit(1)).alias("total_comments"), F.sum("prediction").alias("positive_comments"),
            F.sum("retweets").alias("retweets")).withColumn("mode", F.lit(mode))
        out = rows if out is None else out.unionByName(rows)
    return out


# The whole job over files: a JSON-lines folder and a reviews CSV to both tables, run twice with one run id.
@register("score_job_files", _rule_sql("""
SELECT airline, count(*) AS n_rows, count(DISTINCT mention_pos || '|' || comment) AS n_ids, count(*) AS total_comments,
       CAST(sum(prediction) AS BIGINT) AS positive_comments, CAST(sum(prediction) AS DOUBLE) / count(*) AS score
FROM m GROUP BY airline"""))
def q_score_job_files(spark, sf):
    folder, predictions, scores = (scratch_path(spark, n) for n in ("messages", "predictions", "scores"))
    _messages(spark, sf).write.option("compression", "gzip").text(folder)
    reviews = read_reviews_csv(spark, _write_reviews_csv(spark, sf))
    for _ in range(2):
        table = run_score_job(spark, read_json_lines(spark, folder), None, TERMS, predictions, scores,
                              model=_rule_model(reviews), run_id="run-rule")
    rows = read_predictions(spark, predictions).groupBy("airline").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"))
    return rows.join(table, "airline").select("airline", "n_rows", "n_ids", "total_comments", "positive_comments", "score")


# C1 as the reference runs it: last mention, equal (airline, comment) rows folded in the predictions, every mention
# row scored, 'null' texts dropped.
@register("brand_scores_compat", _rule_sql("""
SELECT airline, CAST(sum(prediction) AS DOUBLE) / count(*) AS score, count(*) AS total_comments,
       CAST(sum(prediction) AS BIGINT) AS positive_comments, count(DISTINCT comment) AS n_rows FROM m GROUP BY airline""",
    msgs=f"SELECT * FROM ({_MSGS_SQL}) WHERE NOT starts_with(text, 'null')", mode="last_mention"))
def q_brand_scores_compat(spark, sf):
    res = score_mentions(_messages(spark, sf), None, TERMS, compat=True, model=_rule_model(_reviews(spark, sf)), run_id="run-rule")
    rows = res.predictions.groupBy("airline").agg(F.count(F.lit(1)).alias("n_rows"))
    return res.scores.join(rows, "airline").select("airline", "score", "total_comments", "positive_comments", "n_rows")


# X4, second half: the same scores, kept up over a stream that is stopped and started again.
@register("stream_scores", "SELECT airline, score, total_comments, positive_comments FROM (" + _rule_sql(_SCORES_SQL) + ")")
def q_stream_scores(spark, sf):
    src, out, ckpt = (scratch_path(spark, n) for n in ("scores_src", "scores_out", "scores_ckpt"))
    model = _rule_model(_reviews(spark, sf))
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    messages = _messages(spark, sf)
    for part in (0, 1):
        messages.where(half == part).repartition(STREAM_FILES // 2).write.mode("append").option("compression", "gzip").text(src)
        scores_stream(spark, src, out, ckpt, TERMS, model, max_files_per_trigger=FILES_PER_TRIGGER,
                      compact_every=2).awaitTermination()
    return read_stream_scores(spark, out)


@register("scores_upsert_buckets", _SQL_OF["scores_upsert"])
def q_scores_upsert_buckets(spark, sf):
    from brandpulse.plans.catalog import _scores
    from brandpulse.sinks.keyed import KeyedTable

    table = KeyedTable(spark, scratch_path(spark, "scores_keyed"), ["airline"],
                       "airline string, score double, total_comments bigint, positive_comments bigint", "latest")
    first = _scores(spark, sf, "per_mention").withColumnRenamed("term", "airline")
    second = _scores(spark, sf, "distinct").where(F.col("term").isin(TERMS[:3])).withColumnRenamed("term", "airline")
    table.upsert(first)
    table.compact()
    table.upsert(second)
    return table.read()


# X1, then S1 over all its outputs: a record that names several terms is collected several times and counted once.
@register("record_dedup", f"""
SELECT text, count(*) AS n, count(*) - 1 AS retweets FROM (
  SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM conversations WHERE len({S.hits_sql(_conv_sql_tokens(), TERMS)}) > 0)
GROUP BY text
""")
def q_record_dedup(spark, sf):
    from brandpulse.operators.dedup_records import dedup_records
    from brandpulse.operators.scoring import count_repeats
    from brandpulse.plans.composites import message_texts
    from brandpulse.streaming.ingest import routed_records

    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "text", partitions=STREAM_FILES)
    raw = conv.select(F.to_json(F.struct(F.concat_ws(":", "conv_id", "turn").alias("id"), "text")).alias("value"))
    out = scratch_path(spark, "collected")
    routed_records(raw, TERMS).select("value", "stream").write.partitionBy("stream").text(out)
    once = dedup_records(spark.read.text(out).select("value"))
    return count_repeats(message_texts(once), "text")


# Lines in every form a collector meets, blank ones included; each ends in exactly one output.
@register("stream_deadletter", f"""
SELECT outcome, reason, text, count(*) AS n FROM (
  SELECT CASE WHEN reason IS NULL THEN 'records' ELSE 'dead' END AS outcome, reason,
         CASE WHEN reason IS NULL THEN {S.rt_sql(S.ascii_sql('r'))} END AS text
  FROM (SELECT CASE doc_id % 7 WHEN 0 THEN 'text_not_string' WHEN 1 THEN 'malformed' WHEN 2 THEN 'no_text'
                               WHEN 3 THEN 'malformed' WHEN 4 THEN 'malformed' END AS reason,
               CASE doc_id % 3 WHEN 0 THEN 'RT ' || text ELSE text END AS r FROM documents)
  UNION ALL SELECT 'dead', 'empty', NULL FROM documents)
GROUP BY outcome, reason, text
""")
def q_stream_deadletter(spark, sf):
    from brandpulse.plans.catalog import _record_json
    from brandpulse.streaming.routing import deadletter_stream, read_dead, read_records

    src, out, ckpt = (scratch_path(spark, n) for n in ("dead_src", "dead_out", "dead_ckpt"))
    docs = _docs(spark, sf, "doc_id", "text", "lang", "n_chars")
    lines = docs.select(F.explode(F.array(_record_json(), F.lit("  "))).alias("value"))
    lines.repartition(STREAM_FILES).write.text(src)
    deadletter_stream(spark, src, out, ckpt, max_files_per_trigger=FILES_PER_TRIGGER).awaitTermination()
    none = F.lit(None).cast("string")
    both = (read_records(spark, out).select(F.lit("records").alias("outcome"), none.alias("reason"), "text")
            .unionByName(read_dead(spark, out).select(F.lit("dead").alias("outcome"), "reason", none.alias("text"))))
    return both.groupBy("outcome", "reason", "text").agg(F.count(F.lit(1)).alias("n"))


# X1 with a term table: every distinct token of the benchmark texts, half of them added while the stream runs.
@register("stream_route_table", f"""
WITH terms AS (SELECT DISTINCT lower(unnest({S.tokens_sql('text')})) AS term FROM benchmark),
live AS (SELECT term, 0 AS since FROM terms WHERE length(term) % 2 = 0 UNION ALL SELECT term, 1 FROM terms WHERE length(term) % 2 = 1)
SELECT DISTINCT conv_id, turn, 'stream_' || regexp_replace(term, '[^-_.A-Za-z0-9]', '_', 'g') || '.json' AS stream
FROM (SELECT conv_id, turn, conv_id % 2 AS part, unnest({_conv_sql_tokens()}) AS token FROM conversations) t
JOIN live ON lower(t.token) = live.term AND live.since <= t.part
""")
def q_stream_route_table(spark, sf):
    from brandpulse.streaming.routing import put_terms, route_table_stream

    src, out, ckpt, root = (scratch_path(spark, n) for n in ("table_src", "table_out", "table_ckpt", "table_terms"))
    bench = read_table(spark, sf, "benchmark", "text")
    terms = bench.select(F.explode(clean_text_tokens("text")).alias("term")).distinct()
    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    record = F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value")
    for part in (0, 1):       # the even conversations arrive first, before the terms of odd length are tracked
        put_terms(spark, root, terms.where(F.char_length("term") % 2 == part))
        conv.where(F.col("conv_id") % 2 == part).select(record).repartition(FILES_PER_TRIGGER).write.mode("append").text(src)
        route_table_stream(spark, src, out, ckpt, root, max_files_per_trigger=FILES_PER_TRIGGER).awaitTermination()
    back = spark.read.text(out)
    return back.select(json_field("value", "conv_id", "BIGINT").alias("conv_id"),
                       json_field("value", "turn", "BIGINT").alias("turn"), "stream").distinct()
