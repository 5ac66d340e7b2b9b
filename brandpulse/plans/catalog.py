"""Registered queries: one Spark plan per operator of SURVEY section 2, each over the
driver tables, and (where SQL can say it) the equivalent DuckDB SQL.

Table stand-ins (FIXTURES section 4): ``documents`` are the messages and the
reviews, ``labels.quality`` is the review label, ``events.props`` is JSON,
``events`` also feeds keyed updates, ``pages.url`` feeds file names,
``embeddings`` are feature vectors, ``conversations`` feed the streaming source
and ``benchmark`` texts are the evaluation samples.

Every query reads whole tables. Where an input form the data lacks is needed
(a 'RT' prefix, a null text, a ':::' inside content) it is derived from every
row by the same CASE on both sides; no row is filtered out to make a check cheap.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.functions.text import (
    ascii_strip,
    clean_text_tokens,
    clean_tokens,
    emit_nonempty,
    emit_text,
    json_field,
    keep_text,
    normalize_text,
    record_text,
    rt_strip,
    safe_name,
    stream_file_name,
    term_list,
    to_json_record,
)
from brandpulse.operators.labels import (
    label_split,
    parse_labeled,
    reviews_to_training,
    serialize_labeled,
    split_column,
)
from brandpulse.operators.mentions import match_terms, mention_array
from brandpulse.operators.scoring import count_repeats, error_rate, rank_entities, score_entities
from brandpulse.operators.upsert import upsert_latest
from brandpulse.plans import sqlfrag as S
from brandpulse.sources.readers import read_table
from brandpulse.sinks.writers import with_run_columns

# Test parameters: the terms the checks match on.
TERMS = ["that", "with", "this", "from", "tion", "than"]
RUN_ID = "run-0001"
RUN_TIME = _dt.datetime(2024, 1, 1, 0, 0, 0)
# Events before this instant form the old table of the keyed merge, the rest the new batch.
UPSERT_CUT = "2024-01-16 00:00:00"
# Linear rule for M6 checks: weight of dimension i is ((i mod 7) - 3) / 4.
EMB_DIM = 64
LINEAR_WEIGHTS = [((i % 7) - 3) / 4.0 for i in range(EMB_DIM)]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# The test tables are single files (one input split): their rows are dealt to so many partitions.
PARTITIONS = 16


def _docs(spark, sf, *cols):
    return read_table(spark, sf, "documents", *(cols or ("doc_id", "text")), partitions=PARTITIONS)


def _labels(spark, sf):
    return read_table(spark, sf, "labels", "doc_id", "quality")


# ---------------------------------------------------------------------------
# Text functions

@register("ascii_strip", f"""
SELECT doc_id, {S.ascii_sql('text')} AS text_ascii FROM documents
""")
def q_ascii_strip(spark, sf):
    return _docs(spark, sf).select("doc_id", ascii_strip("text").alias("text_ascii"))


_RT_VARIANT_SQL = ("CASE doc_id % 5 WHEN 0 THEN 'RT ' || text WHEN 1 THEN 'RT' || text "
                   "WHEN 2 THEN 'rt ' || text WHEN 3 THEN 'RT' ELSE text END")


def _rt_variant():
    m = F.pmod(F.col("doc_id"), F.lit(5))
    t = F.col("text")
    return (F.when(m == 0, F.concat(F.lit("RT "), t)).when(m == 1, F.concat(F.lit("RT"), t))
            .when(m == 2, F.concat(F.lit("rt "), t)).when(m == 3, F.lit("RT")).otherwise(t))


@register("rt_strip", f"""
SELECT doc_id, {S.rt_sql('v')} AS text_rt FROM (SELECT doc_id, {_RT_VARIANT_SQL} AS v FROM documents)
""")
def q_rt_strip(spark, sf):
    return _docs(spark, sf).select("doc_id", rt_strip(_rt_variant()).alias("text_rt"))


# Contractions, apostrophes, brackets and question marks woven into the real text
# (the documents have none), so every normaliser step meets real input.
_INJECT = [("the ", "the's "), ("an ", "an't "), ("er ", "er've "), ("on ", "on're ("),
           ("es ", "es'd) "), ("ou ", "ou'll? "), ("Th", "TH'S`"), ("in", "IN'T")]


def _inject_spark(c):
    for a, b in _INJECT:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _inject_sql(e):
    for a, b in _INJECT:
        e = f"replace({e}, {S.q(a)}, {S.q(b)})"
    return e


@register("normalize_text", f"""
SELECT doc_id, {S.normalize_sql(_inject_sql('text'))} AS text_clean FROM documents
""")
def q_normalize_text(spark, sf):
    return _docs(spark, sf).select("doc_id", normalize_text(_inject_spark(F.col("text"))).alias("text_clean"))


@register("tokenize", f"""
WITH t AS (SELECT doc_id, {S.tokens_sql('text')} AS toks FROM documents)
SELECT doc_id, CAST(unnest(range(len(toks))) AS BIGINT) AS pos, unnest(toks) AS token FROM t
""")
def q_tokenize(spark, sf):
    return (_docs(spark, sf)
            .select("doc_id", F.posexplode(clean_text_tokens("text")).alias("pos", "token"))
            .select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token"))


@register("json_field", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def q_json_field(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "props")
    return ev.select("event_id", json_field("props", "k", "BIGINT").alias("k"))


# JSON records built from every document; some carry a non-string text, some are
# cut short (malformed), some lack the field, some are followed by more: all of those yield no text.
_RECORD_SQL = ("CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL "
               "ELSE (CASE doc_id % 3 WHEN 0 THEN 'RT ' || text ELSE text END) END")


def _record_json():
    m7 = F.pmod(F.col("doc_id"), F.lit(7))
    body = F.when(F.pmod(F.col("doc_id"), F.lit(3)) == 0, F.concat(F.lit("RT "), F.col("text"))).otherwise(F.col("text"))
    good = F.to_json(F.struct(F.col("doc_id").alias("id"), body.alias("text"), F.col("lang")))
    return (F.when(m7 == 0, F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("text"))))
            .when(m7 == 1, F.substr(good, F.lit(1), F.lit(12)))
            .when(m7 == 2, F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("lang"))))
            .when(m7 == 3, F.concat(good, F.lit(" xyz")))
            .when(m7 == 4, F.concat(good, good))
            .otherwise(good))


@register("record_text", f"""
SELECT doc_id, text FROM (
  SELECT doc_id, {S.rt_sql(S.ascii_sql('r'))} AS text FROM (SELECT doc_id, {_RECORD_SQL} AS r FROM documents)
) WHERE text IS NOT NULL
""")
def q_record_text(spark, sf):
    docs = _docs(spark, sf, "doc_id", "text", "lang", "n_chars")
    recs = docs.select("doc_id", _record_json().alias("value"))
    return recs.select("doc_id", emit_text(record_text("value")).alias("text"))


@register("json_encode", """
SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}'
  AS record FROM events
""")
def q_json_encode(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "event_type", "user_id")
    return ev.select("event_id", to_json_record("event_id", "event_type", "user_id").alias("record"))


_NULL_VARIANT_SQL = ("CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'null' || text "
                     "WHEN 2 THEN 'nullify ' || text ELSE text END")


def _null_variant():
    m = F.pmod(F.col("doc_id"), F.lit(5))
    t = F.col("text")
    return (F.when(m == 0, F.lit(None).cast("string")).when(m == 1, F.concat(F.lit("null"), t))
            .when(m == 2, F.concat(F.lit("nullify "), t)).otherwise(t))


@register("drop_null_text", f"""
SELECT doc_id, v AS text FROM (SELECT doc_id, {_NULL_VARIANT_SQL} AS v FROM documents) WHERE v IS NOT NULL
""")
def q_drop_null_text(spark, sf):
    return _docs(spark, sf).select("doc_id", _null_variant().alias("text")).where(keep_text("text"))


@register("drop_null_text_compat", f"""
SELECT doc_id, v AS text FROM (SELECT doc_id, coalesce({_NULL_VARIANT_SQL}, 'null') AS v FROM documents)
WHERE NOT starts_with(v, 'null')
""")
def q_drop_null_text_compat(spark, sf):
    t = F.coalesce(_null_variant(), F.lit("null"))
    return _docs(spark, sf).select("doc_id", t.alias("text")).where(keep_text("text", compat=True))


@register("term_list", """
SELECT doc_id, unnest(list_distinct(string_split(replace(lower(text), ' ', ''), ','))) AS term FROM documents
""")
def q_term_list(spark, sf):
    return _docs(spark, sf).select("doc_id", F.explode(term_list("text")).alias("term"))


@register("safe_name", """
SELECT page_id, regexp_replace(url, '[^-_.A-Za-z0-9]', '_', 'g') AS safe,
       'stream_' || regexp_replace(url, '[^-_.A-Za-z0-9]', '_', 'g') || '.json' AS file_name FROM pages
""")
def q_safe_name(spark, sf):
    pages = read_table(spark, sf, "pages", "page_id", "url")
    return pages.select("page_id", safe_name("url").alias("safe"), stream_file_name("url").alias("file_name"))


# ---------------------------------------------------------------------------
# De-duplication, mentions, scores, ranking

def _message_text():
    return rt_strip(ascii_strip(F.col("text")))


@register("dedup_counts", f"""
SELECT text, count(*) AS n, count(*) - 1 AS retweets
FROM (SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM documents) GROUP BY text
""")
def q_dedup_counts(spark, sf):
    return count_repeats(_docs(spark, sf).select(_message_text().alias("text")), "text")


@register("head_rows", f"""
SELECT text, count(*) AS n, count(*) - 1 AS retweets
FROM (SELECT {S.rt_sql(S.ascii_sql('text'))} AS text FROM documents) GROUP BY text
ORDER BY n DESC, text LIMIT 20
""")
def q_head_rows(spark, sf):
    counts = count_repeats(_docs(spark, sf).select(_message_text().alias("text")), "text")
    return counts.orderBy(F.col("n").desc(), F.col("text")).limit(20)


def _mention_sql(mode: str) -> str:
    h = S.hits_sql(S.tokens_sql("text"), TERMS)
    return f"SELECT doc_id, unnest({S.mode_sql('h', mode)}) AS term FROM (SELECT doc_id, {h} AS h FROM documents)"


def _mentions(spark, sf, mode: str) -> DataFrame:
    # One generator emits the hits, the next the mode's array: the cleaner runs once for each document.
    hits = _docs(spark, sf).select("doc_id", emit_nonempty(match_terms(clean_text_tokens("text"), TERMS)).alias("h"))
    return hits.select("doc_id", F.explode(mention_array("h", mode)).alias("term"))


def _score_sql(mode: str) -> str:
    return f"""
SELECT term, CAST(sum(l.quality) AS DOUBLE) / count(*) AS score, count(*) AS total_comments,
       CAST(sum(l.quality) AS BIGINT) AS positive_comments
FROM ({_mention_sql(mode)}) m JOIN labels l USING (doc_id) GROUP BY term"""


def _scores(spark, sf, mode: str) -> DataFrame:
    # Mentions are computed on the document side (narrow) and only (doc_id, terms)
    # meets the labels: the join never moves the text.
    hits = _docs(spark, sf).select("doc_id", emit_nonempty(match_terms(clean_text_tokens("text"), TERMS)).alias("h"))
    mentions = hits.join(_labels(spark, sf), "doc_id").select(F.explode(mention_array("h", mode)).alias("term"),
                                                               F.col("quality").alias("prediction"))
    return score_entities(mentions, "term", "prediction")


for _mode, _suffix in (("per_mention", "per"), ("last_mention", "last"), ("distinct", "distinct")):
    register(f"mentions_{_suffix}", _mention_sql(_mode))(lambda spark, sf, _m=_mode: _mentions(spark, sf, _m))
    register(f"score_{_suffix}", _score_sql(_mode))(lambda spark, sf, _m=_mode: _scores(spark, sf, _m))


@register("rank_entities", f"""
SELECT *, CAST(rank() OVER (ORDER BY score DESC) AS INTEGER) AS rank FROM ({_score_sql('per_mention')})
""")
def q_rank_entities(spark, sf):
    return rank_entities(_scores(spark, sf, "per_mention"), "term")


@register("predictions_table", f"""
WITH d AS (
  SELECT {S.rt_sql(S.ascii_sql('text'))} AS comment, l.quality FROM documents JOIN labels l USING (doc_id)
), c AS (
  SELECT comment, count(*) - 1 AS retweets, max(quality) AS prediction FROM d GROUP BY comment
), m AS (
  SELECT comment, retweets, prediction, {S.hits_sql(S.tokens_sql('comment'), TERMS)} AS h FROM c
), e AS (
  SELECT comment, retweets, prediction, unnest(h) AS airline, unnest(range(len(h))) AS mention_pos FROM m
)
SELECT airline, sha256(concat_ws('|', '{RUN_ID}', airline, CAST(mention_pos AS VARCHAR), comment)) AS id,
       TIMESTAMP '{RUN_TIME:%Y-%m-%d %H:%M:%S}' AS processing_time, '{RUN_ID}' AS processing_id,
       comment, retweets, prediction FROM e
""")
def q_predictions_table(spark, sf):
    d = _docs(spark, sf).join(_labels(spark, sf), "doc_id").select(_message_text().alias("comment"), "quality")
    c = d.groupBy("comment").agg((F.count(F.lit(1)) - 1).alias("retweets"), F.max("quality").alias("prediction"))
    m = c.select("comment", "retweets", "prediction",
                 emit_nonempty(match_terms(clean_tokens("comment", ascii_input=True), TERMS)).alias("h"))
    e = m.select("comment", "retweets", "prediction", F.posexplode("h").alias("mention_pos", "airline"))
    rows = with_run_columns(e, RUN_ID, RUN_TIME, [F.col("airline"), F.col("mention_pos").cast("string"), F.col("comment")])
    return rows.select("airline", "id", "processing_time", "processing_id", "comment", "retweets", "prediction")


# ---------------------------------------------------------------------------
# Labels, splits, labelled text

@register("hash_split", f"""
SELECT doc_id, {S.split_sql('doc_id')} AS split FROM documents
""")
def q_hash_split(spark, sf):
    return _docs(spark, sf, "doc_id").select("doc_id", split_column("doc_id").alias("split"))


@register("label_split", f"""
SELECT doc_id, {S.split_sql('doc_id')} AS split, CAST(l.quality AS VARCHAR) AS label, d.text AS sentiment
FROM documents d JOIN labels l USING (doc_id) WHERE CAST(l.quality AS VARCHAR) IN ('1', '0')
""")
def q_label_split(spark, sf):
    reviews = _docs(spark, sf).join(_labels(spark, sf), "doc_id").select(
        "doc_id", F.col("text").alias("content"), F.col("quality").alias("recommended"))
    return label_split(reviews, "doc_id")


@register("serialize_labeled", """
SELECT d.doc_id, concat_ws(':::', regexp_replace(coalesce(d.text, 'None'), '\\r\\n|\\r|\\n', ' ', 'g'),
                           coalesce(CAST(l.quality AS VARCHAR), 'None')) AS line,
       concat_ws(':::', coalesce(d.text, 'None'), coalesce(CAST(l.quality AS VARCHAR), 'None')) AS line_compat
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def q_serialize_labeled(spark, sf):
    joined = _docs(spark, sf).join(_labels(spark, sf), "doc_id", "left")
    return joined.select("doc_id", serialize_labeled("text", "quality").alias("line"),
                         serialize_labeled("text", "quality", compat=True).alias("line_compat"))


# Lines in every form the parser must accept or reject, one per labelled document.
_LINE_SQL = ("CASE doc_id % 7 WHEN 0 THEN text || ':::' || quality WHEN 1 THEN text || '::: ' || quality || ' ' "
             "WHEN 2 THEN text || ':::' || quality || '.0' WHEN 3 THEN text || ':::x:::' || quality "
             "WHEN 4 THEN text || '::::' || quality WHEN 5 THEN text || ':::+' || quality "
             "ELSE ':::' || quality END")


def _line_variant():
    m = F.pmod(F.col("doc_id"), F.lit(7))
    t, qv = F.col("text"), F.col("quality").cast("string")
    return (F.when(m == 0, F.concat(t, F.lit(":::"), qv))
            .when(m == 1, F.concat(t, F.lit("::: "), qv, F.lit(" ")))
            .when(m == 2, F.concat(t, F.lit(":::"), qv, F.lit(".0")))
            .when(m == 3, F.concat(t, F.lit(":::x:::"), qv))
            .when(m == 4, F.concat(t, F.lit("::::"), qv))
            .when(m == 5, F.concat(t, F.lit(":::+"), qv))
            .otherwise(F.concat(F.lit(":::"), qv)))


@register("parse_labeled", f"""
WITH l AS (SELECT doc_id, string_split({S.ascii_sql(_LINE_SQL)}, ':::') AS p
           FROM documents JOIN labels USING (doc_id))
SELECT doc_id, comment, sentiment FROM (
  SELECT doc_id, {S.normalize_sql('p[1]')} AS comment, {S.strict_int_sql('p[2]')} AS sentiment
  FROM l WHERE len(p) = 2) WHERE sentiment IS NOT NULL
""")
def q_parse_labeled(spark, sf):
    lines = _docs(spark, sf).join(_labels(spark, sf), "doc_id").select("doc_id", _line_variant().alias("value"))
    return parse_labeled(lines, "value", keep=["doc_id"])


@register("train_tokens", f"""
SELECT doc_id, {S.split_sql('doc_id')} AS split, comment, len(string_split(comment, ' ')) AS n_tokens, sentiment
FROM (SELECT doc_id, {S.normalize_sql(S.ascii_sql("coalesce(text, 'None')"))} AS comment, quality AS sentiment
      FROM documents JOIN labels USING (doc_id))
""")
def q_train_tokens(spark, sf):
    reviews = _docs(spark, sf).join(_labels(spark, sf), "doc_id").select(
        "doc_id", F.col("text").alias("content"), F.col("quality").alias("recommended"))
    rows = reviews_to_training(reviews.select("doc_id", "content", "recommended"), keep=["doc_id"])
    return rows.select("doc_id", split_column("doc_id").alias("split"), "comment",
                       F.size(F.split("comment", " ", -1)).cast("bigint").alias("n_tokens"), "sentiment")


# ---------------------------------------------------------------------------
# Keyed merge, linear prediction, error rate (K4, M6, A4)

@register("upsert_latest", f"""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch DESC, ts DESC, event_id DESC) AS rn
  FROM (SELECT *, CASE WHEN ts < TIMESTAMP '{UPSERT_CUT}' THEN 0 ELSE 1 END AS batch FROM events))
WHERE rn = 1
""")
def q_upsert_latest(spark, sf):
    ev = read_table(spark, sf, "events", "user_id", "event_id", "ts", "event_type", "value")
    cut = F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp")
    merged = upsert_latest(ev.where(cut), ev.where(~cut), ["user_id"], ["ts", "event_id"])
    return merged.select("user_id", "event_id", "event_type", "value")


def _linear_sql() -> str:
    w = "[" + ", ".join(repr(x) for x in LINEAR_WEIGHTS) + "]"
    return f"list_sum(list_transform(list_zip(CAST(embedding AS DOUBLE[]), {w}), lambda p: p[1] * p[2]))"


@register("linear_predict", f"""
SELECT vec_id, label, round(m, 6) AS margin, CAST(m > 0 AS INTEGER) AS prediction
FROM (SELECT vec_id, label, {_linear_sql()} AS m FROM embeddings)
""")
def q_linear_predict(spark, sf):
    from brandpulse.operators.model import linear_margin

    emb = read_table(spark, sf, "embeddings", "vec_id", "label", "embedding")
    m = linear_margin(F.col("embedding"), LINEAR_WEIGHTS)
    return emb.select("vec_id", "label", m.alias("m")).select(
        "vec_id", "label", F.round("m", 6).alias("margin"), (F.col("m") > 0).cast("int").alias("prediction"))


@register("error_rate", f"""
SELECT split, count(*) AS n, count(*) FILTER (WHERE quality <> prediction) AS wrong,
       CAST(count(*) FILTER (WHERE quality <> prediction) AS DOUBLE) / count(*) AS error
FROM (SELECT {S.split_sql('doc_id')} AS split, l.quality,
             CAST(len({S.hits_sql(S.tokens_sql('text'), TERMS)}) > 0 AS INTEGER) AS prediction
      FROM documents JOIN labels l USING (doc_id))
GROUP BY split
""")
def q_error_rate(spark, sf):
    pred = (_docs(spark, sf)
            .select("doc_id", (F.size(match_terms(clean_text_tokens("text"), TERMS)) > 0).cast("int").alias("prediction"))
            .join(_labels(spark, sf), "doc_id")
            .select(split_column("doc_id").alias("split"), "quality", "prediction"))
    return error_rate(pred, "quality", "prediction", ["split"])


__all__ = ["TERMS", "oracle_sql", "queries", "register"]


# ---------------------------------------------------------------------------
# A term *table* derived from the data (every distinct cleaned token of the
# benchmark passages, thousands of terms): the join path of W4/G1.

@register("mentions_table", f"""
WITH terms AS (SELECT DISTINCT lower(unnest({S.tokens_sql('text')})) AS term FROM benchmark),
toks AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos
         FROM (SELECT doc_id, {S.tokens_sql('text')} AS t FROM documents))
SELECT doc_id, term, CAST(pos AS BIGINT) AS mention_pos FROM toks JOIN terms ON lower(toks.token) = terms.term
""")
def q_mentions_table(spark, sf):
    from brandpulse.operators.mentions import explode_mentions_join

    bench = read_table(spark, sf, "benchmark", "text")
    terms = bench.select(F.explode(clean_text_tokens("text")).alias("term"))
    docs = _docs(spark, sf).select("doc_id", clean_text_tokens("text").alias("tokens"))
    out = explode_mentions_join(docs, "tokens", terms, "per_mention", term_col="term")
    return out.select("doc_id", "term", F.col("mention_pos").cast("bigint").alias("mention_pos"))
