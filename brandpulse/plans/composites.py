"""User-level jobs: compositions of the operators, DataFrame in,
DataFrame out, plus runners that write their sinks.

C1's plan, as written here, differs from the reference's order on purpose:

1. records -> text (F1-F4) and the term hits (F5, F6, W4) are computed per row,
   *before* the shuffle, and rows without a hit are dropped there: a message
   that names no brand yields no output row in any mode, so it need not be
   shuffled, vectorised or classified;
2. repeats are counted by ``groupBy(text, hits)`` (A1; the hits are a function
   of the text, so the groups are the texts) with map-side partial counts, so a
   text repeated a billion times is reduced inside each task;
3. only the surviving distinct texts are tokenised again and classified (M2, M6);
4. mentions are exploded (G1) and, in the runner, written first; the scores
   (A2, A3) are aggregated from the written predictions, which cuts lineage and
   never recomputes the model step after a lost executor.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandpulse.functions.text import clean_tokens, emit_nonempty, emit_text, normalize_terms, record_text
from brandpulse.operators.labels import label_split, parse_labeled, reviews_to_training, split_column
from brandpulse.operators.mentions import (
    DEFAULT_MAX_INLINE_TERMS,
    match_terms,
    match_terms_table,
    mention_array,
    term_table,
)
from brandpulse.operators.model import SentimentModel, sample_eval, train_and_report
from brandpulse.operators.scoring import count_repeats, rank_entities, score_entities
from brandpulse.session import written
from brandpulse.sinks.writers import (
    latest_scores,
    read_predictions,
    with_run_columns,
    write_label_split,
    write_labeled_text,
    write_predictions,
    write_scores_version,
)
from brandpulse.sources.readers import read_labeled_text, read_reviews_csv


@dataclass
class MentionResult:
    predictions: DataFrame
    scores: DataFrame
    model: SentimentModel
    run_id: str
    mentions: DataFrame                 # one row per mention (compat folds equal keys in ``predictions``)
    report: DataFrame | None = None     # (split, n, wrong, error) of the trained model
    by_brand: DataFrame | None = None   # one row per text and brand, with the positions of its mentions
    rows_of: Callable[[DataFrame], DataFrame] | None = None     # ``by_brand`` to mention rows


def message_texts(messages: DataFrame, value_col: str = "value", compat: bool = False) -> DataFrame:
    """S1 + F1-F4 + W2: raw JSON lines to ``text`` (one row per record kept)."""
    return messages.select(emit_text(record_text(value_col, compat=compat), compat=compat).alias("text"))


def training_rows(reviews: DataFrame, content_col: str = "content", label_col: str = "recommended",
                  compat: bool = False, train_fraction: float = 0.8) -> DataFrame:
    """M8: reviews to ``(comment ARRAY<STRING>, sentiment INT, split)``; stable split on the text."""
    rows = reviews_to_training(reviews, content_col, label_col, compat=compat)
    return rows.select(
        F.split("comment", " ", -1).alias("comment"),
        "sentiment",
        split_column(F.col("comment"), train_fraction).alias("split"),
    )


def score_mentions(messages: DataFrame, reviews: DataFrame | None, terms: str | Iterable[str] | DataFrame,
                   mode: str | None = None, compat: bool = False, run_id: str | None = None,
                   processing_time: _dt.datetime | None = None, model: SentimentModel | None = None,
                   value_col: str = "value", fit_kw: dict | None = None,
                   max_inline_terms: int = DEFAULT_MAX_INLINE_TERMS) -> MentionResult:
    """Classify messages that name a term and score each term.

    ``messages``: raw JSON lines in ``value_col``. ``reviews``: ``(content,
    recommended)`` to train on (or pass a fitted ``model``). ``terms``: a
    comma-separated string, a list, or a one-column DataFrame (any size), all under
    the same rule: lower-case, spaces deleted, nulls dropped, distinct. Beyond
    ``max_inline_terms`` distinct terms they are matched by a join; the result is the same.
    ``compat`` reproduces the reference as it runs: last-mention rows sharing one
    id (T1, T2), 'null'-prefix drop (T7), fail-fast parsing (T8), ':::' losses (T9)
    and the SGD trainer. A model trained here comes with its error ``report``.
    """
    mode = mode or ("last_mention" if compat else "per_mention")
    run_id = run_id or str(uuid.uuid4())
    processing_time = processing_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    texts = message_texts(messages, value_col, compat)

    report = None
    if model is None:
        if reviews is None:
            raise ValueError("give reviews to train on, or a fitted model")
        model, report = _trained(training_rows(reviews, compat=compat), compat, fit_kw)

    if not isinstance(terms, DataFrame):
        term_list = normalize_terms(terms)
        if len(term_list) > max_inline_terms:
            terms = messages.sparkSession.createDataFrame([(t,) for t in term_list], "term string")
    if isinstance(terms, DataFrame):
        table = term_table(terms, terms.columns[0])
        # At most max_inline_terms + 1 rows come to the driver.
        some = [r[0] for r in table.limit(max_inline_terms + 1).collect()]
        term_list = some if len(some) <= max_inline_terms else None
    if term_list is None or len(term_list) > max_inline_terms:
        # Distinct texts first, then their hits by an equi-join.
        counted = count_repeats(texts, "text").select("text", "retweets",
                                                      clean_tokens("text", ascii_input=True).alias("_tok"))
        counted = match_terms_table(counted, "_tok", terms, term_col=terms.columns[0])
    else:
        hits = texts.select("text", emit_nonempty(match_terms(clean_tokens("text", ascii_input=True), term_list)).alias("hits"))
        counted = count_repeats(hits, "text", extra_keys=["hits"])
    # Only distinct texts that name a term are vectorised and classified.
    scored = model.predict(counted.withColumn(model.input_col, clean_tokens("text", ascii_input=True)))
    scored = scored.select(F.col("text").alias("comment"), "retweets", "prediction", "hits")
    mentions = scored.select(
        "comment", "retweets", "prediction",
        F.posexplode(mention_array("hits", mode)).alias("mention_pos", "airline"),
    )

    # Row id: stable under recomputation. Compat: the n copies of a last mention share one id.
    id_cols = ([F.col("airline"), F.col("comment")] if compat
               else [F.col("airline"), F.col("mention_pos").cast("string"), F.col("comment")])
    columns = ["airline", "id", "processing_time", "processing_id", "comment", "retweets", "prediction"]
    rows = with_run_columns(mentions, run_id, processing_time, id_cols)
    scores = score_entities(rows, "airline", "prediction").withColumn("processing_id", F.lit(run_id))
    predictions = rows.select(*columns)

    # The generator stands between, so that the mode's array is built once.
    placed = scored.select("comment", "retweets", "prediction", F.explode(F.array(mention_array("hits", mode))).alias("_m"))
    by_brand = placed.select(F.explode(F.array_distinct("_m")).alias("airline"), "comment", "retweets", "prediction", "_m")
    at = F.transform("_m", lambda b, i: F.when(b == F.col("airline"), i))
    by_brand = by_brand.select("airline", "comment", "retweets", "prediction", F.array_compact(at).alias("_at"))

    def rows_of(dealt: DataFrame) -> DataFrame:
        each = dealt.select("airline", "comment", "retweets", "prediction", F.explode("_at").alias("mention_pos"))
        return with_run_columns(each, run_id, processing_time, id_cols).select(*columns)

    if compat:
        predictions = predictions.dropDuplicates(["airline", "id"])
    scores = scores.select("airline", "score", "processing_id", "total_comments", "positive_comments")
    return MentionResult(predictions=predictions, scores=scores, model=model, run_id=run_id,
                         mentions=rows.select(*predictions.columns), report=report, by_brand=by_brand, rows_of=rows_of)


def _trained(rows: DataFrame, compat: bool, fit_kw: dict | None) -> tuple[SentimentModel, DataFrame]:
    """M7 with the reference's trainer under ``compat``: the model and its error on both splits."""
    kw = dict(fit_kw or {})
    if compat:
        kw.setdefault("trainer", "sgd")
    return train_and_report(rows, **kw)


def run_score_job(spark: SparkSession, messages: DataFrame, reviews: DataFrame | None, terms,
                  predictions_path: str, scores_root: str, **kw) -> DataFrame:
    """C1 runner: write predictions (K3), then merge scores computed from the written rows (K4).

    Returns the newest score table. The classifier runs once, even if an executor is lost in between, and
    only this run's folder is read back. The same run can be written again without repeating a row.
    """
    return run_score_job_report(spark, messages, reviews, terms, predictions_path, scores_root, **kw)[0]


def run_score_job_report(spark: SparkSession, messages: DataFrame, reviews: DataFrame | None, terms,
                         predictions_path: str, scores_root: str, **kw) -> tuple[DataFrame, DataFrame | None]:
    """``run_score_job`` and the error report of the model it trained (None for a given model)."""
    result = score_mentions(messages, reviews, terms, **kw)
    if kw.get("compat"):
        # The reference scores every mention row, before the keyed table folds equal keys: both come from
        # the mention rows, written once.
        rows = written(result.mentions, "mentions")
        write_predictions(rows.dropDuplicates(["airline", "id"]), predictions_path, result.run_id)
    else:
        write_predictions(result.by_brand, predictions_path, result.run_id, rows_of=result.rows_of)
        rows = read_predictions(spark, predictions_path, result.run_id)
    scores = score_entities(rows, "airline", "prediction").withColumn("processing_id", F.lit(result.run_id))
    scores = scores.select("airline", "score", "processing_id", "total_comments", "positive_comments")
    write_scores_version(spark, scores, scores_root)
    return latest_scores(spark, scores_root), result.report


def prepare_reviews(spark: SparkSession, csv_path: str, out_path: str, single_file: bool = False,
                    compat: bool = False) -> None:
    """Review CSV -> labelled text, one line per review."""
    reviews = read_reviews_csv(spark, csv_path)
    write_labeled_text(reviews, out_path, single_file=single_file, compat=compat)


def saved_text_rows(spark: SparkSession, labeled_path: str) -> DataFrame:
    """S3 + M8: labelled text lines to ``(comment ARRAY<STRING>, sentiment, split)``."""
    rows = parse_labeled(read_labeled_text(spark, labeled_path))
    return rows.select(F.split("comment", " ", -1).alias("comment"), "sentiment",
                       split_column(F.col("comment")).alias("split"))


def score_from_saved_text(spark: SparkSession, messages: DataFrame, labeled_path: str, terms,
                          mode: str | None = None, compat: bool = False, **kw) -> MentionResult:
    """Train from labelled text lines (with the error report) and classify; its predictions are the job's output."""
    model, report = _trained(saved_text_rows(spark, labeled_path), compat, kw.pop("fit_kw", None))
    result = score_mentions(messages, None, terms, mode=mode, compat=compat, model=model, **kw)
    result.report = report
    return result


def split_reviews(spark: SparkSession, csv_path: str, out_path: str, single_file: bool = False,
                  compat: bool = False) -> None:
    """C4: review CSV -> positive/negative x train/valid outputs (one partitioned write)."""
    reviews = read_reviews_csv(spark, csv_path)
    # The stable split is keyed on the review text (CSV rows carry no id).
    keyed = reviews.withColumn("_key", F.col("content"))
    write_label_split(label_split(keyed, "_key"), out_path, single_file=single_file, compat=compat)


def train_and_report_text(spark: SparkSession, labeled_path: str, samples: DataFrame | None = None,
                          **fit_kw) -> tuple[SentimentModel, DataFrame]:
    """Labelled text -> model and an error table (train, valid and, given samples, the samples)."""
    model, report = train_and_report(saved_text_rows(spark, labeled_path), **fit_kw)
    if samples is not None:
        sample = sample_eval(model, samples).withColumn("split", F.lit("samples"))
        report = report.unionByName(sample)
    return model, report


def ranking(scores: DataFrame, min_comments: int = 0, top_k: int | None = None) -> DataFrame:
    """N1 over a score table (``airline`` entity column)."""
    return rank_entities(scores, "airline", min_comments=min_comments, top_k=top_k)
