"""Feedback flow: raw review rows -> History, User, GeneralFeedback and
FeedbackDetail tables (exact step order of the daily load)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.exprs import epoch_to_text, lenient_timestamp, reference_time, ts_text, unknown_if_null, zero_if_null
from martlake.operators.dedup import earliest_dated, least_masked, priority_pick
from martlake.operators.order import SEQ, dense_id, distinct_rows, keep_first, tag_run
from martlake.operators.quality import strict_cast

DEFAULT_TZ_OFFSET_HOURS = 0
DETAIL_KEYS = ["ProductID", "UserID", "GeneralFeedbackID", "CreatedDate"]
# Columns whose null or unparsable value is an error in FeedbackDetail (ints).
DETAIL_STRICT = {"ProductID": "bigint", "GeneralFeedbackID": "bigint", "Upvote": "bigint", "Rating": "bigint"}


def history(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """Distinct (user, totals) rows, user 0 dropped, numbered by first arrival."""
    h = raw.select(zero_if_null(F.col("user_id")).alias("UserID"),
                   zero_if_null(F.col("total_reviews")).alias("TotalReview"),
                   zero_if_null(F.col("total_upvotes")).alias("TotalUpvote"), SEQ)
    h = distinct_rows(h).filter(F.col("UserID") != 0)
    h = dense_id(h, [F.col(SEQ)], "HistoryID")
    return tag_run(h.select("HistoryID", "UserID", "TotalReview", "TotalUpvote"), run_id)


def _user_rows(raw: DataFrame, fill_name: bool) -> DataFrame:
    name = unknown_if_null("username") if fill_name else F.col("username").cast("string")
    u = raw.select(zero_if_null(F.col("user_id")).alias("UserID"), name.alias("Name"),
                   lenient_timestamp("joined_time").alias("JoinedDate"), SEQ)
    return u.filter(F.col("UserID") != 0)


def user_dim(raw: DataFrame) -> DataFrame:
    """One row per user: the earliest dated row, else the first row."""
    u = earliest_dated(_user_rows(raw, fill_name=True), "UserID", "JoinedDate")
    return u.select("UserID", "Name", ts_text("JoinedDate").alias("JoinedDate"))


def priority_user(raw: DataFrame) -> DataFrame:
    """One row per user by the priority rules (dated, longest name, non-null
    name, first), applied to raw rows with names not yet filled."""
    u = priority_pick(_user_rows(raw, fill_name=False), "UserID", "JoinedDate", "Name")
    return u.select("UserID", "Name", ts_text("JoinedDate").alias("JoinedDate"))


def general_feedback(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """Per review the page-level star counts, counts null -> 0, plus run time; distinct."""
    return general_feedback_rows(raw, as_of, tz_offset_hours).dropDuplicates()


def general_feedback_rows(raw: DataFrame, as_of: str, tz_offset_hours: int = DEFAULT_TZ_OFFSET_HOURS) -> DataFrame:
    """General-feedback rows before the distinct (one per raw review row)."""
    ref = reference_time(as_of, tz_offset_hours)
    g = raw.select(
        zero_if_null(F.col("review_id")).alias("GeneralFeedbackID"),
        zero_if_null(F.col("OneStarCount")).alias("OneStar"),
        zero_if_null(F.col("TwoStarCount")).alias("TwoStar"),
        zero_if_null(F.col("ThreeStarCount")).alias("ThreeStar"),
        zero_if_null(F.col("FourStarCount")).alias("FourStar"),
        zero_if_null(F.col("FiveStarCount")).alias("FiveStar"),
        zero_if_null(F.col("reviews_count")).alias("ReviewCount"),
        ts_text(ref).alias("LastUpdated"))
    return g


def detail_columns(raw: DataFrame) -> DataFrame:
    """The detail columns of raw review rows, before the strict casts.

    Title/Content stay null when missing (not the text 'nan')."""
    return raw.select(
        F.col("ProductID"), zero_if_null(F.col("user_id")).alias("UserID"),
        F.col("review_id").alias("GeneralFeedbackID"), F.col("review_title").cast("string").alias("Title"),
        F.col("review_content").cast("string").alias("Content"), F.col("review_upvote").alias("Upvote"),
        F.col("review_rating").alias("Rating"), F.col("review_created_at").alias("CreatedDate"), SEQ)


def detail_versions(valid: DataFrame) -> DataFrame:
    """Distinct conformed detail rows of the rows that passed the casts."""
    return distinct_rows(valid.withColumn("CreatedDate", epoch_to_text(F.col("CreatedDate").try_cast("bigint"))))


def detail_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conformed detail rows and the quarantine of rows failing a strict cast."""
    valid, quarantine = strict_cast(detail_columns(raw), DETAIL_STRICT)
    return detail_versions(valid), quarantine


def unmasked_content(raw: DataFrame) -> DataFrame:
    """Per (product, user, review, created) the version of the text with the
    fewest '*'; rows with a null key part are dropped."""
    valid, _ = detail_rows(raw)
    return least_masked(valid, DETAIL_KEYS, "Content")


def one_per_review(versions: DataFrame) -> DataFrame:
    """Least-masked rows, first per review in (product, user, created) order."""
    a6 = least_masked(versions, DETAIL_KEYS, "Content").drop(SEQ)
    return keep_first(a6, ["GeneralFeedbackID"], [F.col("ProductID"), F.col("UserID"), F.col("CreatedDate")])


def feedback_detail_rows(raw: DataFrame) -> DataFrame:
    """The detail table without its ordinal id (enough for aggregates)."""
    return one_per_review(detail_rows(raw)[0])


def detail_table(versions: DataFrame, run_id: str | None = None) -> DataFrame:
    """:func:`one_per_review` plus a dense FeedbackDetailID in
    (product, user, review, created) order."""
    out = dense_id(one_per_review(versions), [F.col(c) for c in DETAIL_KEYS], "FeedbackDetailID")
    out = out.select("FeedbackDetailID", "ProductID", "UserID", "GeneralFeedbackID", "Title", "Content",
                     "Upvote", "Rating", "CreatedDate")
    return tag_run(out, run_id)


def feedback_detail(raw: DataFrame, run_id: str | None = None) -> DataFrame:
    """:func:`detail_table` of raw review rows."""
    return detail_table(detail_rows(raw)[0], run_id)


def detail_quarantine(raw: DataFrame) -> DataFrame:
    """Rows the strict casts reject, with the failing columns named."""
    _, q = detail_rows(raw)
    return q.select("ProductID", "UserID", "GeneralFeedbackID", "Upvote", "Rating", "_error")
