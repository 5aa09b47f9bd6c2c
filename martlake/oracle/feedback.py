"""Oracle SQL for the feedback flow."""

from martlake.sources.bindings import RAW_FEEDBACK_SQL, with_bindings

_BASE = """
rf AS (SELECT *, row_number() OVER (ORDER BY s_e, s_c) AS sq FROM raw_feedback),
fd0 AS (
  SELECT ProductID, coalesce(user_id, 0) AS UserID, review_id AS GeneralFeedbackID, review_title AS Title,
         review_content AS Content, review_upvote AS Upvote, review_rating AS Rating,
         strftime(make_timestamp(review_created_at * 1000000), '%Y-%m-%d %H:%M:%S') AS CreatedDate, sq
  FROM rf
  WHERE ProductID IS NOT NULL AND review_id IS NOT NULL AND review_upvote IS NOT NULL AND review_rating IS NOT NULL),
fd AS (SELECT ProductID, UserID, GeneralFeedbackID, Title, Content, Upvote, Rating, CreatedDate, min(sq) AS sq
       FROM fd0 GROUP BY ALL),
a6 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ProductID, UserID, GeneralFeedbackID, CreatedDate
                                 ORDER BY coalesce(length(Content) - length(replace(Content, '*', '')), 0), sq) AS rn
    FROM fd
    WHERE ProductID IS NOT NULL AND UserID IS NOT NULL AND GeneralFeedbackID IS NOT NULL AND CreatedDate IS NOT NULL)
  WHERE rn = 1),
users AS (
  SELECT coalesce(user_id, 0) AS UserID, username AS RawName, coalesce(username, 'Unknown') AS Name,
         try_strptime(joined_time, '%Y-%m-%d %H:%M:%S') AS JoinedDate, sq
  FROM rf WHERE coalesce(user_id, 0) <> 0)
"""

_W = with_bindings(RAW_FEEDBACK_SQL, _BASE)
TS = "'%Y-%m-%d %H:%M:%S'"

SQL = {
    "history": _W + """
SELECT row_number() OVER (ORDER BY sq) AS HistoryID, UserID, TotalReview, TotalUpvote FROM (
  SELECT coalesce(user_id, 0) AS UserID, coalesce(total_reviews, 0) AS TotalReview,
         coalesce(total_upvotes, 0) AS TotalUpvote, min(sq) AS sq
  FROM rf GROUP BY ALL HAVING UserID <> 0)""",
    "user_dim": _W + f"""
SELECT UserID, Name, strftime(JoinedDate, {TS}) AS JoinedDate FROM (
  SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY JoinedDate NULLS LAST, sq) AS rn FROM users)
WHERE rn = 1""",
    "priority_dedup": _W + f"""
SELECT UserID, RawName AS Name, strftime(JoinedDate, {TS}) AS JoinedDate FROM (
  SELECT *, row_number() OVER (PARTITION BY UserID ORDER BY (JoinedDate IS NULL), length(coalesce(RawName, '')) DESC,
                                (RawName IS NULL), sq) AS rn FROM users)
WHERE rn = 1""",
    "general_feedback": _W + """
SELECT DISTINCT coalesce(review_id, 0) AS GeneralFeedbackID, coalesce(OneStarCount, 0) AS OneStar,
       coalesce(TwoStarCount, 0) AS TwoStar, coalesce(ThreeStarCount, 0) AS ThreeStar,
       coalesce(FourStarCount, 0) AS FourStar, coalesce(FiveStarCount, 0) AS FiveStar,
       coalesce(reviews_count, 0) AS ReviewCount, '2002-01-01 00:00:00' AS LastUpdated
FROM rf""",
    "unmasked_content": _W + """
SELECT ProductID, UserID, GeneralFeedbackID, CreatedDate, Title, Content, Upvote, Rating FROM a6""",
    "feedback_detail": _W + """
SELECT row_number() OVER (ORDER BY ProductID, UserID, GeneralFeedbackID, CreatedDate) AS FeedbackDetailID,
       ProductID, UserID, GeneralFeedbackID, Title, Content, Upvote, Rating, CreatedDate
FROM (SELECT *, row_number() OVER (PARTITION BY GeneralFeedbackID ORDER BY ProductID, UserID, CreatedDate) AS rn FROM a6)
WHERE rn = 1""",
    "strict_cast_quarantine": _W + """
SELECT ProductID, coalesce(user_id, 0) AS UserID, review_id AS GeneralFeedbackID, review_upvote AS Upvote,
       review_rating AS Rating,
       concat_ws(',', CASE WHEN ProductID IS NULL THEN 'ProductID' END,
                      CASE WHEN review_id IS NULL THEN 'GeneralFeedbackID' END,
                      CASE WHEN review_upvote IS NULL THEN 'Upvote' END,
                      CASE WHEN review_rating IS NULL THEN 'Rating' END) AS _error
FROM rf
WHERE ProductID IS NULL OR review_id IS NULL OR review_upvote IS NULL OR review_rating IS NULL""",
}

# The load writes the same rows, valid and rejected ones in one pass.
SQL["detail_load"] = SQL["feedback_detail"]
SQL["detail_quarantine"] = SQL["strict_cast_quarantine"]
