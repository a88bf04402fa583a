"""Labels derived from a rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and the ratings that make a one-word review positive or negative.
BETTER, WORSE, NORMAL = "better", "worse", "normal"
POSITIVE, NEGATIVE = "positive", "negative"
GOOD_RATINGS = (4.0, 5.0)
BAD_RATINGS = (0.0, 1.0, 2.0)


def deviation(rating: Column, average: Column) -> Column:
    return rating - average


def deviation_label(difference: Column) -> Column:
    """Above, below or at the norm; with no norm to compare with, ``normal``."""
    return F.when(difference > 0, BETTER).when(difference < 0, WORSE).otherwise(NORMAL)


def keyword_sentiment(keyword: Column, rating: Column) -> Column:
    """Sentiment of a one-word review by its rating; null for longer texts and for a 3."""
    by_rating = F.when(rating.isin(*GOOD_RATINGS), POSITIVE).when(rating.isin(*BAD_RATINGS), NEGATIVE)
    return F.when(keyword.isNotNull(), by_rating)
