"""Text helpers: keyword sentiment tag and prompt assembly (Column expressions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists of the sentiment tag (fixed values; negative words win over positive ones)
NEGATIVE_WORDS = ("bad", "terrible")
POSITIVE_WORDS = ("great", "excellent")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sentiment_tag(text, negative=NEGATIVE_WORDS, positive=POSITIVE_WORDS) -> Column:
    """'negative' if any negative word occurs (substring, case-insensitive), else 'positive' if any
    positive word occurs, else 'neutral'. NULL text gives NULL."""
    low = F.lower(_c(text))
    any_of = lambda words: reduce(lambda a, b: a | b, [low.contains(w.lower()) for w in words], F.lit(False))
    return (F.when(_c(text).isNull(), F.lit(None).cast("string"))
            .when(any_of(negative), "negative")
            .when(any_of(positive), "positive")
            .otherwise("neutral"))


# Default prompt of the order extraction; callers with other goods or columns pass their own
ORDER_PROMPT_TEMPLATE = (
    "Below is a message from a customer of a shop. List every good it orders, one line of comma-separated "
    "values per good: customer, order_date, delivery_date, item, quantity. Dates look like 2031-12-24; a date "
    "without a year is in the current year, and a missing order date is today. Answer with the lines only.\n\n"
    "Message:\n")


def prompt_build(text, template: str = ORDER_PROMPT_TEMPLATE) -> Column:
    return F.concat(F.lit(template), _c(text))
