"""Documents offered to search: reviews and support tickets with their attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_search_docs(reviews: DataFrame, products: DataFrame, processed: DataFrame) -> DataFrame:
    """REVIEW_ID is the key of reviews. What is joined to a review is put together first
    without its text, so that texts move once at most."""
    names = products.select("PRODUCT_ID", "PRODUCT_NAME", "CATEGORY", "BRAND")
    scores = processed.select("REVIEW_ID", "SENTIMENT_LABEL", "SENTIMENT_SCORE")
    about = reviews.select("REVIEW_ID", "PRODUCT_ID").join(names, "PRODUCT_ID", "left").drop("PRODUCT_ID")
    return (
        reviews.join(about.join(scores, "REVIEW_ID", "left"), "REVIEW_ID", "left")
        .select(
            "REVIEW_ID",
            "REVIEW_TEXT",
            "RATING",
            "REVIEW_DATE",
            "HELPFUL_VOTES",
            "PRODUCT_NAME",
            "CATEGORY",
            "BRAND",
            F.coalesce("SENTIMENT_LABEL", F.lit("unknown")).alias("SENTIMENT_LABEL"),
            F.coalesce("SENTIMENT_SCORE", F.lit(0.0)).alias("SENTIMENT_SCORE"),
        )
    )


def ticket_search_docs(tickets: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    people = customers.select("CUSTOMER_ID", "CUSTOMER_SEGMENT", F.col("STATE").alias("CUSTOMER_STATE"))
    names = products.select("PRODUCT_ID", "PRODUCT_NAME", F.col("CATEGORY").alias("PRODUCT_CATEGORY"))
    content = F.concat("TICKET_SUBJECT", F.lit(". "), F.coalesce("TICKET_DESCRIPTION", F.lit("")))
    return (
        tickets.join(people, "CUSTOMER_ID", "left")
        .join(names, "PRODUCT_ID", "left")
        .select(
            "TICKET_ID",
            content.alias("TICKET_CONTENT"),
            "TICKET_SUBJECT",
            "CATEGORY",
            "PRIORITY",
            "STATUS",
            "RESOLUTION_TIME_HOURS",
            "SATISFACTION_SCORE",
            "CREATED_AT",
            "CUSTOMER_SEGMENT",
            "CUSTOMER_STATE",
            F.coalesce("PRODUCT_NAME", F.lit("N/A")).alias("PRODUCT_NAME"),
            F.coalesce("PRODUCT_CATEGORY", F.lit("N/A")).alias("PRODUCT_CATEGORY"),
        )
    )
