"""Failures as data: classes of codes, resuming decisions, page samples, and the guard against empty results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code, category, whether it may be tried again.
CLASSES: tuple[tuple[str, str, bool], ...] = (
    ("HOST_DEFERRED", "network", False),
    ("DNS_ERROR", "network", True),
    ("TLS_CERTIFICATE_ERROR", "network", False),
    ("TLS_HANDSHAKE_TIMEOUT", "network", True),
    ("TLS_ERROR", "network", True),
    ("NETWORK_TIMEOUT", "network", True),
    ("CONNECTION_ERROR", "network", True),
    ("TRANSPORT_ERROR", "network", True),
    ("BACKEND_UNAVAILABLE", "environment", False),
    ("OBSERVATION_OUT_OF_SCOPE", "eligibility", False),
    ("NO_STRUCTURED_TABLES", "parse", False),
    ("OCR_EMPTY", "parse", False),
    ("NO_CANDIDATES", "parse", False),
    ("NO_PANEL_ROWS", "parse", False),
    ("PARSING_OR_CONFIGURATION_ERROR", "parse", False),
)
#: Answers of a server after which a request may be made again.
AGAIN = (408, 429, 500, 502, 503, 504)


def classified(code: Column) -> Column:
    """struct(category, retryable) of a failure code; HTTP_n is a network failure, to be tried again for the codes in ``AGAIN``; others are parse failures."""
    status = F.regexp_extract(code, "^HTTP_([0-9]{3})$", 1).try_cast("int")
    out = F.when(code.isNull(), F.lit(None)).when(status.isNotNull(), F.struct(F.lit("network").alias("category"), status.isin(*AGAIN).alias("retryable")))
    for c, category, retry in CLASSES:
        out = out.when(code == c, F.struct(F.lit(category).alias("category"), F.lit(retry).alias("retryable")))
    return out.otherwise(F.struct(F.lit("parse").alias("category"), F.lit(False).alias("retryable")))


def resume_decision(status: Column, same_validator: Column, partial: Column) -> Column:
    """What to do with the answer to a transfer: append, restart, or discard the partial file and fail."""
    return (
        F.when((status == 206) & same_validator & (partial > 0), "append")
        .when((status == 206), "discard_and_fail")
        .when(status == 200, "restart")
        .otherwise("fail")
    )


def sampled_pages(pages: Column, wanted: Column | None = None) -> Column:
    """Pages to probe: those wanted, at most 8, else the first, third, eighth, middle and last; only pages there are."""
    usual = F.array(F.lit(1), F.lit(3), F.lit(8), F.floor((pages + 1) / 2).cast("int"), pages)
    chosen = usual if wanted is None else F.coalesce(F.slice(wanted, 1, 8), usual)
    return F.array_sort(F.array_distinct(F.filter(chosen, lambda p: (p >= 1) & (p <= pages))))


def require_rows(df: DataFrame, code: str) -> DataFrame:
    """``df``; raises with ``code`` if it is empty, since an empty result is a failure."""
    if df.isEmpty():
        raise ValueError(code)
    return df
