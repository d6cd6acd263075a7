"""URL-safe random tokens (``secrets.token_urlsafe``) as a column.

Non-deterministic by nature: a retried task draws new tokens, so write the
result once (``sources.sinks.write_table``) before anything else reads it.
Arrow-batched pandas UDF; the randomness comes from the OS generator.
"""

from __future__ import annotations

import secrets

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN_BYTES = 32  # 32 random bytes -> 43 URL-safe characters


@F.pandas_udf(T.StringType())
def _tokens(anchor: pd.Series) -> pd.Series:
    return pd.Series([secrets.token_urlsafe(TOKEN_BYTES) for _ in range(len(anchor))], dtype=object)


_token_udf = _tokens.asNondeterministic()


def url_token(anchor) -> Column:
    """A fresh token per row (``anchor`` is any column; it only sizes the batch)."""
    a = F.col(anchor) if isinstance(anchor, str) else anchor
    return _token_udf(a)


def reset_url(base_url: str, anchor) -> Column:
    """``base_url + token_urlsafe()``."""
    return F.concat(F.lit(base_url), url_token(anchor))
