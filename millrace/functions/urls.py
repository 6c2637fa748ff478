"""URL expressions that stay in the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AUTHORITY = r"(?i)^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\s]*)"


def host(url: Column | str) -> Column:
    """Lower-case host name of ``url`` without user, port; NULL without one."""
    return F.nullif(F.lower(F.regexp_extract(url, _AUTHORITY, 1)), F.lit(""))


def site(url: Column | str) -> Column:
    """Host without a leading ``www.``; other subdomains are sites of their own."""
    return F.nullif(F.regexp_replace(host(url), r"^www\.", ""), F.lit(""))


def join_url(base: Column | str, reference: Column | str) -> Column:
    """RFC 3986 resolution of ``reference`` against ``base``.

    Absolute, ``//host`` and ``/root`` references without dot segments, which
    are nearly all, are joined in the JVM; the rest goes to the standard
    library in Arrow batches.  NULL on either side gives NULL; a reference
    that can't be parsed gives NULL.
    """
    base_col = F.col(base) if isinstance(base, str) else base
    ref = F.col(reference) if isinstance(reference, str) else reference
    scheme = F.regexp_extract(base_col, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    root = F.regexp_extract(base_col, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    plain = ~ref.rlike(r"(^|/)\.{1,2}(/|$|[?#])|[\s\x00-\x20]") & (root != "") & scheme.rlike("^https?$")
    return (
        F.when(plain & ref.rlike(r"^https?://[^/?#]+"), ref)
        .when(plain & ref.rlike(r"^//[^/]"), F.concat(scheme, F.lit(":"), ref))
        .when(plain & ref.rlike(r"^/([^/]|$)"), F.concat(root, ref))
        .otherwise(_join_udf()(base_col, ref))
    )


def _join_udf():
    @F.pandas_udf(T.StringType())
    def run(base: pd.Series, reference: pd.Series) -> pd.Series:
        from urllib.parse import urljoin

        def one(b: str | None, r: str | None) -> str | None:
            try:
                return None if b is None or r is None else urljoin(b, r)
            except ValueError:
                return None

        return pd.Series([one(b, r) for b, r in zip(base, reference)], dtype=object)

    return run
