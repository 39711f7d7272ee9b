"""URL helpers: percent-quoting, unquoting, public URLs and slice links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c

# Public object-store host layout (the bucket is a parameter).
PUBLIC_HOST = "https://{bucket}.s3.amazonaws.com"
DEFAULT_BUCKET = "example-bucket"


def url_quote(c: ColumnOrName) -> Column:
    """percent-encode UTF-8 keeping ``A-Za-z0-9_.-~/`` (Python's
    ``urllib.parse.quote`` defaults). ``url_encode`` is form encoding: it keeps
    ``*``, writes a blank as ``+`` and escapes ``~`` and ``/``; a literal ``+``
    is already ``%2B`` there, so every ``+`` left is a blank."""
    e = F.url_encode(_c(c))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    e = F.replace(e, F.lit("%7E"), F.lit("~"))
    return F.replace(e, F.lit("%2F"), F.lit("/"))


def url_unquote(c: ColumnOrName) -> Column:
    """percent-decode like ``urllib.parse.unquote``: ``+`` stays ``+``
    and a ``%`` that does not start a two-digit hex escape stays as is."""
    x = _c(c)
    guarded = F.regexp_replace(F.replace(x, F.lit("+"), F.lit("%2B")),
                               "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(guarded), x)


def public_url(key: ColumnOrName, bucket: str = DEFAULT_BUCKET, quote: bool = True,
               slash: bool = True) -> Column:
    """public URL of an object. The landing jobs quote the key and put a
    ``/`` after the host; the cohort API appends the stored path as is."""
    k = url_quote(key) if quote else _c(key)
    host = PUBLIC_HOST.format(bucket=bucket) + ("/" if slash else "")
    return F.concat(F.lit(host), k)


def slice_object_key(prefix: ColumnOrName, tag: ColumnOrName, i: ColumnOrName) -> Column:
    """K5 target key of slice ``i``: ``{prefix}/{tag}_{i}.jpg``."""
    return F.concat(_c(prefix), F.lit("/"), _c(tag), F.lit("_"), _c(i).cast("string"),
                    F.lit(".jpg"))


def enumerate_links(prefix: ColumnOrName, tag: ColumnOrName, n: ColumnOrName,
                    bucket: str = DEFAULT_BUCKET) -> Column:
    """A10: one public URL per slice index ``0..n-1``; ``n = 0`` gives an
    empty array."""
    n = _c(n).cast("int")
    # quoting works character by character: prefix and tag are quoted once per
    # row, and only the slice number and extension are added per slice
    stem = public_url(F.concat(_c(prefix), F.lit("/"), _c(tag), F.lit("_")), bucket)
    links = F.transform(F.array_repeat(stem, n),
                        lambda s, i: F.concat(s, i.cast("string"), F.lit(".jpg")))
    return F.when(n > 0, links).otherwise(F.array().cast("array<string>"))
