"""String and key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill import constants as K

# every character up to U+0020, which is what trimming removes
CONTROL_AND_SPACE = "".join(chr(i) for i in range(0x21))


def trimmed(text: Column) -> Column:
    """Strip all characters up to U+0020 from both ends."""
    return F.btrim(text, F.lit(CONTROL_AND_SPACE))


def file_stem(url: Column) -> Column:
    """Last path part without its extension, unsafe characters as ``_``."""
    name = F.substring_index(url, "/", -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.regexp_replace(stem, "[^a-zA-Z0-9_-]", "_")


def output_key(job_id: Column, method: Column, url: Column, line_no: Column | None = None) -> Column:
    """``prefix/job/METHOD-stem.txt``; with ``line_no`` no two tasks share a key."""
    stem = file_stem(url)
    if line_no is not None:
        stem = F.concat_ws("-", stem, line_no.cast("string"))
    return F.concat(
        F.lit(K.RESULTS_PREFIX + "/"), job_id.cast("string"), F.lit("/"), method, F.lit("-"), stem, F.lit(".txt")
    )


def object_bucket(url: Column) -> Column:
    """Bucket of ``s3://bucket/key``; null where the URL has another form."""
    part = F.regexp_extract(url, "^s3://([^/]*)/", 1)
    return F.when(url.rlike("^s3://[^/]*/"), part)


def object_key(url: Column) -> Column:
    """Key of ``s3://bucket/key``; the URL itself where it has another form."""
    return F.regexp_replace(url, "^s3://[^/]*/", "")


def console_link(url: Column) -> Column:
    """Browser link of an object; other URLs stay as they are."""
    bucket = object_bucket(url)
    link = F.concat(F.lit(K.CONSOLE_LINK), bucket, F.lit("?prefix="), object_key(url))
    return F.coalesce(link, url)


def html_escape(text: Column) -> Column:
    """Escape the five markup characters; null becomes the empty string."""
    out = F.coalesce(text, F.lit(""))
    for plain, entity in K.HTML_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def percent_decoded(name: Column) -> Column:
    """Resolve percent escapes; a plus sign stays one, and a stray percent sign leaves the name as it is."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
