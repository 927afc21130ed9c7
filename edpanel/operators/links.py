"""Raw files and web-page links (A1, A3, A5).

- :func:`file_hashes` hashes files by stream in the tasks that their listing is spread over.
- :func:`resolve_links` finds, per page, the first anchor (document order) whose text
  matches a pattern, and absolutises its href against the page URL; :func:`resolve_files`
  is the second step on a category page. Pages are independent: one projection, no shuffle.
"""

from __future__ import annotations

import functools
import hashlib
import operator
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Link-resolution fixed values.
ANCHOR_PATTERN = r"(?is)<a\b[^>]*>.*?</a>"
HREF_PATTERN = r"""(?is)^<a\b(?:[^>"']|"[^"]*"|'[^']*')*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
ANCHOR_TEXT_PATTERN = r"(?is)^<a\b[^>]*>(.*)</a>$"
EXCLUDED_TEXT = "time series"
FILE_SUFFIX_PATTERN = r"(?i)\.xlsx?$"
FILE_TEXTS = ("monthly a&e", "monthly ae")


CHUNK_BYTES = 8 << 20             # of a file held in memory while it is hashed


def _open_stream(path: str):
    """A byte stream of a listed file, in the task that hashes it."""
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    from pyarrow import fs
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_stream(inner)


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        hashes = []
        for path in files["path"]:
            digest = hashlib.sha256()
            with _open_stream(path) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            hashes.append(digest.hexdigest())
        yield files.assign(sha256=hashes)


def file_hashes(spark: SparkSession, path_glob: str) -> DataFrame:
    """path, name, size and SHA-256 of every file under ``path_glob`` (A1). The listing reads no content;
    the task that holds a file's row reads the file in chunks, so its size has no bound but the task's time.
    Files without a byte have no row, as Spark's scan passes them over; a path that does not exist is an error."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path_glob)
              .select("path", F.col("length").alias("size_bytes")))
    hashed = listed.mapInPandas(_hash_batches, "path string, size_bytes long, sha256 string")
    return hashed.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "size_bytes", "sha256")


def content_hashes(rows: DataFrame, content_col: str) -> DataFrame:
    """``rows`` with the size in bytes and the SHA-256 of a text or binary column (A1)."""
    return rows.withColumns({"size_bytes": F.octet_length(content_col).cast("long"), "sha256": F.sha2(F.col(content_col), 256)})


def read_archived(spark: SparkSession, archive_root: str, ingest_date: str) -> DataFrame:
    """Read back archived raw files of one ingest date (A5): the archive is partitioned
    by ``ingest_date``, so the filter prunes to that one folder."""
    return spark.read.parquet(archive_root).where(F.col("ingest_date") == F.lit(ingest_date))


def anchor_text(anchor: F.Column) -> F.Column:
    """Visible text of an anchor: inner tags stripped, the common entities decoded,
    whitespace collapsed."""
    inner = F.regexp_extract(anchor, ANCHOR_TEXT_PATTERN, 1)
    no_tags = F.regexp_replace(inner, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(no_tags), r"\s+", " "))


def decode_entities(text: F.Column) -> F.Column:
    """The common named entities and decimal character references decoded."""
    named = text
    for name, char in (("nbsp", " "), ("quot", '"'), ("apos", "'"), ("lt", "<"), ("gt", ">")):
        named = F.regexp_replace(named, f"&{name};", char)
    parts = F.split(named, r"(?=&#\d{1,7};)")
    decoded = F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^&#\d{1,7};"), F.concat(
        F.decode(F.unhex(F.lpad(F.hex(F.regexp_extract(p, r"^&#(\d+);", 1).cast("int")), 8, "0")), "UTF-32"),
        F.regexp_replace(p, r"^&#\d+;", ""))).otherwise(p)), "")
    return F.regexp_replace(decoded, "&amp;", "&")


def absolutise(href: F.Column, page_url: F.Column) -> F.Column:
    """Absolute URL for an href found on ``page_url``: absolute kept; ``//host/x`` takes
    the page scheme; ``/x`` takes scheme and host; anything else is resolved against the
    page's folder."""
    scheme = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(page_url, r"^([^?#]*/)", 1)
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(origin, href))
            .otherwise(F.concat(folder, href)))


def first_anchor(html: F.Column, keep: Callable[[F.Column, F.Column], F.Column]) -> F.Column:
    """The first anchor with a real href for which ``keep(text, href)`` holds, in document
    order: struct(pos, text, href), or NULL. Array functions only, so no row leaves its page."""
    anchors = F.transform(F.regexp_extract_all(html, F.lit(ANCHOR_PATTERN), F.lit(0)), lambda a, i: F.struct(
        i.alias("pos"), anchor_text(a).alias("text"),
        decode_entities(F.regexp_replace(F.regexp_extract(a, HREF_PATTERN, 1), "^[\"']|[\"']$", "")).alias("href")))
    return F.get(F.filter(anchors, lambda a: (a["href"] != "") & keep(a["text"], a["href"])), F.lit(0))


def _resolved(pages: DataFrame, keep: Callable[[F.Column, F.Column], F.Column]) -> DataFrame:
    found = pages.select("page_id", "url", first_anchor(F.col("html"), keep).alias("m"))
    return found.select("page_id", F.col("m.pos").alias("anchor_pos"), F.col("m.text").alias("link_text"),
                        absolutise(F.col("m.href"), F.col("url")).alias("resolved_url"),
                        F.when(F.col("m").isNull(), F.lit("no_match")).otherwise(F.lit("found")).alias("status"))


def resolve_links(pages: DataFrame, text_pattern: str) -> DataFrame:
    """Per page (A3): the first anchor whose text matches ``text_pattern`` and does not
    mention a time series. ``link_kind`` is 'file' for a direct spreadsheet link and
    'category' otherwise; pages without a match get status 'no_match'."""
    found = _resolved(pages, lambda text, href: text.rlike(text_pattern) & ~F.lower(text).contains(EXCLUDED_TEXT))
    kind = F.when(F.col("resolved_url").rlike(FILE_SUFFIX_PATTERN), F.lit("file")).when(F.col("status") == "found", F.lit("category"))
    return found.select("page_id", "anchor_pos", "link_text", "resolved_url", kind.alias("link_kind"), "status")


def resolve_files(pages: DataFrame, texts: Sequence[str] = FILE_TEXTS, href_pattern: str = FILE_SUFFIX_PATTERN) -> DataFrame:
    """Second step (A3), over the category pages: the first anchor whose text contains one of
    ``texts`` (lower case) and whose href matches ``href_pattern``."""
    def keep(text, href):
        low = F.lower(text)
        return functools.reduce(operator.or_, [low.contains(t) for t in texts]) & href.rlike(href_pattern)
    return _resolved(pages, keep)
