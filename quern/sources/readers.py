"""Readers and writers: JSON lines (strict, permissive, with captured errors), JSON, Parquet, HTML, Markdown, packs.

All paths go through Spark's readers, so any store that Spark reads will do.
"""

from __future__ import annotations

import html.parser
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys under which a JSON file may hold its rows.
ROW_KEYS = ("data", "rows", "examples", "items", "records")
FORMATS = {"parquet": "parquet", "jsonl": "jsonl", "ndjson": "jsonl", "json": "json", "md": "markdown", "markdown": "markdown", "html": "html", "htm": "html"}


def format_of(name: str) -> str | None:
    """The format that a file name says, also before `.gz`; None if it says none."""
    parts = name.lower().removesuffix(".gz").rsplit(".", 1)
    return FORMATS.get(parts[1]) if len(parts) == 2 else None


def jsonl(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST", recursive: bool = False) -> DataFrame:
    """JSON lines with a declared schema; FAILFAST raises on a bad line, DROPMALFORMED leaves it out. Gzip by suffix."""
    r = spark.read.schema(schema).option("mode", mode).option("recursiveFileLookup", str(recursive).lower())
    return (r.option("pathGlobFilter", "*.jsonl*") if recursive else r).json(path)


def jsonl_with_errors(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, errors): errors holds the text and file of each line that is no JSON object of the schema."""
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).select(F.col("value"), F.input_file_name().alias("file")).where(F.trim("value") != "")
    parsed = lines.select("value", "file", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("x"))
    good = parsed.where("x._bad IS NULL").select(*(F.col(f"x.{f.name}") for f in schema.fields))
    return good, parsed.where("x._bad IS NOT NULL").select(F.col("value").alias("line"), "file")


def latest_index(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; rows without a key are left out."""
    rest = [c for c in rows.columns if c != key]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("x")).select(key, "x.*")


def json_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON files: a list, an object with a list under one of ROW_KEYS, or one object."""
    wrapped = T.StructType([*(T.StructField(k, T.ArrayType(schema)) for k in ROW_KEYS)])
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.from_json("v", T.ArrayType(schema))
    held = F.from_json("v", wrapped)
    rows = F.when(F.col("v").startswith("["), listed).otherwise(F.coalesce(*(held[k] for k in ROW_KEYS), F.array(F.from_json("v", schema))))
    return text.select(F.explode(rows).alias("x")).select("x.*")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as (id, payload): the line's id, else its file's stem and position; payload is the line."""
    lines = spark.read.text(path).select(F.col("value").alias("payload"), F.monotonically_increasing_id().alias("ord"), F.col("_metadata.file_name").alias("file")).where(F.trim("payload") != "")
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    return lines.select(F.coalesce(F.get_json_object("payload", "$.id"), F.concat_ws("_", stem, F.col("ord").cast("string"))).alias("id"), "payload", "ord")


def cells(df: DataFrame) -> DataFrame:
    """Binary columns as text: UTF-8 where valid, else lower-case hex."""
    text = lambda c: F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.lower(F.hex(c)))
    return df.select(*(text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name) for f in df.schema.fields))


def parquet(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = cells(spark.read.parquet(path))
    return df if limit is None else df.limit(limit)


# Tags that break a line when they open or close, and tags whose content is not text.
OPEN_BREAKS = ("p", "div", "br", "li", "h1", "h2", "h3", "h4", "tr")
CLOSE_BREAKS = ("p", "div", "li", "h1", "h2", "h3", "h4")
HIDDEN = ("script", "style", "noscript")
#: White space that the expressions know; Python's str.strip() knows more.
BLANKS = " \t\r\n\f\x0b\u00a0"


class _Page(html.parser.HTMLParser):
    """Line ends at block tags, and every visible run of text without the white space (or the given characters) around it."""

    def __init__(self, blanks: str | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.blanks = blanks
        self.runs: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in HIDDEN
        self.runs += ["\n"] * (tag in OPEN_BREAKS)

    def handle_endtag(self, tag):
        self.depth = max(0, self.depth - (tag in HIDDEN))
        self.runs += ["\n"] * (tag in CLOSE_BREAKS)

    def handle_data(self, data):
        if not self.depth and (run := data.strip(self.blanks)):
            self.runs.append(run)


def page_text(page: str | None, blanks: str | None = None) -> str:
    """Visible text of an HTML page, the title's with it: runs joined by blanks, at most one empty line. Broken markup is read as far as it goes."""
    reader = _Page(blanks)
    reader.feed(page or "")
    reader.close()
    return re.sub("\n{3,}", "\n\n", re.sub("[ \t]+", " ", " ".join(reader.runs))).strip(blanks)


@F.pandas_udf(T.StringType())
def html_extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """page_text() in Arrow batches; the faithful form, by an HTML parser."""
    for s in pages:
        yield s.map(page_text)


@F.pandas_udf(T.StringType())
def _plain_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """page_text() of pages from plain_markup(), with no white space but BLANKS taken off."""
    for s in pages:
        yield s.map(lambda page: page_text(page, BLANKS))


def html_title(c: Column, stem: Column | None = None) -> Column:
    """The title element's text with single blanks and no space characters at its ends, else the file's stem; without a stem empty, and null for a null page."""
    found = F.regexp_replace(F.regexp_replace(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1), r"[ \t\r\n\f\x0B]+", " "), r"^\p{Zs}+|\p{Zs}+\z", "")
    return F.when(c.rlike(r"(?is)<title[^>]*>.*?</title>"), found).otherwise(stem if stem is not None else F.when(c.isNotNull(), ""))


#: Character references that the expressions decode; the parser knows them all.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&copy;": "\u00a9", "&middot;": "\u00b7", "&amp;": "&"}


def listed_references(c: Column) -> Column:
    """A page whose ampersands are escaped but where they begin one of REFERENCES, so that a parser decodes these alone: `&amp` cut off before its semicolon stays as it is."""
    return F.regexp_replace(c, f"&(?!(?:{'|'.join(ref[1:] for ref in REFERENCES)}))", "&amp;")


def _marked(c: Column) -> Column:
    """A page with U+0001 for hidden elements, comments, declarations and tags, and U+0002 between two of them for tags that break a line.

    Names end, letters fold (long s for s) and white space is told as RE2 does it, not as Java does.
    """
    hidden = "|".join(rf"{n}(?!\w).*?</{n}[\t\n\f\r ]*>" for n in (h.replace("s", "[s\u017f]") for h in HIDDEN))
    c = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?is)<(?:{hidden}|!--.*?-->|![^>]*>)", "\u0001")
    c = F.regexp_replace(c, rf"(?i)<(?:{'|'.join(OPEN_BREAKS)}|/(?:{'|'.join(CLOSE_BREAKS)}))(?!\w)[^>]*>", "\u0001\u0002\u0001")
    return F.regexp_replace(c, r"<[^>]+>", "\u0001")


def plain_markup(c: Column) -> Column:
    """A page in markup that a parser and the expressions read alike: a tag for each mark of _marked(), all else escaped but REFERENCES."""
    c = F.replace(listed_references(_marked(c)), F.lit("<"), F.lit("&lt;"))
    return F.replace(F.replace(c, F.lit("\u0001\u0002\u0001"), F.lit("<br>")), F.lit("\u0001"), F.lit("<wbr>"))


def _squeezed(c: Column) -> Column:
    """Line ends for U+0002, single blanks, at most one empty line, no BLANKS at the ends."""
    c = F.regexp_replace(F.regexp_replace(F.replace(c, F.lit("\u0002"), F.lit("\n")), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(c, rf"^[{BLANKS}]+|[{BLANKS}]+\z", "")


def html_plain(c: Column) -> Column:
    """html_text() by the parser: page_text() of plain_markup(), equal to it on every page."""
    return _squeezed(_plain_text(plain_markup(c)))


def html_text(c: Column) -> Column:
    """page_text() by expressions alone, equal to it on pages without other references, markup inside attributes, stray angle brackets or white space other than BLANKS."""
    c = _marked(c)
    for ref, char in REFERENCES.items():
        c = F.replace(c, F.lit(ref), F.lit(char))
    return _squeezed(F.regexp_replace(c, f"[{BLANKS}]*\u0001[{BLANKS}\u0001]*", " "))


def sections(df: DataFrame, text: str, stem: Column | None = None) -> DataFrame:
    """df with one row for each Markdown section (section, title, body): `#` to `###` open one.

    Sections are numbered from 0; those without a body are left out and their numbers stay free, as is text before the
    first heading. A text of which nothing is left is one section (number null) with the stem for its title.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    parts = F.split(F.regexp_replace(whole, r"(?md)^(#{1,3})[ \t\r\n\f\x0B]+(.+)$", "\u0001$2\u0002"), "\u0001")
    strip = lambda x: F.regexp_replace(x, r"^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$", "")
    found = F.transform(F.slice(parts, 2, F.greatest(F.lit(1), F.size(parts))), lambda p, i: F.struct(i.alias("section"), strip(F.substring_index(p, "\u0002", 1)).alias("title"), strip(F.substring_index(p, "\u0002", -1)).alias("body")))
    kept = F.filter(found, lambda s: s["body"] != "")
    alone = F.array(F.struct(F.lit(None).cast("int").alias("section"), (stem if stem is not None else F.lit("")).alias("title"), whole.alias("body")))
    return df.withColumn("_found", kept).select(*df.columns, F.explode(F.when(F.size("_found") > 0, F.col("_found")).otherwise(alone)).alias("_s")).select(*df.columns, "_s.*")


def sniffed(head: Column) -> Column:
    """Whether the first 200 bytes of a file look like an HTML page."""
    low = F.lower(F.substring(head.cast("string"), 1, 200))
    return low.contains("<html") | low.contains("<!doctype html")


def extract(spark: SparkSession, path: str, hint: str = "") -> DataFrame:
    """(id, payload) of files of one format: by the hint, else by name, else HTML if each begins like it. Payloads are JSON with title and text, or rows."""
    kind = FORMATS.get(hint.lower(), "html" if hint == "documentation" else None) or format_of(path.rstrip("/").rsplit("/", 1)[-1])
    if kind is None:
        heads = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 200).alias("head"))
        if heads.where(~sniffed(F.col("head"))).isEmpty():
            kind = "html"
    if kind == "parquet":
        rows = parquet(spark, path)
        return rows.select((F.col("id").cast("string") if "id" in rows.columns else F.monotonically_increasing_id().cast("string")).alias("id"), F.to_json(F.struct(*rows.columns)).alias("payload"))
    if kind == "jsonl":
        return payloads(spark, path).select("id", "payload")
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    whole = spark.read.text(path, wholetext=True).select("value", stem.alias("stem"))
    if kind == "html":
        return whole.select(F.concat("stem", F.lit("_doc")).alias("id"), F.to_json(F.struct(html_title(F.col("value"), F.col("stem")).alias("title"), html_extract("value").alias("text"))).alias("payload"))
    if kind == "markdown":
        cut = sections(whole, "value", F.col("stem"))
        return cut.select(F.when(F.col("section").isNull(), F.concat("stem", F.lit("_md"))).otherwise(F.concat("stem", F.lit("_sec_"), F.lpad(F.col("section").cast("string"), 4, "0"))).alias("id"), F.to_json(F.struct("title", F.col("body").alias("text"))).alias("payload"))
    if kind == "json":
        v = F.trim("value")
        held = F.coalesce(*(F.get_json_object(v, f"$.{k}") for k in ROW_KEYS))
        rows = F.from_json(F.when(v.startswith("["), v).otherwise(F.coalesce(held, F.concat(F.lit("["), v, F.lit("]")))), "array<string>")
        each = whole.select("stem", F.posexplode(rows).alias("i", "payload"))
        return each.select(F.coalesce(F.get_json_object("payload", "$.id"), F.concat("stem", F.lit("_"), F.lpad(F.col("i").cast("string"), 6, "0"))).alias("id"), "payload")
    raise ValueError(f"no extractor for {path}")


def write_jsonl(df: DataFrame, path: str, gzip: bool = False, by: list[str] | None = None) -> None:
    """JSON lines with keys in order, in one folder for each value of `by`."""
    w = df.select(*sorted(df.columns)).write.option("ignoreNullFields", "false")
    w = w.option("compression", "gzip") if gzip else w
    (w.partitionBy(*by) if by else w).json(path)


def write_pack(df: DataFrame, path: str, id_col: str, where: Column | None = None) -> DataFrame:
    """A gzip pack sorted by id across its files; returns its manifest, one row a file: path, bytes, sha256."""
    rows = df.where(where) if where is not None else df
    write_jsonl(rows.orderBy(id_col), path, gzip=True)
    return manifest(df.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_pack(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """(path, state): ok, mismatched or missing, for each file of a manifest."""
    now = manifest(spark, path).withColumnsRenamed({"sha256": "now"}).select("path", "now")
    state = F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("sha256"), "mismatched").otherwise("ok")
    return expected.join(now, "path", "left").select("path", state.alias("state"))


def cache_index(entries: DataFrame) -> DataFrame:
    """The last entry of each source_ref, by fetched_at."""
    return latest_index(entries, "source_ref", "fetched_at")


def cache_stats(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("n"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))


def cache_listing(index: DataFrame) -> DataFrame:
    return index.orderBy("source_ref")


def object_path(digest: Column) -> Column:
    """Where a content-addressed store keeps an object of this digest."""
    return F.concat(F.lit("objects/"), F.substring(digest, 1, 2), F.lit("/"), digest)
