"""Reading collections, parquet relations, JSON lines, event logs, log slices, HTML and EPUB."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuskiln.functions.keys import trim_blanks
from corpuskiln.session import ship_package

# Folders that are never scanned.
EXCLUDED = "node_modules .git .cache vendor dist build".split()
EXAMPLE = T.StructType([T.StructField("query", T.StringType()), T.StructField("output", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("category", T.StringType()), T.StructField("intent", T.StringType()), T.StructField("is_short", T.BooleanType())])


class RelationError(ValueError):
    """A relation that does not meet its contract."""


def read_collection(spark: SparkSession, root: str, glob: str = "*.md", ignore: list[str] | None = None) -> DataFrame:
    """(path, body, modified_at) of a folder's files: no dot-prefixed parts, none of the excluded folders or ignored globs
    (matched on the path below the root), no blank bodies."""
    from corpuskiln.operators.lookup import glob_pattern

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/")
    base = base[len("file:"):].replace("//", "/", 1) if base.startswith("file:") else base
    path = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^" + re.escape(base) + "/+", "")
    rows = files.select(path.alias("path"), F.col("content").cast("string").alias("body"), F.col("modificationTime").alias("modified_at"))
    rows = rows.where(~F.col("path").rlike(r"(^|/)\.") & ~F.col("path").rlike(f"(^|/)({'|'.join(map(re.escape, EXCLUDED))})/"))
    for g in ignore or []:
        rows = rows.where(~F.col("path").rlike(glob_pattern(g)))
    return rows.where(trim_blanks(F.col("body")) != "")


def read_relation(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A parquet relation with at least the given columns; extra columns drop out, missing ones are an error."""
    df = spark.read.parquet(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise RelationError(f"{path}: missing columns {', '.join(missing)}")
    return df.select(*columns)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Training examples of JSON lines, failing on a line that is no valid example (with file and content)."""
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    parsed = raw.select("*", F.from_json("value", EXAMPLE).alias("e"))
    problem = _example_problem(F.col("e"))
    message = F.concat(F.lit("invalid example in "), F.col("file"), F.lit(": "), problem, F.lit(": "), F.left("value", F.lit(120)))
    checked = parsed.select(F.when(problem.isNull(), F.col("e")).otherwise(F.raise_error(message).cast(EXAMPLE)).alias("e"))
    return checked.select("e.query", F.transform("e.output", lambda p: F.struct(p[0].alias("type"), p[1].alias("text"))).alias("output"), "e.category", "e.intent", F.coalesce("e.is_short", F.lit(False)).alias("is_short"))


def _example_problem(e: Column) -> Column:
    bad = lambda p: (F.size(p) != 2) | ~F.coalesce(p[0].isin("lex", "vec", "hyde"), F.lit(False)) | (F.coalesce(F.trim(p[1]), F.lit("")) == "")
    return F.when(e.isNull(), "no JSON object").when(F.coalesce(F.trim(e["query"]), F.lit("")) == "", "no query").when(F.coalesce(F.size(e["output"]), F.lit(0)) < 1, "no output").when(F.exists(e["output"], bad), "bad output line")


def validate_examples(spark: SparkSession, path: str) -> DataFrame:
    """(file, total, valid) of JSON-lines files."""
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("file")).where(F.trim("value") != "")
    ok = _example_problem(F.from_json("value", EXAMPLE)).isNull()
    return raw.groupBy("file").agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("valid"))


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """(query, output text) of JSON lines in either shape: structured lines or chat messages."""
    schema = "query string, output array<array<string>>, messages array<struct<role:string,content:string>>"
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema).alias("r"))
    said = lambda role: F.filter("r.messages", lambda m: m["role"] == role)[0]["content"]
    asked = F.trim(F.regexp_replace(F.regexp_replace(said("user"), r"(?s)^.*Expand this search query:", ""), r"(?s)<\|im_end\|>.*$", ""))
    text = F.array_join(F.transform("r.output", lambda p: F.concat(p[0], F.lit(": "), p[1])), "\n")
    return rows.where("r is not null").select(F.coalesce("r.query", asked).alias("query"), F.coalesce(text, said("assistant")).alias("output"))


def intact_events(lines: DataFrame, line_no: str, text: str) -> DataFrame:
    """Lines of an event log up to (not including) the first that is no JSON object."""
    bad = lines.where(F.try_parse_json(F.col(text)).isNull() | ~F.trim(F.col(text)).startswith("{")).agg(F.min(line_no).alias("__cut"))
    return lines.join(F.broadcast(bad)).where(F.col("__cut").isNull() | (F.col(line_no) < F.col("__cut"))).drop("__cut")  # one row


def log_payloads(lines: DataFrame, text: str, header: str, schema: str) -> DataFrame:
    """Fields of the JSON payload after a header pattern, per matching line."""
    payload = F.regexp_extract(F.col(text), f"(?s){header}(\\{{.*\\}})", 1)
    return lines.select("*", F.from_json(F.when(payload != "", payload), schema).alias("p")).where("p is not null").select(*[c for c in lines.columns if c != text], "p.*")


def vector_rows(content_vectors: DataFrame, vectors: DataFrame, hashes: DataFrame) -> DataFrame:
    """Pieces of the given bodies with their vectors, joined on (hash, seq)."""
    return content_vectors.join(hashes.select("hash").distinct(), "hash", "left_semi").join(vectors, ["hash", "seq"])


class _Markdown(HTMLParser):
    """HTML as plain Markdown: headings, list items, paragraphs; scripts and styles are skipped."""

    BLOCKS = set("p div section article tr table ul ol blockquote pre br hr header footer figure".split())
    SKIPPED = {"script", "style", "noscript", "template"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.SKIPPED:
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.parts.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "li":
            self.parts.append("\n- ")
        elif tag in self.BLOCKS:
            self.parts.append("\n\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
            self.parts.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.parts.append(re.sub(r"\s+", " ", data))

    def text(self) -> str:
        lines = [re.sub(r"[ \t]+", " ", x).strip() for x in "".join(self.parts).split("\n")]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def markdown_of(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Markdown()
    parser.feed(html)
    parser.close()
    return parser.text()


def html_to_text(html: Column) -> Column:
    """HTML as plain Markdown, in Arrow batches."""

    @F.pandas_udf("string")
    def convert(pages: pd.Series) -> pd.Series:
        return pages.map(markdown_of)

    return convert(html)


def markdown_of_epub(data: bytes) -> str:
    """The spine of an EPUB as Markdown; an archive that cannot be read gives an empty text."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            name = lambda e: e.tag.rpartition("}")[2]
            box = ElementTree.fromstring(z.read("META-INF/container.xml"))
            package = next(e.get("full-path") for e in box.iter() if name(e) == "rootfile")
            opf = ElementTree.fromstring(z.read(package))
            items = {e.get("id"): e.get("href") for e in opf.iter() if name(e) == "item"}
            spine = [items[e.get("idref")] for e in opf.iter() if name(e) == "itemref" and e.get("idref") in items]
            at = [posixpath.normpath(posixpath.join(posixpath.dirname(package), h)) for h in spine]
            return "\n\n".join(filter(None, (markdown_of(z.read(p).decode("utf-8", "replace")) for p in at if p in z.namelist())))
    except (zipfile.BadZipFile, KeyError, StopIteration, ElementTree.ParseError):
        return ""


def read_epubs(spark: SparkSession, root: str) -> DataFrame:
    """(path, body) of EPUB files, one task per file split."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").option("recursiveFileLookup", "true").load(root).select("path", "content")

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "body": [markdown_of_epub(x) for x in batch["content"]]})

    return files.mapInPandas(convert, "path string, body string")


def discover(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """(hash, path, item_id) of listed files: the catalog's id of (hash, path), else a stable new one."""
    known = catalog.select("hash", "path", "item_id")
    return files.join(known, ["hash", "path"], "left").withColumn("item_id", F.coalesce("item_id", F.concat(F.lit("item-"), F.left(F.sha2(F.concat_ws("\n", "hash", "path"), 256), F.lit(16)))))
