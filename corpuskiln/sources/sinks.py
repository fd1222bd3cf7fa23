"""Writing relations and results: fixed columns, output formats, atomic publishing of a generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import rounded
from corpuskiln.operators.ranking import running_total
from corpuskiln.sources.readers import intact_events
from corpuskiln.sources.storage import Folder

FORMATS = ("json", "csv", "xml", "md", "files")


def write_relation(df: DataFrame, path: str, columns: list[str]) -> None:
    """Parquet with exactly these columns in this order."""
    df.select(*columns).write.mode("overwrite").parquet(path)


def csv_field(c: Column) -> Column:
    """A field of a CSV line: quoted where it holds a comma, quote or line break; null is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(text.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def xml_text(c: Column) -> Column:
    """Text with the five XML entities; null is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def format_rows(results: DataFrame, kind: str) -> DataFrame:
    """One ``line`` per result (docid, score, file, title, context, snippet) in a format; scores have two places (four in csv)."""
    two, four = F.format_string("%.2f", rounded(F.col("score"), 2)), F.format_string("%.4f", rounded(F.col("score"), 4))
    context = F.coalesce("context", F.lit(""))
    if kind == "json":
        line = F.to_json(F.struct(F.concat(F.lit("#"), "docid").alias("docid"), rounded(F.col("score"), 2).alias("score"), "file", "title", F.when(context != "", context).alias("context"), "snippet"))
    elif kind == "csv":
        line = F.concat_ws(",", F.concat(F.lit("#"), "docid"), four, csv_field(F.col("file")), csv_field(F.col("title")), csv_field(context), csv_field(F.col("snippet")))
    elif kind == "xml":
        line = F.concat(F.lit('<file docid="#'), F.col("docid"), F.lit('" name="'), xml_text(F.col("file")), F.lit('" title="'), xml_text(F.col("title")), F.lit('">'), xml_text(F.col("snippet")), F.lit("</file>"))
    elif kind == "md":
        line = F.concat(F.lit("---\n# "), F.coalesce("title", F.col("file")), F.lit("\n\n**docid:** `#"), F.col("docid"), F.lit("`\n"), F.when(context != "", F.concat(F.lit("**context:** "), context, F.lit("\n"))).otherwise(""), F.lit("\n"), F.coalesce("snippet", F.lit("")))
    elif kind == "files":
        line = F.concat(F.lit("#"), F.col("docid"), F.lit(","), two, F.lit(","), F.col("file"), F.when(context != "", F.concat(F.lit(',"'), F.replace(context, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(""))
    else:
        raise ValueError(f"format must be one of {FORMATS}, not {kind!r}")
    return results.select("rank", line.alias("line"))


def format_documents(documents: DataFrame, kind: str) -> DataFrame:
    """One ``line`` per fetched document (ord, file, title, context, body, skip_reason) in a format; a row with a ``skip_reason`` was skipped and shows
    that instead of its body. Keeps ``ord``."""
    skipped, context = F.col("skip_reason").isNotNull(), F.coalesce("context", F.lit(""))
    shown = F.coalesce(F.when(skipped, F.col("skip_reason")).otherwise(F.col("body")), F.lit(""))
    some = F.when(context != "", context)
    tag = lambda name, c: F.concat(F.lit(f"    <{name}>"), xml_text(c), F.lit(f"</{name}>\n"))
    if kind == "json":
        line = F.to_json(F.struct("file", "title", some.alias("context"), F.when(skipped, F.lit(True)).alias("skipped"), F.when(skipped, shown).alias("reason"), F.when(~skipped, shown).alias("body")))
    elif kind == "csv":
        line = F.concat_ws(",", csv_field(F.col("file")), csv_field(F.col("title")), csv_field(context), F.when(skipped, "true").otherwise("false"), csv_field(shown))
    elif kind == "files":
        line = F.concat(F.col("file"), F.coalesce(F.concat(F.lit(',"'), F.replace(some, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")), F.when(skipped, ",[SKIPPED]").otherwise(""))
    elif kind == "md":
        titled = F.when(F.coalesce("title", F.lit("")).isin("") | (F.col("title") == F.col("file")), "").otherwise(F.concat(F.lit("**Title:** "), F.col("title"), F.lit("\n\n")))
        line = F.concat(F.lit("## "), F.col("file"), F.lit("\n\n"), F.coalesce(titled, F.lit("")), F.coalesce(F.concat(F.lit("**Context:** "), some, F.lit("\n\n")), F.lit("")), F.when(skipped, F.concat(F.lit("> "), shown, F.lit("\n"))).otherwise(F.concat(F.lit("```\n"), shown, F.lit("\n```\n"))))
    elif kind == "xml":
        rest = F.when(skipped, F.concat(F.lit("    <skipped>true</skipped>\n"), tag("reason", shown))).otherwise(tag("body", shown))
        line = F.concat(F.lit("  <document>\n"), tag("file", F.col("file")), tag("title", F.col("title")), F.when(context != "", tag("context", context)).otherwise(""), rest, F.lit("  </document>"))
    else:
        raise ValueError(f"format must be one of {FORMATS}, not {kind!r}")
    return documents.select("ord", line.alias("line"))


def append_records(records: DataFrame, root: str, name: str) -> int:
    """Append rows to a log of JSON lines below ``root``; the number of lines it then has.

    A log whose tail is broken (from the first line on that is no JSON object) is kept aside as ``<name>.corrupt-...`` and goes on
    with its intact lines. The log is written anew and switched by a rename, so readers see the old or the new one.
    """
    spark = records.sparkSession
    folder = Folder(spark, root)
    new = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    current = folder.read_json(f"{name}.json")
    kept, number = None, 0
    if current:
        lines = spark.read.parquet(folder.path(current["table"]))
        kept = intact_events(lines.where(F.trim("value") != ""), "line", "value").select("line", "value")
        number = kept.agg(F.coalesce(F.max("line"), F.lit(0)).alias("n")).first()["n"]
    numbered = running_total(new.withColumn("all", F.lit("all")), "all", ["value"], F.lit(1), "at").select((F.col("at") + F.lit(number)).alias("line"), "value")
    table = folder.write_table(numbered if kept is None else kept.unionByName(numbered), name)
    broken = current is not None and kept.count() < spark.read.parquet(folder.path(current["table"])).where(F.trim("value") != "").count()
    if broken:
        folder.write_json(f"{name}.corrupt-{current['table'].rpartition('-')[2]}.json", current)
    n = spark.read.parquet(folder.path(table)).count()
    folder.write_json(f"{name}.json", {"table": table, "lines": n})
    if current and not broken:
        folder.delete(current["table"])
    return n


def read_records(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(line, value) of a log; empty if there is none."""
    folder = Folder(spark, root)
    current = folder.read_json(f"{name}.json")
    return folder.read_tables([current["table"]] if current else [], "line bigint, value string")


def publish(frames: dict[str, DataFrame], root: str, generation: str) -> str:
    """Write relations into a new generation folder and then switch the ``CURRENT`` pointer (a rename). Returns the folder's URI.
    Readers follow the pointer, so they see a whole generation or the one before. ``root`` lies on the session's file system."""
    spark = next(iter(frames.values())).sparkSession
    folder, counts = Folder(spark, root), {}
    for name, df in frames.items():
        path = folder.path(f"generation-{generation}/{name}")
        df.write.mode("overwrite").parquet(path)
        counts[name] = spark.read.parquet(path).count()
    folder.write_json("CURRENT", {"generation": generation, "rows": counts})
    return folder.path(f"generation-{generation}")


def read_published(spark, root: str, name: str) -> DataFrame:
    """A relation of the current generation; its row count must be the published one."""
    folder = Folder(spark, root)
    current = folder.read_json("CURRENT")
    df = spark.read.parquet(folder.path(f"generation-{current['generation']}/{name}"))
    if df.count() != current["rows"][name]:
        raise ValueError(f"{name}: {current['rows'][name]} rows were published")
    return df
