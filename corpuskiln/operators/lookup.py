"""Finding documents by path, id, glob or similarity; contexts by path prefix; lines and snippets."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.text import docid, virtual_path
from corpuskiln.operators.ranking import first_per_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def like_pattern(text: str) -> str:
    """Regular expression of a LIKE pattern as SQLite matches it: ``%`` and ``_`` are wildcards, ASCII letters fold."""
    return "(?s)^" + "".join(".*" if ch == "%" else "." if ch == "_" else f"[{ch.upper()}{ch.lower()}]" if ch.isascii() and ch.isalpha() else re.escape(ch) for ch in text) + "$"


def by_prefix(documents: DataFrame, prefix: str) -> DataFrame:
    """Documents below a path prefix."""
    return documents.where(F.col("path").rlike(like_pattern(prefix + "%")))


def by_suffix(documents: DataFrame, suffix: str) -> DataFrame:
    """The document of smallest id whose path ends in a suffix."""
    return documents.where(F.col("path").rlike(like_pattern("%" + suffix))).orderBy("doc_id").limit(1)


def by_docid(documents: DataFrame, short: str) -> DataFrame:
    """The active document of smallest id whose hash begins so."""
    return documents.where(F.col("active") & F.startswith("hash", F.lit(short.lower()))).orderBy("doc_id").limit(1)


def glob_pattern(glob: str) -> str:
    """Regular expression of a path glob with ``*``, ``**``, ``?``, ``[...]`` and ``{a,b}``."""
    out, i, depth = "", 0, 0
    while i < len(glob):
        ch = glob[i]
        if glob.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
            continue
        if glob.startswith("**", i):
            out, i = out + ".*", i + 2
            continue
        if ch == "*":
            out += "[^/]*"
        elif ch == "?":
            out += "[^/]"
        elif ch == "[" and "]" in glob[i:]:
            end = glob.index("]", i)
            out, i = out + "[" + glob[i + 1:end].replace("!", "^", 1) + "]", end
        elif ch == "{":
            out, depth = out + "(?:", depth + 1
        elif ch == "}" and depth:
            out, depth = out + ")", depth - 1
        elif ch == "," and depth:
            out += "|"
        else:
            out += re.escape(ch)
        i += 1
    return f"^{out}$"


def in_collections(documents: DataFrame, names: list[str], column: str = "source") -> DataFrame:
    """Active documents of the named collections; no names mean all. Names are typed by users, so they are few."""
    active = documents.where("active")
    return active.where(F.col(column).isin(names)) if names else active


def by_glob(documents: DataFrame, glob: str) -> DataFrame:
    """Documents whose virtual path, path or collection/path matches a glob."""
    p, c = glob_pattern(glob), F.coalesce("source", F.lit(""))
    return documents.where(virtual_path(c, F.col("path")).rlike(p) | F.col("path").rlike(p) | F.concat(c, F.lit("/"), F.col("path")).rlike(p))


def multi_get(documents: DataFrame, names: list[str], most_chars: int = 10240) -> DataFrame:
    """(name, doc_id, body, skip_reason) of a list of paths: exact match, else the first with that suffix; large bodies are
    skipped with a reason. Names are few (typed by a user)."""
    asked = documents.sparkSession.createDataFrame([(i, n) for i, n in enumerate(names)], "ord int, name string")
    hit = documents.where("active").join(F.broadcast(asked), (F.col("path") == F.col("name")) | F.endswith(F.col("path"), F.col("name")))
    best = first_per_key(hit.select("ord", "name", "doc_id", "text", "path"), ["ord", "name"], [(F.col("path") != F.col("name")).cast("int"), F.col("doc_id")])
    large = F.length("text") > most_chars
    reason = F.when(large, F.concat(F.lit("File too large ("), F.round(F.length("text") / 1024).cast("int").cast("string"), F.lit("KB > "), F.lit(f"{round(most_chars / 1024)}KB)")))
    return best.select("name", "doc_id", F.when(~F.coalesce(large, F.lit(False)), F.col("text")).alias("body"), reason.alias("skip_reason"))


def find_document(documents: DataFrame, asked: str) -> DataFrame:
    """(stage, doc_id, path): the first stage that answers, of docid, exact virtual path, exact path, suffix."""
    stages = [F.startswith("hash", F.lit(asked.lstrip("#").lower())) if re.fullmatch(r"#?[A-Fa-f0-9]{6,}", asked) else F.lit(False), virtual_path(F.coalesce("source", F.lit("")), F.col("path")) == asked, F.col("path") == asked, F.col("path").rlike(like_pattern("%" + asked))]
    stage = F.coalesce(*(F.when(c, F.lit(i)) for i, c in enumerate(stages)))
    return documents.where("active").select(stage.alias("stage"), "doc_id", "path").where("stage is not null").orderBy("stage", "doc_id").limit(1)


def similar_files(documents: DataFrame, asked: str, most: int = 3, limit: int = 5) -> DataFrame:
    """(path, distance): active paths within an edit distance, nearest first."""
    d = F.levenshtein(F.lower("path"), F.lit(asked.lower()), most)
    return documents.where("active").select("doc_id", "path", d.alias("distance")).where(F.col("distance") >= 0).orderBy("distance", "doc_id").limit(limit)


def with_contexts(documents: DataFrame, contexts: DataFrame, global_context: str | None = None) -> DataFrame:
    """``context`` of each document: texts of all contexts whose prefix its path begins with, general ones first.

    ``contexts`` (collection, prefix, context) is a small table typed by users; a prefix matches as plain text. It is sent to
    the tasks as a map per collection, so documents are not shuffled.
    """
    per = contexts.groupBy(F.col("collection").alias("source")).agg(F.sort_array(F.collect_list(F.struct(F.length("prefix").alias("l"), F.col("prefix").alias("p"), F.col("context").alias("c")))).alias("cs"))
    found = documents.join(F.broadcast(per), "source", "left")
    hits = F.transform(F.filter(F.coalesce("cs", F.array().cast("array<struct<l:int,p:string,c:string>>")), lambda x: F.startswith(F.concat(F.lit("/"), F.col("path")), F.when(F.startswith(x["p"], F.lit("/")), x["p"]).otherwise(F.concat(F.lit("/"), x["p"])))), lambda x: x["c"])
    whole = F.concat(F.array(F.lit(global_context)), hits) if global_context else hits
    return found.withColumn("context", F.when(F.size(whole) > 0, F.array_join(whole, "\n\n"))).drop("cs")


def longest_prefix(paths: DataFrame, path: str, roots: DataFrame, root: str, name: str, order: str | None = None) -> DataFrame:
    """``name`` of the longest root that a path lies below (or equals), null if none; with ``order``, a column of ``roots``, of the
    first such root. Roots are few."""
    below = (F.col("__r") == F.col(path)) | F.startswith(F.col(path), F.concat("__r", F.lit("/")))
    small = roots.select(F.regexp_replace(F.col(root), "/+$", "").alias("__r"), F.col(name), (-F.col(order) if order else F.length(F.regexp_replace(F.col(root), "/+$", ""))).alias("__o"))
    key = paths.withColumn("__k", F.monotonically_increasing_id())
    best = key.select("__k", path).join(F.broadcast(small), below).groupBy("__k").agg(F.max_by(name, "__o").alias(name), F.max_by("__r", "__o").alias("__r"))
    return key.join(best, "__k", "left").withColumn("relative", F.when(F.col("__r").isNotNull(), F.substr(path, F.length("__r") + 2))).drop("__k", "__r")


def line_slice(body: Column, first: int = 1, most: int | None = None) -> Column:
    """Lines of a text from a 1-based line on."""
    lines = F.split(body, "\n", -1)
    return F.array_join(F.slice(lines, max(1, first), F.lit(most) if most is not None else F.greatest(F.size(lines), F.lit(1))), "\n")


def numbered_lines(body: Column, first: int = 1) -> Column:
    """Text with ``n: `` before each line."""
    return F.array_join(F.transform(F.split(body, "\n", -1), lambda x, i: F.concat((i + first).cast("string"), F.lit(": "), x)), "\n")


def snippet(body: Column, query: str, most: int = 500) -> Column:
    """struct<line, snippet, lines_before, lines_after, snippet_lines>: the line with most query terms (the first of equal
    ones), one line before and two after it, under a diff-style header; long snippets end in an ellipsis."""
    terms = [t for t in query.lower().split() if t]
    lines = F.split(body, "\n", -1)
    score = lambda x: sum((F.contains(F.lower(x), F.lit(t)).cast("int") for t in terms), F.lit(0))
    best = -F.array_max(F.transform(lines, lambda x, i: F.struct(score(x).alias("s"), (-i).alias("i"))))["i"]
    start, total = F.greatest(best - 1, F.lit(0)), F.size(lines)
    count = F.least(total, best + 3) - start
    text = F.array_join(F.slice(lines, start + 1, count), "\n")
    cut = F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most - 3)), F.lit("..."))).otherwise(text)
    after = total - (start + count)
    header = F.format_string("@@ -%d,%d @@ (%d before, %d after)", start + 1, count, start, after)
    return F.struct((best + 1).alias("line"), F.concat(header, F.lit("\n"), cut).alias("snippet"), start.alias("lines_before"), after.alias("lines_after"), count.alias("snippet_lines"))


def highlight(text: Column, query: str, before: str = "**", after: str = "**") -> Column:
    """Query terms of three or more characters marked, whatever their case."""
    terms = sorted({re.escape(t) for t in query.split() if len(t) > 2}, key=len, reverse=True)
    return F.regexp_replace(text, f"(?i)({'|'.join(terms)})", f"{before}$1{after}".replace("**", "**")) if terms else text


def folders_without_context(documents: DataFrame, contexts: DataFrame) -> DataFrame:
    """(source, folder): first path parts of active documents for which no context prefix is set."""
    folder = F.regexp_extract("path", "^([^/]+)/", 1)
    have = contexts.select(F.col("collection").alias("source"), F.regexp_extract("prefix", "^/?([^/]+)", 1).alias("folder")).distinct()
    return documents.where("active and source is not null").select("source", folder.alias("folder")).where("folder <> ''").distinct().join(have, ["source", "folder"], "left_anti")
