"""The graph plane: scoping of graph frames, upper levels over community reports, report search, evidence, capabilities."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.functions.text import as_rank, clean_text, sensitive_reason, spaced_json_hash, topic_tokens
from corpuskiln.operators.ranking import first_per_key, top_per_group, with_rank
from corpuskiln.operators.skew import salted_left_join
from corpuskiln.session import stage_table

# Columns that the relations of an upper level must have.
REQUIRED = {
    "semantic_units": "semanticUnitId level ownerId sourceKind sourceBookId sourceBookshelfId sourceCommunityReportId title summary rank tokenEstimate embeddingId generation evidenceMapIds".split(),
    "semantic_edges": "semanticEdgeId level ownerId sourceSemanticUnitId targetSemanticUnitId relationType weight direction sourceEntityTitles sourceRelationshipIds evidenceMapIds generation".split(),
    "communities": "id human_readable_id community level parent children title semanticUnitIds generation".split(),
    "community_reports": "id human_readable_id community level parent children title summary full_content rank findings evidenceMapIds generation".split(),
    "evidence_map": "evidenceMapId ownerLevel ownerId upperArtifactKind upperArtifactId targetLevel targetBookId targetBookshelfId targetSourceId targetDocumentId targetContentHash targetCommunityReportId targetTextUnitId targetArtifactDigest rank generation".split(),
}
# Relation types an edge may have, and the lineage fields of evidence.
RELATIONS = "shared_entity source_relationship co_clustered_topic parent_child_community bookshelf_membership library_membership".split()
LINEAGE = "targetBookId targetSourceId targetDocumentId targetContentHash targetCommunityReportId targetTextUnitId targetArtifactDigest".split()
METHODS = "local global drift basic graph_query".split()


def id_array(c: Column) -> Column:
    """Ids of a column that holds JSON text: an array, a bare value or nothing. Blank ids drop out, order stays."""
    text = F.trim(c)
    items = F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).otherwise(F.array(F.regexp_replace(text, '^"|"$', "")))
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & (F.trim(x) != "")), F.array().cast("array<string>"))


def selected_reports(reports: DataFrame, member: str, k: int = 8) -> DataFrame:
    """The ``k`` reports of best rank per member, the earlier of equal ones (``pos`` is a report's place)."""
    return top_per_group(reports.withColumn("rank", as_rank(F.col("rank"))), [member], [F.col("rank").desc(), F.col("pos")], k, "place")


def semantic_units(reports: DataFrame, owner: str, generation: str, level: str = "bookshelf", k: int = 8) -> DataFrame:
    """Units of an upper level from members' reports (member, report_id, title, summary, rank, pos).

    Ids are hashes of owner, generation, member and report, so a rebuild gives the same ids.
    """
    chosen = selected_reports(reports, "member", k)
    title = clean_text(F.col("title"), F.concat(F.col("member"), F.lit(" community")), 240)
    unit = F.concat(F.lit("bsu-"), F.left(spaced_json_hash([("bookshelfId", F.lit(owner)), ("generation", F.lit(generation)), ("bookId", F.col("member")), ("reportId", F.col("report_id"))]), F.lit(32)))
    units = chosen.select("member", "report_id", title.alias("title"), "summary", "rank", unit.alias("unit_id"))
    units = units.withColumn("summary", clean_text(F.when(F.coalesce("summary", F.lit("")) != "", F.col("summary")), F.col("title"), 1800))
    evidence = F.concat(F.lit("ev-"), F.left(spaced_json_hash([("unitId", F.col("unit_id")), ("reportId", F.col("report_id"))]), F.lit(32)))
    words = F.size(F.filter(F.split(F.concat("title", F.lit(" "), "summary"), r"\s+"), lambda w: w != ""))
    return units.select("*", F.lit(level).alias("level"), evidence.alias("evidence_id"), F.greatest(words, F.lit(1)).alias("token_estimate"))


def limit_units(units: DataFrame, most: int = 32) -> DataFrame:
    """The best units (rank, member, title, id) with their position in (member, rank, title, id) order, 0-based."""
    best = units.orderBy(F.col("rank").desc(), "member", "title", "unit_id").limit(most)
    return with_rank(best, [F.col("member"), F.col("rank").desc(), F.col("title"), F.col("unit_id")], "position").withColumn("position", F.col("position") - 1)


def edges(units: DataFrame, most_edges: int | None = 96) -> DataFrame:
    """Pairs of units of one member or with two or more topic tokens in common: (left, right, relation, weight, shared).

    Units are few (``limit_units``), yet candidates come from joins on tokens and on members, never from all pairs. Each unit
    leaves out the one of its tokens that is most frequent overall: of two tokens that a pair shares, the rarer one is then
    left in both units, so no edge is lost and the commonest tokens pair nothing. With ``most_edges`` the first edges in
    (left, right) order are kept. Units without tokens only have edges within their member.
    """
    u = units.select("unit_id", "member", "position", topic_tokens(F.concat_ws(" ", "title", "summary")).alias("tokens"))
    each = u.select("unit_id", "member", "position", "tokens", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    each = each.join(often, "token")
    top = each.groupBy("unit_id").agg(F.max(F.struct("df", "token")).alias("top"))
    each = each.join(top, "unit_id").where("token <> top.token").drop("df", "top")
    left, right = (each.select(*(F.col(c).alias(f"{side}_{c}") for c in ("unit_id", "member", "position", "tokens")), "token") for side in ("l", "r"))
    by_token = left.join(right, "token").where("l_position < r_position").drop("token")
    a, b = (u.select(*(F.col(c).alias(f"{side}_{c}") for c in ("unit_id", "member", "position", "tokens"))) for side in ("l", "r"))
    by_member = a.join(b, (F.col("l_member") == F.col("r_member")) & (F.col("l_position") < F.col("r_position")))
    pairs = by_token.unionByName(by_member).dropDuplicates(["l_unit_id", "r_unit_id"])
    shared = F.slice(F.array_sort(F.array_intersect("l_tokens", "r_tokens")), 1, 8)
    same = F.col("l_member") == F.col("r_member")
    found = pairs.withColumn("shared", shared).where(same | (F.size("shared") >= 2))
    out = found.select(
        F.col("l_unit_id").alias("left"), F.col("r_unit_id").alias("right"), "l_position", "r_position",
        F.when(same, "bookshelf_membership").otherwise("co_clustered_topic").alias("relation"), (0.5 + F.least(F.size("shared"), F.lit(6)) / 10).alias("weight"), "shared",
    )
    if most_edges is not None:
        out = out.orderBy("l_position", "r_position").limit(most_edges)
    return out.drop("l_position", "r_position")


def communities(units: DataFrame) -> DataFrame:
    """(member, n_units, rank, summary, unit_ids): a community per member from its units in position order; the summary joins
    the first three summaries. At most ``most`` units exist (``limit_units``), so groups are small."""
    ordered = F.sort_array(F.collect_list(F.struct("position", "unit_id", "title", "summary")))
    per = units.groupBy("member").agg(ordered.alias("u"), F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n_units"))
    first = F.transform(F.slice("u", 1, 3), lambda x: x["summary"])
    return per.select("member", "n_units", "rank", clean_text(F.array_join(first, " "), F.col("u")[0]["title"], 2200).alias("summary"), F.transform("u", lambda x: x["unit_id"]).alias("unit_ids"))


def overview(units: DataFrame) -> DataFrame:
    """One row over all units when there are two or more: summary of the first six, best rank, ids of the first sixteen."""
    whole = units.agg(F.sort_array(F.collect_list(F.struct("position", "unit_id", "summary"))).alias("u"), F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n_units")).where("n_units > 1")
    return whole.select(clean_text(F.array_join(F.transform(F.slice("u", 1, 6), lambda x: x["summary"]), " "), F.lit("overview"), 2400).alias("summary"), "rank", "n_units", F.transform(F.slice("u", 1, 16), lambda x: x["unit_id"]).alias("unit_ids"))


def search_reports(reports: DataFrame, query: str, limit: int = 5, text: tuple[str, ...] = ("title", "summary", "full_content"), pos: str = "pos") -> DataFrame:
    """Best reports for a query: share of its topic tokens found, plus a hundredth of the rank (0 to 10); ties by rank, then place.

    The token filter and the sort key are one pass; the limit is a top-k, not a sort.
    """
    import re

    from corpuskiln.functions.text import TOPIC_STOP_WORDS

    asked = sorted({t for t in re.findall(r"[a-z][a-z0-9_-]{3,}", query.lower()) if t not in TOPIC_STOP_WORDS})
    tokens = topic_tokens(F.concat_ws(" ", *text))
    overlap = F.size(F.array_intersect(tokens, F.array(*(F.lit(t) for t in asked)).cast("array<string>")))
    rank = as_rank(F.col("rank"))
    score = overlap / max(1, len(asked)) + F.least(F.greatest(rank, F.lit(0.0)), F.lit(10.0)) / 100
    order = [F.col("score").desc(), F.col("rank").desc(), F.col(pos)]
    return with_rank(reports.withColumns({"rank": rank, "score": score}).orderBy(*order).limit(limit), order, "place")


def report_evidence(reports: DataFrame, evidence: DataFrame) -> DataFrame:
    """(report_id, ord, evidence_id): evidence named by each report in its order; where none exists, the first (by ``pos``) of
    the evidence that names the report."""
    named = reports.select("report_id", F.posexplode("evidence_ids").alias("ord", "evidence_id")).join(evidence.select("evidence_id", "upper_id").dropDuplicates(["evidence_id"]), "evidence_id").select("report_id", "ord", "evidence_id")
    bare = reports.select("report_id").join(named.select("report_id").distinct(), "report_id", "left_anti")
    other = evidence.join(bare.select(F.col("report_id").alias("upper_id")), "upper_id", "left_semi").groupBy("upper_id").agg(F.min_by("evidence_id", "pos").alias("evidence_id"))
    return named.unionByName(other.select(F.col("upper_id").alias("report_id"), F.lit(0).alias("ord"), "evidence_id"))


def scope_frames(documents: DataFrame, text_units: DataFrame, entities: DataFrame, relationships: DataFrame, community_table: DataFrame, reports: DataFrame, keep: DataFrame) -> dict[str, DataFrame]:
    """The graph frames restricted to documents named in ``keep`` (id): a chain of semi joins on exploded id lists.

    A text unit stays with its document, an entity or relationship with any of its units, a community with any unit, a report
    with its community. Rows whose lists are null or empty drop out.
    """
    docs = documents.join(keep.select("id").distinct(), "id", "left_semi")
    units = text_units.join(docs.select(F.col("id").alias("document_id")), "document_id", "left_semi")
    ids = stage_table(units.select(F.col("id").alias("unit")).distinct(), "scope")  # five frames are cut to it

    def of(frame: DataFrame, key: str) -> DataFrame:
        hit = frame.select(key, F.explode("text_unit_ids").alias("unit")).join(ids, "unit", "left_semi").select(key).distinct()
        return frame.join(hit, key, "left_semi")

    kept = of(community_table, "community")
    return {"documents": docs, "text_units": units, "entities": of(entities, "id"), "relationships": of(relationships, "id"), "communities": kept, "community_reports": reports.join(kept.select("community"), "community", "left_semi")}


class ScopeError(ValueError):
    """A stage of a scope that holds nothing; ``stage`` names it."""

    def __init__(self, stage: str):
        super().__init__(f"the scope leaves no {stage.replace('_', ' ')}")
        self.stage = stage


def checked_scope(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frames of ``scope_frames``, failing with the first stage that is empty."""
    for stage, frame in frames.items():
        if frame.isEmpty():
            raise ScopeError(stage)
    return frames


def match_capabilities(candidates: DataFrame, capabilities: DataFrame) -> DataFrame:
    """(candidate_id, capability_id): ready capabilities by document id, by source id, or by content hash where that hash
    belongs to one document only, each pair once.

    One join for the three keys, whose hot keys (a document with a large part of all rows) are salted. A pair is made at the
    first key on which it agrees, so keys that name the same pair do not multiply it.
    """
    names = ["document_id", "source_id", "content_hash"]
    ready = stage_table(capabilities.where("ready").select("capability_id", *names).distinct(), "ready")
    one = ready.where("content_hash is not null").groupBy("content_hash").agg(F.min("document_id").alias("lo"), F.max("document_id").alias("hi")).where("lo <=> hi").select("content_hash", F.lit(True).alias("one"))
    caps = ready.join(one, "content_hash", "left").withColumn("content_hash", F.when(F.col("one"), F.col("content_hash")))

    def keyed(df: DataFrame, own: str, mark: str) -> DataFrame:
        each = F.array(*(F.when(F.col(n).isNotNull(), F.struct(F.lit(i).alias("kind"), F.concat(F.lit(f"{i}:"), F.col(n)).alias("key"))) for i, n in enumerate(names)))
        return df.select(own, *(F.col(n).alias(f"{mark}{i}") for i, n in enumerate(names)), F.explode(F.array_compact(each)).alias("x")).select(own, f"{mark}0", f"{mark}1", "x.key", *(["x.kind"] if mark == "c" else []))

    pairs = salted_left_join(keyed(caps, "capability_id", "p"), keyed(candidates.select("candidate_id", *names).distinct(), "candidate_id", "c"), "key", how="inner")
    agree = [F.coalesce(F.col(f"p{i}") == F.col(f"c{i}"), F.lit(False)) for i in (0, 1)]
    first = (F.col("kind") == 0) | (F.col("kind") == 1) & ~agree[0] | (F.col("kind") == 2) & ~agree[0] & ~agree[1]
    return pairs.where(first).select("candidate_id", "capability_id").distinct()


def merge_capabilities(derived: DataFrame, explicit: DataFrame, identity: list[str]) -> DataFrame:
    """Derived rows, then explicit ones whose id and whose identity are both unseen."""
    fresh = explicit.join(derived.select("capability_id").distinct(), "capability_id", "left_anti")
    keys = derived.select(*identity).distinct()
    condition = [fresh[c].eqNullSafe(keys[c]) for c in identity]
    return derived.unionByName(fresh.join(keys, condition, "left_anti").select(*derived.columns))


def derive_capabilities(books: DataFrame, book: str, methods: list[str] = METHODS) -> DataFrame:
    """Every (book, method): a cross product with the fixed list of methods, as an explode."""
    return books.select("*", F.explode(F.array(*(F.lit(m) for m in methods))).alias("method")).withColumn("capability_id", F.concat_ws(":", F.lit("cap"), F.col(book), F.col("method")))


def graph_coverage(candidates: DataFrame, matched: DataFrame) -> DataFrame:
    """(total, ready, coverage): share of candidates with a capability; 0 without candidates."""
    hit = matched.select("candidate_id").distinct().withColumn("r", F.lit(1))
    return candidates.join(hit, "candidate_id", "left").agg(F.count(F.lit(1)).alias("total"), F.count("r").alias("ready")).withColumn("coverage", F.when(F.col("total") == 0, 0.0).otherwise(F.col("ready") / F.col("total")))


def lineage_gaps(evidence: DataFrame) -> DataFrame:
    """(field, n, first_pos): lineage fields that are null, blank or ``unknown-``, with the first offending row. One pass."""
    bad = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")).rlike("^$|^unknown-")
    one = evidence.agg(*(x for c in LINEAGE for x in (F.count_if(bad(c)).alias(f"n_{c}"), F.min(F.when(bad(c), F.col("pos"))).alias(f"p_{c}"))))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n_{c}").alias("n"), F.col(f"p_{c}").alias("first_pos")) for c in LINEAGE))).alias("x")).select("x.*").where("n > 0")


# Names of columns that must not leave the engine, whatever they hold (compared without regard to case).
FORBIDDEN_FIELDS = "providerRequestPayload providerResponsePayload rawPrompt rawCompletion apiKey credential absoluteLocalPath queryLogContent".split()


def sensitive_columns(df: DataFrame) -> DataFrame:
    """(column, reason, n) of sensitive values in any column, nested ones included, and of columns with a forbidden name, whose
    values are not looked at (reason ``field_name``, n the rows). One pass over the rows."""
    forbidden = {f.lower() for f in FORBIDDEN_FIELDS}
    text = lambda c, t: F.to_json(F.col(f"`{c}`")) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`").cast("string")
    reasons = [(c, F.lit("field_name") if c.lower() in forbidden else sensitive_reason(text(c, t))) for c, t in df.dtypes]
    rows = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), r.alias("reason")) for c, r in reasons))).alias("x")).select("x.*").where("reason is not null")
    return rows.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("n"))


def complete_lineage(evidence: DataFrame) -> DataFrame:
    """The evidence, failing on a row whose lineage is incomplete: no upper level may be built on it."""
    bad = F.lit(False)
    for c in LINEAGE:
        bad = bad | F.coalesce(F.trim(F.col(c)), F.lit("")).rlike("^$|^unknown-")
    message = F.concat(F.lit("incomplete lineage: "), F.concat_ws(" ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c), F.lit("null"))) for c in LINEAGE)))
    return evidence.withColumn(LINEAGE[0], F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col(LINEAGE[0])))


def library_level(shelf_reports: DataFrame, library: str, generation: str, most_units: int = 32, evidence: DataFrame | None = None) -> dict[str, DataFrame]:
    """The level above the shelves: units, edges, communities and overview over the shelves' reports (member is the shelf).

    ``evidence`` (with the lineage fields) must resolve completely, else the build fails.
    """
    units = stage_table(limit_units(semantic_units(shelf_reports, library, generation), most_units), "library")  # at most ``most_units`` rows
    level = {"units": units, "edges": edges(units), "communities": communities(units), "overview": overview(units)}
    if evidence is not None:
        level["evidence"] = stage_table(complete_lineage(evidence), "lineage")
    return level


def inspect(relations: dict[str, DataFrame], allowed: list[str] = RELATIONS) -> list[str]:
    """Diagnostics of an upper level's relations: missing relations and columns, empty relations, forbidden relation types."""
    found = []
    for name, columns in REQUIRED.items():
        if name not in relations:
            found.append(f"missing_relation:{name}")
            continue
        df = relations[name]
        found += [f"missing_column:{name}:{c}" for c in columns if c not in df.columns]
        if df.isEmpty():
            found.append(f"empty_relation:{name}")
        elif name == "semantic_edges" and "relationType" in df.columns:
            found += sorted(f"relation_not_allowed:{r[0]}" for r in df.where(~F.col("relationType").isin(allowed)).select("relationType").distinct().limit(100).collect())
    return found


def budget(units: int, most_units: int, most_tokens: int, per_unit: int = 640) -> tuple[int, bool]:
    """(estimated tokens, whether they fit)."""
    estimate = min(units, most_units) * per_unit
    return estimate, estimate <= most_tokens


def pack_prompt(reports: DataFrame, order: list[Column], text: str, most_tokens: int) -> DataFrame:
    """Reports, in order, whose texts (four characters a token) fit a prompt; the first always must, else nothing fits."""
    tokens = F.ceil(F.length(F.col(text)) / 4).cast("bigint")
    w = Window.partitionBy(F.lit(1)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return reports.withColumn("tokens", tokens).withColumn("running", F.sum("tokens").over(w)).where(F.col("running") <= most_tokens)


def _digest(lines: DataFrame, order: str, line: str, between: str, around: tuple[str, str] = ("", "")) -> DataFrame:
    """(digest, n): SHA-256 of all lines in order. One hash is one sequence, so one task reads the sorted lines, a batch at a time."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, n = hashlib.sha256(around[0].encode()), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                digest.update(((between if n else "") + text).encode())
                n += 1
        digest.update(around[1].encode())
        yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()]), pa.array([n], pa.int32())], ["digest", "n"])

    return lines.repartition(1).sortWithinPartitions(order).select(line).mapInArrow(walk, "digest string, n int")


def generation_hash(members: DataFrame, id_col: str) -> DataFrame:
    """(generation, n): hash of the sorted member ids of a shelf; null ids take no part."""
    ids = members.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id")).distinct()
    return _digest(ids, "id", "id", "\n").withColumnRenamed("digest", "generation")


def evidence_rows(scope: DataFrame, capabilities: DataFrame, text_units: DataFrame, context: DataFrame | None = None) -> DataFrame:
    """(evidence_id, capability_id, book_id, document_id, unit_id, quote): a row per capability and text unit of a scope.

    ``scope`` (book_id, document_id, unit_ids) lists units per book; where ``context`` (unit_id) names any of a book's units,
    only those count. The quote is the unit's text, trimmed and cut to 1200 characters; null if it has none.
    """
    each = scope.select("book_id", "document_id", F.explode("unit_ids").alias("unit_id")).distinct()
    if context is not None:
        hit = each.join(context.select("unit_id").distinct(), "unit_id", "left_semi")
        named = hit.select("book_id").distinct()
        each = hit.unionByName(each.join(named, "book_id", "left_anti"))
    caps = capabilities.groupBy("book_id").agg(F.min("capability_id").alias("capability_id"))
    quote = F.left(F.trim("text"), F.lit(1200))
    units = text_units.select(F.col("id").alias("unit_id"), F.when(quote != "", quote).alias("quote")).dropDuplicates(["unit_id"])
    rows = each.join(caps, "book_id").join(units, "unit_id", "left")
    return rows.select(F.concat_ws(":", "capability_id", "unit_id").alias("evidence_id"), "capability_id", "book_id", "document_id", "unit_id", "quote").dropDuplicates(["evidence_id"])


def community_context(membership: DataFrame, details: DataFrame, text_units: DataFrame) -> DataFrame:
    """(community, unit_id, text, degree): the units of each community with their degree, 0 where no entity is known.

    ``missing`` marks units that no text unit has: callers fail on them.
    """
    each = membership.select("community", F.explode("text_unit_ids").alias("unit_id"))
    known = details.select("community", F.col("id").alias("unit_id"), "degree")
    texts = text_units.select(F.col("id").alias("unit_id"), "text", F.lit(True).alias("there"))
    return each.join(known, ["community", "unit_id"], "left").join(texts, "unit_id", "left").select("community", "unit_id", "text", F.coalesce("degree", F.lit(0)).alias("degree"), F.col("there").isNull().alias("missing"))


def deepening_targets(evidence: DataFrame, target: str, report: str, pos: str, limit: int = 3) -> DataFrame:
    """(target, reports, first): the first targets of a ranked evidence list with their reports. Evidence of one answer is short."""
    per = evidence.where(F.col(target).isNotNull()).groupBy(target).agg(F.min(pos).alias("first"), F.array_sort(F.collect_set(report)).alias("reports"))
    return per.orderBy("first").limit(limit)


def unique_identity(results: DataFrame, identities: DataFrame) -> DataFrame:
    """Results with the identity of their content hash, only where exactly one identity has that hash."""
    one = identities.where("content_hash is not null").groupBy("content_hash").agg(F.count(F.lit(1)).alias("__n"), F.min("document_id").alias("document_id")).where("__n = 1").drop("__n")
    return results.join(one, "content_hash", "left")


def merge_identities(rows: DataFrame, key: list[str], fields: list[str], pos: str) -> DataFrame:
    """One row per identity key; each field is the first non-null value in order of ``pos``."""
    return rows.groupBy(*key).agg(*(F.min_by(f, F.when(F.col(f).isNotNull(), F.col(pos))).alias(f) for f in fields))


def directory_digest(files: DataFrame) -> DataFrame:
    """(digest, n) of a folder's files (path, content): hash over the JSON list of (path, hash of the content) in path order."""
    rows = files.select("path", F.to_json(F.struct("path", F.sha2("content", 256).alias("h"))).alias("row"))
    return _digest(rows, "path", "row", ",", ("[", "]"))
