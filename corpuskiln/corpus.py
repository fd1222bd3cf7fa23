"""A corpus in a folder: the verbs of the engine over its stored frames.

The folder lies on the session's file system (``storage.Folder``). Frames are parquet folders: documents one per collection,
content, vectors and the search index a list each, to which changes append. A mutation writes only what changed and then switches
the state file, so readers see one whole state; folders that neither the new nor the last state names are removed.
Collections and contexts are small and live in the state file.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.text import title_of
from corpuskiln.operators import chunking, fusion, lexical, lookup, postings, query_document, store, vectors
from corpuskiln.session import stage_table, staging
from corpuskiln.sources.readers import read_collection
from corpuskiln.sources.storage import Folder

DOCUMENTS = "doc_id bigint, collection string, path string, title string, hash string, created_at timestamp, modified_at timestamp, active boolean"
CONTENT = "hash string, doc string, created_at timestamp"
KINDS = ("documents", "content", "vectors", "index")
#: Folders of content or vectors from which on a mutation writes them as one.
MOST_FOLDERS = 32
VECTORS = "hash string, seq int, pos int, model string, embed_fingerprint string, total_chunks int, embedded_at timestamp, embedding array<double>"


class Corpus:
    """Search and maintenance verbs. ``embedder``, ``expander`` and ``reranker`` are injected; the defaults are deterministic. Lexical search compares stems unless ``stem`` is False."""

    def __init__(self, spark: SparkSession, root: str, embedder=None, expander=None, reranker=None, model: str = "hash-16", fingerprint: str = "000000", stem: bool = True):
        self.stem = stem
        self.spark, self.root, self.embedder, self.expander, self.reranker, self.model, self.fingerprint = spark, root, embedder, expander, reranker, model, fingerprint
        self.folder = Folder(spark, root)
        self.state = self.folder.read_json("corpus.json") or {"tables": {"documents": {}, "content": [], "vectors": []}, "index": None, "before": [], "collections": {}, "contexts": [], "global_context": None}

    # --- storage
    def _save(self) -> None:
        self.folder.write_json("corpus.json", self.state)

    def documents(self) -> DataFrame:
        return self.folder.read_tables(sorted(self.state["tables"]["documents"].values()), DOCUMENTS)

    def _documents_of(self, collection: str) -> DataFrame:
        return self.folder.read_tables([n for c, n in self.state["tables"]["documents"].items() if c == collection], DOCUMENTS)

    def content(self) -> DataFrame:
        return self.folder.read_tables(self.state["tables"]["content"], CONTENT)

    def vectors(self) -> DataFrame:
        return self.folder.read_tables(self.state["tables"]["vectors"], VECTORS)

    def _used(self) -> list[str]:
        t = self.state["tables"]
        return [*t["documents"].values(), *t["content"], *t["vectors"], *((self.state["index"] or {}).get("tables", {}).values())]

    def _switch(self, documents: dict[str, str | None] | None = None, content: list[str] | None = None, vectors: list[str] | None = None) -> None:
        """Make these folders the current ones (a collection's None drops it) and remove what the last two states do not name."""
        before, t = self._used(), self.state["tables"]
        merged = t["documents"] | (documents or {})
        t["documents"] = {c: n for c, n in merged.items() if n is not None}
        t["content"] = t["content"] if content is None else content
        t["vectors"] = t["vectors"] if vectors is None else vectors
        if documents or content is not None:
            self.state["index"] = None
        self.state["before"] = before
        self._save()
        self.folder.keep_only(KINDS, {*self._used(), *before})

    def _appended(self, kind: str, more: DataFrame) -> list[str]:
        """The kind's folders with one more, or a single one of all rows where they have become many."""
        have = self.state["tables"][kind]
        if len(have) + 1 < MOST_FOLDERS:
            return [*have, self.folder.write_table(more, kind)]
        return [self.folder.write_table(getattr(self, kind)().unionByName(more), kind)]

    def _joined(self) -> DataFrame:
        return self.documents().where("active").join(self.content().select("hash", F.col("doc").alias("text")), "hash").select("doc_id", F.col("collection").alias("source"), "path", "title", "hash", "text", F.lit(True).alias("active"))

    # --- collections and contexts
    def add_collection(self, name: str, path: str, pattern: str = "*.md", ignore: list[str] | None = None, default: bool = True) -> None:
        self.state["collections"][name] = {"path": path, "pattern": pattern, "ignore": ignore or [], "default": default}
        self._save()

    def configure(self, collections: dict[str, dict]) -> bool:
        """Register exactly these collections (name -> path, pattern, ignore, default, contexts by prefix); False if nothing changed since
        the last configuration. Documents of collections that are gone stay until those are removed."""
        mark = hashlib.sha256(json.dumps(collections, sort_keys=True).encode()).hexdigest()
        if self.state.get("configured") == mark:
            return False
        self.state["collections"] = {n: {"path": c["path"], "pattern": c.get("pattern", "*.md"), "ignore": c.get("ignore") or [], "default": c.get("default", True)} for n, c in collections.items()}
        self.state["contexts"] = [[n, prefix, text] for n, c in collections.items() for prefix, text in sorted((c.get("contexts") or {}).items())]
        self.state["configured"] = mark
        self._save()
        return True

    def rename_collection(self, old: str, new: str) -> bool:
        """False if there is no such collection; an existing target is an error."""
        if new in self.state["collections"]:
            raise ValueError(f"collection {new!r} exists")
        if old not in self.state["collections"]:
            return False
        self.state["collections"][new] = self.state["collections"].pop(old)
        for c in self.state["contexts"]:
            c[0] = new if c[0] == old else c[0]
        renamed = self._documents_of(old).withColumn("collection", F.lit(new))
        self._switch(documents={old: None, new: self.folder.write_table(renamed, "documents")})
        return True

    @staging()
    def remove_collection(self, name: str) -> bool:
        if self.state["collections"].pop(name, None) is None:
            return False
        self.state["contexts"] = [c for c in self.state["contexts"] if c[0] != name]
        documents, content = store.remove_collection(self.documents(), self.content(), name)
        documents = stage_table(documents.select(self.documents().columns), "left")
        left = {c: self.folder.write_table(documents.where(F.col("collection") == c), "documents") if c != name else None for c in self.state["tables"]["documents"]}
        self._switch(documents=left, content=[self.folder.write_table(content, "content")])
        return True

    def list_collections(self) -> DataFrame:
        names = self.spark.createDataFrame([(n,) for n in self.state["collections"]], "collection string")
        return store.collection_status(self.documents(), names)

    def default_collections(self) -> list[str]:
        return sorted(n for n, c in self.state["collections"].items() if c["default"])

    def add_context(self, collection: str, prefix: str, text: str) -> bool:
        if collection not in self.state["collections"]:
            return False
        self.state["contexts"] = [c for c in self.state["contexts"] if c[:2] != [collection, prefix]] + [[collection, prefix, text]]
        self._save()
        return True

    def remove_context(self, collection: str, prefix: str) -> bool:
        left = [c for c in self.state["contexts"] if c[:2] != [collection, prefix]]
        found, self.state["contexts"] = len(left) < len(self.state["contexts"]), left
        self._save()
        return found

    def set_global_context(self, text: str | None) -> None:
        self.state["global_context"] = text
        self._save()

    def list_contexts(self) -> list[tuple[str, str, str]]:
        """By collection, longer prefixes first, then in binary order."""
        return sorted((tuple(c) for c in self.state["contexts"]), key=lambda c: (c[0], -len(c[1]), c[1]))

    # --- indexing
    @staging()
    def update(self, collections: list[str] | None = None) -> dict[str, int]:
        """Scan collections and write what changed; counts by change class. Files are read once, a collection without change is left as it is."""
        counts: dict[str, int] = {}
        for name in collections or sorted(self.state["collections"]):
            c = self.state["collections"][name]
            files = read_collection(self.spark, c["path"], c["pattern"], c["ignore"])
            scan = files.select(F.lit(name).alias("collection"), "path", title_of(F.col("body"), F.col("path")).alias("title"), F.sha2("body", 256).alias("hash"), F.col("body").alias("doc"), F.col("modified_at").alias("created_at"))
            scan = stage_table(scan, "scan")
            mine = self._documents_of(name)
            found = {r["status"]: r["count"] for r in store.classify_changes(scan, mine).groupBy("status").count().collect()}
            for status, n in found.items():
                counts[status] = counts.get(status, 0) + n
            if not set(found) - {"unchanged"}:
                continue
            after = store.upsert_documents(store.deactivate_missing(mine.drop("doc_id"), scan), scan, F.current_timestamp())
            after = after.withColumn("doc_id", F.xxhash64("collection", "path"))  # stable, whatever the order of the scan
            new = store.insert_content(self.content(), scan.select("hash", "doc", "created_at")).select("hash", "doc", "created_at")
            content = self._appended("content", new)
            self._switch(documents={name: self.folder.write_table(after.select(mine.columns), "documents")}, content=content)
        return counts

    @staging()
    def cleanup(self) -> None:
        """Delete inactive rows, bodies without document and vectors without active document; each kind becomes one folder again."""
        documents = stage_table(self.documents().where("active"), "active")
        self._switch(
            documents={c: self.folder.write_table(documents.where(F.col("collection") == c), "documents") for c in self.state["tables"]["documents"]},
            content=[self.folder.write_table(store.orphan_content_kept(self.content(), documents), "content")],
            vectors=[self.folder.write_table(self.vectors().join(documents.select("hash").distinct(), "hash", "left_semi"), "vectors")],
        )

    @staging()
    def embed(self, force: bool = False) -> int:
        """Embed pieces of bodies that have none under the model and fingerprint; the number of pieces written. A failing embedder is
        tried again; a body of which a piece stays without vector keeps none and is pending as before."""
        have = self.vectors().where("false") if force else self.vectors()
        pending = stage_table(store.pending_embeddings(self.documents(), self.content(), have, self.model, self.fingerprint).select("hash"), "pending")
        bodies = self.content().join(pending, "hash", "left_semi")
        pieces = chunking.chunk_documents(bodies, "hash", "doc")
        totals = pieces.groupBy("hash").agg(F.count(F.lit(1)).cast("int").alias("total_chunks"))
        embedded = vectors.embed(pieces, "text", "embedding") if self.embedder is None else stage_table(vectors.embed_with_retries(pieces, "text", "embedding", "failure", self.embedder), "tried")
        if self.embedder is not None:
            embedded = embedded.join(embedded.where("embedding is null").select("hash").distinct(), "hash", "left_anti")
        new = embedded.join(totals, "hash").select("hash", "seq", "pos", F.lit(self.model).alias("model"), F.lit(self.fingerprint).alias("embed_fingerprint"), "total_chunks", F.current_timestamp().alias("embedded_at"), "embedding")
        new = stage_table(new, "embedded")
        stale = have.join(pending, "hash", "left_semi")
        if force or not stale.isEmpty():
            kept = have.join(pending, "hash", "left_anti").select(new.columns)
            self._switch(vectors=[self.folder.write_table(kept.unionByName(new), "vectors")])
        elif not new.isEmpty():
            self._switch(vectors=self._appended("vectors", new))
        return new.count()

    def index(self) -> postings.Index:
        """The search index of the active documents; built if a mutation came after the last one."""
        made = self.state["index"]
        if made is None or made["stem"] != self.stem or made.get("version") != postings.VERSION:
            built = postings.build(self._joined(), stem=self.stem)
            tables = {"index": self.folder.write_table(built.terms.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id"), "index")}
            self.state["index"] = made = {"stem": self.stem, "version": postings.VERSION, "documents": built.documents, "mean": built.mean, "tables": tables}
            self._save()
        return postings.Index(self.spark.read.schema(postings.SCHEMA).parquet(self.folder.path(made["tables"]["index"])), made["documents"], made["mean"], made["stem"])

    # --- retrieval
    def search_lex(self, query: str, limit: int = 20, collection: str | None = None, min_score: float = 0.0) -> DataFrame:
        lexical.validate_lexical(query)
        return postings.search(self.index(), query, limit=limit, collection=collection, min_score=min_score)

    def search_vector(self, query: str, limit: int = 20, min_score: float = 0.3) -> DataFrame:
        """Best piece of each body for the query's vector, joined with the documents that share the body."""
        lexical.validate_semantic(query)
        q = vectors.embed(self.spark.createDataFrame([(query,)], "t string"), "t", "v", self.embedder).first()["v"]
        rows = self.vectors().where((F.col("model") == self.model) & (F.col("embed_fingerprint") == self.fingerprint)).withColumn("vec_id", F.xxhash64("hash", "seq"))
        near = vectors.search(rows, list(q), limit=limit, min_score=min_score, file_col="hash")
        hit = self.documents().where("active").join(F.broadcast(near.select(F.col("file").alias("hash"), "score")), "hash")  # at most ``limit`` rows
        from corpuskiln.operators.ranking import with_rank

        order = [F.col("score").desc(), F.col("doc_id")]
        return with_rank(hit.select("doc_id", "score").orderBy(*order).limit(limit), order)

    def search(self, text: str, limit: int = 10, skip_rerank: bool = False) -> DataFrame:
        """A query document, or a plain query that is expanded and searched in both ways."""
        parsed = query_document.parse(text)
        docs, index = self._joined(), self.index()
        lex = lambda q: postings.search(index, q)
        sem = lambda q: self.search_vector(q, min_score=-1.0)
        if parsed:
            return fusion.structured(lex, sem, parsed.searches, docs, limit=limit, skip_rerank=skip_rerank, scorer=self.reranker)
        query = text.strip().removeprefix("expand:").strip()
        more = query_document.expand(query, self.expander, self.folder, self.model) if self.expander else []
        return fusion.hybrid(lex, sem, query, more, docs, limit=limit, skip_rerank=skip_rerank, scorer=self.reranker)

    def get(self, asked: str) -> DataFrame:
        return lookup.find_document(self._joined(), asked)

    def body(self, asked: str, first: int = 1, most: int | None = None) -> str | None:
        row = self.get(asked).select("doc_id").join(self._joined(), "doc_id").select(lookup.line_slice(F.col("text"), first, most).alias("b")).first()
        return row["b"] if row else None

    def multi_get(self, pattern: str, most_chars: int = 10240) -> DataFrame:
        """Documents of a comma list, or of a glob."""
        docs = self._joined()
        if any(ch in pattern for ch in "*?[{") and "," not in pattern.replace("{", "").split("}")[0]:
            return lookup.by_glob(docs, pattern).select(F.col("path").alias("name"), "doc_id", F.when(F.length("text") <= most_chars, F.col("text")).alias("body"), F.when(F.length("text") > most_chars, "File too large").alias("skip_reason"))
        return lookup.multi_get(docs, [p.strip() for p in pattern.split(",") if p.strip()], most_chars)

    def contexts_of(self) -> DataFrame:
        contexts = self.spark.createDataFrame([tuple(c) for c in self.state["contexts"]], "collection string, prefix string, context string")
        return lookup.with_contexts(self._joined(), contexts, self.state["global_context"]).select("doc_id", "context")

    def status(self) -> dict:
        """Document, body and pending counts and the days since the last change."""
        d = self.documents().agg(F.count(F.lit(1)).alias("documents"), F.count_if("active").alias("active"), F.floor((F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.max("modified_at"))) / 86400).alias("days_since_change")).first()
        return d.asDict() | {"bodies": self.content().count(), "pending": store.pending_embeddings(self.documents(), self.content(), self.vectors(), self.model, self.fingerprint).count(), "vectors": self.vectors().count()}
