"""Operator 6: benchmark decontamination by size-partitioned MinHash
containment search, in Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash, text_of

WORDS, CONTAINMENT = 5, 0.8
#: Items of fewer words than this ("yes", "the capital") are no evidence within a longer text: they match the same words alone.
SHORTEST = 3
#: Sketch hashes and ids (a long each), candidate pairs (two), and words of all items, up to which they are broadcast: 100 MB at most with overhead.
BROADCAST_LONGS, BROADCAST_PAIRS, BROADCAST_WORDS = 2_000_000, 400_000, 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def runs(length: int, hashed: bool) -> str:
    """The runs of so many words of column words: their 64-bit hashes, or themselves."""
    run = "xxhash64(" + ", ".join(f"words[i + {j}]" for j in range(length)) + ")" if hashed else f"concat_ws(' ', slice(words, i + 1, {length}))"
    return f"transform(sequence(0, size(words) - {length}), i -> {run})"


def item_shingles(k: int, hashed: bool) -> Column:
    """The distinct shingles of an item: its runs of k words, or of as many as it has."""
    cases = "".join(f" WHEN size(words) = {j} THEN {runs(j, hashed)}" for j in range(k - 1, 0, -1))
    return F.expr(f"array_distinct(CASE WHEN size(words) >= {k} THEN {runs(k, hashed)}{cases} ELSE array() END)")


def document_shingles(lengths: list[int], shortest: int, hashed: bool) -> Column:
    """The runs of a document's words of each length that items have; those of
    fewer than ``shortest`` words only if they are the whole document."""
    parts = [f"CASE WHEN size(words) {'>=' if j >= shortest else '='} {j} THEN {runs(j, hashed)} ELSE array() END" for j in lengths]
    return F.expr(parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})")


def sketches(items: DataFrame, k: int, containment: float) -> DataFrame:
    """hash, item_id: the smallest hashes of each item's shingles.

    Items fall into partitions by size (powers of two).  An item of at most u
    shingles that a document contains to the share c lacks at most (1-c)u of
    them, so of its floor((1-c)u)+1 smallest hashes at least one is in the
    document: a sketch of that length, the same for a partition, misses none.
    """
    hashes = items.select("item_id", F.array_sort(item_shingles(k, True)).alias("h")).where("size(h) > 0")
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.size("h"))) + 1) - 1
    length = (F.floor(F.lit(1 - containment) * upper + 1e-9) + 1).cast("int")
    return hashes.select("item_id", F.explode(F.slice("h", 1, length)).alias("hash"))


def contained(docs: DataFrame, items: DataFrame, k: int = WORDS, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", most_hashes: int = BROADCAST_LONGS, most_pairs: int = BROADCAST_PAIRS, most_words: int = BROADCAST_WORDS, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment of every pair in which
    the document holds at least that share of the item's distinct shingles.

    The items are the queries.  Documents are never compared with each other or
    with all items: the hashes of their shingles are looked up among those of
    the items' sketches, which alone are broadcast (up to ``most_hashes``,
    shuffled beyond), and what is found, rarely more than a few rows a document,
    meets the sketches' items.  Each candidate is verified exactly on the
    shingles: the candidates are broadcast to the documents while they are at
    most ``most_pairs``, so no text is shuffled, and join them by doc_id beyond;
    so are the items while they have ``most_words`` words.

    Words are lower-cased and split at ASCII white space.  An item of fewer than
    k words is one shingle of its own length, looked for among the documents'
    runs of that many words (documents are hashed for the lengths that occur
    alone); of fewer than ``shortest`` words, it matches only a document of the
    same words.  Texts that are null or without words match nothing; texts of
    any length are searched whole.  Rows
    of one doc_id are one document, which holds the shingles of all of them;
    rows without an id are left out.  Each distinct text of an item_id is
    searched on its own, and the best share is reported.  Empty tables on either
    side give an empty result; other columns are ignored.
    """
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text")).where("doc_id is not null")
    base = items.select(items[item_id_col].cast("long").alias("item_id"), words_of(text_of(item_text_col)).alias("words")).where("item_id is not null")
    # every distinct text of an item is a query of its own, numbered once; the item's id comes back at the end
    named = stash(base.distinct().select(F.col("item_id").alias("item"), F.monotonically_increasing_id().alias("item_id"), "words"))
    lengths = sorted(row[0] for row in named.where("size(words) > 0").select(F.least(F.size("words"), F.lit(k))).distinct().collect()) or [k]  # k numbers at most
    sketch = stash(sketches(named.select("item_id", "words"), k, containment))
    known = stash(sketch.select("hash").distinct())
    known = F.broadcast(known) if known.count() <= most_hashes else known
    hashed = own.select("doc_id", words_of(F.col("text")).alias("words")).select("doc_id", F.explode(document_shingles(lengths, shortest, True)).alias("hash"))
    hits = stash(hashed.join(known, "hash", "left_semi").distinct())
    pairs = stash(hits.join(sketch, "hash").select("doc_id", "item_id").distinct())
    full = named.select("item_id", "item", item_shingles(k, False).alias("item_shingles"))
    per_doc = pairs.groupBy("doc_id").agg(F.collect_list("item_id").alias("item_ids"))
    few = pairs.count() <= most_pairs
    short = (named.agg(F.sum(F.size("words"))).first()[0] or 0) <= most_words
    texts = own.join(F.broadcast(per_doc) if few else per_doc, "doc_id").select("doc_id", "item_ids", words_of(F.col("text")).alias("words")).select("doc_id", "item_ids", document_shingles(lengths, shortest, False).alias("doc_shingles"))
    both = texts.select("doc_id", "doc_shingles", F.explode("item_ids").alias("item_id")).join(F.broadcast(full) if short else full, "item_id")
    shared = both.select("doc_id", "item", "item_id", F.size("item_shingles").cast("long").alias("n_shingles"), F.explode(F.array_intersect("doc_shingles", "item_shingles")).alias("shingle")).distinct()
    shared = shared.groupBy("doc_id", "item", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    best = shared.where(F.col("n_shared") >= F.lit(containment) * F.col("n_shingles") - 1e-9).withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    best = best.groupBy("doc_id", F.col("item").alias("item_id")).agg(F.max(F.struct("containment", "n_shared", "n_shingles")).alias("best"))
    return best.select("doc_id", "item_id", "best.n_shared", "best.n_shingles", "best.containment")


def clean(docs: DataFrame, items: DataFrame, k: int = WORDS, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without those that contain an item, with their columns
    as they are.  Rows without an id are searched one by one, and items without
    one too."""
    inner = [f"in_{i}" for i in range(len(docs.columns))]
    own, doc_id, text = docs.toDF(*inner), inner[docs.columns.index(id_col)], inner[docs.columns.index(text_col)]
    queries = items.select(F.coalesce(items[item_id_col].cast("long"), F.lit(-1)).alias("item_id"), items[item_text_col].alias("text"))

    def free(part: DataFrame, key: str) -> DataFrame:
        found = stash(contained(part.select(key, text), queries, k, containment, id_col=key, text_col=text).select(F.col("doc_id").alias("id")).distinct())
        return part.join(F.broadcast(found) if found.count() <= BROADCAST_LONGS else found, part[key] == found["id"], "left_anti")

    out = free(own.where(F.col(doc_id).isNotNull()), doc_id)
    nameless = own.where(F.col(doc_id).isNull())
    if not nameless.isEmpty():
        numbered = stash(nameless.withColumn("row", F.monotonically_increasing_id()))  # written with their numbers
        out = out.union(free(numbered, "row").select(*inner))
    return out.toDF(*docs.columns)
