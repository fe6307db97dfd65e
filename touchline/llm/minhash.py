"""Operator 12: MinHash near-duplicates by fast similarity sketching."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, release, stash, text_of
from .components import components

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Coordinates of a sketch: BANDS bands of WIDTH each.  Sets of similarity 0.85 share no band with probability
#: (1 - 0.85^7)^64 = 2e-11, more similar ones with less.
WIDTH, BANDS = 7, 64
SIZE = WIDTH * BANDS
#: 64-bit numbers of one-bit coordinates, and of parities, by which pairs are told apart before sets are compared.
BITS, PARITIES = 7, 8
#: Standard deviations by which the agreement of two sketches may fall short of what is expected.
DEVIATIONS = 6.5
#: Hashed placements that are worked out at once.
PLACED = 1 << 16
SEED = 42
#: Pairs (16 bytes each) up to which they are broadcast, about 100 MB with overhead.
BROADCAST_PAIRS = 2_000_000


def mixed(v: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which all bits depend on all."""
    v = (v ^ v >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ v >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return v ^ v >> np.uint64(31)


#: A number for each of the 2 x SIZE rounds.
ROUNDS = mixed(np.arange(1, 2 * SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingled(text: str, k: int) -> tuple[int, np.ndarray]:
    """Number of distinct shingles of ``k`` words, and their sorted 64-bit
    hashes; fewer words are one shingle, none none."""
    words = text.encode().translate(FOLD).split()  # bytes.split() splits at ASCII white space alone
    if len(words) < k:
        runs = {b" ".join(words)} if words else set()
    else:
        runs = set(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))
    digest = xxhash.xxh64_intdigest
    return len(runs), np.sort(np.fromiter((digest(x, SEED) for x in runs), np.uint64, len(runs)))


def sketch(h: np.ndarray) -> np.ndarray:
    """The SIZE coordinates of a set of hashes.

    In each of the first SIZE rounds every element is placed in a bin that its
    hash of the round chooses, with the round and the rest of that hash as its
    value; in round SIZE + b every element is placed in bin b.  A bin keeps its
    smallest value, so every bin is filled, and earlier rounds win: as soon as
    no bin is empty later rounds can change nothing.  Two sets agree in a bin
    with their Jaccard similarity as probability, and the number of bins that
    agree is concentrated like that of independent ones.
    """
    out = np.full(SIZE, np.iinfo(np.uint64).max)
    done, step = 0, max(1, min(PLACED // len(h), int(1.3 * SIZE * np.log(SIZE) / len(h)) + 1))
    while done < SIZE and (done == 0 or out.max() == np.iinfo(np.uint64).max):
        numbers = np.arange(done, min(SIZE, done + step), dtype=np.uint64)
        v = mixed(h[None, :] ^ ROUNDS[numbers][:, None])
        bins = (v >> np.uint64(32)) * np.uint64(SIZE) >> np.uint64(32)
        np.minimum.at(out, bins.ravel().astype(np.int64), (numbers[:, None] << np.uint64(32) | v & np.uint64(0xFFFFFFFF)).ravel())
        done += len(numbers)
    for b in np.nonzero(out == np.iinfo(np.uint64).max)[0]:
        out[b] = np.uint64(SIZE + b) << np.uint64(32) | (mixed(h ^ ROUNDS[SIZE + b]) & np.uint64(0xFFFFFFFF)).min()
    return out


def bands(coordinates: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in coordinates.reshape(BANDS, WIDTH).T:
        keys = mixed(keys ^ column)
    return keys


def marks(h: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
    """One bit of each of the first coordinates, and the parities of the set's
    elements, dealt to buckets by their hashes: BITS + PARITIES numbers."""
    low = np.packbits((mixed(coordinates[: 64 * BITS]) & np.uint64(1)).astype(bool), bitorder="little").view(np.uint64)
    odd = np.bincount((mixed(h) >> np.uint64(32) & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.concatenate([low, np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)])


def may_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets (columns n and marks, with prefixes) may be as similar as that.

    The smaller set must have its share of the larger one's size.  Two sets of a
    and b elements that are, differ in at most (100 - percent) / (100 + percent)
    of a + b elements, and in at least as many as there are buckets whose
    parities differ: both tests are exact.  One-bit coordinates agree in the
    similarity and half of the rest: fewer by DEVIATIONS standard deviations
    than expected happens once in 10^10 such pairs.
    """
    n, expected = 64 * BITS, (1 + percent / 100) / 2
    least = int(n * expected - DEVIATIONS * (n * expected * (1 - expected)) ** 0.5)
    apart = lambda start, count: "+".join(f"bit_count({a}marks[{i}] ^ {b}marks[{i}])" for i in range(start, start + count))
    return F.expr(
        f"100 * least({a}n, {b}n) >= {percent} * greatest({a}n, {b}n) AND {100 + percent} * ({apart(BITS, PARITIES)}) <= {100 - percent} * ({a}n + {b}n) AND {n} - ({apart(0, BITS)}) >= {least}"
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", few: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    Rows are linked if ``percent`` % of the union of their sets of ``k``-word
    shingles is in both; a component is named by its smallest doc_id, whose
    rows are kept.  Fewer words than k are one shingle.

    Equal sets collapse to one node first, by a map-side aggregate, so copies
    cost a row each.  The others are sketched; sets that share a band of their
    sketches are candidates.  First every set is compared with one of each of
    its bands' sets, the one that shares most bands with others: that joins up
    large groups by links linear in them.  Then sets that are still apart and
    share a band are compared, where sizes, parities and sketches don't rule
    them out; sets of the largest part of a band only with the others.  All
    links are confirmed on the full sets, and what a band misses is stated at
    BANDS: no candidates are capped.  Equality of shingles is that of 64-bit
    hashes.

    Sets are written once, with row numbers that are fixed by that.  Texts are
    not shuffled, and sets only where a pair is to be confirmed.

    Null and blank texts have an empty set, which is linked with nothing: their
    component is their own doc_id.  Rows without doc_id are linked like others;
    their component is null if no row of it has one, and so is kept.  Repeated
    rows give repeated results, rows of one doc_id are not linked by it.  Texts
    of any length are read whole.  An empty table gives an empty result; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, same, sets, keys, mark = [], [], [], [], []
            for text in batch.column(2):
                n, h = shingled(text.as_py(), k)
                # with fewer elements one more is too large a share
                able = n > 0 and 100 * n >= percent * (n + 1)
                c = sketch(h) if able else None
                sizes.append(n)
                same.append(hashlib.md5(h.tobytes()).digest() if n else None)
                sets.append(h.view(np.int64) if able else None)
                keys.append(bands(c).view(np.int64) if able else None)
                mark.append(marks(h, c).view(np.int64) if able else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (sets, keys, mark))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "row", "n", "same", "shingles", "keys", "marks"])

    bounded_batches(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_of(text_col).alias("text"))
    rows = stash(own.mapInArrow(run, "doc_id long, row long, n long, same binary, shingles array<long>, keys array<long>, marks array<long>"))
    # the first row of each set is its node; empty sets are none
    firsts = stash(rows.where("same is not null").groupBy("same").agg(F.min("row").alias("node"), F.min("doc_id").alias("least")))

    def spread(small: DataFrame, longs: int = 2) -> DataFrame:
        return F.broadcast(small) if small.count() * longs <= 2 * few else small

    def of_nodes(*columns: str) -> DataFrame:
        return rows.where("keys is not null").select(F.col("row").alias("node"), *columns).join(nodes, "node", "left_semi")

    nodes = spread(firsts.select("node"))
    all_keys = of_nodes("keys").select("node", F.explode("keys").alias("key"))
    often = stash(all_keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    shared = stash(all_keys.join(spread(often), "key"))
    # how many other sets a set meets in its bands: the center of a band is the one that meets most
    met = shared.groupBy("node").agg(F.sum(F.col("c") - 1).alias("met"))
    known = stash(of_nodes("n", "marks").join(met, "node"))
    keyed = first = stash(shared.select("node", "key").join(spread(known, 3 + BITS + PARITIES), "node"))
    centers = keyed.groupBy("key").agg(F.min(F.struct((-F.col("met")).alias("met"), "node", "n", "marks")).alias("m"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links, by their full sets."""
        asked = spread(stash(pairs.select("b").distinct()))
        sets = rows.select("row", "shingles")
        others = sets.join(asked, sets["row"] == asked["b"]).select("b", F.col("shingles").alias("s_b"))
        both = sets.join(spread(pairs), F.col("row") == F.col("a")).select("a", "b", F.col("shingles").alias("s_a")).join(others, "b")
        both = both.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).alias("in_both"), (F.size("s_a") + F.size("s_b")).alias("total"))
        return stash(both.where(100 * F.col("in_both") >= percent * (F.col("total") - F.col("in_both"))).select("a", "b"))

    star = keyed.join(centers, "key").withColumns({"c_n": F.col("m.n"), "c_marks": F.col("m.marks")}).where((F.col("m.node") != F.col("node")) & may_link("c_", "", percent))
    links = confirmed(stash(star.select(F.col("m.node").alias("a"), F.col("node").alias("b")).distinct()))
    # what is still apart: of each band the sets outside its largest part, with all of other parts
    parted = known.select("node").join(components(links), "node", "left").select("node", F.coalesce("component", "node").alias("part"))
    keyed = stash(keyed.drop("met").join(spread(stash(parted)), "node"))
    lead = keyed.groupBy("key", "part").agg(F.count("*").alias("size")).groupBy("key").agg(F.max_by("part", F.struct("size", "part")).alias("lead"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    mixed_keys = stash(keyed.join(spread(stash(lead)), "key"))
    one = mixed_keys.where("part <> lead").select("key", F.col("node").alias("a"), F.col("part").alias("a_part"), F.col("n").alias("a_n"), F.col("marks").alias("a_marks"))
    other = mixed_keys.select("key", F.col("node").alias("b"), F.col("part").alias("b_part"), "lead", F.col("n").alias("b_n"), F.col("marks").alias("b_marks"))
    apart = (F.col("a_part") != F.col("b_part")) & ((F.col("b_part") == F.col("lead")) | (F.col("a") < F.col("b"))) & may_link("a_", "b_", percent)
    pairs = one.join(other, "key").where(apart).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.union(confirmed(stash(pairs)))

    named = firsts.join(components(links), "node", "left").select("same", "least", F.coalesce("component", "node").alias("part"))
    ids = named.groupBy("part").agg(F.min("least").alias("component_id"))
    named = stash(named.select("same", "part").join(ids, "part").select("same", "component_id"))
    out = rows.select("doc_id", "n", "same").join(named, "same", "left")
    for gone in (often, shared, known, first, keyed, mixed_keys):
        release(gone)
    component = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
