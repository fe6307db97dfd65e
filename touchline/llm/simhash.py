"""Operator 7: SimHash near-duplicates by Golay-code fuzzy hashing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import split_by_ids, without
from .common import bounded_batches, shuffled, stash, text_of, worker_cache
from .components import components

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Fixed value: generator polynomial of the binary Golay code (23, 12, 7).
GENERATOR = 0b101011100011
#: The 64 bits of a fingerprint as three segments of at most 23 bits: first bit and width.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
SEED = 42
#: Rows (48 bytes at most) up to which candidates are broadcast: about 50 MB of the driver at once, and several are alive.
BROADCAST_PAIRS = 200_000
#: Hot shingles (16 bytes each) that are told apart at most.
MOST_HOT = 1_000_000
#: Shingle hashes beyond its prefix by which texts without a partner are told, and the least share of its shingles (1 in so many); a pair has as many in common.
LOW, LOW_SHARE = 32, 20
#: Texts that hold a shingle from which on it counts as hot and is ordered by that number, after all others.
HOT = 50


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()  # bytes.split() splits at ASCII white space alone


def grams(words: list[bytes], k: int) -> list[bytes]:
    """Runs of k words, repeats included; fewer words are one run, none none."""
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def hashes(runs: list[bytes], seed: int = SEED) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, seed) for x in runs), np.uint64, len(runs))


def fingerprint(h: np.ndarray) -> int:
    """Bits that are set in over half of the 64-bit hashes (unsigned)."""
    if not len(h):
        return 0
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        total += np.unpackbits(h[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "little")


class Golay:
    """The perfect (23, 12, 7) code: every 23-bit vector is within distance 3 of
    one codeword.  The tables follow from the generator polynomial."""

    def __init__(self):
        def remainder(v: int) -> int:
            for i in range(22, 10, -1):
                if v >> i & 1:
                    v ^= GENERATOR << i - 11
            return v

        self.unit = np.array([remainder(1 << i) for i in range(23)], np.int64)
        self.low = np.array([remainder(v) for v in range(1 << 12)], np.int64)
        self.high = np.array([remainder(v << 12) for v in range(1 << 11)], np.int64)
        self.error = np.zeros(1 << 11, np.int64)
        for weight in (1, 2, 3):
            for at in combinations(range(23), weight):
                self.error[np.bitwise_xor.reduce(self.unit[list(at)])] = sum(1 << i for i in at)

    def decode(self, v: np.ndarray) -> np.ndarray:
        """Index (12 bits) of the nearest codeword."""
        return (v ^ self.error[self.low[v & 0xFFF] ^ self.high[v >> 12]]) >> 11

    def keys(self, v: np.ndarray) -> np.ndarray:
        """Up to 6 indices of each vector, in columns, -1 where there are fewer:
        the codewords within distance 4, which are those that the vector or one
        of its 23 neighbours decodes to."""
        near = np.concatenate([v[:, None], v[:, None] ^ (1 << np.arange(23))[None, :]], axis=1)
        got = np.sort(self.decode(near), axis=1)
        new = np.concatenate([np.ones((len(v), 1), bool), got[:, 1:] != got[:, :-1]], axis=1)
        out = np.full((len(v), 6), -1, np.int64)
        row, column = np.nonzero(new)
        out[row, new.cumsum(1)[row, column] - 1] = got[row, column]
        return out


def golay() -> Golay:
    cache = worker_cache()
    if "golay" not in cache:
        cache["golay"] = Golay()
    return cache["golay"]


def keys_of(fps: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``fps`` (signed 64-bit) and their join keys.

    If at most three of 64 bits differ, some two of the three segments differ
    in at most one bit each; a key is the pair of such two segments and a
    codeword index of each, 26 bits.  Narrow keys are the decoded indices alone
    (3 a fingerprint), wide ones all nearby indices (84 mostly).  Segments one
    bit apart: one's narrow key is among the other's wide keys.  Segments two
    bits apart: they share a wide key.
    """
    code, v = golay(), fps.view(np.uint64)
    parts = [((v >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    index = [code.keys(p) if wide else code.decode(p)[:, None] for p in parts]
    rows, keys = [], []
    for tag, (i, j) in enumerate(combinations(range(3), 2)):
        a, b = index[i][:, :, None], index[j][:, None, :]
        row, x, y = np.nonzero((a >= 0) & (b >= 0))
        rows.append(row)
        keys.append(tag << 24 | index[i][row, x] << 12 | index[j][row, y])
    return np.concatenate(rows), np.concatenate(keys)


def keyed(fps: DataFrame, columns: list[str], wide: bool, along: tuple[str, ...] = ()) -> DataFrame:
    """key, node and the fingerprints in ``columns`` of ``fps`` (node, ...) by
    the keys of each column; a column's number is part of the key.  The long
    columns ``along`` come along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                node, *values = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
                for c, value in enumerate(values[: len(columns)]):
                    row, key = keys_of(value, wide)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key | c << 26, node[row], *(v[row] for v in values))], names=["key", "node", *columns, *along])

    return fps.select("node", *columns, *along).mapInArrow(run, "key long, node long, " + ", ".join(f"{c} long" for c in (*columns, *along)))


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(hashes(grams(words_of(x.as_py()), k))) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    bounded_batches(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, fp long")


def fingerprint_components(docs: DataFrame, k: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs``.

    Fingerprints that differ in at most ``bits`` (3 at most) bits are linked.
    Equal fingerprints collapse to one node, their smallest doc_id, by a
    map-side aggregate, so groups of copies of any size cost one row each.  Of
    two linked fingerprints the narrow keys of one meet the wide keys of the
    other in an equi-join that verifies the distance in its condition: every
    link is found, whatever the number of partners.  It is always a shuffle, as
    Spark counts a row for the 84 keys of a node.  Components are joins too.

    Null, empty and blank texts have fingerprint zero and are linked like any
    other.  Rows without doc_id get their fingerprint's component, null if no
    row of that component has one.  Texts of any length are read whole, all
    their shingles counted.  Repeated rows give repeated results; an empty table
    gives an empty one; other columns are ignored, whatever they are named.
    """
    if bits > 3:
        raise ValueError("three segments prove links of at most three bits")
    rows = stash(fingerprints(docs, k, id_col, text_col))
    nodes = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"))
    one = keyed(nodes, ["fp"], wide=False).select("key", F.col("node").alias("a"), F.col("fp").alias("fp_a"))
    other = keyed(nodes, ["fp"], wide=True).select("key", F.col("node").alias("b"), F.col("fp").alias("fp_b"))
    links = shuffled(one).join(other, "key").where((F.col("fp_a") < F.col("fp_b")) & (_differ("fp_a", "fp_b") <= bits)).select("a", "b")
    found = components(links.distinct())
    named = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return rows.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, k: int = 5, similarity: float = 0.8, bits: int = 26, id_col: str = "doc_id", text_col: str = "text", few: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, component_id (smallest doc_id of the group) of every document
    whose group is not its own.

    Groups are components of links: the same words, or sets of ``k``-word
    shingles of Jaccard similarity ``similarity`` or more, verified exactly.
    The same words collapse first, so copies cost one row each; no pairs within
    a group of copies are made.

    No link is missed.  Of two texts that share ``similarity`` of their union, a
    text of n shingles lacks at most (1 - similarity) n in the other one; so in
    any order of shingles that holds for all texts, their first
    (1 - similarity) n + j ones have j in common.  First this is applied to the
    smallest hashes with j of ``LOW`` or a share of n, which tells texts that can't have a partner.
    Among those left all shingles are counted: one that a text alone holds counts
    against each of its pairs, and two texts differ in their lone shingles and
    in at least as many others as there are bits in which the parities of their
    other hashes, dealt to 128 buckets, differ.

    Large groups are then joined up by links linear in them: two fingerprints
    over two-word runs (which an edit disturbs less than longer ones) are
    searched by wide Golay keys, and pairs that differ in more than ``bits`` bits
    of both are left to the next step.  Last the texts still apart meet on their
    first (1 - similarity) n + 1 shingles, hot ones ordered last; keys that only
    texts of one group hold are dropped before.

    No text is shuffled while the chosen ones are at most ``few``, and beyond only
    those that pass a filter over their ids; no shingle set but those of candidate
    pairs: hashes are, one by one, to be counted, and numbers about texts.  Pairs
    are broadcast while they are at most ``few`` and join beyond; keys are never,
    as Spark counts a row for the many keys of a text.

    Null and blank texts count as the same words; rows of one doc_id as one
    document, which is linked as any of its texts is; rows without doc_id are
    left out; an empty table gives an empty result; other columns are ignored.
    """

    def common(n: int) -> int:
        """How many of its first shingles a text of n has in common with one at least as large."""
        return min(int(np.ceil(similarity * n - 1e-9)), max(LOW, -(-n // LOW_SHARE)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for x in batch.column(1):
                words = words_of(x.as_py())
                h = np.unique(hashes(grams(words, 2)))
                out[0].append(hashlib.md5(b" ".join(words)).digest())
                out[1].append(fingerprint(h))
                out[2].append(fingerprint(h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)))
                s = np.unique(hashes(grams(words, k))).view(np.int64)
                least = int(np.ceil(similarity * len(s) - 1e-9))
                out[3].append(np.sort(s)[: len(s) - least + common(len(s))])
                out[4].append(common(least))
            columns = [batch.column(0), pa.array(out[0], pa.binary()), *(pa.array(np.array(c, np.uint64).view(np.int64), pa.int64()) for c in out[1:3]), pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "fp1", "fp2", "low", "need"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shingles of those texts whose words are the ones asked for, and
        their parities by bucket."""
        for batch in batches:
            nodes, sets, sums = [], [], []
            for text, node, same in zip(*batch.columns, strict=True):
                words = words_of(text.as_py())
                if hashlib.md5(b" ".join(words)).digest() == same.as_py():
                    h = np.unique(hashes(grams(words, k)))
                    nodes.append(node.as_py())
                    sets.append(h.view(np.int64))
                    sums.append([int(np.bitwise_xor.reduce(np.uint64(1) << (h[h >> np.uint64(6) & np.uint64(1) == b] & np.uint64(63)))) for b in (0, 1)])
            columns = [pa.array(nodes, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), *(pa.array(np.array([x[b] for x in sums], np.uint64).view(np.int64), pa.int64()) for b in (0, 1)), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "all0", "all1", "shingles"])

    bounded_batches(docs.sparkSession)
    # rows are numbered where they are written; the first row of each text is its node
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text")).where("doc_id is not null")
    rows = stash(own.mapInArrow(sketch, "doc_id long, same binary, fp1 long, fp2 long, low array<long>, need long").withColumn("row", F.monotonically_increasing_id()))
    firsts = stash(rows.groupBy("same").agg(F.min("row").alias("node")))  # written, so that Spark can split the rows of a hot text
    named = stash(rows.select("doc_id", "row", "same").join(firsts, "same").select("doc_id", "row", "node"))
    nodes = without(rows, named.where("row <> node").select(F.col("row").alias("id")), "row").withColumnRenamed("row", "node")

    held = nodes.select("node", F.explode("low").alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    alone = held.where("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    some = stash(nodes.select("doc_id", "same", "node", "fp1", "fp2", "need", F.size("low").alias("n")).join(alone, "node", "left").where(F.col("n") - F.coalesce("alone", F.lit(0)) >= F.col("need")).select("doc_id", "same", "node", "fp1", "fp2"))

    def spread(small: DataFrame) -> DataFrame:
        return F.broadcast(small) if small.count() <= few else small

    # a text that a document has in several rows is taken once
    copies = named.groupBy("doc_id", "node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    chosen = stash(some.select("doc_id", "node", "same").join(copies.withColumn("again", F.lit(True)), "node", "left"))

    def sets_of(part: DataFrame) -> DataFrame:
        asked = part.select("doc_id", "node", "same")
        n = asked.count()
        # beyond what is broadcast, texts that a filter over the ids rules out aren't shuffled
        texts = own.join(F.broadcast(asked), "doc_id") if n <= few else split_by_ids(own, asked.select(F.col("doc_id").alias("id")), n)[0].join(asked, "doc_id")
        return texts.select("text", "node", "same").mapInArrow(shingled, "node long, size long, all0 long, all1 long, shingles array<long>")

    sets, many = sets_of(chosen.where("again is null")), chosen.where("again")
    sets = stash(sets if many.isEmpty() else sets.union(sets_of(many).dropDuplicates(["node"])))
    # how many shingles no other text has (lone), and the parities of those that others have (p0, p1)
    bit = ["if(h & 64 = 0, shiftleft(1L, cast(h & 63 as int)), 0L)", "if(h & 64 = 0, 0L, shiftleft(1L, cast(h & 63 as int)))"]
    held = sets.select("node", F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    lone = held.where("n = 1").groupBy("node").agg(F.count("*").alias("lone"), *(F.expr(f"bit_xor({x}) AS lone{i}") for i, x in enumerate(bit)))
    counted = sets.select("node", "size", "all0", "all1").join(lone, "node", "left").select("node", "size", F.coalesce("lone", F.lit(0)).cast("long").alias("lone"), *(F.expr(f"all{i} ^ coalesce(lone{i}, 0L) AS p{i}") for i in (0, 1)))
    some = stash(some.select("node", "fp1", "fp2").join(counted.where(F.col("lone") <= (1 - similarity) * F.col("size") + 1e-9), "node"))

    def verified(pairs: DataFrame) -> DataFrame:
        asked = spread(stash(pairs.select("b").distinct()))
        others = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b")).join(asked, "b", "left_semi")
        both = spread(pairs).join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a")), "a").join(others, "b")
        both = both.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).alias("n"), (F.size("s_a") + F.size("s_b")).alias("total"))
        return stash(both.where(F.col("n") >= similarity * (F.col("total") - F.col("n")) - 1e-9).select("a", "b"))

    def able(a: str, b: str):
        total, shared = F.col(f"{a}size") + F.col(f"{b}size"), F.least(*(F.col(f"{x}size") - F.col(f"{x}lone") for x in (a, b)))
        apart = F.col(f"{a}lone") + F.col(f"{b}lone") + _differ(f"{a}p0", f"{b}p0") + _differ(f"{a}p1", f"{b}p1")
        return (shared >= similarity * (total - shared) - 1e-9) & (apart * (1 + similarity) <= total * (1 - similarity) + 1e-9)

    # first each text with the least edited one of each of its keys: this joins up large groups by links linear in them
    known = ("size", "lone", "p0", "p1")
    star = keyed(some, ["fp1", "fp2"], wide=True, along=known)
    least = star.groupBy("key").agg(F.min(F.struct("lone", "node", "fp1", "fp2", "size", "p0", "p1")).alias("m"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = shuffled(star).join(least, "key")
    close = _differ("m.fp1", "fp1") + _differ("m.fp2", "fp2") <= bits
    links = verified(stash(star.where((F.col("m.node") != F.col("node")) & close & able("m.", "")).select(F.col("m.node").alias("a"), F.col("node").alias("b")).distinct()))
    # then all pairs that are still apart and share one of their first shingles
    parted = stash(some.select("node", *known).join(components(links), "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component"))
    own_sets = sets.select("node", "shingles").join(spread(parted.select("node", "part")), "node")
    often = stash(own_sets.select(F.explode("shingles").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= HOT))
    late = docs.sparkSession.sparkContext.broadcast(most_frequent(often))

    def firsts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, n = late.value
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for node, part, h in zip(*batch.columns, strict=True):
                s = np.sort(h.values.to_numpy())
                at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
                s = s[np.argsort(np.where(hot[at] == s, n[at], 0), kind="stable")] if len(hot) else s
                s = s[: len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1]
                for column, value in zip(out, (np.full(len(s), node.as_py()), np.full(len(s), part.as_py()), np.arange(len(s)), s), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in out], names=["node", "part", "at", "key"])

    keys = stash(own_sets.where("size(shingles) > 0").select("node", "part", "shingles").mapInArrow(firsts_of, "node long, part long, at long, key long"))
    mixed = keys.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("key")
    keys = stash(shuffled(keys).join(mixed, "key").drop("part").join(parted, "node"))
    one, other = (keys.select("key", *(F.col(c).alias(f"{n}_{c}") for c in ("node", "part", "at", *known))) for n in ("a", "b"))
    apart = (F.col("a_node") < F.col("b_node")) & (F.col("a_part") != F.col("b_part")) & able("a_", "b_")
    # at the first shingle in common, no more can be shared than what follows in either
    rest = F.least(*(F.col(f"{n}_size") - F.col(f"{n}_at") for n in ("a", "b")))
    apart &= rest * (1 + similarity) >= similarity * (F.col("a_size") + F.col("b_size")) - 1e-9
    links = links.union(verified(stash(shuffled(one).join(other, "key").where(apart).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct())))
    # the texts of a document are one, too
    texts = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("doc_id", "a")
    links = links.union(named.join(texts, "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct())
    parts = stash(named.join(components(links), "node", "left").select("doc_id", F.coalesce("component", "node").alias("part")))
    least = parts.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.max("doc_id").alias("last")).where("last > component_id").drop("last")
    least = stash(least)
    return parts.join(least, "part").select("doc_id", "component_id").where("doc_id <> component_id").distinct()


def most_frequent(counts: DataFrame, most: int = MOST_HOT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) of ``counts`` (h, n) and their counts: those of the largest
    counts, by powers of two, ``most`` at most.  Which ones these are decides
    about work only: any order of shingles that holds for all texts will do."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r["level"], r["rows"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect()), reverse=True)
    taken, least = 0, 64
    for at, n in sizes:
        if taken + n > most:
            break
        taken, least = taken + n, at
    found = counts.where(level >= least).select("h", "n").toArrow()
    h, n = (found[c].to_numpy() for c in ("h", "n"))
    order = np.argsort(h)
    return h[order], n[order]
