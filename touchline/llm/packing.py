"""Operator 4: packing documents into fixed windows by best-fit decreasing."""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stash, text_of, worker_cache

#: Pieces that one packing group holds on average, whatever the input's size.
GROUP_PIECES = 2048
PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
MEMO_CHARS, MEMO_WORDS = 48, 150_000
#: Texts of these characters alone are cut into words here; others go to the library whole.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: The tokenizer's own pattern (letters first), written for lower-cased texts of those characters.
PARTS = "[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\sa-zß-öø-ÿ0-9]+"
PRE_TOKENIZER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class WordIds(dict):
    """Ids of words as little-endian unsigned 32-bit bytes, worked out by the
    tokenizer's model when first asked for; those of short words are kept."""

    def __init__(self, tokenize, byte_letters: dict[int, str]):
        self.tokenize, self.byte_letters = tokenize, byte_letters

    def __missing__(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word if word.isascii() else word.translate(self.byte_letters))]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                first = [*islice(self.items(), MEMO_WORDS // 2)]  # those that came first are the most frequent ones
                self.clear()
                self.update(first)
            self[word] = out
        return out


class ChunkEncoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    A tokenizer that lower-cases, drops white space, splits words off by
    PRE_TOKENIZER and writes their bytes as letters encodes each word on its
    own.  So texts of PLAIN characters are cut into words here, the tokenizer's
    model encodes each distinct word once, and a text is put together from
    their ids.  Texts with other characters or a special token, and all texts
    under a tokenizer of another make, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.parts = re.compile(PARTS).findall
        made = json.loads(self.tok.to_str())
        steps = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        split, *letters = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        as_bytes = [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in letters if x["type"] == "ByteLevel"]
        self.by_word = steps == ["NFC", "Replace", "Lowercase"] and split.get("pattern", {}).get("Regex") == PRE_TOKENIZER and len(letters) == 1 and as_bytes == [("ByteLevel", False, False)]
        self.special = [t["content"] for t in made["added_tokens"]]
        step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = WordIds(self.tok.model.tokenize, {c: step.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)})

    def direct(self, text: str) -> bytes:
        (got,) = self.tok.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(got.ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.by_word or not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.direct(text)
        return b"".join(map(self.words.__getitem__, self.parts(text.lower())))


def encoder_for(path: str) -> ChunkEncoder:
    cache = worker_cache()
    if ("chunks", path) not in cache:
        cache["chunks", path] = ChunkEncoder(path)
    return cache["chunks", path]


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of counts.

    ``take(n)`` finds the smallest remaining capacity that is at least ``n``
    and has an open window: up from the leaf to the first right sibling that
    isn't empty, then down to its leftmost leaf.  O(log window) for each call.
    """

    def __init__(self, window: int):
        self.base = 1 << window.bit_length()
        self.count = [0] * (2 * self.base)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.base + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window_id: int) -> None:
        if capacity:
            self.open[capacity].append(window_id)
            self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        node = self.base + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.base
        window_id = self.open[capacity].pop()
        self._add(capacity, -1)
        return capacity, window_id


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset in it of each length (each 1 to ``window``)."""
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins, made = OpenWindows(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        capacity, window_id = bins.take(need) or (window, made)
        made += window_id == made
        where[i], offset[i] = window_id, window - capacity
        bins.put(capacity - need, window_id)
    return where, offset


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 4096, group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents and their places in sequences of ``window`` tokens.

    A document is its ids and ``end_id``.  Overlong documents are first cut
    into full windows, each a sequence of its own (odd sequence_id); what is
    left of each is packed by best-fit decreasing (even sequence_id).
    Tokenising is a narrow pass whose small result, a few numbers a piece, is
    written once.  A piece's row number, written with it, deals it to a group, so groups
    hold about ``group_pieces`` pieces whatever ids and texts repeat, and a rerun
    after a lost executor deals it again as before.  Only pieces under a full
    window are shuffled; each group's last windows alone lose padding.

    Null texts count as empty (one piece, the end id).  Rows without doc_id and
    repeated rows are packed one by one; texts of any length are cut whole; an
    empty table gives an empty result; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder_for(tokenizer_path), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (doc_id, start, length, crc, total), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[*PIECE])

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32", "row"], kind="stable")
        where, offset = best_fit_decreasing(group["length"].to_numpy(), window)
        return group[[*PIECE]].assign(sequence_id=2 * ((group["pack_group"].to_numpy() << 32) + where), offset=offset)

    bounded_batches(docs.sparkSession)
    kinds = ", ".join(f"{c} long" for c in PIECE)
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    pieces = stash(narrow.mapInArrow(cut, kinds).withColumn("row", F.monotonically_increasing_id()))
    full, part = pieces.where(F.col("length") == window), pieces.where(F.col("length") < window)
    groups = max(1, -(-part.count() // group_pieces))
    part = part.withColumn("pack_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    placed = part.groupBy("pack_group").applyInPandas(place, kinds + ", sequence_id long, offset long")
    return placed.union(full.select(*PIECE, (2 * F.col("row") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
