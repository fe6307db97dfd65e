"""Operator 2: token counts by heap-and-linked-list byte-pair merging."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, text_of, worker_cache

#: Longest unit, and most units, that one Python worker remembers.
MEMO_CHARS, MEMO_UNITS = 48, 400_000
SPACE = "▁"


def merge_count(symbols: str, rank: dict[str, int]) -> tuple[int, list[str]]:
    """Initial symbols minus merges, and the symbols that are left.

    ``symbols`` starts as a doubly linked list of characters.  A heap holds the
    adjacent pairs whose concatenation is a piece, as rank and left position in
    one number; the lowest is popped and merged, and the pairs with the two new
    neighbours are pushed.  A popped pair whose sides have changed since is
    stale and skipped.  O(n log n) for n characters.
    """
    part: list = list(symbols)
    n = len(part)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    get = rank.get
    heap = [r << bits | i for i, r in enumerate(map(get, map(str.__add__, part, part[1:]))) if r is not None]
    if not heap:
        return n, part
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    merges = 0
    while heap:
        pair = pop(heap)
        left = pair & mask
        right = after[left]
        if part[left] is None or right < 0 or get(both := part[left] + part[right]) != pair >> bits:
            continue
        part[left], part[right] = both, None
        merges += 1
        after[left] = right = after[right]
        if right >= 0:
            before[right] = left
            if (r := get(both + part[right])) is not None:
                push(heap, r << bits | left)
        if (left := before[left]) >= 0 and (r := get(part[left] + both)) is not None:
            push(heap, r << bits | left)
    return n - merges, [p for p in part if p is not None]


class PieceCounter:
    """Counts the tokens that a sentencepiece BPE model with byte fallback gives.

    A text is cut into units that no piece can straddle: before a space mark
    that follows something else, and around line breaks where no piece holds
    one.  Units repeat, so each worker remembers the counts of short ones.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = sp.normalize
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
        score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not special(i)}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in score.items()}  # pieces of one score share a rank; the leftmost goes first
        self.cut_spaces = not any(SPACE in p.lstrip(SPACE) for p in self.rank)
        self.cut_lines = not any("\n" in p for p in self.rank)
        probe = " a  b\néﬁ e\u0301Ａ①\u00a0x\u200b\t\u3000ſ½ "
        self.plain = sp.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.inside = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.unit = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.marked, self.bare, self.kernels = Memo(self.count_cut, SPACE), Memo(self.count_cut), Memo(self.count_unit)
        # pieces that a user has defined are matched before any merge; they have the score of none
        best = [p.replace(SPACE, " ") for p, s in score.items() if s >= 0 and len(p) > 1]
        for text in (probe, *(f"x{p}y" for p in best), *self.sample(score)):
            if self.count(text) != len(sp.encode(text)):
                raise ValueError(f"{path}: a model with rules that this counter doesn't know, as in {text!r}")

    @staticmethod
    def sample(score: dict[str, float], step: int = 97) -> list[str]:
        """Texts of some of the pieces, run together, to hold the counter against the library."""
        some = sorted(score)[::step]
        return ["".join(some[i : i + 20]).replace(SPACE, " ") for i in range(0, len(some), 20)]

    def count_unit(self, unit: str) -> int:
        """Tokens of one unit: a symbol that is no piece falls back to bytes."""
        n, left = merge_count(unit, self.rank)
        return n + sum(len(p.encode()) - 1 for p in left if p not in self.rank)

    def count_cut(self, unit: str) -> int:
        """The same, cut between neighbours that stand together in no piece."""
        inside, start, total = self.inside, 0, 0
        for i, pair in enumerate(map(str.__add__, unit, unit[1:]), 1):
            if pair not in inside:
                total += self.kernels[unit[start:i]]
                start = i
        return total + (self.kernels[unit[start:]] if start else self.count_unit(unit))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not (self.plain and self.cut_spaces and self.cut_lines):
            whole = self.normalize(text)
            units = self.unit.findall(whole) if self.cut_spaces else [whole]
            return sum(map(self.bare.__getitem__, units))
        lines = text.split("\n")
        total = len(lines) - 1  # each line break is one byte
        for k, line in enumerate(lines):
            if "  " in line or SPACE in line or line[:1] == " " or line[-1:] == " ":
                marked = line.replace(" ", SPACE)
                total += sum(map(self.bare.__getitem__, self.unit.findall(marked if k else SPACE + marked)))
                continue
            words = line.split(" ")
            if k:
                total += self.bare[words[0]] if words[0] else 0
                words = words[1:]
            elif not line:
                total += self.bare[SPACE]
                continue
            total += sum(map(self.marked.__getitem__, words))
        return total


class Memo(dict):
    """Counts of short units, worked out when first asked for."""

    def __init__(self, count, prefix: str = ""):
        self.work_out, self.prefix = count, prefix

    def __missing__(self, unit: str) -> int:
        n = self.work_out(self.prefix + unit)
        if len(unit) <= MEMO_CHARS:
            if len(self) >= MEMO_UNITS:
                self.clear()
            self[unit] = n
        return n


def counter_for(path: str) -> PieceCounter:
    cache = worker_cache()
    if ("pieces", path) not in cache:
        cache["pieces", path] = PieceCounter(path)
    return cache["pieces", path]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    One narrow pass without a shuffle; a batch of Arrow rows at a time is in
    memory.  Null texts count as empty: 0 bytes, 0 tokens.  Very long texts are
    counted whole, a unit at a time, so in time that grows as their length.
    Repeated rows give repeated results, an empty table an empty one; other
    columns are ignored, whatever they are named.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(model_path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py()
                n_bytes.append(len(text.encode()))
                n_tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    bounded_batches(docs.sparkSession)
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
