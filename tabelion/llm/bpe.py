"""Byte-level BPE by merge replay over the distinct words of a shard of the corpus.

Texts are cut into words by the tokenizer's pattern. Not each word is encoded
by itself: all distinct new words of a shard are laid end to end as byte tokens,
with an inverted index from adjacent token pairs, named by the token that they
merge into, to the positions where they stand. Merges are then applied in rank
order, each at all its positions from left to right; a merge touches its two
neighbours only, whose new pairs enter the index. Words that are encoded stay
in a bounded table of the task, so each distinct word is replayed about once a
task. Texts are encoded where they are read: no shuffle.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabelion.llm.common import ship
from tabelion.sources import fs

ship(__name__)

#: Characters of text whose new words are replayed together.
SHARD = 8 << 20
#: Characters of a text beyond which its words are cut out in parts.
LONG = 4 << 20
#: Bytes of distinct words and their tokens that a task remembers before it starts anew.
REMEMBERED = 64 << 20
#: Positions of a pair from which its merges are done as array operations.
MANY = 24


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (lines of base64 token, blank, rank) in the order of their ranks, which are 0, 1, 2, ..."""
    filesystem, where = fs.resolve(path)
    with filesystem.open_input_stream(where) as f:
        pairs = [line.split() for line in f.read().splitlines() if line]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if len(set(tokens)) < len(tokens) or len({t for t in tokens if len(t) == 1}) < 256:
        raise ValueError(f"{path} is not a list of distinct tokens with ranks 0, 1, 2, ... and all bytes")
    return tokens


class Replay:
    """Merge replay over any number of words, given the tokens in rank order."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        #: The rank that a pair of tokens (left << 32 | right) merges into, or -1; filled as pairs occur.
        self.merged: dict[int, int] = {}

    def rank_of(self, pair: int) -> int:
        rank = self.merged.get(pair)
        if rank is None:
            both = self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF]
            rank = self.merged[pair] = self.ranks.get(both, -1)
        return rank

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' tokens end to end, and where in them each word ends."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        token = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        inner = np.ones(len(token), bool)  # positions with a right neighbour in their word
        inner[ends[sizes > 0] - 1] = False
        at = np.flatnonzero(inner)
        right, left = np.full(len(token), -1, np.int64), np.full(len(token), -1, np.int64)
        right[at], left[at + 1] = at + 1, at

        # The index: each pair that merges to the positions of its left token, and the agenda of pairs by rank.
        index: dict[int, list[np.ndarray]] = {}
        single: dict[int, list[int]] = defaultdict(list)
        agenda: list[tuple[int, int]] = []

        def enter(pairs: np.ndarray, positions: np.ndarray) -> None:
            order = np.argsort(pairs, kind="stable")
            pairs, positions = pairs[order], positions[order]
            starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
            for pair, a, b in zip(pairs[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(pairs)], strict=True):
                rank = self.rank_of(pair)
                if rank >= 0:
                    if pair not in index and pair not in single:
                        heapq.heappush(agenda, (rank, pair))
                    index.setdefault(pair, []).append(positions[a:b])

        if len(at):
            enter(token[at] << 32 | token[at + 1], at)
        token_at, left_at, right_at = memoryview(token), memoryview(left), memoryview(right)
        while agenda:
            rank, pair = heapq.heappop(agenda)
            x, y = pair >> 32, pair & 0xFFFFFFFF
            places, few = index.pop(pair, []), single.pop(pair, [])
            if sum(map(len, places)) + len(few) < MANY:
                for p in sorted([*few, *(i for part in places for i in part.tolist())]):
                    q = right_at[p]
                    if token_at[p] != x or q < 0 or token_at[q] != y:
                        continue  # an earlier merge took one of the two
                    after, before = right_at[q], left_at[p]
                    token_at[p], token_at[q], right_at[p] = rank, -1, after
                    new = []
                    if after >= 0:
                        left_at[after] = p
                        new.append((rank << 32 | token_at[after], p))
                    if before >= 0:
                        new.append((token_at[before] << 32 | rank, before))
                    for pair_of, place in new:
                        its = self.rank_of(pair_of)
                        if its >= 0:
                            if pair_of not in index and pair_of not in single:
                                heapq.heappush(agenda, (its, pair_of))
                            single[pair_of].append(place)
                continue
            p = np.unique(np.concatenate([*places, np.array(few, np.int64)]))
            p = p[(token[p] == x) & (right[p] >= 0)]
            p = p[token[right[p]] == y]
            if x == y and len(p):  # in a row of equal tokens every other position merges, from the left
                first = np.r_[True, p[1:] != right[p[:-1]]]
                nth = np.arange(len(p))
                p = p[(nth - np.maximum.accumulate(np.where(first, nth, 0))) % 2 == 0]
            q = right[p]
            after = right[q]
            token[p], token[q], right[p] = rank, -1, after
            has = after >= 0
            left[after[has]] = p[has]
            before = left[p]
            had = before >= 0
            pairs = np.concatenate([rank << 32 | token[after[has]], token[before[had]] << 32 | rank])
            if len(pairs):
                enter(pairs, np.concatenate([p[has], before[had]]))
        alive = token >= 0
        return token[alive].astype(np.int32), np.r_[0, np.cumsum(alive)][ends]


def _encode(tokens, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern)
        replay = number = table = None

        def numbers_of(text: str) -> list[np.ndarray]:
            if len(text) <= LONG:
                return [np.fromiter(map(number.__getitem__, cut.findall(text)), np.int64)]
            found, parts = cut.finditer(text), []
            while True:
                parts.append(np.fromiter((number[m[0]] for m in islice(found, LONG // 8)), np.int64))
                if not len(parts[-1]):
                    return parts

        for batch in batches:
            ids, texts, at = batch.column("id"), batch.column("text"), 0
            while at < len(ids):
                if number is None:
                    replay, number = Replay(tokens.value), defaultdict(count().__next__)
                    table = pa.array([], pa.list_(pa.int32()))  # each numbered word's tokens
                start, size, parts, ends = at, 0, [], [0]
                while at < len(ids) and size < SHARD:
                    text = texts[at].as_py()
                    parts += (mine := numbers_of(text))
                    ends.append(ends[-1] + sum(map(len, mine)))
                    size += len(text)
                    at += 1
                new = [w.encode() for w in islice(number, len(table), None)]
                if new:
                    flat, upto = replay.encode(new)
                    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, upto].astype(np.int32)), pa.array(flat))
                    table = pa.concat_arrays([table, lists])
                spelt = table.take(pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))
                offsets = spelt.offsets.to_numpy()[np.array(ends)]
                lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), spelt.flatten())
                yield pa.RecordBatch.from_arrays([ids.slice(start, at - start), lists], names=["id", "ids"])
                if table.nbytes + 150 * len(number) > REMEMBERED:
                    number = None

    return run


def encode(docs: DataFrame, tokens: list[bytes], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (the text's tokens) for each row; special tokens are ordinary text.

    ``tokens`` are a vocabulary in rank order (``load_ranks``), which the tasks
    are sent whole; ``pattern`` cuts texts into words, as ``regex`` reads it.
    A null text is empty; an empty text has no tokens; a null id stays one;
    repeated rows are encoded each; an empty table gives no rows. Other columns
    are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tokens)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_encode(sent, pattern), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def _decode(tokens, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = pa.array(tokens.value, pa.large_binary())
        for batch in batches:
            lists = batch.column(position)
            flat = spelt.take(lists.flatten())
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            _, offsets, data = flat.buffers()
            starts = np.frombuffer(offsets, np.int64, len(flat) + 1, flat.offset * 8)
            ends = starts[np.r_[0, np.cumsum(sizes)]]
            whole = memoryview(data) if data else b""
            rows = [bytes(whole[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            column = pa.array(rows, pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*map(str, range(batch.num_columns)), "bytes"])

    return run


def decode(encoded: DataFrame, tokens: list[bytes], ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """``encoded`` plus ``out``, the bytes that the tokens of ``ids_col`` stand for (null for null).

    Bytes, not text: a list of tokens may end within a character.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(tokens)
    at = encoded.columns.index(ids_col)
    numbered = encoded.toDF(*map(str, range(len(encoded.columns))))
    schema = numbered.select("*", F.lit(None).cast("binary").alias("bytes")).schema
    return numbered.mapInArrow(_decode(sent, at), schema).toDF(*encoded.columns, out)
