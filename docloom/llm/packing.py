"""Vector best-fit packing of documents into training sequences.

A document is its token ids and an end id; one that is longer than a sequence is cut into
full pieces behind a first, maybe shorter one. A piece needs three things of a sequence: its
tokens, one document, and the cost of attention over it, its length squared. Pieces are taken
in falling length; each goes to the open sequence that it fits under every capacity and that
is best by the weighted norm of what would be left (``norm``), or by the weighted dot product
of what is left and what is needed (``dot``), or else to a new sequence.

What a piece needs follows from its length, so the packing of any number of pieces follows
from how many there are of each length: at most as many numbers as a sequence has tokens.
From these the driver packs classes of equal sequences at once, just as one by one would end.
Under ``norm`` a chosen sequence stays the best until it holds no more of that length, so
whole classes take their fill. A length splits at most two classes and opens at most two;
a sequence holds at most sqrt(2 x tokens) different lengths; that bounds the plan, whatever
the number of documents (about 500,000 rows of 48 bytes at 2,048 tokens).

Pieces are numbered within each length by the task that cut them, and tasks by running sums
of their counts; a piece then finds its sequence and place in the plan by that number. Texts
aren't shuffled, and no length, however common, meets in one task.

Edge cases: NULL and empty texts are the end id alone; special tokens written in a text
become their ids, as the library does by default; a NULL doc_id is kept; repeated rows
are documents of their own; equal lengths are told apart by task and order; an empty table
gives no rows.
"""

from __future__ import annotations

import gc
import math
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.arrays import arrow_batches, slices
from docloom.llm.bpe import read_text
from docloom.session import materialize

TOKENS, END_ID = 2048, 0
#: Chunks one worker remembers, twice (about 140 MB each); rows of a plan that tasks may be sent.
CACHE_CHUNKS, PLAN_ROWS = 700_000, 2_000_000

#: A space that a chunk can't start with: white space or nothing is behind it.
LOOSE = re.compile(r" (?=\s|$)")
#: Where a chunk may start otherwise: at white space with a sign behind it.
BORDER = re.compile(r"(?=[ \t-\r][^\s])")


# ------------------------------------------------------------- encoding -----
class ChunkEncoder:
    """Token ids of texts by a byte-level BPE of the tokenizers library, each distinct chunk encoded once.

    The tokenizer cuts in front of white space that has a sign behind it, whatever stands
    before, so chunks from one such place to the next are encoded as in the whole text.
    Where special tokens are written, texts go to the library whole: the end of a part
    joins white space differently.
    """

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(source)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.size = np.zeros(self.library.get_vocab_size(), np.int64)  # bytes that a token stands for: one letter each
        for token, n in self.library.get_vocab().items():
            self.size[n] = len(token)
        # chunks without their leading space; chunks as they are
        self.spaced: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.plain: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def spaced_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that start with white space and a sign: one long text for all, cut where the bytes of its tokens say."""
        text = "".join(chunks)
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.size[ids])
        wanted = np.cumsum(np.fromiter(map(len, map(str.encode, chunks)), np.int64, len(chunks)))
        stops = np.searchsorted(ends, wanted) + 1
        if not len(ids) or stops[-1] != len(ids) or not np.array_equal(ends[stops - 1], wanted):
            return self.ids(chunks)
        raw, stops = ids.tobytes(), [0, *(stops * 4).tolist()]
        return [raw[a:b] for a, b in zip(stops[:-1], stops[1:], strict=True)]

    def _learn(self, known: tuple[dict[str, bytes], dict[str, bytes]], lists: list[list[str]], lead: str) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Encode what isn't known of these chunks. A full memory becomes the older one, so that common chunks outlive it."""
        young, old = known
        if len(young) > CACHE_CHUNKS:
            young, old = {}, young
        new = list(set().union(*lists).difference(young))  # a look-up for each of these chunks; ``-`` walks all that is known
        if old:
            young.update({c: old[c] for c in new if c in old})
            new = [c for c in new if c not in young]
        for low in range(0, len(new), 20_000):
            part = new[low : low + 20_000]
            young.update(zip(part, self.spaced_ids([lead + c for c in part]) if lead else self.ids(part), strict=True))
        return young, old

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each text."""
        heads, rests, whole = [], [], []
        for text in texts:
            text = text or ""
            if any(s in text for s in self.special):
                whole.append(text)
                heads.append(None)
                rests.append([])
            elif LOOSE.search(text):
                heads.append(BORDER.split(text))
                rests.append([])
            else:
                first, *rest = text.split(" ")
                heads.append([first] if first else [])
                rests.append(rest)
        self.spaced = self._learn(self.spaced, rests, " ")
        self.plain = self._learn(self.plain, [h for h in heads if h], "")
        spaced, plain, others = self.spaced[0].__getitem__, self.plain[0].__getitem__, iter(self.ids(whole))
        return [next(others) if head is None else b"".join([*map(plain, head), *map(spaced, rest)]) for head, rest in zip(heads, rests, strict=True)]


# ------------------------------------------------------------- the plan -----
@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how much each of it weighs in the choice."""

    tokens: int = TOKENS
    docs: int = TOKENS
    attention: int = TOKENS * TOKENS
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"

    @property
    def longest(self) -> int:
        """Tokens that a piece may have."""
        return min(self.tokens, math.isqrt(self.attention))

    def needs(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], np.int64)

    @property
    def whole(self) -> np.ndarray:
        return np.array([self.tokens, self.docs, self.attention], np.int64)


#: Columns of a plan: pieces of ``length`` numbered from ``first``, ``per`` of them in each of ``bins`` sequences from ``bin`` on, behind ``used`` tokens.
PLAN = ("length", "first", "per", "bins", "bin", "used")


def plan(counts: dict[int, int], capacity: Capacity = Capacity()) -> np.ndarray:
    """Rows (PLAN) that place ``counts[length]`` pieces of each length by best fit, longest first."""
    if capacity.rule not in ("norm", "dot") or capacity.longest < 1 or capacity.docs < 1:
        raise ValueError(f"no packing under {capacity}")
    scale = np.array(capacity.weights) / capacity.whole.astype(float) ** 2
    left = np.zeros((0, 3), np.int64)  # of each class of equal sequences
    bins, start = np.zeros(0, np.int64), np.zeros(0, np.int64)
    out: list[tuple[int, ...]] = []
    opened = 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        todo, need, placed = counts[length], capacity.needs(length), 0
        while todo:
            room = (left >= need).all(axis=1)
            if room.any():
                score = ((left - need) ** 2 if capacity.rule == "norm" else -(left * need)) @ scale
                k = int(np.where(room, score, np.inf).argmin())
                most = int((left[k] // need).min()) if capacity.rule == "norm" else 1
                at, have, n_bins = int(start[k]), left[k].copy(), int(bins[k])
            else:
                k, at, have = None, opened, capacity.whole
                most = int((have // need).min())
                n_bins = opened = -(-todo // most)
                opened += at
            full = min(todo // most, n_bins)
            rest = min(todo - full * most, most - 1) if full < n_bins else 0
            new = []
            for taken, many, low in ((most, full, at), (rest, 1, at + full)):
                if taken and many:
                    out.append((length, placed, taken, many, low, capacity.tokens - int(have[0])))
                    new.append((have - taken * need, many, low))
                    placed += taken * many
                    todo -= taken * many
            if k is not None:
                used = full + (rest > 0)
                start[k] += used
                bins[k] -= used
            left = np.concatenate([left, *(x[0][None] for x in new)])
            bins, start = np.append(bins, [x[1] for x in new]), np.append(start, [x[2] for x in new])
            open_still = (bins > 0) & (left > 0).all(axis=1)
            left, bins, start = left[open_still], bins[open_still], start[open_still]
    return np.array(out, np.int64).reshape(-1, len(PLAN))


# ------------------------------------------------------------- the jobs -----
def pieces(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, part, nth[, ids]): the pieces, each with its number among those of its length in its task."""
    shared = docs.sparkSession.sparkContext.broadcast({"source": read_text(tokenizer)})
    arrow_batches(docs)
    longest, end = capacity.longest, struct.pack("<I", end_id)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.set_threshold(200_000, 50, 50)  # the memories hold no cycles
        seen, part, held = [0] * (longest + 1), TaskContext.get().partitionId(), shared.value
        for batch in batches:
            for some in slices(batch):
                # the tasks of one worker share what it was sent, and so its encoder and what that knows
                encoder = held["encoder"] = held.get("encoder") or ChunkEncoder(held["source"])
                row, out = [], []
                for k, raw in enumerate(encoder.encode(some.column("text").to_pylist())):
                    raw += end
                    total = len(raw) // 4
                    stops = range((total - 1) % longest + 1, total + 1, longest)
                    begin = 0
                    for n, stop in enumerate(stops):
                        own = raw[4 * begin : 4 * stop]
                        row.append(k)
                        out.append((n, begin, stop - begin, zlib.crc32(own), part, seen[stop - begin]) + ((np.frombuffer(own, "<i4"),) if ids else ()))
                        seen[stop - begin] += 1
                        begin = stop
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column("doc_id").take(pa.array(row)), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def placed(cut: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset`` in place of their numbers."""
    spark = cut.sparkSession
    counts = materialize(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "piece-numbers")
    of_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row per length at most
    rows = plan(of_length, capacity)
    if len(rows) > PLAN_ROWS:
        raise ValueError(f"a plan of {len(rows)} rows; ask for shorter sequences")
    sent = spark.sparkContext.broadcast(rows[np.lexsort((rows[:, 1], rows[:, 0]))])
    kept = [c for c in cut.columns if c not in ("part", "nth")]
    schema = cut.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, per, _, start, used = sent.value.T
        key = (length << 44) + first
        for batch in batches:
            own, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            k = np.searchsorted(key, (own << 44) + number, side="right") - 1
            nth = number - first[k]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(start[k] + nth // per[k]), pa.array(used[k] + nth % per[k] * own)], names=schema.names)

    numbered = cut.join(counts.select("length", "part", "before"), ["length", "part"]).select(*kept, (F.col("before") + F.col("nth")).alias("number"))
    return numbered.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset): where every piece of every document lies."""
    return placed(materialize(pieces(docs, tokenizer, capacity, end_id, ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, n_docs, ids) of what ``pack(..., ids=True)`` returns; a sequence is no longer than its capacity."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    found = packed.groupBy("sequence_id").agg(held.alias("held"))
    return found.select("sequence_id", F.size("held").alias("n_docs"), F.flatten(F.transform("held", lambda x: x["ids"])).alias("ids"))
