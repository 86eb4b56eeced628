"""Periodic runs of words by maximal pairs over a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q, long enough (``LEAST`` words and
``EXPONENT`` periods), that no neighbouring word extends. With the stretch from s to e,
the occurrences s and s + q of its first e - s - q words are a maximal pair: the words
behind them differ, and so do the words in front. The other way round, a maximal pair of
depth l at distance q whose l + q meets the length constraints is such a stretch, so
nothing has to be extended: of the pairs of one stretch the nearest has its period.

The suffixes of all texts of a slice are sorted together by prefix doubling, the text
first, so that no two texts meet; suffixes that are alone drop out, and usually few
outlive the first rounds. Ranks of every round give the common prefixes. A stack builds
the LCP-interval tree bottom up; each node holds its occurrences in text order with the
class of the word on their left. Where children join, each place of the smaller list meets
its neighbours in the larger one. A word run's first pair lies side by side in its node
(an occurrence in between would give a smaller period), so neighbours are enough, and a
stretch of n words needs no n^2 pairs. Pairs of one left class aren't maximal.

Rows stay in their tasks; memory follows a slice of about 4 MB, or its longest text.

Edge cases: NULL, empty and blank texts have no words, no runs and the empty collapsed
text; of runs of equal length the first is the longest one, then that of the smaller
period; repeated rows give equal results each; an empty table gives no rows; added columns
replace columns of the same name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as st

from docloom.llm.arrays import by_text

#: Fewest words of a run, and fewest periods (3 or more).
LEAST, EXPONENT = 6, 4

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[bytes]:
    """What lies between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


# --------------------------------------------------------- suffix order -----
def _starts(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _begin(starts: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


class Suffixes:
    """Suffixes of many word sequences that share ``depth`` words with another of their sequence (and some that don't), in order, and their common prefixes."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, depth: int) -> None:
        n = len(codes)
        # rounds whose ranks are kept for all places: their spans are up to depth; later ones keep those of the suffixes still in question
        self.rounds = depth.bit_length()
        self.of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.end = first[1:]
        key = self.of * (int(codes.max()) + 1 if n else 1) + codes
        order = np.argsort(key, kind="stable")
        starts = _starts(key[order])
        rank = np.empty(n, np.int64)
        rank[order] = _begin(starts)
        self.levels = [rank.copy()]
        active, span = order[~(starts & np.append(starts[1:], True))], 1
        self.place = np.full(n, -1, np.int64)  # of a suffix in the later rounds' ranks
        kept = active
        while len(active) or len(self.levels) < self.rounds:
            if len(self.levels) == self.rounds:
                kept = np.sort(active)
                self.place[kept] = np.arange(len(kept))
            after = active + span
            behind = np.where(after < self.end[self.of[active]], rank[np.minimum(after, n - 1)] + 1, 0) if n else after
            both = rank[active] * (n + 1) + behind
            order = np.argsort(both, kind="stable")
            active, both = active[order], both[order]
            before, starts = rank[active], _starts(both)
            rank[active] = before + _begin(starts) - _begin(_starts(before))
            span *= 2
            self.levels.append(rank.copy() if len(self.levels) < self.rounds else rank[kept])
            active = active[~(starts & np.append(starts[1:], True))]
            if len(self.levels) == self.rounds:
                kept = active
        self.order = kept[np.argsort(rank[kept], kind="stable")]
        self.common = self._common(self.order)

    def _common(self, order: np.ndarray) -> np.ndarray:
        """Words that each suffix shares with the one before it."""
        i, j = order[1:], order[:-1]
        shared = np.zeros(len(i), np.int64)
        end_i, end_j = self.end[self.of[i]], self.end[self.of[j]]
        for level in range(len(self.levels) - 1, -1, -1):
            at = np.flatnonzero((i + shared < end_i) & (j + shared < end_j))
            a, b = i[at] + shared[at], j[at] + shared[at]
            if level >= self.rounds:
                a, b = self.place[a], self.place[b]
                known = (a >= 0) & (b >= 0)
                at, a, b = at[known], a[known], b[known]
            rank = self.levels[level]
            shared[at[rank[a] == rank[b]]] += 1 << level
        return np.concatenate([[0], shared])[: len(order)]


# ------------------------------------------------------------- the tree -----
def least_depth(least: int, exponent: int) -> int:
    """Fewest words that the pair of a run has in common."""
    return min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))


def subtrees(suffixes: Suffixes, depth: int) -> Iterator[tuple[list[int], list[int]]]:
    """Suffixes that share ``depth`` words, with their common prefixes; without those whose places all lie too far apart."""
    order, common = suffixes.order, suffixes.common
    if not len(order):
        return
    starts = np.flatnonzero(common < depth)
    sizes = np.diff(np.append(starts, len(order)))
    tree = np.repeat(np.arange(len(starts)), sizes)
    by_place = np.lexsort((order, tree))
    gaps = np.diff(order[by_place], prepend=0)
    gaps[starts] = np.iinfo(np.int64).max  # no gap in front of a tree's first place
    inner = common.copy()
    inner[starts] = 0
    hopeful = np.flatnonzero((sizes > 1) & (np.minimum.reduceat(gaps, starts) <= np.maximum.reduceat(inner, starts)))
    for k in hopeful.tolist():
        low, high = int(starts[k]), int(starts[k] + sizes[k])
        yield order[low:high].tolist(), common[low:high].tolist()


def maximal_pairs(order: list[int], common: list[int], left: Callable[[int], int], least: int, exponent: int) -> Iterator[Run]:
    """(start, length, distance) of the maximal pairs of neighbours that meet the length constraints, from one subtree."""

    def joined(a: list[int], b: list[int], depth: int) -> Iterator[Run]:
        """Pairs between two children of a node; afterwards ``b``, the larger one, holds both."""
        for x in a:
            k = bisect_left(b, x)
            for i, j in ((b[k - 1], x) if k else (x, x), (x, b[k]) if k < len(b) else (x, x)):
                q = j - i
                if q and (exponent - 1) * q <= depth and depth + q >= least and left(i) != left(j):
                    yield i, depth + q, q
        if len(a) * 16 < len(b):
            for x in a:
                b.insert(bisect_left(b, x), x)
        else:
            b += a
            b.sort()

    def join(x: list[int], y: list[int], depth: int) -> tuple[list[int], list[Run]]:
        a, b = (x, y) if len(x) <= len(y) else (y, x)
        return b, list(joined(a, b, depth))

    stack: list[tuple[int, list[int]]] = []
    held = [order[0]]
    for place, depth in zip([*order[1:], None], [*common[1:], 0], strict=True):
        while stack and stack[-1][0] >= depth:
            above, places = stack.pop()
            held, found = join(places, held, above)
            yield from found
        if place is None:
            break
        stack.append((depth, held))
        held = [place]


def runs_of(texts: list[list[bytes]], least: int = LEAST, exponent: int = EXPONENT) -> list[list[Run]]:
    """(start, length, period) of every run of each text, by start, then period."""
    number: dict[bytes, int] = {}
    sizes = [len(words) for words in texts]
    first = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    for words in texts:
        for word in set(words).difference(number):
            number[word] = len(number)
    codes = np.empty(int(first[-1]), np.int64)
    for k, words in enumerate(texts):
        codes[first[k] : first[k + 1]] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    depth = least_depth(least, exponent)
    suffixes = Suffixes(codes, first, depth)
    start_of, text_of = first.tolist(), suffixes.of

    def left(place: int) -> int:
        return -1 if place == start_of[text_of[place]] else int(codes[place - 1])

    periods: dict[tuple[int, int], int] = {}
    for order, common in subtrees(suffixes, depth):
        for start, length, period in maximal_pairs(order, common, left, least, exponent):
            known = periods.get((start, length))
            if known is None or period < known:
                periods[start, length] = period
    out: list[list[Run]] = [[] for _ in texts]
    for (start, length), period in periods.items():
        k = int(text_of[start])
        out[k].append((start - start_of[k], length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that lie in a run after its first period."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        start, length, period = np.array(runs, np.int64).T
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, runs: bool = True, text: bool = False, digests: bool = False,
                  rewrite: Callable[[list[bytes], int | None], list[bytes]] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add ``n_runs`` and the longest run (``start``, ``length``, ``period``); as asked ``runs`` (all of them), ``collapsed`` (the text without repeats) and digests of both.

    ``rewrite(words, doc_id)`` may change a document's words first.
    """
    if exponent < 3:
        raise ValueError("a run's pair of neighbours is found for three periods or more")
    added: list[tuple[str, st.DataType]] = [("n_runs", st.LongType()), *((c, st.LongType()) for c in ("start", "length", "period"))]
    run_type = st.StructType([st.StructField(c, st.LongType()) for c in ("start", "length", "period")])
    added += [("runs", st.ArrayType(run_type))] * runs + [("collapsed", st.StringType())] * text
    added += [("runs_sha256", st.StringType()), ("collapsed_sha256", st.StringType())] * digests
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {n for n, _ in added}]
    arrow_runs = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            if rewrite:
                texts = [rewrite(words, doc_id) for words, doc_id in zip(texts, batch.column("doc_id").to_pylist(), strict=True)]
            found = runs_of(texts, least, exponent)
            longest = [min(r, key=lambda x: (-x[1], x[0], x[2])) if r else (None, None, None) for r in found]
            out = [pa.array([len(r) for r in found], pa.int64()), *(pa.array([x[k] for x in longest], pa.int64()) for k in range(3))]
            if runs:
                out.append(pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in found], arrow_runs))
            short = [collapsed(w, r) for w, r in zip(texts, found, strict=True)] if text or digests else []
            if text:
                out.append(pa.array([s.decode("utf-8", "surrogatepass") for s in short], pa.string()))
            if digests:
                told = ["".join(f"{a},{b},{c}\n" for a, b, c in r) for r in found]
                out += [pa.array([hashlib.sha256(t.encode()).hexdigest() for t in told]), pa.array([hashlib.sha256(s).hexdigest() for s in short])]
            return out

        return add

    return by_text(docs, work, added, keep, ("doc_id",) if rewrite else ())
