"""N-best SentencePiece segmentations and exact decoding.

A text is a lattice of pieces; a path from its begin to its end is a segmentation, and its cost the sum of its pieces'
costs.  The forward Viterbi pass gives the cheapest cost to every place.  The search for the N best runs backward from
the end as A*, with those costs as an exact estimate of what is left: paths come out of the queue in order of cost, and
nothing is expanded that isn't on one of them.

Every path passes the places that no piece spans: before a run of spaces, and between letters or digits and other
characters, but for the few pairs that some piece of the vocabulary joins (found when the model is opened).  There the
lattice falls into units; units are searched once and kept, and the N smallest sums over a text's units are the N best
of the text.

Costs are negative log probabilities in whole millionths, so sums are exact.  A unigram model's own scores are used; a
BPE model has merge ranks only, and rank r costs log(r + 2).  Characters without a piece cost a fixed sum for each UTF-8
byte and are written as byte pieces.  Spaces become U+2581 in pieces; a U+2581 in the text is written as bytes, so
decoding gives back the text, whatever it holds.
"""
from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from bisect import insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import text_column

UNIT = 1_000_000
NONE = 1 << 62
CACHE = 1 << 17
#: Units that are searched together: this many, of at most LONG characters, all among the vocabulary's COLUMNS commonest.
TOGETHER, LONG, COLUMNS = 1 << 13, 32, 255
#: Characters of texts whose units are looked up together, about.
GROUP = 1 << 18
_UNITS = re.compile(r" *[^\W_]+| *(?:[^\w ]|_)+| +")


class Pieces:
    """A vocabulary with costs; ``open`` keeps one a Python worker, file and N."""

    _open: dict[tuple, "Pieces"] = {}

    def __init__(self, path: str, n: int):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = [sp.get_score(i) for i in plain]
        ranks = len(scores) > 1 and all(s in (-k, -1e9) for k, s in enumerate(scores))  # -1e9: never merged
        costs = [math.log(k + 2) if ranks else -s for k, s in enumerate(scores)]
        piece = {i: sp.id_to_piece(i).replace("▁", " ") for i in plain}
        bytes_ = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self._set(piece, dict(zip(plain, costs)), bytes_, n)

    def _set(self, piece: dict[int, str], cost: dict[int, float], bytes_: dict[int, int], n: int) -> None:
        self.n = n
        self.cost = {p: (round(cost[i] * UNIT), i) for i, p in sorted(piece.items(), reverse=True)}
        self.begins = {p[:k]: None for p in self.cost for k in range(1, len(p))} | self.cost  # what pieces begin with, too
        self.byte_id, self.byte_cost = bytes_, round((max(cost.values(), default=0.0) + 10) * UNIT)
        self.raw = {i: p.encode() for i, p in piece.items()} | {i: bytes([b]) for b, i in bytes_.items()}
        # pairs of characters that a piece joins across two units; such units stay together
        self.joins = {a[-1] + b[0] for p in piece.values() for u in [_UNITS.findall(p)] for a, b in zip(u, u[1:])}
        self._table()
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.chosen: dict[str, list] = {}

    def _table(self) -> None:
        """The vocabulary as a trie in arrays.  State 0 is dead, 1 the root; states that nothing follows come last and share
        a row.  Column 0 stands for other characters."""
        common = Counter(c for p in self.cost for c in p)
        alone = [c for c, _ in common.most_common() if c in self.cost][:COLUMNS]
        self.column = np.zeros(0x110000, np.uint8)
        self.column[[ord(c) for c in alone]] = range(1, len(alone) + 1)
        inner = {"": None} | {p[:-1]: None for p in self.begins}
        state = {p: k for k, p in enumerate([*inner, *(p for p in self.begins if p not in inner)], 1)}
        self.leaves = len(inner) + 1
        self.follow = np.zeros((self.leaves + 1, COLUMNS + 1), np.min_scalar_type(len(state)))
        self.end_cost, self.end_id = np.full(len(state) + 1, NONE), np.zeros(len(state) + 1, np.int32)
        for p, k in state.items():
            if p:
                self.follow[state[p[:-1]], self.column[ord(p[-1])]] = k
                if got := self.begins[p]:
                    self.end_cost[k], self.end_id[k] = got
        self.follow[:, 0] = 0

    @classmethod
    def open(cls, path: str, n: int) -> "Pieces":
        if (path, n) not in cls._open:
            cls._open[path, n] = cls(path, n)
        return cls._open[path, n]

    def lattice(self, unit: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """For each place, the pieces that end there: (begin, cost, ids)."""
        into: list[list[tuple[int, int, tuple[int, ...]]]] = [[] for _ in range(len(unit) + 1)]
        begins, cost, n = self.begins, self.cost, len(unit)
        for i in range(n):
            for j in range(i + 1, n + 1):
                piece = unit[i:j]
                if piece not in begins:
                    break
                if got := begins[piece]:
                    into[j].append((i, got[0], (got[1],)))
            if unit[i] not in cost:
                raw = unit[i].encode("utf-8", "surrogatepass")
                into[i + 1].append((i, self.byte_cost * len(raw), tuple(self.byte_id[b] for b in raw)))
        return into

    def n_best(self, unit: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The ``n`` cheapest (cost, ids), cheapest first."""
        into = self.lattice(unit)
        ahead = [0] * len(into)  # forward Viterbi: cheapest cost from the begin
        for j in range(1, len(into)):
            ahead[j] = min([ahead[i] + c for i, c, _ in into[j]])
        out, room, order = [], n, 1
        queue: list[tuple] = [(ahead[-1], 0, len(unit), 0, None)]
        while queue and room:
            total, _, j, behind, path = queue.pop(0)
            if not j:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                out.append((total, tuple(ids)))
                room -= 1
                continue
            for i, c, ids_ in into[j]:
                t = ahead[i] + c + behind
                # estimates are exact, so each entry stands for a path of that cost: no more than ``room`` are needed
                if len(queue) < room or t < queue[-1][0]:
                    insort(queue, (t, order, i, c + behind, (ids_, path)))
                    order += 1
                    del queue[room:]
        return out

    def units(self, text: str) -> list[str]:
        text = " " + text if text else ""
        units = _UNITS.findall(text)
        if any(j in text for j in self.joins):
            whole: list[str] = []
            for u in units:
                if whole and whole[-1][-1] + u[0] in self.joins:
                    whole[-1] += u
                else:
                    whole.append(u)
            return whole
        return units

    def best(self, unit: str) -> tuple[int, tuple[int, ...], int]:
        """Cost and ids of the cheapest segmentation, and how much more the second one costs (-1: there is none).

        The second one leaves the first, seen from the end, at some place by another piece; before that it is the
        cheapest: the first two results of the backward search, without a queue."""
        get, n = self.begins.get, len(unit)
        none = NONE
        first, second, back, ids = [none] * (n + 1), [none] * (n + 1), [0] * (n + 1), [None] * (n + 1)
        first[0] = 0
        for i in range(n):
            before = first[i]
            if before == none:
                continue
            for j in range(i + 1, n + 1):
                got = get(unit[i:j], 0)
                if got:
                    cost = before + got[0]
                    if cost < first[j]:  # equal costs: the earlier begin
                        second[j], first[j], back[j], ids[j] = first[j], cost, i, got[1]
                    elif cost < second[j]:
                        second[j] = cost
                elif got == 0:
                    break
            if unit[i] not in self.cost:
                raw, j = unit[i].encode("utf-8", "surrogatepass"), i + 1
                cost = before + self.byte_cost * len(raw)
                if cost < first[j]:
                    second[j], first[j], back[j], ids[j] = first[j], cost, i, tuple(self.byte_id[x] for x in raw)
                elif cost < second[j]:
                    second[j] = cost
        j, path, gap = n, [], none
        while j:
            more = second[j] - first[j]
            if more < gap and second[j] < none:
                gap = more
            path.append(ids[j])
            j = back[j]
        path.reverse()
        if any(type(x) is tuple for x in path):
            path = [k for x in path for k in (x if type(x) is tuple else (x,))]
        return first[n], tuple(path), gap if gap < none else -1

    def best_of(self, units: list[str]) -> Iterator[tuple[str, tuple[int, bytes, int, int]]]:
        """``best`` of many units of common characters, with the ids as bytes and their number: the same passes, each step
        taken for all units at once."""
        units = sorted(units, key=len, reverse=True)  # those that reach a place come first
        sizes, many = np.fromiter(map(len, units), np.int64, len(units)), len(units)
        width, rows, begin = len(units[0]), np.arange(many), np.cumsum(sizes) - sizes
        reach = [int(np.count_nonzero(sizes >= j)) for j in range(width + 1)]
        columns = self._columns(units)
        chars = [columns[begin[:reach[j + 1]] + j] for j in range(width)]
        first, second = np.full((width + 1, many), NONE), np.full((width + 1, many), NONE)
        back, last = np.zeros((width + 1, many), np.int16), np.zeros((width + 1, many), np.int32)
        first[0] = 0
        for i in range(width):
            state = np.ones(many, self.follow.dtype)
            for j in range(i + 1, width + 1):
                state = self.follow[np.minimum(state[:reach[j]], self.leaves), chars[j - 1]]
                if not state.any():
                    break
                cost, least, other = first[i, :reach[j]] + self.end_cost[state], first[j, :reach[j]], second[j, :reach[j]]
                better = np.flatnonzero(cost < least)  # equal costs: the earlier begin
                np.minimum(other, np.maximum(least, cost), out=other)
                least[better] = cost[better]
                back[j, better], last[j, better] = i, self.end_id[state[better]]
        whole, gap, path, n = first[sizes, rows], np.full(many, NONE), np.zeros((many, width), np.int32), np.zeros(many, np.int64)
        place = sizes
        while len(rows):
            n[rows] += 1
            more = second[place, rows]
            gap[rows] = np.minimum(gap[rows], np.where(more < NONE, more - first[place, rows], NONE))
            path[rows, width - n[rows]] = last[place, rows]
            place = back[place, rows]
            rows, place = rows[place > 0], place[place > 0]
        gap[gap == NONE] = -1
        ids, step = path.tobytes(), path.itemsize
        ends = (np.arange(1, many + 1) * width * step).tolist()
        for unit, cost, extra, size, end in zip(units, whole.tolist(), gap.tolist(), n.tolist(), ends):
            yield unit, (cost, ids[end - size * step:end], extra, size)

    def _columns(self, units: list[str]) -> np.ndarray:
        return self.column[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _learn(self, units: Iterable[str]) -> None:
        """Cost, ids, distance to the second choice and number of ids of each unit.  Units of the last generation of
        the cache move on to the new one, so frequent ones stay."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        new = []
        for u in set(units).difference(self.known):
            if (old := self.older.get(u)) is None:
                new.append(u)
            else:
                self.known[u] = old
        if not new:
            return
        new.sort(key=len)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        able = (np.minimum.reduceat(self._columns(new), np.cumsum(sizes) - sizes) > 0) & (sizes <= LONG)
        for k in np.flatnonzero(~able).tolist():
            cost, ids, gap = self.best(new[k])
            self.known[new[k]] = cost, array("i", ids).tobytes(), gap, len(ids)
        many = [new[k] for k in np.flatnonzero(able).tolist()]
        for k in range(0, len(many), TOGETHER):
            self.known.update(self.best_of(many[k:k + TOGETHER]))

    def choices(self, unit: str) -> list[tuple[int, tuple[int, ...]]]:
        """The N best of a unit, that of ``best`` first."""
        if (found := self.chosen.get(unit)) is None:
            cost, ids, *_ = self.best(unit)
            if len(self.chosen) > CACHE // 8:
                self.chosen.clear()
            found = self.chosen[unit] = [(cost, ids), *(x for x in self.n_best(unit, self.n) if x[1] != ids)][:self.n]
        return found

    def segment(self, text: str | None) -> tuple[int, np.ndarray, list[tuple[int, list[tuple[int, int, tuple[int, ...]]]]]]:
        """Cost and ids of the best segmentation of a text, and the others of the N best: cost and edits to the best
        one's ids as (place, ids to drop, ids to put)."""
        return next(self.segments([text]))

    def segments(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, list[tuple[int, list[tuple[int, int, tuple[int, ...]]]]]]]:
        """``segment`` of each text; new units of texts that follow each other are searched together."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(self.units(text or ""))
            size += len(text or "")
            if size >= GROUP:
                self._learn(u for units in group for u in units)
                yield from map(self._segment, group)
                group, size = [], 0
        self._learn(u for units in group for u in units)
        yield from map(self._segment, group)

    def _segment(self, units: list[str]) -> tuple[int, np.ndarray, list[tuple[int, list[tuple[int, int, tuple[int, ...]]]]]]:
        if not units:
            return 0, np.empty(0, np.int32), []
        costs, ids, second, sizes = zip(*map(self.known.__getitem__, units))
        cost, whole = sum(costs), np.frombuffer(b"".join(ids), dtype=np.int32)
        # a deviation outside the N - 1 units with the cheapest second choice can't be among the N best
        second = np.array(second, dtype=np.int64)
        able = np.flatnonzero(second >= 0)
        if self.n < 2 or not len(able):
            return cost, whole, []
        few = np.sort(able[np.argsort(second[able], kind="stable")[:self.n - 1]])
        start = dict(zip(few.tolist(), (np.cumsum(sizes) - sizes)[few].tolist()))
        ways: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
        best = {u: self.choices(units[u]) for u in start}
        for u in start:
            ways = heapq.nsmallest(self.n, [(extra + c - costs[u], path + ((u, k),) if k else path) for extra, path in ways for k, (c, _) in enumerate(best[u])])
        return cost, whole, [(cost + extra, [(start[u], sizes[u], best[u][k][1]) for u, k in path]) for extra, path in ways[1:]]

    def decode(self, ids) -> str:
        """The text of any segmentation."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")
        return text[1:]


def apply_edits(ids: list[int], edits) -> list[int]:
    """The ids of another segmentation, from the best one's and its edits."""
    out, at = [], 0
    for place, drop, put in edits:
        out += [*ids[at:place], *put]
        at = place + drop
    return out + list(ids[at:])


_RESULT = ("ids array<int>, ids_crc32 bigint, score double, "
           "others array<struct<score:double,edits:array<struct<place:int,drop:int,put:array<int>>>>>, round_trip boolean")
_OTHERS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([("place", pa.int32()), ("drop", pa.int32()), ("put", pa.list_(pa.int32()))])))]))
SLICE = 256


def _segmented(pieces: Pieces, texts: list[str]) -> pa.StructArray:
    costs, ids, others = zip(*pieces.segments(texts))
    size = np.cumsum([0, *map(len, ids)])
    lists = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
    rest = pa.array([[{"score": -c / UNIT, "edits": [{"place": p, "drop": d, "put": put} for p, d, put in e]} for c, e in o] for o in others], _OTHERS)
    same = [pieces.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)]
    return pa.StructArray.from_arrays([lists, pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array([-c / UNIT for c in costs], pa.float64()), rest, pa.array(same)],
                                      ["ids", "ids_crc32", "score", "others", "round_trip"])


def encode_pieces(df: DataFrame, path: str, text: str = "text", n: int = 4, name: str = "pieces", keep: list[str] | None = None) -> DataFrame:
    """``df`` with a column ``name``: ids of the best segmentation, their crc32 (as little-endian 32-bit integers), its
    score (log probability), the ``others`` of the N best as edits to it, and whether decoding the ids gave the text back.

    Null text counts as empty, with no ids, score 0 and no others.  Equal costs come in an order that depends on the
    text alone.  Each row is by itself: repeated rows give equal results; a column called ``name`` is replaced.  ``keep``
    names the columns to carry along (all by default).  Empty table: no rows."""
    rest = [c for c in (df.columns if keep is None else keep) if c != name]
    whole = "__text"
    while whole in rest:
        whole += "_"

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.open(path, n)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                done = _segmented(pieces, part.column(len(rest)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(rest)], done], [*rest, name])

    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(name, T.StructType.fromDDL(_RESULT))])
    return df.select(*rest, text_column(df, text).alias(whole)).mapInArrow(segment, schema)


def decode_pieces(df: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """``df`` with the text of the ``ids`` column; null ids count as none."""

    @F.pandas_udf("string")
    def decode(lists: pd.Series) -> pd.Series:
        pieces = Pieces.open(path, 1)
        return lists.map(lambda x: "" if x is None else pieces.decode(x))

    return df.withColumn(name, decode(F.col(ids)))
