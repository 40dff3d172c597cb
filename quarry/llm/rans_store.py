"""Token ids in binary blocks, coded by a static range asymmetric numeral system (rANS).

Format: a folder with two Parquet tables.

* ``freqs``: id, freq.  One shared table; frequencies of all ids seen anywhere in the input, scaled to sum 2**bits.
* ``blocks``: one row a block, in order of part and block (the number of its first document in the part): n_tokens, crc32 (of the ids as little-endian
  unsigned 32-bit integers), ``words`` (the coded stream, 32-bit little-endian), ``marks`` (checkpoints) and the
  documents in it (``doc_ids``, ``doc_tokens``).

A block holds whole documents, about ``block_tokens`` ids, and is decoded by itself.  Its ids are dealt to ``LANES``
coders in turn, whose words are interleaved in one stream.  A checkpoint after each ``mark_tokens`` ids holds the
coders' states and the place in the stream; decoding starts at all checkpoints of a block at once, each with its lanes.
A state stays in [2**31, 2**63); a word of 32 bits moves out or in where it would leave that range.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, scratch_dir, text_column, with_row_key

LANES, LOW = 1024, 31
_U = np.uint64
BLOCK_SCHEMA = "part int, block long, n_tokens long, crc32 long, words binary, marks array<struct<token:bigint,word:bigint,states:binary>>, doc_ids array<bigint>, doc_tokens array<bigint>"


def scaled(counts: np.ndarray, bits: int) -> np.ndarray:
    """Whole frequencies that sum to 2**bits, at least 1 where the count is above 0."""
    seen = counts > 0
    out = np.zeros(len(counts), dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return out
    room = (1 << bits) - int(seen.sum())
    out[seen] = 1 + (counts[seen].astype(object) * room // total).astype(np.int64)
    out[int(np.argmax(counts))] += (1 << bits) - int(out.sum())
    return out


class Coder:
    """Encoder and decoder of one frequency table; ``ids`` ascending."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray):
        self.bits = int(freqs.sum()).bit_length() - 1 if len(freqs) else 0
        self.ids, self.freq = ids.astype(np.uint32), freqs.astype(np.uint64)
        self.first = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64) if len(freqs) else np.zeros(0, np.uint64)
        self._slots: np.ndarray | None = None
        top = int(ids.max(initial=0))
        self._place = np.zeros(top + 1, dtype=np.int32) if top < 1 << 24 else None
        if self._place is not None:
            self._place[ids] = np.arange(len(ids))

    def encode(self, ids: np.ndarray, mark_tokens: int) -> tuple[bytes, list[tuple[int, int, bytes]]]:
        """Coded words and checkpoints (token, word, states), the first at token 0."""
        n, k, bits, word = len(ids), LANES, _U(self.bits), _U(32)
        at = np.searchsorted(self.ids, ids) if self._place is None else self._place[ids]
        freq, first = self.freq[at], self.first[at]
        states = np.full(k, 1 << LOW, dtype=np.uint64)
        limit = freq << (_U(LOW + 32) - bits)  # a state from here on gives out a word first
        out, size, marks = [], 0, []
        step = max(1, mark_tokens // k) * k
        for s in range((n - 1) // k * k, -1, -k):
            e = min(s + k, n)
            x, f = states[:e - s], freq[s:e]
            full = x >= limit[s:e]
            if full.any():
                out.append((x[full] & _U(0xFFFFFFFF)).astype("<u4")[::-1])
                size += len(out[-1])
                x = np.where(full, x >> word, x)
            q = x // f
            states[:e - s] = (q << bits) + (x - q * f) + first[s:e]
            if s % step == 0:
                marks.append((s, size, states.astype("<u8").tobytes()))
        words = np.concatenate(out)[::-1] if out else np.empty(0, "<u4")
        return words.tobytes(), [(s, size - w, st) for s, w, st in reversed(marks)]

    def decode(self, words: bytes, marks, n: int) -> np.ndarray:
        """Ids of a block; all checkpoints are decoded side by side."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        k, bits, word, low, mask = LANES, _U(self.bits), _U(32), _U(1 << LOW), _U((1 << self.bits) - 1)
        stream = np.frombuffer(words, dtype="<u4").astype(np.uint64)
        start = np.array([m[0] for m in marks], dtype=np.int64)
        stop = np.append(start[1:], n)
        ptr = np.array([m[1] for m in marks], dtype=np.int64)
        x = np.stack([np.frombuffer(m[2], dtype="<u8") for m in marks]).astype(np.uint64)
        longest = int((stop - start).max(initial=0))
        out, lane = np.empty((len(start), -(-longest // k) * k), dtype=np.uint32), np.arange(k)
        for s in range(0, longest, k):
            live = slice(None) if s + k <= (stop - start).min() else np.flatnonzero(start + s < stop)
            y = x[live]
            slot = y & mask
            sym = self._slots[slot]
            y = self.freq[sym] * (y >> bits) + slot - self.first[sym]
            out[live, s:s + k] = self.ids[sym]
            here = None if isinstance(live, slice) else lane < (stop - start)[live][:, None] - s  # lanes with an id
            need = y < low if here is None else (y < low) & here
            rank = np.cumsum(need, axis=1)
            y[need] = (y[need] << word) | stream[(ptr[live][:, None] + rank - 1)[need]]
            ptr[live] += rank[:, -1]
            x[live] = y if here is None else np.where(here, y, x[live])
        return np.concatenate([row[:m] for row, m in zip(out, (stop - start).tolist(), strict=True)])


def _le32(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def write_ids(docs: DataFrame, tokenize: Callable[[list[str]], list[np.ndarray]], path: str, doc_id: str = "doc_id", text: str = "text", max_id: int = 65535,
              bits: int = 20, block_tokens: int = 1 << 18, mark_tokens: int = 1 << 17) -> None:
    """Tokenizes ``docs`` and writes their ids to ``path`` in ascending doc_id order (null last; rows of one doc_id by
    their place).  ``tokenize`` maps texts to id arrays, ids up to ``max_id``; a larger one raises.  Blocks are written in the
    tasks' order: their ``part`` and ``block`` give the ascending order.  An empty table makes an empty store; other columns
    are not read.

    Null text counts as empty; a document may have no ids.  A document longer than a block makes a longer block, with
    more checkpoints.  Texts are range-partitioned once and tokenized in order; the ids are then read twice, to count
    them and to code them, and not shuffled."""
    spark, width = docs.sparkSession, "<u2" if max_id < 1 << 16 else "<u4"
    keyed = with_row_key(docs)
    rows = keyed.select(F.col(doc_id).cast("long").alias("doc_id"), FILE, POS, text_column(keyed, text).alias("t"))

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            made = tokenize(b.column(1).to_pylist())
            if max((int(x.max()) for x in made if len(x)), default=0) > max_id:
                raise ValueError(f"an id is above max_id {max_id}")
            ids = pa.array([x.astype(width).tobytes() for x in made], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(no, no + n)), b.column(0), ids], ["part", "no", "doc_id", "ids"])
            no += n

    order = [F.col("doc_id").asc_nulls_last(), F.col(FILE), F.col(POS)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "t").mapInArrow(to_ids, "part int, no long, doc_id long, ids binary")
    made = scratch_dir(spark, "token-ids")
    ordered.write.option("compression", "zstd").parquet(made)
    ordered = spark.read.schema(ordered.schema).parquet(made)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for b in batches:
            got = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype=width))
            if len(got) > len(total):
                got, total = total, got
            total[:len(got)] += got
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    counts = ordered.select("ids").mapInArrow(tally, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toPandas()  # one row an id of the vocabulary
    ids, n = counts["id"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=np.int64)
    freqs = scaled(n, max(bits, len(n).bit_length() + 4))
    spark.createDataFrame(counts.assign(freq=freqs)[["id", "freq"]], "id long, freq long").coalesce(1).write.parquet(f"{path}/freqs")
    shared = spark.sparkContext.broadcast((ids, freqs))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        names, held, size, part, block = [], [], 0, -1, 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate(held)
            words, marks = coder.encode(every, mark_tokens) if len(every) else (b"", [])
            one = {"part": part, "block": block, "n_tokens": len(every), "crc32": zlib.crc32(_le32(every)), "words": words,
                   "marks": [{"token": t, "word": w, "states": s} for t, w, s in marks], "doc_ids": names, "doc_tokens": [len(h) for h in held]}
            return pa.RecordBatch.from_pylist([one], schema=BLOCK_ARROW)

        for b in batches:
            for p, no, name, raw in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if names and (size >= block_tokens or len(names) >= block_tokens or p != part or no != block + len(names)):
                    yield flush()
                    names, held, size = [], [], 0
                if not names:
                    part, block = p, no
                names.append(name)
                held.append(np.frombuffer(raw, dtype=width))
                size += len(held[-1])
        if names:
            yield flush()

    ordered.mapInArrow(encode, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


BLOCK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n_tokens", pa.int64()), ("crc32", pa.int64()), ("words", pa.binary()),
                         ("marks", pa.list_(pa.struct([("token", pa.int64()), ("word", pa.int64()), ("states", pa.binary())]))),
                         ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64()))])


def _coder(spark: SparkSession, path: str):
    freqs = spark.read.schema("id long, freq long").parquet(f"{path}/freqs").orderBy("id").toPandas()
    return spark.sparkContext.broadcast((freqs["id"].to_numpy(dtype=np.int64), freqs["freq"].to_numpy(dtype=np.int64)))


def decode_blocks(spark: SparkSession, path: str, each: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """Reads the blocks back, checks their sums, and returns part, block, no (the document's number in its block),
    doc_id, at (ids before it in its part), n_tokens and ``value``: ``each(ids)``, of Spark type ``kind``."""
    shared = _coder(spark, path)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("part", "block", "n_tokens").withColumn("at", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).drop("n_tokens")
    arrow = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("no", pa.int64()), ("doc_id", pa.int64()), ("within", pa.int64()), ("n_tokens", pa.int64()), ("value", _ARROW[kind])])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for b in batches:
            for row in b.to_pylist():
                marks = [(m["token"], m["word"], m["states"]) for m in row["marks"]]
                ids = coder.decode(row["words"], marks, row["n_tokens"]) if row["n_tokens"] else np.empty(0, np.uint32)
                if zlib.crc32(_le32(ids)) != row["crc32"]:
                    raise ValueError(f"checksum of part {row['part']} block {row['block']} differs")
                size = np.array(row["doc_tokens"], dtype=np.int64)
                end = np.cumsum(size)
                m = len(size)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, row["part"], np.int32)), pa.array(np.full(m, row["block"], np.int64)), pa.array(np.arange(m)), pa.array(row["doc_ids"], pa.int64()),
                                                  pa.array(end - size), pa.array(size), pa.array([each(ids[e - s:e]) for s, e in zip(size, end)], _ARROW[kind])], schema=arrow)

    docs = blocks.mapInArrow(decode, f"part int, block long, no long, doc_id long, within long, n_tokens long, value {kind}")
    return docs.join(starts, ["part", "block"]).select("part", "block", "no", "doc_id", (F.col("at") + F.col("within")).alias("at"), "n_tokens", "value")


_ARROW = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of each document."""
    return _with_start(spark, path, decode_blocks(spark, path, lambda ids: ids.astype(np.int32), "array<int>")).withColumnRenamed("value", "ids")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32: the checksum of each document's decoded ids."""
    return _with_start(spark, path, decode_blocks(spark, path, lambda ids: zlib.crc32(_le32(ids)), "long")).withColumnRenamed("value", "ids_crc32")


def _with_start(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """``start``: ids of all documents before; parts are numbered in order of doc_id, one offset a part."""
    parts = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return docs.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("at")).cast("long").alias("start"), "n_tokens", "value")
