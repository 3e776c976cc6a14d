"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over a text's bytes sets chunk borders, so equal passages give equal
chunks wherever they stand. Chunks that stand in more than one place are encoded once:

1. every chunk's digest is counted; those counted twice or more set bits in a sketch of
   fixed size, the only thing that is broadcast;
2. chunks whose bit is set are collected by digest and each distinct one is encoded;
3. a text without such chunks is encoded where it is. Any other is written as a list of
   runs: runs of chunks that stand once are encoded at once, the rest are references;
4. references are joined to the encodings, and texts are put together again.

A chunk border can fall inside a word. So an encoding leaves out the chunk's open ends:
the text before its first white space and from its last white space on. At each join
the open ends are put together, over as many chunks as have no white space, and encoded
anew; as no token spans white space in front of a word, the result agrees exactly with
the encoding of the whole text.

If the sketch is full, more chunks take the long way and results are the same.

Defined results: a null text counts as empty, with no ids and empty decoded text.
Repeated rows give repeated results; an empty table gives none. Null ids are kept. Texts of
any length are taken whole. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundpanel.llm.common import FIRST_WHITE, UNIT, UnitEncoder, in_sketch, key_sketch, staged

#: Chunks have MEAN bytes on average, and no more than LONGEST.
MEAN, LONGEST = 512, 1 << 16
#: Rows of results in one Arrow batch.
OUT_ROWS = 200

_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)


def chunks(raw: bytes, mean: int = MEAN, longest: int = LONGEST) -> list[bytes]:
    """Cuts after each byte where the hash of the last 16 bytes has log2(mean) zero bits,
    moved to the next start of a character."""
    n = len(raw)
    if n <= 32:
        return [raw] if n else []
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    for k in (1, 2, 4, 8):  # sums of 2, 4, 8, 16 shifted gear values
        h[k:] += h[:-k] << np.uint32(k)
    ends = np.flatnonzero(h[16:] < np.uint32(1 << (32 - (mean.bit_length() - 1)))) + 17
    out, last = [], 0
    for e in [*ends.tolist(), n]:
        while e < n and raw[e] & 0xC0 == 0x80:
            e += 1
        while e - last > longest:
            mid = last + longest
            while raw[mid] & 0xC0 == 0x80:
                mid -= 1
            out.append(raw[last:mid])
            last = mid
        if e > last:
            out.append(raw[last:e])
            last = e
    return out


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def open_ends(text: str) -> tuple[str, str, str, bool]:
    """(head, core, tail, solid) of a run: what its neighbours may change, and what not."""
    first = FIRST_WHITE.search(text)
    if first is None:
        return text, "", "", True
    head, rest = text[:first.start()], text[first.start():]
    tail = UNIT.findall(rest)[-1]
    return head, rest[:len(rest) - len(tail)], tail, False


def _narrow(coder: UnitEncoder) -> bool:
    return coder.tokenizer.get_vocab_size() <= 1 << 16


def packed(ids: bytes, coder: UnitEncoder) -> bytes:
    """Ids in two bytes each on the way, where the vocabulary allows it."""
    return np.frombuffer(ids, "<u4").astype("<u2").tobytes() if _narrow(coder) else ids


def unpacked(ids: bytes, coder: UnitEncoder) -> bytes:
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if _narrow(coder) else ids


def join_runs(runs: Iterable[tuple[str, bytes, str, bool]], coder: UnitEncoder) -> bytes:
    """Ids of a text from its runs (head, core ids, tail, solid) in order."""
    out, ends = [], ""
    for head, core, tail, solid in runs:
        ends += head
        if not solid:
            out += (coder.encode(ends), core)
            ends = tail
    return b"".join([*out, coder.encode(ends)])


def _results(keys: pa.Array, found: list[bytes], coder: UnitEncoder) -> Iterator[pa.RecordBatch]:
    """(key, ids, decoded) in small batches."""
    for at in range(0, len(found), OUT_ROWS):
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in found[at:at + OUT_ROWS]]
        texts = [coder.decode(x.tolist()) for x in ids]
        yield pa.RecordBatch.from_arrays([keys.slice(at, len(ids)), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())], ["key", "ids", "decoded"])


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", mean: int = MEAN) -> DataFrame:
    """(key, ids array<int>, decoded string) of every whole text."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    raw = lambda t: (t.as_py() or "").encode()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, int] = {}
            for t in batch.column("text"):
                for c in chunks(raw(t), mean):
                    k = _key(_digest(c))
                    counts[k] = counts.get(k, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["h", "n"])

    often = rows.select("text").mapInArrow(digests, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    sketch = key_sketch(often, "h")

    def flags(parts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        own = [_digest(c) for c in parts]
        return own, in_sketch(np.frombuffer(sketch, np.uint32), np.array([_key(d) for d in own], np.int64))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, str] = {}
            for t in batch.column("text"):
                parts = chunks(raw(t), mean)
                own, hit = flags(parts)
                for k in np.flatnonzero(hit):
                    found[own[k]] = parts[k].decode()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.string())], ["digest", "chunk"])

    def encode_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = UnitEncoder.of(tokenizer)
        for batch in batches:
            ends = [open_ends(c.as_py()) for c in batch.column("chunk")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([x[0] for x in ends]), pa.array([packed(coder.encode(x[1]), coder) for x in ends], pa.binary()),
                 pa.array([x[2] for x in ends]), pa.array([x[3] for x in ends], pa.bool_())], ["digest", "r_head", "r_core", "r_tail", "r_solid"])

    known = staged(rows.select("text").mapInArrow(shared, "digest binary, chunk string").groupBy("digest").agg(F.first("chunk").alias("chunk"))
                   .mapInArrow(encode_once, "digest binary, r_head string, r_core binary, r_tail string, r_solid boolean"), "chunks", "zstd")

    def has_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of the texts that have shared chunks."""
        coder, names = UnitEncoder.of(tokenizer), ["row", "n", "key", "digest", "head", "core", "tail", "solid"]
        types = [pa.int64(), pa.int32(), None, pa.binary(), pa.string(), pa.binary(), pa.string(), pa.bool_()]
        number = 0
        for batch in batches:
            keys, at, out = batch.column("key"), [], []
            for i, t in enumerate(batch.column("text")):
                parts = chunks(raw(t), mean)
                own, hit = flags(parts)
                number += 1
                if not hit.any():
                    continue
                own_run, n = b"", 0
                for k, c in enumerate([*parts, b""]):
                    end = k == len(parts)
                    if not end and not hit[k]:
                        own_run += c
                        continue
                    if own_run:
                        head, core, tail, solid = open_ends(own_run.decode())
                        at.append(i)
                        out.append((number, n, None, head, packed(coder.encode(core), coder), tail, solid))
                        own_run, n = b"", n + 1
                    if not end:
                        at.append(i)
                        out.append((number, n, own[k], None, None, None, None))
                        n += 1
            for a in range(0, len(out), 5000):
                columns = list(zip(*out[a:a + 5000], strict=True))
                columns.insert(2, keys.take(pa.array(at[a:a + 5000], pa.int64())))
                yield pa.RecordBatch.from_arrays([c if t is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of the texts that share nothing."""
        coder = UnitEncoder.of(tokenizer)
        for batch in batches:
            at, found = [], []
            for i, t in enumerate(batch.column("text")):
                if not flags(chunks(raw(t), mean))[1].any():
                    at.append(i)
                    found.append(coder.encode(t.as_py() or ""))
            yield from _results(batch.column("key").take(pa.array(at, pa.int64())), found, coder)

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs in order of (part, row, n); the text of a row may span batches."""
        coder, last, runs, keys, found = UnitEncoder.of(tokenizer), None, [], [], []

        def close() -> None:
            keys.append(last[2])
            found.append(join_runs(runs, coder))
            runs.clear()

        kind = None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            kind = columns["key"].type
            for i in range(batch.num_rows):
                row = {name: c[i].as_py() for name, c in columns.items()}
                if last is not None and last[:2] != (row["part"], row["row"]):
                    close()
                    if len(found) >= OUT_ROWS:
                        yield from _results(pa.array(keys, kind), found, coder)
                        keys.clear()
                        found.clear()
                last = (row["part"], row["row"], row["key"])
                runs.append((row["head"], unpacked(row["core"], coder), row["tail"], row["solid"]))
        if last is not None:
            close()
            yield from _results(pa.array(keys, kind), found, coder)

    runs = staged(rows.mapInArrow(has_shared, f"row long, n int, key {key_type}, digest binary, head string, core binary, tail string, solid boolean")
                  .withColumn("part", F.spark_partition_id()), "runs", "zstd")
    result = f"key {key_type}, ids array<int>, decoded string"
    # only references meet the encodings; encoded runs move once, to their text
    refs = runs.filter("digest is not null").select("part", "row", "n", "key", "digest").join(known, "digest")
    both = runs.filter("digest is null").select("part", "row", "n", "key", "head", "core", "tail", "solid").union(
        refs.select("part", "row", "n", "key", "r_head", "r_core", "r_tail", "r_solid"))
    joined = both.repartition("part", "row").sortWithinPartitions("part", "row", "n")
    return rows.mapInArrow(alone, result).union(joined.mapInArrow(put_together, result))
