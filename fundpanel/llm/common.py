"""What several of the corpus operators share: tables, staged copies, bounded key
sketches, cached encoding, distributed components and running numbers."""

from __future__ import annotations

import atexit
import functools
import itertools
import json
import os
import re
import tempfile
import uuid
from array import array
from collections.abc import Callable
from contextvars import ContextVar
from functools import cached_property
from pathlib import Path

import numpy as np
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundpanel.session import shared_root

#: The white space that tokenizer patterns call \s (Unicode White_Space); fixed values.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space with the word after it. No token of the tokenizers used here spans two units.
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
FIRST_WHITE = re.compile(f"[{WHITE}]")
_PLAIN_WHITE = "\t\n\v\f\r "
#: New units that are encoded in a row.
JOINED = 100
#: The normalizer and pre-tokenizer of files whose words end by a suffix, and what their
#: pattern finds in lower-case ASCII.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

SKETCH_BITS = 23
_folders: dict[str, SparkSession] = {}
#: Staged copies that the operator at work has written so far.
_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # workers on this machine find the package wherever the driver was started; a cluster
    # has it installed or shipped by --py-files
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stage_folder(spark: SparkSession) -> str:
    """Folder of this application below the shared checkpoint folder. Where none is set,
    as in tests on one machine, a temporary one is set; a cluster must name its own."""
    root = shared_root(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fundpanel-"))
        root = spark.sparkContext.getCheckpointDir()
    folder = f"{root.rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders[folder] = spark
        atexit.register(_forget, folder)
    return folder


def _forget(folder: str) -> None:
    """Remove the application's staged copies when the driver ends."""
    context = _folders.pop(folder).sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        _remove(context, folder)


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, several readers share
    the work, and a lost executor costs nothing that was written. codec: of the files, if
    not the session's; zstd makes numbers smaller that snappy leaves as they are."""
    path = f"{stage_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    if (written := _written.get()) is not None:
        written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator, with its staged copies removed as it returns, but for those that its
    result is read from; of an operator within it, the rest goes with the outer one."""
    @functools.wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        before = _written.set([])
        try:
            out = operator(*args, **kwargs)
            own = _written.get()
        finally:
            _written.reset(before)
        folders = {file.rsplit("/", 2)[-2] for file in out.inputFiles()}
        kept = [path for path in own if path.rsplit("/", 1)[-1] in folders]
        for path in set(own).difference(kept):
            _remove(out.sparkSession.sparkContext, path)
        if (above := _written.get()) is not None:
            above += kept
        return out

    return run


def _remove(context: SparkContext, folder: str) -> None:
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def key_sketch(keys: DataFrame, column: str, bits: int = SKETCH_BITS) -> bytes:
    """Bit set of fixed size (2**bits bits) over 64-bit keys. It can only say too often
    that a key is there, so users of it do more work, never less, as it fills up."""
    at = F.pmod(F.col(column), F.lit(1 << bits))
    words = (keys.select(F.floor(at / 32).cast("int").alias("w"), F.pmod(at, F.lit(32)).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m")))
    out = np.zeros((1 << bits) // 32, np.uint32)
    for w, m in words.collect():  # 2**bits / 32 rows at most
        out[w] = m & 0xFFFFFFFF
    return out.tobytes()


def in_sketch(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """sketch: uint32 words; keys: int64."""
    at = keys & (len(sketch) * 32 - 1)
    return (sketch[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


class UnitEncoder:
    """tokenizers' encoding of whole texts. Where the file is a plain byte-level BPE whose
    ids follow its merges, a text without `<` goes through tiktoken with the ranks that the
    file states, which gives the same ids and keeps nothing. Of all other texts units that
    may hold a special token, and with other kinds of files all units, go through
    tokenizers, each once while it stays in a cache of bounded size. Files that lower-case
    and end words by a suffix have ranks too, for ASCII units of texts without `<` and NUL."""

    loaded: dict[str, UnitEncoder] = {}

    def __init__(self, path: str, keep: int = 500_000) -> None:
        self.path, self.keep, self.ranked, self.worded = path, keep, ranked_encoding(path), worded_encoding(path)
        #: Encoded units: those met since the last change of caches, and those before.
        self.cache, self.older = {}, {}

    @classmethod
    def of(cls, path: str, keep: int = 500_000) -> UnitEncoder:
        """One for each worker process, with the size of cache it is asked for last."""
        if path not in cls.loaded:
            cls.loaded[path] = cls(path, keep)
        cls.loaded[path].keep = keep
        return cls.loaded[path]

    @cached_property
    def tokenizer(self):
        """Some 50 MB, which files with ranks need for special tokens only."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    @cached_property
    def tokens(self) -> dict[int, str]:
        return {i: t for t, i in self.tokenizer.get_vocab().items()}

    def _learn(self, units: set[str]) -> None:
        if len(self.cache) > self.keep // 2:
            self.cache, self.older = {}, self.cache
        self.cache.update((u, self.older[u]) for u in units if u in self.older)
        groups, plain = [], []
        for u in units:
            if u in self.older:  # looked up one by one: a difference of sets would walk all that is kept
                continue
            if _joins(u):
                plain.append(u)
            else:
                groups.append([u])
        groups += [plain[at:at + JOINED] for at in range(0, len(plain), JOINED)]
        for at in range(0, len(groups), 500):
            part = groups[at:at + 500]
            for group, e in zip(part, self.tokenizer.encode_batch(["".join(g) for g in part], add_special_tokens=False), strict=True):
                ids = array("I", e.ids).tobytes()
                if len(group) == 1:
                    self.cache[group[0]] = ids
                    continue
                ends = np.cumsum([len(u) for u in group])
                first = 0
                for u, last in zip(group, (4 * np.searchsorted([x for x, _ in e.offsets], ends)).tolist(), strict=True):
                    self.cache[u] = ids[first:last]
                    first = last

    def _of_units(self, units: list[str]) -> list[bytes]:
        found = list(map(self.cache.get, units))
        if new := {u for u, f in zip(units, found, strict=True) if f is None}:
            self._learn(new)
            return [self.cache[u] if f is None else f for u, f in zip(units, found, strict=True)]
        return found

    def _by_units(self, units: list[str]) -> bytes:
        return b"".join(self._of_units(units))

    def _by_words(self, text: str) -> bytes:
        odd = []
        if not text.isascii():
            units = UNIT.findall(text)
            odd = [u for u in units if not u.isascii()]
            text = "".join([u if u.isascii() else " \0 " for u in units])
        ids = np.array(self.worded.encode_ordinary("\0".join([*ASCII_WORD.findall(text.lower()), ""])), "<u4")
        raw, out, last = ids.tobytes(), [], 0
        if odd:
            places = 4 * np.flatnonzero(ids == self.worded.encode_single_token(b"\0\0"))
            for at, own in zip(places.tolist(), self._of_units(odd), strict=True):
                out += (raw[last:at], own)
                last = at + 4
        return b"".join([*out, raw[last:]])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.ranked is None and (self.worded is None or "<" in text or "\0" in text):
            return self._by_units(UNIT.findall(text))
        if self.ranked is None:
            return self._by_words(text)
        if "<" not in text:
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        out = []
        for special, units in itertools.groupby(UNIT.findall(text), lambda u: "<" in u):
            out.append(self._by_units(list(units)) if special else array("I", self.ranked.encode_ordinary("".join(units))).tobytes())
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """tokenizers' decoding, special tokens included. Without a decoder in the file
        that is the tokens with blanks between them."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids))


def _joins(unit: str) -> bool:
    """Whether a unit can be encoded in a row with others and cut out by its offsets: plain
    characters, white space in front and none after, and no special token."""
    return unit.isascii() and unit[0] in _PLAIN_WHITE and unit[-1] not in _PLAIN_WHITE and "<" not in unit


def ranked_encoding(path: str):
    """tiktoken's encoding with a file's vocabulary, or None where the file is anything
    but byte-level BPE with its usual pattern, no normalizer and ids in merge order."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if model["type"] != "BPE" or odd or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        return None
    if any("<" not in t["content"] for t in spec["added_tokens"]):
        return None
    byte_of = _byte_of()
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        return None
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes that are written as themselves
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}


def worded_encoding(path: str):
    """tiktoken's encoding of ASCII words, each with a NUL after it (two for a place that is
    left open), or None where the file is
    anything but lower-cased byte-level BPE that ends words by a suffix and numbers bytes,
    bytes with the suffix and then merges in order. The NUL stands for the suffix: as the
    last byte with it comes before all merges, it is merged first, and once a word."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}]
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    suffix = model.get("end_of_word_suffix")
    split = {"type": "Split", "pattern": {"Regex": _WORD_PATTERN}, "behavior": "Removed", "invert": True}
    level = len(pre) == 2 and pre[1].get("type") == "ByteLevel" and not pre[1].get("add_prefix_space") and not pre[1].get("use_regex")
    if model["type"] != "BPE" or odd or not suffix or spec["normalizer"] != _WORD_NORMALIZER or pre[0] != split or not level:
        return None
    if any("<" not in t["content"] for t in spec["added_tokens"]):
        return None
    byte_of, vocab = _byte_of(), model["vocab"]
    as_bytes = lambda t: bytes(byte_of[c] for c in t.removesuffix(suffix)) + b"\0" * t.endswith(suffix)
    added = {t["content"] for t in spec["added_tokens"]}
    ranks = {as_bytes(t): i for t, i in vocab.items() if t not in added}
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    first = [vocab.get(c) for c in byte_of] + [vocab.get(c + suffix) for c in byte_of]
    if None in first or {*first[:256]} != {*range(256)} or {*first[256:]} != {*range(256, 512)} or [vocab[m] for m in merged] != list(range(512, 512 + len(merged))) or len(ranks) != 512 + len(merged):
        return None
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00|\x00\x00", mergeable_ranks=ranks, special_tokens={})


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; component: its smallest reachable
    node. Smallest labels spread over edges and pointers are shortened in every round,
    so that rounds grow with the logarithm of a component's width. All rounds are joins
    and minimum aggregates; nothing is collected but whether a label changed."""
    both = staged(edges.select(F.col(a).alias("s"), F.col(b).alias("d"))
                  .union(edges.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("s").alias("node")).agg(F.min(F.least("s", "d")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.d == labels.node).groupBy(F.col("s").alias("node")).agg(F.min("component").alias("near"))
        moved = labels.join(near, "node").select("node", F.least("component", "near").alias("to"), F.col("component").alias("was"))
        up = labels.select(F.col("node").alias("to"), F.col("component").alias("above"))
        new = staged(moved.join(up, "to").select("node", F.least("to", "above").alias("component"), "was"), "labels")
        if new.filter("component <> was").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")


def numbered(df: DataFrame, group: str, order: Column, out: str, buckets: int = 256,
             first: Column | None = None, spread: Column | None = None) -> DataFrame:
    """Gapless numbers from 0 within each group, by buckets and then by `order` in each:
    a (group, bucket) is one window, started at the sum of the earlier ones, so that no
    group is ordered in one task. Buckets are a hash of the row's order, so `order` should
    tell rows apart. first: rows for which it is true come in later buckets than all
    others. spread is for an order by (hub, row): hubs then stay together, one bucket or,
    where spread is true, some buckets in a row for a hub."""
    b, r, o = f"{out}_bucket", f"{out}_row", f"{out}_order"
    at = F.pmod(F.xxhash64(o), F.lit(buckets))
    if spread is not None:
        salt = F.when(spread, 1 + F.pmod(at, F.lit(buckets - 1))).otherwise(F.lit(0))
        at = F.pmod(F.xxhash64("hub"), F.lit(buckets)) * buckets + salt
    if first is not None:
        at = at + F.when(first, F.lit(buckets * buckets)).otherwise(F.lit(0))
    rows = df.withColumn(o, order).withColumn(b, at)
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(group, b).count().select(group, b, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(out))
    within = rows.withColumn(r, F.row_number().over(Window.partitionBy(group, b).orderBy(o)) - 1)
    return within.join(starts, [group, b]).withColumn(out, (F.col(out) + F.col(r)).cast("long")).drop(b, r, o)
