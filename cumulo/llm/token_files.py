"""Token-ID output: raw id payloads with a minimal perfect hash index.

`write` encodes documents with the tokenizers library and writes shards in ascending id order, one
file for each range of ids, through Spark's own file committer (so retried or speculative tasks
leave no trace). A shard is raw little-endian ids, document after document, each closed by the end
id, then a directory:

    ids of document 1, end id, ids of document 2, end id, ...
    directory: int64 keys, uint8 key-is-null flags, int64 id counts (with the end id)
    trailer:   int64 documents, int64 magic; then one more end id, which closes every record

ids are 16-bit where the vocabulary fits, else 32-bit. The end id is what Spark's text writer puts
after a record, so its bytes must be below 0x80.

The index maps a key to (shard, position, count) in constant time: keys are dealt by hash into
buckets of about `BUCKET` keys, and each bucket has a minimal perfect hash (hash and displace: the
keys of a small group share a pilot number, chosen so that all keys fall on different slots) and per
slot a 32-bit fingerprint of its key, so a key that was never written is refused (but for 1 in 2^32).
`read` looks keys up bucket by bucket and then reads each shard's slices by seeking.

Encoding calls the library, many at a time in one string, on segments of the texts at which its pre-tokeniser always breaks
(see segments.py), each distinct one once while it is remembered; the ids are those of the whole text.

Defined cases: NULL and empty texts are a lone end id; a NULL key is written but not indexed
(`scan` returns it, `read_unkeyed` its ids); rows that repeat a key lie side by side ordered by text, the index points to the
first and counts them, `read` returns them all; an empty table gives no shard, an empty index and an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cumulo.llm.common import tidy
from cumulo.llm.segments import SegmentTable, check_special

BUCKET, GROUP, MAGIC = 4096, 4, 0x6D756C756375
SIDE = 1 << 20  # ids read at once where records lie side by side, besides the last one
RECORDS = "key long, start long, n_tokens long, ids binary"
_SHARD = re.compile(r"part-(\d+)")


# -- encoding -----------------------------------------------------------------------------------

class LibraryEncoder:
    """Ids of segments (as `segments.cuts` makes them) by the tokenizers library."""

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer
        self.tok, self.dtype = Tokenizer.from_file(path), dtype
        added = self.tok.get_added_tokens_decoder()
        check_special([t.content for t in added.values()])
        # a special string parts segments: the library cuts it out before anything else
        specials = [(t.content, i) for i, t in added.items()
                    if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark, self.mark_id = specials[0] if specials else ("", -1)
        # bytes that each token stands for: a byte-level vocabulary has a character for each byte
        vocabulary = self.tok.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        for i, t in added.items():
            self.width[i] = len(t.content.encode("utf-8"))

    def _strung(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """All ids and their counts, with the segments encoded as one string. One that begins with a break follows one
        that ends with a visible character as it would in a text; the special mark goes before the others. The tokens' bytes tell
        which are whose; None if a token reaches over an edge."""
        apart = np.array([i for i, (a, b) in enumerate(zip(segments, segments[1:]), 1) if not (
            b[0] in " \n" and (a[-1].isalnum() or "!" <= a[-1] <= "~"))], np.int64)
        if len(apart) and not self.mark:
            return None
        pieces = list(segments)
        for i in apart.tolist():
            pieces[i] = self.mark + pieces[i]
        ids = np.array(self.tok.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, np.int64)
        edge = np.cumsum([len(p.encode("utf-8")) for p in pieces])
        total = np.cumsum(self.width[ids])
        last = np.searchsorted(total, edge)
        marks = last[apart - 1] + 1
        if last[-1] != len(ids) - 1 or (total[last] != edge).any() or (ids[marks] != self.mark_id).any():
            return None
        counts = np.diff(last, prepend=-1)
        counts[apart] -= 1
        return np.delete(ids, marks).astype(self.dtype), counts

    def segment_ids(self, segments: list[str], at_once: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all non-empty segments one after the other, how many of each)."""
        flat, counts = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for i in range(0, len(segments), at_once):
            got = self._strung(segments[i:i + at_once])
            if got is None:
                single = [self.tok.encode(s, add_special_tokens=False).ids for s in segments[i:i + at_once]]
                got = np.array([i for s in single for i in s], self.dtype), np.array([len(s) for s in single], np.int64)
            flat.append(got[0])
            counts.append(got[1])
        return np.concatenate(flat), np.concatenate(counts)


_ENCODERS: dict[tuple, SegmentTable] = {}  # bounded: the vocabulary and the table's own limits


def _encoder(path: str, dtype: str) -> SegmentTable:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = SegmentTable(LibraryEncoder(path, dtype).segment_ids, dtype)
    return _ENCODERS[path, dtype]


def id_dtype(path: str) -> str:
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


# -- shards -------------------------------------------------------------------------------------

def write(docs: DataFrame, out: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write shards below `out`/shards; returns that folder. Ids must be integers."""
    dtype = id_dtype(path)
    close = np.array([end_id], dtype).tobytes()
    if max(close) > 127:
        raise ValueError("each byte of the end id must be below 128")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _encoder(path, dtype)
        keys, counts = [], []
        for b in batches:
            n, flat = cache.encode(b.column("t").to_pylist())
            ends = np.concatenate(([0], np.cumsum(n) * len(close))).astype(np.int32)
            keys += b.column("id").to_pylist()
            counts += (n + 1).tolist()
            yield pa.RecordBatch.from_arrays([pa.BinaryArray.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes())])], ["ids"])
        if keys:
            null = np.array([k is None for k in keys], np.uint8)
            whole = np.array([0 if k is None else k for k in keys], "<i8")
            last = (whole.tobytes() + null.tobytes() + np.array(counts, "<i8").tobytes()
                    + np.array([len(keys), MAGIC], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary())], ["ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions(F.asc_nulls_first("id"), "t")
    (ordered.mapInArrow(tidy(shard), "ids binary").select(F.col("ids").cast("string").alias("value"))
     .write.option("lineSep", close.decode("ascii")).option("compression", "none").text(f"{out}/shards"))
    return f"{out}/shards"


def _open(path: str):
    """A seekable input file on any store that Arrow knows."""
    from pyarrow import fs
    where, inner = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "/", path))
    return where.open_input_file(inner)


def _directory(f, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = f.size() - width
    n, magic = np.frombuffer(f.read_at(16, size - 16), "<i8").tolist()
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    raw = f.read_at(17 * n, size - 16 - 17 * n)
    return (np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n).astype(bool),
            np.frombuffer(raw, "<i8", n, 9 * n))


def scan(spark: SparkSession, shards: str, dtype: str) -> DataFrame:
    """The directories of all shards: shard, file, key, row (in the shard), at (ids before it in the
    shard), n_tokens, start (ids before it in all shards)."""
    width = np.dtype(dtype).itemsize

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _ENCODERS.clear()  # workers live on: their tables are of no use after the writing stage
        for files in batches:
            for name in files["path"]:
                with _open(name) as f:
                    if not f.size():  # a partition without rows
                        continue
                    keys, null, counts = _directory(f, width)
                yield pd.DataFrame({"shard": int(_SHARD.search(name).group(1)), "file": name,
                                    "key": np.where(null, 0, keys), "null": null, "row": np.arange(len(keys)),
                                    "at": np.cumsum(counts) - counts, "n_tokens": counts})

    # lists files only: the content column is not asked for
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(shards).select("path")
    found = files.mapInPandas(tidy(entries), "shard int, file string, key long, null boolean, row long, at long, n_tokens long")
    found = found.withColumn("key", F.when(~F.col("null"), F.col("key"))).drop("null")
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("t"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    base = totals.select("shard", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    return found.join(base, "shard").select("shard", "file", "key", "row", "at", "n_tokens",
                                            (F.col("base") + F.col("at")).alias("start"))


# -- index --------------------------------------------------------------------------------------

def _mix(h: np.ndarray, salt) -> np.ndarray:
    """Another 64-bit hash of a 64-bit hash."""
    x = h ^ (np.asarray(salt, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _groups(h: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h, 1) % np.uint64(max(1, n // GROUP))).astype(np.int64)


def _fingerprints(h: np.ndarray) -> np.ndarray:
    return (_mix(h, 2) >> np.uint64(32)).astype("<u4")


def build_hash(h: np.ndarray) -> np.ndarray:
    """Pilot numbers of a minimal perfect hash over distinct 64-bit hashes."""
    n = len(h)
    group = _groups(h, n)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=max(1, n // GROUP))
    ends = np.cumsum(sizes)
    pilots = np.zeros(len(sizes), "<u4")
    free = np.ones(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        if not sizes[g]:
            break
        own = h[order[ends[g] - sizes[g]:ends[g]]]
        begin, step = 0, 64
        while True:
            trial = np.arange(begin, begin + step, dtype=np.uint64) + np.uint64(3)
            slots = (_mix(own[None, :], trial[:, None]) % np.uint64(n)).astype(np.int64)
            ok = free[slots].all(axis=1)
            if sizes[g] > 1:
                s = np.sort(slots, axis=1)
                ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            if ok.any():
                i = int(np.argmax(ok))
                pilots[g], free[slots[i]] = begin + i, False
                break
            begin, step = begin + step, min(2 * step, 8192)
            if begin > 1 << 31:
                raise ValueError("keys of one bucket share a hash")
    return pilots


def slots_of(h: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h, pilots[_groups(h, n)].astype(np.uint64) + np.uint64(3)) % np.uint64(n)).astype(np.int64)


def build_index(entries: DataFrame, out: str) -> DataFrame:
    """Write and return the index: one row per bucket with its pilots and its slots' columns."""
    spark = entries.sparkSession
    # the first row of each key; equal keys lie side by side in one shard
    first = entries.where("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("shard", "row", "at", "n_tokens", "start")).alias("f"), F.count(F.lit(1)).alias("records"),
        F.min("file").alias("file")).select("key", "f.*", "records", "file")
    n = first.count()
    buckets = max(1, -(-n // BUCKET))
    dealt = first.withColumn("h", F.xxhash64("key")).withColumn("bucket", F.pmod("h", F.lit(buckets)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy().view(np.uint64)
        pilots = build_hash(h)
        at = slots_of(h, pilots, len(h))
        col = lambda c, kind: (lambda v: v.tobytes())(_placed(pdf[c].to_numpy(), at, kind))
        names = sorted(set(pdf["file"]))
        return pd.DataFrame([{
            "bucket": int(pdf["bucket"].iloc[0]), "n": len(h), "pilots": pilots.tobytes(),
            "prints": _placed(_fingerprints(h), at, "<u4").tobytes(), "files": names,
            "file": _placed(pdf["file"].map({f: i for i, f in enumerate(names)}).to_numpy(), at, "<i4").tobytes(),
            **{c: col(c, "<i8") for c in ("row", "at", "n_tokens", "start", "records")}}])

    dealt.groupBy("bucket").applyInPandas(
        build, "bucket long, n int, pilots binary, prints binary, files array<string>, file binary, row binary, "
               "at binary, n_tokens binary, start binary, records binary").write.parquet(f"{out}/index")
    return spark.read.parquet(f"{out}/index").withColumn("buckets", F.lit(buckets))


def _placed(values: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    out = np.empty(len(values), kind)
    out[at] = values
    return out


def lookup(keys: DataFrame, index: DataFrame, key_col: str = "key") -> DataFrame:
    """Records of those keys that the index knows: key, file, row, at, n_tokens, start, records."""
    buckets = index.select("buckets").head()
    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key IS NOT NULL").distinct() \
        .withColumn("h", F.xxhash64("key")).withColumn("bucket", F.pmod("h", F.lit(buckets[0] if buckets else 1)))

    def find(asked: pd.DataFrame, idx: pd.DataFrame) -> pd.DataFrame:
        cols = ["key", "file", "row", "at", "n_tokens", "start", "records"]
        if not len(idx) or not len(asked):
            return pd.DataFrame({c: pd.Series([], dtype=object if c == "file" else "int64") for c in cols})
        x, h = idx.iloc[0], asked["h"].to_numpy().view(np.uint64)
        slot = slots_of(h, np.frombuffer(x["pilots"], "<u4"), int(x["n"]))
        known = np.frombuffer(x["prints"], "<u4")[slot] == _fingerprints(h)
        slot = slot[known]
        out = {"key": asked["key"].to_numpy()[known],
               "file": np.array(list(x["files"]), object)[np.frombuffer(x["file"], "<i4")[slot]]}
        # object strings: Arrow-backed ones are handed over in chunks, which an empty group has none of
        return pd.DataFrame(out | {c: np.frombuffer(x[c], "<i8")[slot] for c in cols[2:]}).astype({"file": object})

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        find, "key long, file string, row long, at long, n_tokens long, start long, records long")


def read(records: DataFrame, dtype: str) -> DataFrame:
    """The ids of looked-up records, read from their shards by seeking: key, start, n_tokens, ids."""
    width = np.dtype(dtype).itemsize
    by_file = records.repartition("file").sortWithinPartitions("file", "at")

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for pdf in batches:
            key, file, at, n, start, records, row = (pdf[c].to_numpy(object if c == "file" else None) for c in (
                "key", "file", "at", "n_tokens", "start", "records", "row"))
            end, several, out = at + n, records > 1, []
            apart = np.ones(len(pdf), bool)
            apart[1:] = (file[1:] != file[:-1]) | (at[1:] != end[:-1]) | several[1:] | several[:-1]
            runs = np.flatnonzero(apart).tolist()
            for a, b in zip(runs, [*runs[1:], len(pdf)]):
                if file[a] != name:
                    if f is not None:
                        f.close()
                    name, f = file[a], _open(file[a])
                if several[a]:
                    lens = _directory(f, width)[2][row[a]:row[a] + records[a]]
                    keys, edge = [key[a]] * len(lens), np.concatenate(([0], np.cumsum(lens)))
                else:
                    lens, keys, edge = n[a:b], key[a:b], np.append(at[a:b], end[b - 1]) - at[a]
                # records that follow each other are read at once, as far as they begin in the same block of ids
                turns = [0, *(np.flatnonzero(np.diff(edge[:-1] // SIDE)) + 1).tolist(), len(lens)]
                for i, j in zip(turns, turns[1:]):
                    side = edge[i:j + 1] - edge[i]
                    raw = f.read_at(int(side[-1]) * width, int(at[a] + edge[i]) * width)
                    ends = (side * width).tolist()
                    out.extend(zip(keys[i:j], (start[a] + edge[i:j]).tolist(), lens[i:j].tolist(),
                                   (raw[x:y] for x, y in zip(ends, ends[1:]))))
            yield pd.DataFrame(out, columns=["key", "start", "n_tokens", "ids"])
        if f is not None:
            f.close()

    return by_file.mapInPandas(tidy(slices), RECORDS)


def read_unkeyed(entries: DataFrame, dtype: str) -> DataFrame:
    """The ids of the records with a NULL key, which the index leaves out: as from `read`."""
    records = entries.where("key IS NULL").select(F.lit(0).cast("long").alias("key"), "file", "row", "at", "n_tokens",
                                                  "start", F.lit(1).cast("long").alias("records"))
    return read(records, dtype).withColumn("key", F.lit(None).cast("long"))


def crc32_of_ids(ids_col: str, dtype: str):
    """Column: unsigned crc32 of the ids as little-endian 32-bit integers."""
    @F.pandas_udf("long")
    def crc(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: zlib.crc32(np.frombuffer(b, dtype).astype("<u4").tobytes()))
    return crc(F.col(ids_col))
