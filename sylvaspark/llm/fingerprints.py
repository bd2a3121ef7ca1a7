"""Operator 8, substring dedup: a log-structured index of window fingerprints.

The index is a set of immutable runs in the shared folder. Each run is split into buckets by anchor hash, and each bucket file holds rows sorted
by anchor hash: the document, and the digests of the windows that have this anchor (see windows). A manifest beside the runs names those that count, so a later job
opens the index where an earlier one left it, and files of a batch that failed are never read. A new batch is sorted the same way;
each bucket merge-joins it with the runs' files by anchor hash, verifies the windows by digest, reports those seen before, and writes
the unseen ones as the next run. When `fanout` runs of about one size are there, they are compacted into one.

Defined results
- A window of 50 words is reported unless the document is the first to hold it: the index or, within a batch, the lowest doc_id comes first.
  Reported windows that overlap or touch are one span, with the lowest first document.
- Repetitions within one document aren't reported, nor is a document that is added again against itself.
- Null, empty and shorter texts give no rows and aren't indexed; rows without doc_id are left out; other columns are ignored;
  an empty batch leaves the index as it is. Texts of any length are read whole.
Windows are equal when 128 bits (64 of the anchor, 64 of the digest) are. A lost executor's bucket is done again with the same result: files
are written aside and moved into place.
"""

import json
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvaspark.llm import shared, suffixdedup, textkit, windows

BUCKET_BYTES, FANOUT = 24 << 20, 3
COLUMNS = ["key", "doc_id", "digests"]


def _rows(length: int, buckets: int):
    @shared.released
    def rows(batches):
        for b in batches:
            texts, ids = b.column("text"), b.column("doc_id").to_numpy()
            for at, to in textkit.slices(texts):
                words = textkit.Words(texts.slice(at, to - at))
                r = windows.Runs(words, length)
                digest = textkit.rolling_hash(words.hash, length)
                digest = digest[windows.ranges(r.at, r.count)]
                packed = shared.binaries(digest, np.concatenate(([0], np.cumsum(r.count))))
                bucket = (r.key % np.uint64(buckets)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(textkit.signed(r.key)), pa.array(ids[at + r.doc]), pa.array(r.start.astype(np.int32)), packed], ["bucket", "key", "doc_id", "start", "digests"])

    return rows


def _read(folder: str, run: str, bucket: int):
    """(key, doc, digests, ptr) of a bucket file, which may be absent."""
    fs, root = pafs.FileSystem.from_uri(f"{folder}/{run}")
    path = f"{root}/{bucket}.arrow"
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_file(path) as f:
        t = ipc.open_file(f).read_all()
    return (shared.column(t, "key").to_numpy(), shared.column(t, "doc_id").to_numpy(), *shared.ragged(t, "digests", np.uint64))


def _write(folder: str, run: str, bucket: int, key: np.ndarray, doc: np.ndarray, digests: np.ndarray, count: np.ndarray) -> None:
    some = np.flatnonzero(count > 0)
    if not len(some):
        return
    order = some[np.argsort(key[some], kind="stable")]
    ptr = np.concatenate(([0], np.cumsum(count)))
    t = pa.table([pa.array(key[order]), pa.array(doc[order]), shared.binaries(digests[windows.ranges(ptr[:-1][order], count[order])], np.concatenate(([0], np.cumsum(count[order]))))], COLUMNS)
    fs, root = pafs.FileSystem.from_uri(f"{folder}/{run}")
    fs.create_dir(root, recursive=True)
    aside = f"{root}/{bucket}-{uuid.uuid4().hex}.part"
    with fs.open_output_stream(aside) as f, ipc.new_file(f, t.schema) as w:
        w.write_table(t)
    fs.move(aside, f"{root}/{bucket}.arrow")


def _join(parts):
    """Runs' rows as one (key, doc, digests, count)."""
    parts = [p for p in parts if p is not None]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), np.concatenate([np.diff(p[3]) for p in parts])


def _firsts(key, doc, digests, count, old):
    """For rows whose anchor comes more than once: (their windows' index, row, the first document that holds the window, whether it is the first row)."""
    by_key = np.argsort(key, kind="stable")
    same = key[by_key][1:] == key[by_key][:-1]
    again = np.zeros(len(key), bool)
    again[by_key[1:][same]] = again[by_key[:-1][same]] = True
    rows = np.flatnonzero(again)
    ptr = np.concatenate(([0], np.cumsum(count)))
    at = windows.ranges(ptr[:-1][rows], count[rows])
    row = np.repeat(rows, count[rows])
    order = np.lexsort((doc[row], ~old[row], digests[at], key[row]))
    at, row = at[order], row[order]
    new = np.ones(len(at), bool)
    new[1:] = (key[row][1:] != key[row][:-1]) | (digests[at][1:] != digests[at][:-1])
    first = doc[row][np.flatnonzero(new)][np.cumsum(new) - 1] if len(at) else doc[:0]
    return at, row, first, new


def _merge(folder: str, runs: list[str], run: str, length: int):
    def one(bucket, g):
        key, doc, start = (shared.column(g, c).to_numpy() for c in ("key", "doc_id", "start"))
        digests, ptr = shared.ragged(g, "digests", np.uint64)
        h = _join([_read(folder, r, bucket) for r in runs])
        known = np.isin(h[0], key)  # merge join by anchor: only runs' rows with an anchor of the batch take part
        hptr = np.concatenate(([0], np.cumsum(h[3])))
        take = windows.ranges(hptr[:-1][known], h[3][known])
        m = int(known.sum())
        key, doc, count = np.concatenate((h[0][known], key)), np.concatenate((h[1][known], doc)), np.concatenate((h[3][known], np.diff(ptr)))
        digests, old = np.concatenate((h[2][take], digests)), np.arange(len(key)) < m
        at, row, first, new = _firsts(key, doc, digests, count, old)
        keep = np.repeat(~old, count)
        keep[at[~new]] = False
        wptr = np.concatenate(([0], np.cumsum(count)))
        _write(folder, run, bucket, key, doc, digests[keep], np.add.reduceat(np.append(keep, False), wptr[:-1]) if len(count) else count)
        hit = ~old[row] & (first != doc[row])
        row, at, first = row[hit], at[hit], first[hit]
        if len(row):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in suffixdedup.spans(doc[row], start[row - m].astype(np.int64) + at - wptr[row], first, length)], ["doc_id", "start_word", "n_words", "first_doc_id"])

    @shared.released
    def merge(batches):
        for g in shared.grouped(batches, "bucket"):
            b = shared.column(g, "bucket").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            for s, e in zip(cuts, np.append(cuts[1:], len(b))):
                if (out := one(int(b[s]), g.slice(s, e - s))) is not None:
                    yield out

    return merge


def _compact(folder: str, runs: list[str], run: str):
    @shared.released
    def compact(batches):
        for b in batches:
            for bucket in b.column("id").to_pylist():
                key, doc, digests, count = _join([_read(folder, r, bucket) for r in runs])
                if len(key):
                    _write(folder, run, bucket, key, doc, digests, count)
                yield pa.RecordBatch.from_arrays([pa.array([bucket])], ["id"])

    return compact


class FingerprintIndex:
    """add(batch) -> spans of the batch that were seen before. The folder is the index: where it holds a manifest, the index goes on with the runs, buckets and length
    that it names. `buckets` is fixed at the start; the index takes up to twice the bytes of the texts."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, length: int = windows.LENGTH, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        kept = self._manifest()
        self.buckets, self.length = kept.get("buckets", buckets), kept.get("length", length)
        self.made: int = kept.get("made", 0)
        self.runs: list[tuple[str, int]] = [tuple(r) for r in kept.get("runs", [])]  # oldest first, with the level: the number of compactions behind it

    def _manifest(self) -> dict:
        fs, root = pafs.FileSystem.from_uri(self.folder)
        if fs.get_file_info(f"{root}/manifest.json").type == pafs.FileType.NotFound:
            return {}
        with fs.open_input_stream(f"{root}/manifest.json") as f:
            return json.loads(f.read())

    def _commit(self) -> None:
        """Puts the runs that count in the manifest, at once: written aside and moved."""
        fs, root = pafs.FileSystem.from_uri(self.folder)
        fs.create_dir(root, recursive=True)
        aside = f"{root}/manifest-{uuid.uuid4().hex}.part"
        with fs.open_output_stream(aside) as f:
            f.write(json.dumps({"buckets": self.buckets, "length": self.length, "made": self.made, "runs": self.runs}).encode())
        fs.move(aside, f"{root}/manifest.json")

    def _name(self) -> str:
        self.made += 1
        return f"run-{self.made:06d}-{uuid.uuid4().hex[:8]}"

    def add(self, docs: DataFrame) -> DataFrame:
        docs = shared.documents(docs, "doc_id", "text").where(F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
        run = self._name()
        rows = docs.mapInArrow(_rows(self.length, self.buckets), "bucket int, key long, doc_id long, start int, digests binary")
        rows = rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "key")
        merged = rows.mapInArrow(_merge(self.folder, [r for r, _ in self.runs], run, self.length), suffixdedup.SPANS)
        merged = merged.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(suffixdedup._join_spans, suffixdedup.SPANS)
        out = shared.persist_shared(merged, self.spark)
        self.runs.append((run, 0))
        self._commit()
        while len(self.runs) >= self.fanout and len({level for _, level in self.runs[-self.fanout :]}) == 1:
            old = self.runs[-self.fanout :]
            new = self._name()
            self.spark.range(0, self.buckets, 1, self.buckets).mapInArrow(_compact(self.folder, [r for r, _ in old], new), "id long").write.format("noop").mode("overwrite").save()
            self.runs[-self.fanout :] = [(new, old[0][1] + 1)]
            self._commit()
            for r, _ in old:
                self._drop(r)
        return out

    def _drop(self, run: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{run}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self) -> None:
        """Deletes the index."""
        self._drop("")


def incremental_spans(docs: DataFrame, batches: int = 4, length: int = windows.LENGTH) -> DataFrame:
    """The spans found when documents (doc_id, text) arrive in `batches` ranges of doc_id, the lowest first."""
    spark = SparkSession.active()
    ids = shared.documents(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
    low, high, total = ids.agg(F.min("doc_id"), F.max("doc_id"), F.sum(F.octet_length("text"))).first()
    if low is None:
        return spark.createDataFrame([], suffixdedup.SPANS)
    index = FingerprintIndex(spark, shared.shared_dir(spark), max(12, -(-2 * int(total or 0) // BUCKET_BYTES)), length)
    step = -(-(high - low + 1) // batches)
    out = None
    for k in range(batches):
        lo = low + k * step
        found = index.add(ids.where((F.col("doc_id") >= lo) & (F.col("doc_id") < lo + step)))
        out = found if out is None else out.unionByName(found)
    index.drop()
    return out
