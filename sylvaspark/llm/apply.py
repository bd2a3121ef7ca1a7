"""What the pipeline does with the operators' decisions: rows or passages go, all columns stay as they are.

Rows that share a doc_id are one document here: they stay or go together, and lose the same passages. Rows without doc_id stay.
Columns beside doc_id and text pass through, whatever their names; n_chars, where there is one, follows the text.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvaspark.llm import jaccard, shared, suffixdedup, textkit, toxicity, windows


def without_toxic(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The documents that the classifier doesn't reject; scored row by row, so nothing is shuffled."""
    fitted = toxicity.fit(docs, labels, **bounds)
    score = toxicity._score(fitted)

    @shared.released
    def clean(batches):
        for b in batches:
            at = 0
            narrow = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), b.column("text")], ["doc_id", "text"])
            for s in score([narrow]):
                yield b.slice(at, s.num_rows).filter(pc.invert(s.column("toxic")))
                at += s.num_rows

    return docs.mapInArrow(clean, docs.schema)


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The lowest doc_id of each class of near duplicates stays, and all documents without one."""
    rest = jaccard.classes(docs, **options).where("doc_id <> class_id").select(F.col("doc_id").alias("_dropped_id"))
    return docs.join(rest, docs["doc_id"] == rest["_dropped_id"], "left_anti")


def _remove(data: np.ndarray, words: textkit.Words, d: int, start: np.ndarray, n: np.ndarray) -> bytes | None:
    """Text d without those words, each with what follows up to the next word; None if no word is left."""
    own = slice(words.ptr[d], words.ptr[d + 1])
    gone = np.zeros(words.count[d], bool)
    at = windows.ranges(start, n)
    gone[at[at < len(gone)]] = True
    if gone.all():
        return None
    lo, hi = words.offsets[d], words.offsets[d + 1]
    begin = words.start[own]
    upto = np.append(begin[1:], hi)
    cut = np.zeros(hi - lo + 1, np.int64)
    np.add.at(cut, begin[gone] - lo, 1)
    np.add.at(cut, upto[gone] - lo, -1)
    return data[lo:hi][np.cumsum(cut[:-1]) == 0].tobytes()


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents without the passages that an earlier document holds as well; those that nothing is left of go."""
    spans = suffixdedup.repeated_spans(docs, **options).groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "n_words")).alias("_spans"))
    spans = spans.withColumnRenamed("doc_id", "_spans_id")
    names = docs.columns
    joined = docs.join(spans, docs["doc_id"] == spans["_spans_id"], "left").drop("_spans_id")

    @shared.released
    def cut(batches):
        for b in batches:
            spans, text = b.column("_spans"), b.column("text")
            some = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
            keep = np.ones(b.num_rows, bool)
            new: dict[int, str] = {}
            if len(some):
                part = text.take(pa.array(some))
                lists = spans.take(pa.array(some)).to_pylist()
                for at, to in textkit.slices(part):
                    words = textkit.Words(part.slice(at, to - at))
                    for d in range(to - at):
                        s = lists[at + d]
                        left = _remove(words.data, words, d, np.array([x["start_word"] for x in s]), np.array([x["n_words"] for x in s])) if words.count[d] else b""
                        keep[some[at + d]] = left is not None
                        new[int(some[at + d])] = (left or b"").decode("utf-8")
            b = b.select(names)
            if new:
                mask = np.zeros(b.num_rows, bool)
                mask[list(new)] = True
                fresh = pc.replace_with_mask(b.column("text").cast(pa.large_string()), pa.array(mask), pa.array(list(new.values()), pa.large_string())).cast(b.schema.field("text").type)
                b = b.set_column(names.index("text"), b.schema.field("text"), fresh)
            yield b.filter(pa.array(keep))

    out = joined.mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
