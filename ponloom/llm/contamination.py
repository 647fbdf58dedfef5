"""Benchmark passages in training texts, found through a distributed positional inverted index.

Training tokens are kept as postings: documents lie in blocks of about a quarter megabyte, and each block is one row with its sorted
terms and, for each term, the positions where it stands. A test passage is looked up in every block through its terms: the
postings of its rarest term there, moved back by that term's offset, are intersected with the moved postings of the others,
next rarest first. Common words are touched only where all rarer words of a passage agree, and a block that lacks one
word of a passage never reads its other postings.

Words and lower case are those of ``words.py``. A passage is ``window`` consecutive words of an item; an item of fewer words,
but not none, is one passage. Passages do not run across documents. Null and empty texts have no words. Repeated
documents are searched each for itself; items that repeat an id count as one item; an item without id counts, but has no part in
a digest of ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ponloom.llm.words import words
from ponloom.operators.lineage import stored

#: Passages that one pass over the index looks for; more take more passes.
PASSAGES_PER_PASS = 200_000


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index to the shared folder and read it back: one row per block with the ids, where each document's words begin,
    the terms, where each term's postings begin, and the positions.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)),
        *(T.StructField(c, T.BinaryType()) for c in ("documents", "terms", "heads", "positions")),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, w in words(batch.column(1)):
                terms, which = np.unique(w.hashes, return_inverse=True)
                order = np.argsort(which, kind="stable")
                heads = np.searchsorted(which[order], np.arange(len(terms) + 1))
                ids = batch.column(0).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids])),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (w.offsets.astype("<i8"), terms.astype("<u8"), heads.astype("<i4"), order.astype("<i4"))),
                ], names=[f.name for f in schema.fields])
                number += 1

    return stored(rows.mapInArrow(run, schema), "postings")


def passages(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms array<long>) for every passage."""
    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in words(batch.column(1)):
                terms, items = [], []
                for i in range(hi - lo):
                    own = w.hashes[w.offsets[i]:w.offsets[i + 1]].view(np.int64)
                    for at in range(max(1, len(own) - window + 1) if len(own) else 0):
                        terms.append(own[at:at + window])
                        items.append(lo + i)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(items, pa.int64())), pa.array(terms, pa.list_(pa.int64()))], names=["item", "terms"])

    return rows.mapInArrow(run, T.StructType([T.StructField("item", rows.schema["item"].dataType), T.StructField("terms", T.ArrayType(T.LongType()))]))


class Block:
    """The postings of one block."""

    def __init__(self, documents: bytes, terms: bytes, heads: bytes, positions: bytes):
        self.documents = np.frombuffer(documents, "<i8")
        self.terms = np.frombuffer(terms, "<u8")
        self.heads = np.frombuffer(heads, "<i4").astype(np.int64)
        positions_ = np.frombuffer(positions, "<i4").astype(np.int64)
        # Postings of all terms as one sorted list of (term, position).
        self.postings = np.repeat(np.arange(len(self.terms)), np.diff(self.heads)) << 32 | positions_

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term here, -1 where absent."""
        if not len(self.terms):
            return np.full(terms.shape, -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def match(self, rows: np.ndarray, sizes: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which passage, from where, to where, for passages given as rows of term numbers (all present, padded by -1)."""
        count = np.where(rows >= 0, np.diff(self.heads)[rows], np.int64(1) << 60)
        ranked = np.argsort(count, axis=1, kind="stable")
        each = np.arange(len(rows))
        rare = ranked[:, 0]
        term = rows[each, rare]
        times = count[each, rare]
        which = np.repeat(each, times)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
        place = self.postings[self.heads[term[which]] + nth] & 0xFFFFFFFF
        if slop:
            first, last = self._chain(rows, sizes, which, place, rare, slop)
        else:
            first = place - rare[which]
            for r in range(1, rows.shape[1]):
                offset = ranked[which, r]
                known = rows[which, offset]
                want = known << 32 | np.maximum(first + offset, 0)
                at = np.minimum(np.searchsorted(self.postings, want), len(self.postings) - 1)
                keep = (known < 0) | ((self.postings[at] == want) & (first + offset >= 0))
                which, first = which[keep], first[keep]
            last = first + sizes[which]
            which, first, last = which[first >= 0], first[first >= 0], last[first >= 0]
            return self._inside(which, first, last)
        keep = first >= 0
        return self._inside(which[keep], first[keep], last[keep])

    def _chain(self, rows, sizes, which, place, rare, slop):
        """From the rarest word of each occurrence to both ends, with at most ``slop`` words between neighbours: the nearest begin and end.

        All positions that can be reached are followed at each step, for the nearest one may lead nowhere. First is -1 where no chain is whole.
        """
        anchor, first, last = rare[which], np.full(len(which), -1, np.int64), np.full(len(which), -1, np.int64)
        for forward, out in ((True, last), (False, first)):
            who, at = np.arange(len(which)), place.copy()
            for step in range(rows.shape[1]):
                offset = anchor[who] + step if forward else anchor[who] - step
                ends = offset == (sizes[which[who]] - 1 if forward else 0)
                # Of the positions at an end the one nearest to the rarest word.
                arrived, spot = who[ends], at[ends]
                order = np.lexsort((spot if forward else -spot, arrived))
                arrived, pick = np.unique(arrived[order], return_index=True)
                out[arrived] = spot[order][pick]
                who, at, offset = who[~ends], at[~ends], offset[~ends]
                if not len(who):
                    break
                known = rows[which[who], offset + (1 if forward else -1)] << 32
                low, high = (at + 1, at + slop + 1) if forward else (np.maximum(at - slop - 1, 0), at - 1)
                begin = np.searchsorted(self.postings, known | np.maximum(low, 0), "left")
                end = np.where(high >= low, np.searchsorted(self.postings, known | np.maximum(high, 0), "right"), begin)
                count = end - begin
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                reached = self.postings[np.repeat(begin, count) + nth] & 0xFFFFFFFF
                who, at = np.unique(np.stack([np.repeat(who, count), reached]), axis=1)
        return np.where((first >= 0) & (last >= 0), first, -1), last + 1

    def _inside(self, which, first, last):
        begin = np.searchsorted(self.documents, first, "right")
        end = np.searchsorted(self.documents, last - 1, "right")
        keep = begin == end
        return which[keep], first[keep], last[keep]


def _search(index: DataFrame, taken: pa.Table, slop: int) -> DataFrame:
    """One pass: a row for each document, with the merged stretches of words hit and the items they come from."""
    lists = taken.column("terms").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    grid = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0), np.uint64)
    filled = np.arange(grid.shape[1])[None, :] < sizes[:, None]
    grid[filled] = lists.flatten().to_numpy().view(np.uint64)
    # Equal passages of several items are searched once.
    uniq, same = np.unique(np.concatenate([grid, sizes[:, None].astype(np.uint64)], 1), axis=0, return_inverse=True)
    item_of = np.argsort(same.ravel(), kind="stable")
    item_at = np.searchsorted(same.ravel()[item_of], np.arange(len(uniq) + 1))
    vocabulary, numbers = np.unique(uniq[:, :-1], return_inverse=True)
    numbers = numbers.reshape(len(uniq), uniq.shape[1] - 1)
    numbers = np.where(np.arange(numbers.shape[1])[None, :] < uniq[:, -1:].astype(np.int64), numbers, -1)
    lengths = uniq[:, -1].astype(np.int64)
    items = taken.column("item").combine_chunks()
    item_type, id_type = items.type, to_arrow_type(index.schema["ids"].dataType.elementType)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            for r in range(batch.num_rows):
                block = Block(*(get(c)[r].as_py() for c in ("documents", "terms", "heads", "positions")))
                n = len(block.documents) - 1
                spans: list[list] = [[] for _ in range(n)]
                owners: list[set] = [set() for _ in range(n)]
                here = np.append(block.find(vocabulary), -2)
                rows = here[numbers] if len(uniq) else np.zeros((0, 0), np.int64)
                rows = np.where(numbers < 0, -2, rows)
                whole = np.flatnonzero((rows != -1).all(1)) if len(rows) else np.zeros(0, np.int64)
                if len(whole):
                    which, first, last = block.match(np.where(rows[whole] == -2, -1, rows[whole]), lengths[whole], slop)
                    order = np.lexsort((last, first))
                    which, first, last = whole[which[order]], first[order], last[order]
                    docs = np.searchsorted(block.documents, first, "right") - 1
                    begin = block.documents[docs]
                    for d, s, e in zip(docs.tolist(), (first - begin).tolist(), (last - begin).tolist()):
                        if spans[d] and s <= spans[d][-1]["end"]:
                            spans[d][-1]["end"] = max(e, spans[d][-1]["end"])
                        else:
                            spans[d].append({"start": s, "end": e})
                    for d, p in np.unique(np.stack([docs, which], 1), axis=0).tolist() if len(docs) else ():
                        owners[d].update(item_of[item_at[p]:item_at[p + 1]].tolist())
                flat = [i for o in owners for i in sorted(o)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, get("block")[r].as_py())), pa.array(np.arange(n)), get("ids")[r].values.cast(id_type),
                    pa.array(np.diff(block.documents)), pa.array(spans, pa.list_(span)),
                    pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, owners)]), pa.int32()), items.take(pa.array(flat, pa.int64()))),
                ], names=["block", "place", "id", "n_words", "spans", "items"])

    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("place", T.LongType()), T.StructField("id", index.schema["ids"].dataType.elementType),
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(_spark_type(item_type))),
    ])
    return index.mapInArrow(run, schema)


def _spark_type(kind: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind)


def search(
    index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0, id_col: str = "item_id", text_col: str = "text",
    per_pass: int = PASSAGES_PER_PASS,
) -> DataFrame:
    """(id, n_words, n_hit, spans, items) for every document of the index.

    ``spans`` are stretches of word numbers that lie in occurrences of passages, merged, ``n_hit`` their words, ``items`` the
    distinct items. With ``slop`` neighbouring words of a passage may have up to that many other words between them. An occurrence
    reaches from its rarest word to the nearest begin and the nearest end that a whole chain leads to. About ``per_pass`` passages go
    with the tasks of one pass over the index; a larger benchmark is dealt by hash to several passes, each written before the
    next one's passages are fetched, and their results are merged by document.
    """
    found = passages(benchmark, window, id_col, text_col)
    passes = max(1, -(-found.count() // per_pass))
    if passes == 1:
        out = _search(index, found.toArrow(), slop)
    else:
        found = stored(found, "passages")
        deal = F.pmod(F.xxhash64("item", "terms"), F.lit(passes))
        out = _merged([stored(_search(index, found.filter(deal == k).toArrow(), slop), "pass") for k in range(passes)])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("id", "n_words", hit.alias("n_hit"), "spans", F.array_distinct("items").alias("items"))


def _merged(passes: list[DataFrame]) -> DataFrame:
    """The results of several passes as those of one."""
    key, rows = ["block", "place"], reduce(DataFrame.unionAll, passes)
    each = rows.select(*key, F.explode("spans").alias("s")).select(*key, "s.start", "s.end")
    earlier = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begins = each.withColumn("begins", (F.col("start") > F.coalesce(F.max("end").over(earlier), F.lit(-1))).cast("int"))
    run = F.sum("begins").over(Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0))
    spans = begins.withColumn("run", run).groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    docs = rows.groupBy(*key).agg(F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"))
    return docs.join(spans, key, "left").withColumn("spans", F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")))
