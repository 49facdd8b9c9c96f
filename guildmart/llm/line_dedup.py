"""Line dedup that can be taken back: exact reference counts behind sharded cuckoo filters.

The state is three written tables. ``postings`` has a row per document and distinct key of its
lines; ``refs`` is the exact reference count of every key with the smallest document that holds it;
``filters`` has a cuckoo filter per shard of the keys that two documents or more hold. Inserting
documents adds counts, and a key that reaches two holders enters its shard's filter. Deleting
documents takes counts away, and a key that falls to one holder leaves the filter, which a Bloom
filter could not do. So after any inserts and deletes the state gives the same lines as one built
from the documents that are left.

Deduplication streams every shard's postings past its filter; most keys are in no second document
and end there. What the filter lets pass is verified against the exact counts. At most HOT_SHARE hot
keys are broadcast instead, so that no line, however common, fills a task.

Keys are identified by 128-bit digests. Defined results: a missing or empty text is one empty line.
Rows with equal doc_id are one document for counting, each with its own result. A missing doc_id is
one document that comes after all others. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guildmart.llm.common import HOT_SHARE, Frames, hot_keys, ordered_id, utf8
from guildmart.sources.warehouse import written

MIN_POINTS = 10  # code points of the shortest key that counts
N_SHARDS = 64
SPACES = b" \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]


def line_key(line: bytes, min_points: int = MIN_POINTS) -> bytes | None:
    """The digest of the line's key, or None if the key is too short to count."""
    key = line.strip(SPACES).lower()
    if len(key) < 4 * min_points and len(key.decode("utf-8", "replace")) < min_points:
        return None
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key is in one of two buckets. Keys are (hi, lo) digests."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> CuckooFilter:
        """A filter of the distinct keys, as small as they fit in."""
        buckets = 1 << max(4, int(len(hi) / (cls.SLOTS * 0.8)).bit_length())
        while True:
            new = cls(np.zeros((buckets, cls.SLOTS), dtype=np.uint16))
            if new.insert(hi, lo):
                return new
            buckets *= 2

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype="<u2").reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _places(self, hi: np.ndarray, lo: np.ndarray):
        print_ = (lo.astype(np.int64).view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        print_ = np.maximum(print_, np.uint16(1))
        mask = len(self.table) - 1
        first = lo.astype(np.int64).view(np.uint64).astype(np.int64) & mask
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_):
        return (np.asarray(print_).astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        print_, first, second = self._places(hi, lo)
        here = (self.table[first] == print_[:, None]) | (self.table[second] == print_[:, None])
        return here.any(axis=1)

    def insert(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """Add keys that are not in it; False if one found no place, after which it is void."""
        table, rng = self.table, np.random.Generator(np.random.PCG64(len(hi)))
        for print_, first, second in zip(*(x.tolist() for x in self._places(hi, lo))):
            for bucket in (first, second):
                free = np.flatnonzero(table[bucket] == 0)
                if len(free):
                    table[bucket, free[0]] = print_
                    break
            else:
                for _ in range(self.KICKS):
                    slot = int(rng.integers(self.SLOTS))
                    print_, table[bucket, slot] = int(table[bucket, slot]), print_
                    bucket ^= int(self._jump(print_))
                    free = np.flatnonzero(table[bucket] == 0)
                    if len(free):
                        table[bucket, free[0]] = print_
                        break
                else:
                    return False
        return True

    def delete(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Take out keys that are in it."""
        for print_, first, second in zip(*(x.tolist() for x in self._places(hi, lo))):
            for bucket in (first, second):
                at = np.flatnonzero(self.table[bucket] == print_)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


@dataclass(frozen=True)
class LineState:
    postings: DataFrame  # doc_id, hi, lo
    refs: DataFrame  # hi, lo, n, first_id
    filters: DataFrame  # shard, filter
    n_shards: int = N_SHARDS


def _shard(n_shards: int):
    return F.pmod(F.col("hi"), F.lit(n_shards)).cast("int")


def _digests(docs: DataFrame, min_points: int) -> DataFrame:
    def keys(frames: Frames) -> Frames:
        for frame in frames:
            ids, found = [], []
            for doc_id, text in zip(frame.doc_id.tolist(), frame.text):
                own = {k for k in (line_key(x, min_points) for x in text.split(b"\n")) if k}
                ids.extend([doc_id] * len(own))
                found.extend(own)
            both = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pd.DataFrame({"doc_id": np.array(ids, dtype=np.int64), "hi": both[:, 0], "lo": both[:, 1]})

    return docs.select(ordered_id().alias("doc_id"), utf8().alias("text")).mapInPandas(keys, "doc_id bigint, hi bigint, lo bigint")


def _counts(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


def _filters(refs: DataFrame, n_shards: int) -> DataFrame:
    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        built = CuckooFilter.of(frame.hi.to_numpy(), frame.lo.to_numpy())
        return pd.DataFrame({"shard": [key[0]], "filter": [built.dump()]})

    shared = refs.where("n > 1").select(_shard(n_shards).alias("shard"), *KEY)
    return shared.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def _distinct_ids(docs: DataFrame) -> bool:
    """Whether no two rows share a doc_id, so that postings are distinct already."""
    return not docs.groupBy(ordered_id().alias("doc_id")).count().where("count > 1").limit(1).count()


def build(docs: DataFrame, min_points: int = MIN_POINTS, n_shards: int = N_SHARDS) -> LineState:
    """The state of a corpus from nothing."""
    postings = _digests(docs, min_points)
    postings = written(postings if _distinct_ids(docs) else postings.distinct())
    refs = written(_counts(postings))
    return LineState(postings, refs, written(_filters(refs, n_shards)), n_shards)


def _changed_filters(state: LineState, changes: DataFrame) -> DataFrame:
    """The filters after the changes (hi, lo, enters): keys that enter, or leave, the shared ones."""

    def change(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        shard = int((left if len(left) else right)["shard"].iloc[0])
        enters = right.enters.to_numpy(dtype=bool)
        hi, lo = right.hi.to_numpy(dtype=np.int64), right.lo.to_numpy(dtype=np.int64)
        if not len(left):
            return pd.DataFrame({"shard": [shard], "filter": [CuckooFilter.of(hi[enters], lo[enters]).dump()], "full": [False]})
        new = CuckooFilter.load(left["filter"].iloc[0])
        new.delete(hi[~enters], lo[~enters])
        fits = new.insert(hi[enters], lo[enters])
        return pd.DataFrame({"shard": [shard], "filter": [new.dump()], "full": [not fits]})

    return (
        state.filters.groupBy("shard")
        .cogroup(changes.withColumn("shard", _shard(state.n_shards)).groupBy("shard"))
        .applyInPandas(change, "shard int, filter binary, full boolean")
    )


def _with_refs(state: LineState, postings: DataFrame, touched: DataFrame) -> LineState:
    """The state with new postings; ``touched`` has the new (n, first_id) of every key that changed."""
    old = state.refs.select(*KEY, F.col("n").alias("was"))
    moved = written(touched.join(old, KEY, "left").withColumn("was", F.coalesce("was", F.lit(0))))
    refs = written(
        state.refs.join(moved.select(*KEY), KEY, "left_anti").unionByName(
            moved.where("n > 0").select(*KEY, "n", "first_id")
        )
    )
    changes = moved.where("(n > 1) <> (was > 1)").select(*KEY, F.expr("n > 1").alias("enters"))
    changed = written(_changed_filters(state, changes))
    full = changed.where("full").select("shard")
    again = _filters(refs.withColumn("shard", _shard(state.n_shards)).join(full, "shard", "left_semi"), state.n_shards)
    filters = written(changed.where(~F.col("full")).drop("full").unionByName(again))
    return LineState(postings, refs, filters, state.n_shards)


def insert(state: LineState, docs: DataFrame, min_points: int = MIN_POINTS) -> LineState:
    """The state after more documents; a (document, line) it has already is counted once."""
    fresh = written(_digests(docs, min_points).distinct().join(state.postings, ["doc_id", *KEY], "left_anti"))
    postings = written(state.postings.unionByName(fresh))
    more = _counts(fresh).select(*KEY, F.col("n").alias("more"), F.col("first_id").alias("new_id"))
    touched = more.join(state.refs, KEY, "left").select(
        *KEY,
        (F.coalesce("n", F.lit(0)) + F.col("more")).alias("n"),
        F.least("first_id", "new_id").alias("first_id"),
    )
    return _with_refs(state, postings, touched)


def delete(state: LineState, ids: DataFrame) -> LineState:
    """The state without the documents whose doc_id is in ``ids``."""
    gone = written(ids.select(ordered_id().alias("doc_id")).distinct())
    postings = written(state.postings.join(gone, "doc_id", "left_anti"))
    lost = written(state.postings.join(gone, "doc_id", "left_semi").select(*KEY).distinct())
    left = _counts(postings.join(lost, KEY, "left_semi"))
    touched = lost.join(left, KEY, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _with_refs(state, postings, touched)


def _passing(state: LineState, postings: DataFrame) -> DataFrame:
    """The postings that their shard's filter lets pass."""

    def probe(frames: Frames) -> Frames:
        current, filter_ = -1, None
        for frame in frames:
            shards = frame["shard"].to_numpy()
            for start, end in zip(*_runs(shards)):
                part = frame.iloc[start:end]
                if shards[start] != current:
                    current, filter_ = shards[start], None
                first = part["filter"].iloc[0]
                if first is not None:
                    filter_, part = CuckooFilter.load(first), part.iloc[1:]
                if filter_ is not None and len(part):
                    hi, lo = part.hi.to_numpy(dtype=np.int64), part.lo.to_numpy(dtype=np.int64)
                    yield part[["doc_id", "hi", "lo"]][filter_.contains(hi, lo)]

    columns = ["shard", "filter", "doc_id", "hi", "lo"]
    rows = postings.select(_shard(state.n_shards).alias("shard"), F.lit(None).cast("binary").alias("filter"), "doc_id", *KEY)
    zero = F.lit(0).cast("bigint")
    heads = state.filters.select("shard", "filter", zero.alias("doc_id"), zero.alias("hi"), zero.alias("lo"))
    stream = rows.unionByName(heads).withColumn("tail", F.col("filter").isNull())
    return (
        stream.repartition("shard")
        .sortWithinPartitions("shard", "tail")
        .select(*columns)
        .mapInPandas(probe, "doc_id bigint, hi bigint, lo bigint")
    )


def _runs(values: np.ndarray):
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return [], []
    cuts = np.flatnonzero(np.diff(values)) + 1
    return [0, *cuts.tolist()], [*cuts.tolist(), len(values)]


def dropped_keys(state: LineState) -> DataFrame:
    """(doc_id, hi, lo): the keys whose lines a document loses, as a smaller one holds them."""
    total = state.postings.count()
    hot = F.broadcast(hot_keys(state.refs, total).select(*KEY, F.col("n").alias("hot_n"), F.col("first_id")))
    marked = state.postings.join(hot, KEY, "left")
    common = marked.where("hot_n > 1 and first_id < doc_id").select("doc_id", *KEY)
    passing = _passing(state, marked.where("hot_n is null"))
    rare = state.refs.where((F.col("n") > 1) & (F.col("n") * HOT_SHARE <= total))
    verified = passing.join(rare, KEY).where("first_id < doc_id").select("doc_id", *KEY)
    return common.unionByName(verified)


def deduplicate(state: LineState, docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row of ``docs``, whose documents are in the state."""
    lost = dropped_keys(state).groupBy("doc_id").agg(
        F.collect_list(F.struct(*KEY)).alias("lost")
    ).withColumnRenamed("doc_id", "id")

    @F.pandas_udf("text string, n_lines bigint, n_dropped bigint")
    def keep(texts: pd.Series, all_lost: pd.Series) -> pd.DataFrame:
        rows = []
        for text, lost in zip(texts, all_lost):
            lines = kept = text.split(b"\n")
            if lost is not None and len(lost):
                flat = np.array([(x["hi"], x["lo"]) for x in lost], dtype="<i8").tobytes()
                gone = {flat[i : i + 16] for i in range(0, len(flat), 16)}
                kept = [x for x in lines if line_key(x, min_points) not in gone]
            rows.append((b"\n".join(kept).decode("utf-8", "replace"), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    rows = docs.select(F.col("doc_id").cast("bigint"), utf8().alias("text"), ordered_id().alias("id"))
    return rows.join(lost, "id", "left").select("doc_id", keep("text", "lost").alias("kept")).select("doc_id", "kept.*")
