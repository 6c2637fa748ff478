"""Has this key been seen before? (problem 1)

Keys are hashed to 128 bits in the JVM and spread over partitions by hash.
Each partition walks its keys in row order and keeps only a cuckoo table of
16-bit fingerprints: two candidate buckets a key, four slots a bucket,
deletion, growth by a further table of twice the size when one saturates.
The table answers for every row; it never misses a key it holds, so an answer
"seen" can be wrong only for a key's first row, and only those are checked.
Tables can be kept between batches, each of which is asked against all
earlier ones.

A key may hold a third of all rows: of a key that is frequent within a block
of rows only the first goes to the table, with the number of those behind it
that its answer is for; they stay where they are.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.lineage import materialise
from millrace.plans.skew import HOT_SLICES

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class CuckooTable:
    """Fingerprints of a set of 64-bit key hashes, all operations on arrays.

    ``contains`` has no false negatives for keys added and not removed; its
    false positives are about 8 / 65536 for each filled table.  A table that
    can't place its keys within ``kicks`` rounds or is filled to ``fill`` is
    left as it is and a further one of twice its size takes the next keys.

    ``remove`` takes out keys that were added (once each).  Where a key's
    fingerprint is found in one table only, any of its copies there stands for
    it, as equal fingerprints of one pair of buckets can't be told apart.
    Where several tables have it, its own can't be known: the fingerprints
    stay, and the key is noted as removed by its whole hash.
    """

    SLOTS = 4

    def __init__(self, buckets: int = 1 << 15, fill: float = 0.9, kicks: int = 64, seed: int = 7):
        self.fill, self.kicks, self.random = fill, kicks, np.random.default_rng(seed)
        self.tables = [np.zeros((buckets, self.SLOTS), np.uint16)]
        self.counts = [0]
        self.stash: dict[int, int] = {}  # fingerprint and bucket of the few a saturated table couldn't place
        self.gone = np.zeros(0, np.uint64)  # hashes of removed keys whose fingerprints had to stay

    @staticmethod
    def _fingerprint(h: np.ndarray) -> np.ndarray:
        f = (h >> np.uint64(48)).astype(np.uint16)
        return np.where(f == 0, np.uint16(1), f)

    def _buckets(self, h: np.ndarray, f: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        first = (h & np.uint64(size - 1)).astype(np.int64)
        return first, self._other(first, f, size)

    @staticmethod
    def _other(bucket: np.ndarray, f: np.ndarray, size: int) -> np.ndarray:
        return bucket ^ (_mixed(f.astype(np.uint64) * _MIX) & np.uint64(size - 1)).astype(np.int64)

    def _stashed(self, level: int, bucket: int, f: int) -> int:
        return (level << 56) | (bucket << 16) | f

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        h = _mixed(hashes.astype(np.uint64))
        f = self._fingerprint(h)
        found = np.zeros(len(h), bool)
        for level, table in enumerate(self.tables):
            a, b = self._buckets(h, f, len(table))
            found |= (table[a] == f[:, None]).any(1) | (table[b] == f[:, None]).any(1)
            if self.stash:
                found |= np.array(
                    [self._stashed(level, int(x), int(z)) in self.stash or self._stashed(level, int(y), int(z)) in self.stash for x, y, z in zip(a, b, f)], bool
                )
        return found & ~np.isin(h, self.gone) if len(self.gone) else found

    def add(self, hashes: np.ndarray) -> None:
        """Adds keys that aren't in the set."""
        if len(self.gone):
            back = np.isin(_mixed(hashes.astype(np.uint64)), self.gone)
            self.gone = self.gone[~np.isin(self.gone, _mixed(hashes[back].astype(np.uint64)))]
            hashes = hashes[~back]
        at = 0
        while at < len(hashes):
            table = self.tables[-1]
            free = int(table.size * self.fill) - self.counts[-1]
            if free <= 0:
                self.tables.append(np.zeros((len(table) * 2, self.SLOTS), np.uint16))
                self.counts.append(0)
                continue
            part = hashes[at : at + free]
            self._place(_mixed(part.astype(np.uint64)))
            at += len(part)

    def _place(self, h: np.ndarray) -> None:
        table, level = self.tables[-1], len(self.tables) - 1
        self.counts[-1] += len(h)
        f = self._fingerprint(h)
        bucket, other = self._buckets(h, f, len(table))
        for turn in range(2 + self.kicks):
            # One key a bucket and round: the first that asks for it.
            _, asks = np.unique(bucket, return_index=True)
            rows = table[bucket[asks]]
            empty = rows == 0
            room = empty.any(1)
            put = asks[room]
            table[bucket[put], empty[room].argmax(1)] = f[put]
            left = np.ones(len(f), bool)
            left[put] = False
            if turn >= 2:  # evict where both buckets were full
                full = asks[~room]
                slot = self.random.integers(0, self.SLOTS, len(full))
                victims = table[bucket[full], slot].copy()
                table[bucket[full], slot] = f[full]
                f[full] = victims
                other[full] = self._other(bucket[full], victims, len(table))
                bucket[full], other[full] = other[full], bucket[full]
            f, bucket, other = f[left], bucket[left], other[left]
            if turn < 2:
                bucket, other = other, bucket
            if not len(f):
                return
        # Saturated: what is left goes to the stash, and the table counts as full.
        for b, x in zip(bucket, f):
            key = self._stashed(level, int(b), int(x))
            self.stash[key] = self.stash.get(key, 0) + 1
        self.counts[-1] = max(self.counts[-1], int(table.size * self.fill))

    def remove(self, hashes: np.ndarray) -> np.ndarray:
        """Takes out keys that were added; says for which there was a fingerprint.  A key given twice is taken out once."""
        h, first = np.unique(_mixed(hashes.astype(np.uint64)), return_index=True)
        f = self._fingerprint(h)
        places = [self._buckets(h, f, len(table)) for table in self.tables]
        have = np.zeros((len(self.tables), len(h)), bool)
        for level, (table, (a, b)) in enumerate(zip(self.tables, places)):
            have[level] = (table[a] == f[:, None]).any(1) | (table[b] == f[:, None]).any(1)
            if self.stash:
                have[level] |= np.array([self._key_in_stash(level, *x) is not None for x in zip(a.tolist(), b.tolist(), f.tolist())], bool)
        here = have.any(0) & ~np.isin(h, self.gone)
        unclear = here & (have.sum(0) > 1)
        left = np.flatnonzero(here & ~unclear)
        while len(left):
            level = have[:, left].argmax(0)
            again = []
            for n, table in enumerate(self.tables):
                mine = left[level == n]
                a, b = places[n][0][mine], places[n][1][mine]
                rows = np.concatenate([table[a], table[b]], axis=1) == f[mine][:, None]
                slot = rows.argmax(1)
                cell = np.where(slot < self.SLOTS, a * self.SLOTS + slot, b * self.SLOTS + slot - self.SLOTS)
                there = rows.any(1)
                _, one = np.unique(cell[there], return_index=True)  # two keys may ask for one slot
                done = np.flatnonzero(there)[one]
                table.ravel()[cell[done]] = 0
                self.counts[n] -= len(done)
                for k in np.flatnonzero(~there):  # in the stash, or taken out for another of the same fingerprint
                    key = self._key_in_stash(n, int(a[k]), int(b[k]), int(f[mine[k]]))
                    if key is not None:
                        self.stash[key] -= 1
                        if not self.stash[key]:
                            del self.stash[key]
                waiting = there.copy()
                waiting[done] = False
                again.append(mine[waiting])
            left = np.concatenate(again)
        self.gone = np.union1d(self.gone, h[unclear])
        out = np.zeros(len(hashes), bool)
        out[first] = here
        return out

    def _key_in_stash(self, level: int, a: int, b: int, f: int) -> int | None:
        return next((k for k in (self._stashed(level, a, f), self._stashed(level, b, f)) if k in self.stash), None)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        stash = np.array(list(self.stash.items()), np.int64).reshape(-1, 2)
        np.savez_compressed(out, counts=np.array(self.counts), stash=stash, gone=self.gone, **{f"table{n}": t for n, t in enumerate(self.tables)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooTable:
        table = cls(1)
        with np.load(io.BytesIO(data), allow_pickle=False) as held:
            table.counts, table.stash, table.gone = held["counts"].tolist(), dict(held["stash"].tolist()), held["gone"]
            table.tables = [held[f"table{n}"].copy() for n in range(len(table.counts))]
        return table

    def __len__(self) -> int:
        return sum(int((t != 0).sum()) for t in self.tables) + sum(self.stash.values()) - len(self.gone)


#: Rows of a block, within which a key is frequent that has one in HOT_SLICES of them and this many at least: all
#: others together send a table no more rows of one key than that.
BLOCK_ROWS, LEAST_FREQUENT = 1_000_000, 64
_KEYS = "code tinyint, row_id bigint, h1 bigint, h2 bigint, route bigint, behind boolean"
_SEEN = "code tinyint, row_id bigint, h1 bigint, h2 bigint, behind boolean, flagged boolean"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Routes rows to their key's table; of keys frequent in a block all but the first stay ``behind`` it."""
    kept: list[pa.RecordBatch] = []
    rows = 0

    def flush() -> pa.RecordBatch:
        code, row, h1, h2 = (np.concatenate([b.column(i).to_numpy() for b in kept]) for i in range(4))
        order = np.lexsort((row, h2, h1))
        new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))
        sizes = np.diff(np.append(np.flatnonzero(new), len(order)))
        behind = np.zeros(len(row), bool)
        behind[order] = ~new & np.repeat(sizes >= max(LEAST_FREQUENT, -(-len(row) // HOT_SLICES)), sizes)
        route = np.where(behind, _mixed(row.astype(np.uint64)).astype(np.int64), h1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (code, row, h1, h2, route, behind)], _names(_KEYS))

    for batch in batches:
        kept.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield flush()
            kept, rows = [], 0
    if rows:
        yield flush()


def _ask(table: CuckooTable, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The table's answers for rows in order; new keys are added as they come."""
    key = _mixed(h1.view(np.uint64) ^ (h2.view(np.uint64) * _MIX))
    _, first = np.unique(key, return_index=True)  # the earliest row of each
    seen = table.contains(key[first])
    table.add(key[first][~seen])
    answers = table.contains(key)
    answers[first] = seen
    return answers


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition's keys in row order against its cuckoo table."""
    table = CuckooTable()
    for batch in batches:
        code, row, h1, h2, _, behind = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        flagged = behind.astype(bool)
        asked = np.flatnonzero(~flagged)
        flagged[asked] = _ask(table, h1[asked], h2[asked])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (code, row, h1, h2, behind.astype(bool), flagged)], _names(_SEEN))


def hashed_keys(keys: DataFrame) -> DataFrame:
    """``code, row_id, h1, h2`` of ``code TINYINT, row_id BIGINT, value STRING``; null and empty values and null ids are left out."""
    return keys.filter((F.col("value") != "") & F.col("row_id").isNotNull()).select(
        F.col("code").cast("tinyint").alias("code"),
        F.col("row_id").cast("bigint").alias("row_id"),
        F.xxhash64("code", "value").alias("h1"),
        F.xxhash64(F.lit("second"), "value", "code").alias("h2"),
    )


def mark_seen(keys: DataFrame) -> DataFrame:
    """Answers of the cuckoo tables for ``code TINYINT, row_id BIGINT, value STRING``.

    Result: ``code, row_id, h1, h2, behind, flagged``; ``flagged`` is the
    table's answer, given for a row itself or, where ``behind``, with the
    first row of its key in its block.  Order is by ``row_id`` within
    ``code``.  Null and empty values are no keys, rows with a null id have no
    place in the order; both give no row; an empty input gives an empty result;
    two rows with one id and one value count as the first and its repeat.
    """
    return hashed_keys(keys).mapInArrow(_spread, _KEYS).repartition("route").sortWithinPartitions("row_id").mapInArrow(_walk, _SEEN)


def false_alarms(marked: DataFrame) -> DataFrame:
    """``code, row_id`` of the rows :func:`mark_seen` flagged though they are the first of their key.

    A key's first row is either the one its table didn't flag or, as a table
    never misses a key it holds, the earliest of those it did.  So flagged keys
    alone are looked up, one row each, among the rows that weren't flagged, of
    which a key has one at most.
    """
    asked = marked.filter("NOT behind")
    flagged = asked.filter("flagged").groupBy("code", "h1", "h2").agg(F.min("row_id").alias("row_id"))
    first = asked.filter("NOT flagged").select("h1", "h2").join(flagged.select("h1", "h2"), ["h1", "h2"])
    return flagged.join(first, ["h1", "h2"], "left_anti").select("code", "row_id")


def seen_before(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact ``code, row_id`` of repeated values, and the tables' audit by ``code``.

    Rows the tables flag are published but for the false alarms among them.
    Audit columns: ``rows``, of them ``asked`` one by one and ``behind`` a
    frequent key's first; ``flagged`` of those asked, ``false_alarms``,
    ``missed`` (by an exact count of distinct keys, apart from the tables) and
    ``wrong_share``, wrong answers in those asked.
    """
    marked = materialise(mark_seen(keys), "seen")
    wrong = materialise(false_alarms(marked), "false_alarms")
    found = marked.filter("flagged").select("code", "row_id", "behind")
    found = found.join(wrong.withColumn("behind", F.lit(False)), ["code", "row_id", "behind"], "left_anti").select("code", "row_id")
    sums = marked.groupBy("code").agg(
        F.count("*").alias("rows"), F.count_if(~F.col("behind")).alias("asked"), F.count_if("behind").alias("behind"),
        F.count_if(F.col("flagged") & ~F.col("behind")).alias("flagged"),
    )
    distinct = marked.groupBy("code", "h1", "h2").agg(F.lit(1)).groupBy("code").agg(F.count("*").alias("_keys"))
    alarms = wrong.groupBy("code").agg(F.count("*").alias("false_alarms"))
    audit = sums.join(distinct, "code").join(alarms, "code", "left").withColumn("false_alarms", F.coalesce("false_alarms", F.lit(0)))
    audit = audit.withColumn("missed", F.col("rows") - F.col("_keys") - (F.col("flagged") + F.col("behind") - F.col("false_alarms")))
    audit = audit.withColumn("wrong_share", (F.col("false_alarms") + F.col("missed")) / F.col("asked"))
    return found, audit.select("code", "rows", "asked", "behind", "flagged", "false_alarms", "missed", "wrong_share")


# Tables kept between batches

#: Tables a state has, fixed when its first batch comes.
PARTS = 256
_STATE = "part int, table binary"
_ANSWERS = "part int, code tinyint, row_id bigint, h1 bigint, h2 bigint, behind boolean, flagged boolean, table binary"


def _with_state(forget: bool):
    """Rows of several parts, each part's table first and then its rows in order: answers, and at a part's end its new table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, table = -1, CuckooTable()
        kinds = (pa.int32(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())

        def state() -> pa.RecordBatch:
            values = (part, None, None, None, None, None, None, table.to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], _names(_ANSWERS))

        for batch in batches:
            at = batch.column("part").to_numpy()
            for a, b in zip(edges := np.append(0, np.flatnonzero(np.diff(at)) + 1).tolist(), [*edges[1:], len(at)]):
                rows = batch.slice(a, b - a)
                if at[a] != part:
                    if part >= 0:
                        yield state()
                    part, table = int(at[a]), CuckooTable()
                if (held := rows.column("table")[0].as_py()) is not None:
                    table, rows = CuckooTable.from_bytes(held), rows.slice(1)
                if not rows.num_rows:
                    continue
                h1, h2, behind = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "behind"))
                flagged = behind.astype(bool)
                asked = np.flatnonzero(~flagged)
                if forget:
                    flagged[asked] = table.remove(_mixed(h1[asked].view(np.uint64) ^ (h2[asked].view(np.uint64) * _MIX)))
                else:
                    flagged[asked] = _ask(table, h1[asked], h2[asked])
                yield rows.set_column(rows.schema.get_field_index("flagged"), "flagged", pa.array(flagged))
        if part >= 0:
            yield state()

    return run


def _latest(spark: SparkSession, state: str) -> int | None:
    """Number of the last complete state in a folder; None if there is none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(state)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return None
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    done = [int(n.split("=")[1]) for n in names if n.startswith("state=") and system.exists(jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS"))]
    return max(done, default=None)


def _next_state(keys: DataFrame, state: str, forget: bool) -> DataFrame:
    spark = keys.sparkSession
    last = _latest(spark, state)
    rows = hashed_keys(keys)
    if forget:
        rows = rows.dropDuplicates(["h1", "h2"])
    rows = rows.mapInArrow(_spread, _KEYS).select(
        F.pmod(F.when(F.col("behind"), F.xxhash64("route")).otherwise(F.xxhash64("h1")), F.lit(PARTS)).cast("int").alias("part"),
        "code", "row_id", "h1", "h2", "behind", F.lit(False).alias("flagged"), F.lit(None).cast("binary").alias("table"),
    )
    if last is not None:
        held = spark.read.schema(_STATE).parquet(f"{state}/state={last}")
        rows = rows.unionByName(held, allowMissingColumns=True)
    answers = rows.repartition(PARTS, "part").sortWithinPartitions("part", F.col("table").isNull(), "row_id").mapInArrow(_with_state(forget), _ANSWERS)
    answers = materialise(answers, "answers")
    answers.filter("table IS NOT NULL").select("part", "table").write.mode("overwrite").parquet(f"{state}/state={0 if last is None else last + 1}")
    return answers.filter("table IS NULL").select("code", "row_id", "behind", "flagged")


def seen_in_batch(keys: DataFrame, state: str) -> DataFrame:
    """``code, row_id, flagged``: whether each key occurred in an earlier batch or row, by the tables in the folder ``state``.

    The batch's keys are added to the tables, of which a new generation is
    written; an unfinished one is written again.  Of earlier keys only
    fingerprints are kept, so about 8 / 65536 of the new keys for each filled
    level of their table are flagged wrongly and none is missed (see
    :func:`expected_error`).  Null and empty values and null ids give no row.
    """
    return _next_state(keys, state, False).select("code", "row_id", "flagged")


def forget_keys(keys: DataFrame, state: str) -> DataFrame:
    """``code, row_id, flagged``: takes keys out of the tables in ``state``; ``flagged`` says which were there.

    Only keys that were added may be given, one row each counts.
    """
    return _next_state(keys, state, True).select("code", "row_id", "flagged")


def expected_error(spark: SparkSession, state: str) -> float:
    """Share of new keys that the tables in ``state`` flag wrongly, from how full their buckets are."""
    last = _latest(spark, state)
    if last is None:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [CuckooTable.from_bytes(x) for x in batch.column("table").to_pylist()]
            miss = [np.prod([(1 - 1 / 65535) ** (8 * (t != 0).mean()) for t in x.tables]) for x in tables]
            yield pa.RecordBatch.from_arrays([pa.array([1 - float(m) for m in miss])], ["p"])

    found = spark.read.schema(_STATE).parquet(f"{state}/state={last}").mapInArrow(run, "p double").agg(F.sum("p")).first()[0]
    return (found or 0.0) / PARTS
