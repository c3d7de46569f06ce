"""N-gram Jaccard self-join with set-relation skipping (operator 6).

Documents are sets of word shingles; two link when 100 * |common| >= 85 * |united|. Documents with the same
set are one class. Classes are compared, in steps that each look at all of them:

1. Shingles are counted (by 28 bits of their hash); those that occur more often than a threshold come last in
   one global order, the others before them by hash. The threshold leaves at most 2^22 frequent ones.
2. A class is indexed under its first shingles in that order, as many as guarantee that linked classes
   share one. Lists are sorted by size and position, and what lies in blocks of sizes or positions that
   cannot link is skipped. Pairs of what remains are screened by parity bitmaps as long as the sets, which never
   differ more than the sets do. Lists longer than the threshold make no pairs: neighbours in size are put in one family.
3. Families (components of these candidates) are compared set by set. The common shingles of the first set with
   all others are counted from the family's lists; every further set's counts are derived from those of the set most
   similar to it, by the lists of shingles in which the two differ. Large families are cut in chunks, of
   which every two meet in one task.
4. Links that join something new in their task go to the components, whose least document id names a class.

Sets are compared by 64-bit hashes of shingles and classes by a 64-bit digest. Nothing is dropped, capped or
sampled: frequent shingles only come later in the order, long lists are compared within families.

Cases: a text of any length is one set, read whole in one task; documents exactly on the limit link, and of equal sets one stands for all; a null or blank text has an empty set and links with nothing; fewer words than a shingle make one
shingle; repeated rows and ids are kept, each row with its class; a null id never names a component unless all
of its ids are null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm.components import components
from newsloom.llm.registry import query, table
from newsloom.llm.shingles import digest, shingle_sets
from newsloom.llm.tokens import slices
from newsloom.operators.joins import lookup_join, skew_join
from newsloom.session import stored

WIDTH = 4
SHARE = 85
KEY_BITS = 28
RANGES = 1024
MOST_FREQUENT = 1 << 22
LEAST_FREQUENT = 32
FLUSH = 1 << 21
CHUNK_SETS = 4096
CHUNK_SHINGLES = 1 << 20
LEAST_BITS = 512
ROWS = "doc_id bigint, n bigint, set_id bigint, text_hash bigint, bitmap binary"
COUNTS = "range int, keys binary, more binary"


def keys_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - KEY_BITS)).astype(np.uint32)


def pack_keys(keys: np.ndarray, base: int) -> bytes:
    """Ascending distinct keys as steps of one byte; 255 means that the step goes on."""
    steps = np.diff(keys.astype(np.int64), prepend=base)
    long = steps // 255
    out = np.full(int(long.sum()) + len(steps), 255, np.uint8)
    out[np.cumsum(long + 1) - 1] = steps % 255
    return out.tobytes()


def unpack_keys(packed: bytes, base: int) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8)
    return (base + np.cumsum(steps, dtype=np.int64))[steps != 255]


def _counted(keys: list[np.ndarray]) -> Iterator[tuple[int, bytes, bytes]]:
    """(range, keys, positions and numbers of keys met more than once) of the shingles of many documents."""
    found, n = np.unique(np.concatenate(keys), return_counts=True)
    width = 1 << KEY_BITS >> RANGES.bit_length() - 1
    cuts = np.searchsorted(found, np.arange(RANGES + 1, dtype=np.int64) * width)
    for r in range(RANGES):
        a, b = cuts[r], cuts[r + 1]
        if b > a:
            often = np.flatnonzero(n[a:b] > 1)
            yield r, pack_keys(found[a:b], r * width), np.stack([often, n[a:b][often]]).astype(np.uint32).tobytes()


def bitmap(shingles: np.ndarray) -> bytes:
    """For each group of shingles, of which there are at least as many as shingles, whether an odd number is in the set."""
    bits = max(LEAST_BITS, 1 << int(len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def difference(one: bytes, two: bytes) -> int:
    """In how many groups two bitmaps differ, at most as many as the sets' shingles that only one of them has."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    # Groups of the longer one are parts of those of the shorter.
    folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), 0)
    return int(np.bitwise_count(folded ^ b).sum())


def describe_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of two kinds: per document its set's size, digest and bitmap; per task and range its counts of shingles."""
    schema = ROWS + ", " + COUNTS
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def counts(keys: list[np.ndarray]) -> pa.RecordBatch:
        rows = list(zip(*_counted(keys)))
        empty = [pa.nulls(len(rows[0]), k) for k in kinds[:-3]]
        return pa.RecordBatch.from_arrays([*empty, *[pa.array(v, k) for v, k in zip(rows, kinds[-3:])]], names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = [], 0
        for big in batches:
            for batch in slices(big, 1024):
                n, ids, bits = [], [], []
                for _, own in shingle_sets(batch.column("text"), width):
                    n.append(len(own))
                    ids.append(digest(own) if len(own) else None)
                    bits.append(bitmap(own))
                    if len(own):
                        keys.append(keys_of(own))
                        held += len(own)
                    if held >= FLUSH:
                        yield counts(keys)
                        keys, held = [], 0
                columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.int64()), batch.column("text_hash"), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(n), k) for k in kinds[-3:]]], names)
        if held:
            yield counts(keys)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(describe, schema)


class Frequent:
    """The frequent keys with their counts; at most MOST_FREQUENT."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.level = keys, (1 + np.log2(np.maximum(1, counts))).astype(np.int8)
        self.coarse = np.zeros(1 << 24, bool)
        self.coarse[keys >> np.uint32(KEY_BITS - 24)] = True

    def levels(self, shingles: np.ndarray) -> np.ndarray:
        """0 for shingles that are not frequent, else more for those that occur more often."""
        keys, out = keys_of(shingles), np.zeros(len(shingles), np.int8)
        maybe = np.flatnonzero(self.coarse[keys >> np.uint32(KEY_BITS - 24)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == keys[maybe]
            out[maybe[hit]] = self.level[at[hit]]
        return out


def frequent_shingles(described: DataFrame, threshold: int) -> Frequent:
    """Keys that occur at least `threshold` times, summed by range of keys."""
    width = 1 << KEY_BITS >> RANGES.bit_length() - 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def found() -> pa.RecordBatch:
            keys = np.flatnonzero(total >= threshold)
            return pa.RecordBatch.from_arrays([pa.array([(at * width + keys).astype(np.uint32).tobytes()]), pa.array([total[keys].tobytes()])], ["keys", "counts"])

        for batch in batches:
            for r, keys, more in zip(*[batch.column(c).to_pylist() for c in ("range", "keys", "more")]):
                if r != at:
                    if at is not None:
                        yield found()
                    at, total = r, np.zeros(width, np.int64)
                own = unpack_keys(keys, 0)
                total[own] += 1
                often = np.frombuffer(more, np.uint32).reshape(2, -1)
                total[own[often[0]]] += often[1] - 1
        if at is not None:
            yield found()

    counts = described.where(F.col("range").isNotNull()).select("range", "keys", "more")
    rows = counts.repartition("range").sortWithinPartitions("range").mapInArrow(add, "keys binary, counts binary").collect()
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint32) for r in rows] or [np.zeros(0, np.uint32)])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    order = np.argsort(keys)
    return Frequent(keys[order], counts[order])


def least_common(total, share: int = SHARE):
    """Common shingles that two sets of `total` together need."""
    return -(-share * total // (100 + share))


def postings(docs: DataFrame, frequent: Frequent, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """(shingle, n, place, set_id): every class under its first shingles in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_frequent, met = shared.value, set()
        for big in batches:
            for batch in slices(big, 1024):
                parts, sizes, firsts, ids = [], [], [], []
                for _, own in shingle_sets(batch.column("text"), width):
                    n = len(own)
                    if not n or (name := digest(own)) in met:
                        continue
                    met.add(name)
                    first = n + (-share * n // 100) + 1
                    levels = own_frequent.levels(own)
                    parts.append((own[np.argsort(levels, kind="stable")] if levels.any() else own)[:first])
                    sizes.append(n)
                    firsts.append(first)
                    ids.append(name)
                if parts:
                    place = np.concatenate([np.arange(f) for f in firsts])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(sizes, firsts).astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(np.repeat(np.array(ids, np.int64), firsts))],
                        ["shingle", "n", "place", "set_id"],
                    )

    return docs.select("text").mapInArrow(index, "shingle bigint, n int, place int, set_id bigint")


def candidates(indexed: DataFrame, longest: int, share: int = SHARE) -> DataFrame:
    """(a, b, same_family): pairs of short lists that may link, and neighbours in long ones."""

    def pairs_of(shingle, n, place, ids):
        """Index pairs inside of lists, by distance; blocks of sizes end the search, positions screen it."""
        at, out = np.arange(len(ids)), []
        for distance in range(1, len(ids)):
            at = at[at + distance < len(ids)]
            to = at + distance
            # Sizes ascend inside a list: once one is too large, so is all behind it.
            at = at[(shingle[at] == shingle[to]) & (100 * n[at] >= share * n[to])]
            if not len(at):
                break
            to = at + distance
            left = 1 + np.minimum(n[at] - place[at], n[to] - place[to]) - 1
            ok = left >= least_common(n[at] + n[to], share)
            out.append(np.stack([ids[at[ok]], ids[to[ok]]]))
        return np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)

    def result(pairs: np.ndarray, same: bool) -> pa.RecordBatch:
        low, high = pairs.min(0), pairs.max(0)
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(np.full(len(low), same))], ["a", "b", "same_family"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)
        long_list = False  # the list that `held` begins with was already found to be long
        for last, batch in _with_last(batches):
            if batch is not None:
                held = np.concatenate([held, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("shingle", "n", "place", "set_id")])], 1)
            if not held.shape[1] or (not last and held.shape[1] < 1 << 18):
                continue
            # The same class may come from several tasks.
            new = np.ones(held.shape[1], bool)
            new[1:] = (held[0, 1:] != held[0, :-1]) | (held[3, 1:] != held[3, :-1])
            shingle, n, place, ids = held[:, new]
            start = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            size = np.diff(np.append(start, len(shingle)))
            is_long = size > longest
            is_long[0] |= long_list
            open_from = len(shingle) if last else start[-1]
            if not last and is_long[-1]:
                open_from = len(shingle) - 1
            of_long = np.repeat(is_long, size)
            near = np.flatnonzero(of_long[1:] & (shingle[1:] == shingle[:-1]) & (100 * n[:-1] >= share * n[1:]))
            if len(near):
                yield result(np.stack([ids[near], ids[near + 1]]), True)
            short = ~of_long
            short[open_from:] = False
            several = np.repeat(size > 1, size) & short
            if several.any():
                found = np.unique(pairs_of(shingle[several], n[several], place[several], ids[several]), axis=1)
                if found.shape[1]:
                    yield result(found, False)
            long_list = bool(not last and is_long[-1])
            held = np.stack([shingle, n, place, ids])[:, open_from:]

    in_lists = indexed.repartition("shingle").sortWithinPartitions("shingle", "n", "place", "set_id")
    return in_lists.mapInArrow(scan, "a bigint, b bigint, same_family boolean").distinct()


def _with_last(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield False, batch
    yield True, None


def screened(pairs: DataFrame, classes: DataFrame, share: int = SHARE) -> DataFrame:
    """The pairs whose bitmaps differ no more than linked sets of their sizes may."""

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            most = total - 2 * least_common(total, share)
            differ = [difference(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("bitmap_a"), batch.column("bitmap_b"))]
            near = pa.array(np.array(differ, np.int64) <= most)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])

    side = lambda s: classes.select(F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bitmap").alias(f"bitmap_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(screen, "a bigint, b bigint")


def compare_family(sets: list[np.ndarray], sides: np.ndarray, share: int = SHARE) -> list[tuple[int, int]]:
    """Links (i, j) between sets of one family that join all that is linked; of two sides only links across count.

    Counts of a set's common shingles with all others are derived from those of the set most similar to it.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    distinct, first = np.unique(flat[order], return_index=True)
    ends = np.append(first[1:], len(flat))
    holders = owner[order]
    # A shingle only one set has adds to no count but its own set's.
    code = np.empty(len(flat), np.int64)
    code[order] = np.repeat(np.arange(len(distinct)), ends - first)
    several = (ends - first)[code] > 1
    bounds = np.append(0, np.cumsum(size))
    coded = [c[s] for c, s in ((code[bounds[i] : bounds[i + 1]], several[bounds[i] : bounds[i + 1]]) for i in range(m))]

    def counts(codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(m, np.int64)
        lengths = ends[codes] - first[codes]
        at = np.repeat(first[codes] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return np.bincount(holders[at], minlength=m)

    group, links = np.arange(m), []
    across = len(np.unique(sides)) > 1
    waiting = np.ones(m, bool)
    now, common = 0, counts(coded[0])
    while True:
        waiting[now] = False
        linked = 100 * common >= share * (size + size[now] - common)
        linked[now] = False
        if across:
            linked &= sides != sides[now]
        for other in np.flatnonzero(linked & (group != group[now])).tolist():
            if group[other] != group[now]:
                links.append((now, other))
                group[group == group[other]] = group[now]
        if not waiting.any():
            return links
        likeness = np.where(waiting, common / (size + size[now] - common), -1.0)
        then = int(likeness.argmax())
        gone = np.setdiff1d(coded[now], coded[then], assume_unique=True)
        come = np.setdiff1d(coded[then], coded[now], assume_unique=True)
        if len(gone) + len(come) < len(coded[then]):
            common = common - counts(gone) + counts(come)
        else:
            common = counts(coded[then])
        now = then


def verified_links(docs: DataFrame, members: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """(a, b) links between classes of the same family, from `members` (family, set_id, n, text_hash)."""
    sizes = members.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    chunks = F.greatest(F.ceil(F.col("sets") / CHUNK_SETS), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    chunk = F.pmod(F.xxhash64(F.lit(6), "set_id"), F.col("chunks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(F.least(o, F.col("chunk")).alias("one"), F.greatest(o, F.col("chunk")).alias("two")))
    tasks = members.join(sizes.select("family", chunks.alias("chunks")), "family").withColumn("chunk", chunk).select("family", "set_id", "text_hash", "chunk", F.inline(others))
    wanted = stored(tasks, "family-tasks")
    keys = wanted.select("text_hash").distinct()
    texts = lookup_join(docs.select("text", F.xxhash64("text").alias("text_hash")), stored(keys, "family-texts"), ["text_hash"], ["text_hash"], "inner")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for big in batches:
            for batch in slices(big, 256):
                names, packed, hashes = [], [], batch.column("text_hash").to_pylist()
                rows = []
                for row, own in shingle_sets(batch.column("text"), width):
                    if len(own) and (name := digest(own)) not in met:
                        met.add(name)
                        rows.append(hashes[row])
                        names.append(name)
                        packed.append(own.tobytes())
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["set_id", "shingles"])

    sets = texts.select("text", "text_hash").mapInArrow(read, "set_id bigint, shingles binary")

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        ids = np.asarray(group.column("set_id"))
        _, keep = np.unique(ids, return_index=True)
        group, ids = group.take(pa.array(keep)), ids[keep]
        shingles = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        links = compare_family(shingles, np.asarray(group.column("chunk")), share) if len(ids) > 1 else []
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    tasks = wanted.select("family", "set_id", "chunk", "one", "two")
    grouped = lookup_join(sets, tasks, ["set_id"], ["set_id"], "inner").select("family", "one", "two", "chunk", "set_id", "shingles")
    return grouped.groupBy("family", "one", "two").applyInArrow(compare, "a bigint, b bigint")


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per class of `rows` (doc_id, n, set_id, text_hash, bitmap)."""
    return rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.min("n").alias("n"), F.min("text_hash").alias("text_hash"), F.min("bitmap").alias("bitmap"))


def linked_documents(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """(doc_id, n, set_id, text_hash, root, component_id) per row of `docs` (doc_id, text).

    `root` names the component also where ids are null or shared; it is null, like the sets of rows without a shingle are empty.
    """
    docs = docs.select("doc_id", "text")
    described = stored(describe_sets(docs, width), "sets")
    rows = described.where(F.col("range").isNull())
    total = rows.agg(F.sum("n").alias("n")).first()["n"] or 0
    threshold = max(LEAST_FREQUENT, -(-total // MOST_FREQUENT))
    frequent = frequent_shingles(described, threshold)
    classes = stored(classes_of(rows), "classes")
    found = stored(candidates(postings(docs, frequent, width, share), threshold, share), "candidates")
    likely = screened(found.where("not same_family").select("a", "b"), classes, share)
    families = components(likely.unionAll(found.where("same_family").select("a", "b")))
    members = families.select(F.col("node").alias("set_id"), F.col("root").alias("family")).join(classes.select("set_id", "n", "text_hash"), "set_id")
    groups = components(verified_links(docs, stored(members, "members"), width, share))
    rooted = classes.select("set_id", "first_id").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_class = rooted.join(named, "root").select("set_id", "root", "component_id")
    joined = skew_join(rows.select("doc_id", "n", "set_id", "text_hash"), by_class, ["set_id"], ["doc_id"])
    return joined.withColumn("component_id", F.coalesce("component_id", "doc_id"))


@query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = linked_documents(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
