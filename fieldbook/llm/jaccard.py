"""Similarity join on word shingles: a size-aware heavy-light join, and its connected components.

Texts are linked if the Jaccard similarity of their sets of 5-word shingles is 3/4 or more.

1. Shingles of a single text link nothing. Tasks hash the shingles of a batch of texts and send them, packed,
   to buckets by hash; a bucket finds those that occur again. A text of which fewer than 3/4 of the
   shingles occur elsewhere has no partner.
2. Equal sets become one node. The shingles left are counted again among nodes, exactly.
3. Light nodes, of few shingles, enumerate the subsets of just the size that a partner of each size must
   share; a common subset is a link, so no pair needs a check.
4. Heavy nodes scan inverted lists, of each node's rarest quarter of shingles, which two linked nodes must
   share one of. Lists link through a hub first; then members of different components meet.
5. The size up to which nodes are light is the one with the lowest count of subsets and list entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.components import components
from fieldbook.llm.tables import Scratch, maybe_among, partitions
from fieldbook.llm.words import BLANKS, Splitter, mixed, pieces

SHINGLE = 5
MOST_LIGHT = 14
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; a shorter text has one, of all its words."""
    words = Splitter(BLANKS)(texts)
    keys, first = words.key, words.first
    rolled = keys[:max(0, len(keys) - width + 1)].copy()
    for k in range(1, width):
        rolled = rolled * _STEP + keys[k:len(rolled) + k]
    rolled = mixed(rolled)
    sets = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= width:
            sets.append(np.unique(rolled[a:z - width + 1]))
        elif z > a:
            short = np.uint64(z - a)
            for key in keys[a:z]:
                short = np.uint64((int(short) * int(_STEP) + int(key)) & 0xFFFFFFFFFFFFFFFF)
            sets.append(mixed(np.array([short ^ np.uint64(0x5555555555555555)])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


PACKED = "bucket int, chunk bigint, keys binary, counts binary, info binary"


def _packed(sets: list[np.ndarray], info: bytes, chunk: int, buckets: int, short: bool) -> Iterator[pa.RecordBatch]:
    """The sets' hashes by bucket: in a row, those of all sets in turn, and how many each set has."""
    sizes = np.array([len(s) for s in sets])
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), sizes)
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
    keys, of, bucket = keys[order], of[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = {"bucket": [], "chunk": [], "keys": [], "counts": [], "info": []}
    for b in range(buckets):
        a, z = cuts[b], cuts[b + 1]
        own = b == chunk % buckets
        if a == z and not own:
            continue
        part = keys[a:z]
        rows["bucket"].append(b)
        rows["chunk"].append(chunk)
        rows["keys"].append(((part >> np.uint64(32)).astype(np.uint32) if short else part).tobytes())
        rows["counts"].append(np.bincount(of[a:z], minlength=len(sets)).astype(np.uint32).tobytes())
        rows["info"].append(info if own else None)
    kinds = {"bucket": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "counts": pa.binary(), "info": pa.binary()}
    yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in rows.items()})


def _times(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.empty(len(keys), np.uint32)
    times[order] = np.repeat(np.diff(np.concatenate([starts, [len(keys)]])), np.diff(np.concatenate([starts, [len(keys)]])))
    return times


def _views(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _recurring(group: pa.Table) -> pa.Table:
    """Per row, how many of each set's hashes occur in another set of the bucket."""
    keys = _views(group["keys"], np.uint32)
    counts = _views(group["counts"], np.uint32)
    again = (_times(np.concatenate(keys)) > 1).astype(np.int64)
    at, out = 0, []
    for k, c in zip(keys, counts):
        sums = np.concatenate([[0], np.cumsum(again[at:at + len(k)])])
        edges = np.concatenate([[0], np.cumsum(c.astype(np.int64))])
        out.append(np.diff(sums[edges]).astype(np.uint32).tobytes())
        at += len(k)
    return pa.table({"chunk": group["chunk"], "shared": pa.array(out, pa.binary()), "info": group["info"]})


def _counted(group: pa.Table) -> pa.Table:
    """Per row, how many sets have each of its hashes."""
    keys = _views(group["keys"], np.uint64)
    times = _times(np.concatenate(keys))
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return pa.table({
        "chunk": group["chunk"], "keys": group["keys"], "counts": group["counts"],
        "times": pa.array([t.tobytes() for t in np.split(times, cuts)], pa.binary()), "info": group["info"],
    })


def _buffer(arrays: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(arrays)
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _info(group: pa.Table) -> pa.Table:
    return pa.ipc.open_stream(next(x for x in group["info"].to_pylist() if x is not None)).read_all()


def profiles(docs: DataFrame, buckets: int) -> DataFrame:
    """Per row: doc_id, key (hash of the text), n shingles, how many occur in another row, digest of the set.

    ``docs`` must give the same rows in the same order when a task is repeated, as files do. A hash is sent
    with 32 bits beyond its bucket; a chance agreement counts one shingle too many as shared, which
    keeps a text for the exact steps and loses none. A bucket holds its share of all hashes, a
    frequent one once a text, so ``buckets`` must grow with the input.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, n in pieces(batch.column("text")):
                sets = shingle_sets(batch.column("text").slice(a, n))
                info = _buffer({
                    "doc_id": batch.column("doc_id").slice(a, n), "key": batch.column("key").slice(a, n),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                })
                yield from _packed(sets, info, chunk, buckets, True)
                chunk += 1

    def gather(group: pa.Table) -> pa.Table:
        info = _info(group)
        shared = sum(x.astype(np.int64) for x in _views(group["shared"], np.uint32))
        return info.append_column("shared", pa.array(shared, pa.int64()))

    packed = rows.mapInArrow(pack, PACKED)
    found = packed.groupBy("bucket").applyInArrow(_recurring, "chunk bigint, shared binary, info binary")
    return found.groupBy("chunk").applyInArrow(gather, "doc_id bigint, key bigint, n bigint, digest binary, shared bigint")


ORDERED = (
    "node bigint, n bigint, common bigint, hashes array<bigint>, tokens array<bigint>, places array<bigint>, scan bigint, weight bigint"
)


def _ordered(sets: DataFrame, buckets: int) -> DataFrame:
    """Per node: n, how many hashes others have, its hashes from rare to frequent, its list entries, and sums.

    An entry is a hash of the rarest quarter that others have, with its place in the order. ``scan`` adds
    up the lists' lengths, ``weight`` the occurrences of all hashes. Nodes that cannot have a partner
    are left out.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, n in pieces(batch.column("hashes")):
                part = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("hashes").slice(a, n)]
                yield from _packed(part, _buffer({"node": batch.column("node").slice(a, n)}), chunk, buckets, False)
                chunk += 1

    def gather(group: pa.Table) -> pa.Table:
        nodes = _info(group)["node"].to_numpy()
        counts = _views(group["counts"], np.uint32)
        of = np.concatenate([np.repeat(np.arange(len(nodes)), c) for c in counts])
        keys, times = np.concatenate(_views(group["keys"], np.uint64)), np.concatenate(_views(group["times"], np.uint32))
        order = np.lexsort((keys, times, of))
        of, keys, times = of[order], keys[order].view(np.int64), times[order]
        edges = np.searchsorted(of, np.arange(len(nodes) + 1))
        out = {"node": [], "n": [], "common": [], "hashes": [], "tokens": [], "places": [], "scan": [], "weight": []}
        for k, (a, z) in enumerate(zip(edges[:-1], edges[1:])):
            n, common = int(z - a), int((times[a:z] > 1).sum())
            if 4 * common < 3 * n:
                continue
            first = slice(a, a + n - (3 * n + 3) // 4 + 1)
            listed = times[first] > 1
            out["node"].append(int(nodes[k]))
            out["n"].append(n)
            out["common"].append(common)
            out["hashes"].append(keys[a:z])
            out["tokens"].append(keys[first][listed])
            out["places"].append(np.flatnonzero(listed))
            out["scan"].append(int(times[first][listed].sum()))
            out["weight"].append(int(times[a:z].astype(np.int64).sum()))
        kinds = {c: pa.list_(pa.int64()) if c in ("hashes", "tokens", "places") else pa.int64() for c in out}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    packed = sets.mapInArrow(pack, PACKED)
    counted = packed.groupBy("bucket").applyInArrow(_counted, "chunk bigint, keys binary, counts binary, times binary, info binary")
    return counted.groupBy("chunk").applyInArrow(gather, ORDERED)


def needed(a: int, b: int) -> int:
    """Common elements that sets of sizes a and b need for a similarity of 3/4."""
    return -(-3 * (a + b) // 7)


def partner_sizes(n: int, most: int) -> range:
    return range((3 * n + 3) // 4, min(most, 4 * n // 3) + 1)


def light_cost(n: int, most: int) -> int:
    return sum(comb(n, needed(n, size)) for size in partner_sizes(n, most))


def boundary(sizes: dict[int, tuple[int, int]]) -> int:
    """The size up to which nodes are light, from nodes and list entries by size (sizes up to MOST_LIGHT)."""
    def cost(most: int) -> int:
        subsets = sum(count * light_cost(n, most) for n, (count, _) in sizes.items() if n <= most)
        return subsets + sum(entries for n, (_, entries) in sizes.items() if 4 * n >= 3 * (most + 1))

    return min(range(MOST_LIGHT + 1), key=cost)


def light_links(sets: DataFrame, most: int) -> DataFrame:
    """Links ``low`` - ``high`` that join all light nodes with a common subset of the size they need."""
    @F.arrow_udf("array<struct<subset:binary, same:boolean>>")
    def subsets(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("subset", pa.binary()), ("same", pa.bool_())]))
        for part in parts:
            out = []
            for hashes in part.to_pylist():
                n, found = len(hashes), []
                for size in partner_sizes(n, most):
                    name = bytes([min(n, size), max(n, size)])
                    for chosen in combinations(sorted(hashes), needed(n, size)):
                        digest = xxhash.xxh3_128_digest(name + np.array(chosen, np.int64).tobytes())
                        found.append({"subset": digest, "same": size == n})
                out.append(found)
            yield pa.array(out, kind)

    small = sets.where(F.col("n") <= most)
    entries = small.select("node", "n", F.explode(subsets("hashes")).alias("s")).select("node", "n", "s.subset", "s.same")
    hubs = (
        entries.groupBy("subset").agg(F.min("node").alias("low"), F.max("node").alias("last"), F.min("n").alias("short"), F.max("n").alias("long"), F.first("same").alias("same"))
        .where("low < last and (same or short < long)").select("subset", "low")
    )
    return entries.join(hubs, "subset").where("node <> low").select("low", F.col("node").alias("high")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links, by the size of the sets' intersection."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("hashes").alias(f"{name}_set"))
    both = pairs.join(side("high"), "high").join(side("low"), "low")
    common = F.size(F.array_intersect("low_set", "high_set"))
    return both.where(7 * common >= 3 * (F.size("low_set") + F.size("high_set"))).select("low", "high")


def _may_link(most: int) -> Column:
    """Whether two entries of a list can be of linked nodes, by what is known without their sets.

    Not both light, not known to be connected, and with room for what they need in common: among the hashes
    that others have, and from this entry's place on. The first hash that two nodes share has nothing
    in common before it, so no link is lost.
    """
    seven = 3 * (F.col("a.n") + F.col("b.n"))
    room = [F.least("a.common", "b.common"), F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"), F.least("a.n", "b.n")]
    return (F.greatest("a.n", "b.n") > most) & (F.col("a.component") != F.col("b.component")) & (7 * F.least(*room) >= seven)


def _pairs() -> list[Column]:
    return [F.least("a.node", "b.node").alias("low"), F.greatest("a.node", "b.node").alias("high")]


def node_components(scratch: Scratch, sets: DataFrame, most: int) -> DataFrame:
    """``node`` and ``component`` of all nodes with a link.

    Lists hold the prefixes. First every list proposes its members to one hub, the one of the commonest
    hashes, which joins large groups of near copies at the cost of one check a member. What is left is exact: in every list with more
    than one component, the members outside the commonest one meet all members of other components.
    So a list costs its length times its outsiders, not its square.
    """
    entries = scratch.put(
        sets.where(4 * F.col("n") >= 3 * (most + 1))
        .select(F.explode(F.arrays_zip("tokens", "places")).alias("e"), "node", "n", "common", "weight")
        .select(F.col("e.tokens").alias("token"), F.col("e.places").alias("place"), "node", "n", "common", "weight"), "entries"
    )
    listed = scratch.put(entries.join(entries.groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "token"), "listed")
    hub = F.max_by(F.struct("node", "n", "common", "place"), F.struct("weight", "node")).alias("hub")
    hubs = listed.groupBy("token").agg(hub).select("token", "hub.*")
    alone = lambda df: df.withColumn("component", F.col("node"))
    met = alone(listed).alias("a").join(alone(hubs).alias("b"), "token").where(_may_link(most)).select(*_pairs())
    tested = scratch.put(met.distinct(), "tested")
    links = scratch.put(_verified(tested, sets).union(light_links(sets, most)), "links")
    stars = scratch.put(components(links), "stars")

    known = listed.join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    shares = known.groupBy("token", "component").agg(F.count("*").alias("members"))
    main = shares.groupBy("token").agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.count("*").alias("components"))
    open_lists = scratch.put(known.join(main.where("components > 1"), "token"), "open")
    outside = open_lists.where("component <> main")
    met = outside.alias("a").join(open_lists.alias("b"), "token").where(_may_link(most)).select(*_pairs())
    rest = scratch.put(met.distinct().join(tested, ["low", "high"], "left_anti"), "rest")
    more = scratch.put(_verified(rest, sets), "more")
    if more.limit(1).count() == 0:
        return stars
    return scratch.put(components(more.union(stars.select(F.col("component").alias("low"), F.col("node").alias("high")))), "joined")


def grouped(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, key (hash of the text), n_shingles, class (node or digest), component_id.

    Columns used: doc_id, text. component_id is the smallest doc_id of all texts reachable by links, and
    null only if all of them lack one. A text without words is linked with nothing: class is null and
    component_id its own doc_id. Rows are the unit, so repeated rows and ids are in one component only
    through their texts. Very long texts are hashed in steps; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    buckets = 2 * partitions(spark)
    rows = scratch.put(profiles(docs, buckets), "profiles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    nodes = rows.where("n > 0").groupBy("digest").agg(first, F.max("n").alias("n"), F.max("shared").alias("shared"))
    nodes = nodes.select("digest", F.col("first.doc_id").alias("first_id"), F.col("first.key").alias("first_key"), "n", "shared")
    near = scratch.put(
        nodes.where("4 * shared >= 3 * n").select("digest", "first_id", "first_key", F.monotonically_increasing_id().alias("node")), "near"
    )
    # Of a node's equal texts any row will do. It is found by doc_id and text: rows without doc_id, or of one, are told apart.
    listed = maybe_among(near, F.xxhash64("first_id", "first_key"))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text").where(listed(F.xxhash64("doc_id", "key")))
    some = some.join(near, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n in pieces(batch.column("text")):
                found = [s.tobytes() for s in shingle_sets(batch.column("text").slice(a, n))]
                right = [len(s) > 0 and xxhash.xxh3_128_digest(s) == d for s, d in zip(found, batch.column("digest").slice(a, n).to_pylist())]
                whole = pa.RecordBatch.from_pydict({"node": batch.column("node").slice(a, n), "hashes": pa.array(found, pa.binary())})
                yield whole.filter(pa.array(right, pa.bool_()))

    sets = some.select("node", "digest", "text").mapInArrow(hashed, "node bigint, hashes binary").dropDuplicates(["node"])
    sets = scratch.put(sets, "raw")
    sets = scratch.put(_ordered(sets, buckets), "sets")
    sizes = sets.where(F.col("n") <= 2 * MOST_LIGHT).groupBy("n").agg(F.count("*"), F.sum("scan")).collect()
    most = boundary({r[0]: (r[1], r[2]) for r in sizes})
    joined = node_components(scratch, sets, most)
    members = scratch.put(joined.join(near, "node").select("digest", "component", "first_id"), "members")
    smallest = members.groupBy("component").agg(F.min("first_id").alias("smallest"))
    classes = members.select("digest", "component").join(smallest, "component")
    ids = nodes.select("digest", "first_id").join(classes, "digest", "left").select(
        "digest", F.coalesce(F.col("component").cast("string"), F.hex("digest")).alias("class"), F.coalesce("smallest", "first_id").alias("component_id")
    )
    ids = scratch.put(ids, "ids")
    scratch.keep_only("profiles", "ids")
    linked = rows.where("n > 0").join(ids, "digest").select("doc_id", "key", F.col("n").alias("n_shingles"), "class", "component_id")
    alone = rows.where("n = 0").select("doc_id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("string"), "doc_id")
    return linked.union(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first document, by doc_id, of each component, with the columns of ``docs``.

    Texts without words stay. Of repeated rows, one stays. A document without doc_id comes last. Documents
    that are neither dropped nor repeated, which are most, are not shuffled.
    """
    scratch = Scratch(docs.sparkSession, "keepers")
    per = scratch.put(grouped(docs).where("n_shingles > 0").groupBy("class", "doc_id", "key").agg(F.count("*").alias("copies")), "per")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    firsts = per.groupBy("class").agg(F.min(place).alias("first"))
    judged = per.join(firsts, "class").select("doc_id", "key", "copies", (place == F.col("first")).alias("stays"))
    touched = scratch.put(judged.where("not stays or copies > 1").select("doc_id", "key", "stays"), "touched")
    scratch.keep_only("touched")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    rows = rows.withColumn("maybe", maybe_among(touched, F.xxhash64("doc_id", "key"))(F.xxhash64("id", "hash")))
    rest = rows.where("maybe").join(touched, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("key")), "left")
    once = rest.where("stays").dropDuplicates(["id", "hash"])
    kept = rows.where("not maybe").select("row").union(rest.where("stays is null").select("row")).union(once.select("row"))
    return kept.select("row.*")
