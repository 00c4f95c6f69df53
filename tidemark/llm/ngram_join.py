"""Joining documents by the Jaccard similarity of their word shingles, with a token-group matrix.

1. Equal sets are one class. All tokens have one order: rare ones first, frequent ones last.
2. Every class is put into a group of classes that are likely alike: similar size, same smallest token under a second
   hash (among the frequent tokens, if they are most of the set, so that edits do not scatter a family of copies).
   Large groups are cut into blocks.
3. Two sets that qualify share a token among the first n - ceil(t n) + 1 of each ("prefix"). The matrix holds
   (token, group) for the union of the prefixes in a group, so a family of near copies costs a row per block, and
   the smallest and largest set of the group that have the token there.
4. Two entries of a token meet only if these sizes allow a pair. Two groups with such entries are compared by sizes
   and by the number of shared entries, which bounds the overlap of any two members. Only the token sets of groups that pass are fetched.
5. The larger group of a pair is visited by the members of the smaller one. The overlap with the token union of
   the group bounds all similarities of a visitor; only visitors that reach the threshold are compared, exactly. A
   group returns links that span what it has found, not every pair.
6. Connected components of the links, spread to all members of the classes.

The order of tokens only steers the work: frequent tokens are found by counting in every task over all documents,
and about LISTED of them at most are put last. Tokens are 64-bit hashes of shingles, and a class is told by 64 bits of
its set: the chance that any two of n different sets meet is about n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, attach, attach_left, cell_filter, filter_bits, in_filter, kept_rows, pieces, row_key, stored, text_of

WORDS = 5
PERCENT = 80
LISTED = 1 << 18
#: Groups of more classes or tokens are cut into blocks.
BLOCK = 512
BLOCK_TOKENS = 400_000
#: So many visitors of a group go to one task, and so many (or so many tokens of them) are compared at a time.
LANE = 4096
GUESTS = 512
GUEST_TOKENS = 400_000
#: A token in the prefixes of more groups is put last and the prefixes are taken again, at most ROUNDS times in all.
WIDE = 256
ROUNDS = 3
MAX_BITS = 28
_LOCAL_TOKENS = 2_000_000
_LOCAL_COUNT = 2
_VOCABULARY = 8192
_ARROW_ROWS = 1024
_REMEMBERED = 1 << 17
_BAND = 0.15
#: Found in texts that have words: what bytes.split() takes for white space is not all there is.
_WORDED = r"[^\x20\x09-\x0D]"
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _PRIME
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


_HASHES = _WordHashes()


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `size` words; of a shorter text, of all its words together."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, dtype="uint64")
    hashes = np.fromiter(map(_HASHES.__getitem__, words), dtype="uint64", count=len(words))
    size = min(size, len(words))
    last = len(words) - size + 1
    out = np.full(last, size, dtype="uint64")
    for i in range(size):
        out = _mixed(out * _GOLD + hashes[i : i + last])
    return np.unique(out)


def _set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _family(tokens: np.ndarray, size: int) -> int:
    """Smallest token under another order, and a band of sizes: sets far apart in size cannot qualify anyway."""
    least = _mixed(tokens ^ _GOLD).min(keepdims=True)
    band = np.array([np.log(size) / _BAND]).astype("uint64")
    return int(_mixed(least + band * _GOLD).view("int64")[0])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in pieces(batches):
        yield batch, [shingle_set(t, size) for t in batch.column(1).to_pylist()]
    # Workers are used again: what one task has cached stays in memory beside the next one's data.
    _HASHES.clear()
    pa.default_memory_pool().release_unused()


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in columns.values()], names=list(columns))


def _describe(size: int):
    """Rows of documents (is_doc, with `row` as it came) and of tokens that are frequent in a stretch of the task (sid: token, n: documents)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate([np.empty(0, dtype="uint64"), *held]), return_counts=True)
            tokens, counts = tokens[counts >= _LOCAL_COUNT], counts[counts >= _LOCAL_COUNT]
            held.clear()
            seen.clear()
            blank = [None] * len(tokens)
            return _batch(
                is_doc=([False] * len(tokens), pa.bool_()),
                doc=(blank, pa.int64()),
                sid=(tokens.view("int64"), pa.int64()),
                n=(counts, pa.int64()),
                row=(blank, pa.string()),
            )

        waiting = 0
        for batch, sets in _sets(batches, size):
            sids = [_set_id(s) for s in sets]
            for sid, tokens in zip(sids, sets):
                if sid not in seen:
                    seen.add(sid)
                    held.append(tokens)
                    waiting += len(tokens)
            yield _batch(
                is_doc=([True] * len(sets), pa.bool_()),
                doc=(batch.column(0), pa.int64()),
                sid=(sids, pa.int64()),
                n=([len(s) for s in sets], pa.int64()),
                row=(batch.column(2), pa.string()),
            )
            if waiting >= _LOCAL_TOKENS:
                yield frequent()
                waiting = 0
        yield frequent()

    return describe


def _least(n, percent: int):
    """The smallest overlap with a set of n tokens that can reach the threshold."""
    return -(-percent * n // 100)


def _prefixes(size: int, percent: int, order):
    """(token, sid, fam, n) for the first tokens of each set of n, and one row without a token for the set itself.

    `order` has the tokens that come last, sorted, and the place of each among them.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, rank = order.value
        for _, sets in _sets(batches, size):
            out, sids, fams, counts, sizes, seen = [], [], [], [], [], set()
            for tokens in sets:
                sid = _set_id(tokens)
                if not len(tokens) or sid in seen:
                    continue
                seen.add(sid)
                wanted = len(tokens) - _least(len(tokens), percent) + 1
                first = common = tokens
                if len(listed):
                    at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
                    late = listed[at] == tokens
                    first, behind = tokens[~late], at[late]
                    if 2 * len(behind) > len(tokens):
                        common = tokens[late]
                    if len(first) < wanted:
                        first = np.concatenate([first, listed[behind[np.argsort(rank[behind])]]])
                out.append(first[:wanted])
                sids.append(sid)
                fams.append(_family(common, len(tokens)))
                counts.append(wanted)
                sizes.append(len(tokens))
            flat = np.concatenate([np.empty(0, dtype="uint64"), *out]).view("int64")
            sids, fams, sizes = (np.array(x, dtype="int64") for x in (sids, fams, sizes))
            yield _batch(
                token=(pa.array(flat), pa.int64()),
                sid=(np.repeat(sids, counts), pa.int64()),
                fam=(np.repeat(fams, counts), pa.int64()),
                n=(np.repeat(sizes, counts), pa.int64()),
            )
            yield _batch(
                token=([None] * len(sids), pa.int64()),
                sid=(sids, pa.int64()),
                fam=(fams, pa.int64()),
                n=(sizes, pa.int64()),
            )

    return take


def _rep_key(doc: np.ndarray, sid: np.ndarray) -> np.ndarray:
    return _mixed(doc.astype("int64").view("uint64") * _GOLD ^ sid.astype("int64").view("uint64"))


def _rep_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"h": _rep_key(batch["doc"].to_numpy(), batch["sid"].to_numpy()).view("int64")})


def _fetch(size: int, shared, bits: int):
    """(sid, tokens) of the documents that stand for a wanted class, and of few others."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, size):
            docs = batch.column(0).to_pylist()
            sids = np.array([_set_id(s) for s in sets], dtype="int64")
            found = np.flatnonzero(in_filter(shared.value, bits, _rep_key(np.array(docs, dtype="int64"), sids)))
            yield _batch(
                sid=(sids[found], pa.int64()), tokens=([sets[i].tobytes() for i in found.tolist()], pa.binary())
            )

    return fetch


class _Forest:
    """Which members are already connected; `join` is true for a link that connects two parts."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, over slices of the vocabulary that both sides share."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), dtype="float64")
    row_a = np.repeat(np.arange(len(left)), list(map(len, left)))
    row_b = np.repeat(np.arange(len(right)), list(map(len, right)))
    for start in range(0, len(shared), _VOCABULARY):
        words = shared[start : start + _VOCABULARY]
        sides = []
        for tokens, rows, n in ((a, row_a, len(left)), (b, row_b, len(right))):
            at = np.minimum(np.searchsorted(words, tokens), len(words) - 1)
            hit = words[at] == tokens
            side = np.zeros((n, len(words)), dtype="float32")
            side[rows[hit], at[hit]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype("int64")


def _reaching(sets: list[np.ndarray], union: np.ndarray, smallest: int, percent: int) -> list[int]:
    """Members whose overlap with the other group's union allows a qualifying pair.

    A pair of sizes m and n qualifies from an overlap of percent * (m + n) / (100 + percent) on.
    """
    out = []
    for i, tokens in enumerate(sets):
        at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
        common = np.count_nonzero(union[at] == tokens)
        if common * (100 + percent) >= percent * (len(tokens) + max(smallest, _least(len(tokens), percent))):
            out.append(i)
    return out


def links_between(
    left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, percent: int
) -> list[tuple[int, int]]:
    """Links that span all qualifying pairs between two groups (right None: within one group)."""
    forest, inner = _Forest(), right is None
    if not inner:
        for one, other in ((0, 1), (1, 0)):
            sides = [left, right]
            union = np.unique(np.concatenate([t for _, t in sides[other]]))
            smallest = min(len(t) for _, t in sides[other])
            sides[one] = [sides[one][i] for i in _reaching([t for _, t in sides[one]], union, smallest, percent)]
            left, right = sides
            if not left or not right:
                return []
    else:
        right = left
    sizes_a = np.array([len(t) for _, t in left])
    sizes_b = np.array([len(t) for _, t in right])
    both = _overlaps([t for _, t in left], [t for _, t in right])
    union = sizes_a[:, None] + sizes_b[None, :] - both
    rows, cols = np.nonzero(100 * both >= percent * union)
    names_a, names_b = [s for s, _ in left], [s for s, _ in right]
    found = ((names_a[i], names_b[j]) for i, j in zip(rows.tolist(), cols.tolist()))
    return [(a, b) for a, b in found if a != b and forest.join(a, b)]


def _open(percent: int):
    """Rows come sorted by group and lane, members (side 0) before visitors; one group is held at a time."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        hosts: list[tuple[int, np.ndarray]] = []
        guests: list[tuple[int, np.ndarray]] = []
        found: list[tuple[int, int]] = []
        waiting = 0

        def receive() -> None:
            nonlocal waiting
            if hosts and guests:
                found.extend(links_between(guests, hosts, percent))
            guests.clear()
            waiting = 0

        def close() -> None:
            receive()
            if held[1] == 0 and len(hosts) > 1:
                found.extend(links_between(hosts, None, percent))
            hosts.clear()

        def out() -> pa.RecordBatch:
            u, v = [max(x) for x in found], [min(x) for x in found]
            found.clear()
            return _batch(u=(u, pa.int64()), v=(v, pa.int64()))

        for batch in pieces(batches):
            for host, lane, side, sid, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, lane) != held:
                    close()
                    held = (host, lane)
                (guests if side else hosts).append((sid, np.frombuffer(tokens, dtype="uint64")))
                waiting += side * (len(tokens) // 8)
                if len(guests) >= GUESTS or waiting >= GUEST_TOKENS:
                    receive()
            yield out()
        close()
        yield out()

    return links


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that links reach, for every node of a link (u, v).

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the smallest neighbour,
    until all links are stars. Each turn is a written table.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), "m").where("a <> m")
        small = small.unionByName(least.select(F.col("u").alias("a"), "m")).distinct()
        edges = stored(small.select(F.col("a").alias("u"), F.col("m").alias("v")), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def most_frequent(counts: DataFrame, most: int) -> dict[int, int]:
    """The tokens of the largest df, about `most` at most; of the df where the room ends, a part by hash of the token.

    Sorting rows for a limit would hold that many row objects in every task; here only rows that are wanted are sent.
    """
    counts = stored(counts.select("token", "df"), "counts")
    room, cut, part = most, 0, 0
    for r in sorted(counts.groupBy("df").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["df"]):
        if r["n"] > room:
            cut, part = r["df"], (room << 20) // r["n"]
            break
        room -= r["n"]
    in_part = F.pmod(F.xxhash64("token"), F.lit(1 << 20)) < part
    found = counts.where((F.col("df") > cut) | ((F.col("df") == cut) & in_part))
    return {r["token"]: r["df"] for r in found.collect()}


def _least_sql(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100)


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, copies.

    Words are what stands between white space, with A-Z in lower case; a document's set is its distinct runs of `words`
    words, or all its words as one run if there are fewer. Two documents are linked when the intersection of
    their sets is at least `percent` percent of the union. component_id is the smallest id that links reach,
    copies the number of rows with the same set. Documents without words (or text) are linked with nothing: their
    component is their own id, their n_shingles 0. A null id plays no part in component_id unless all are null.
    Other columns play no part, whatever their names. An empty table gives an empty result.
    """
    members, known, total = _resolved(docs, id, text, words, percent, F.lit(None).cast("string"))
    held = members.where("n > 0").select("doc", "sid", "n")
    known = known.where("copies > 1 or component_id is not null").select("sid", "copies", "component_id")
    result = attach_left(held, known, "sid", "copies", total)
    result = result.select("doc", "n", "component_id", "copies")
    bare = members.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"), F.lit(1).cast("long").alias("copies"))
    return result.unionByName(bare).select(F.col("doc").alias(id), F.col("n").alias("n_shingles"), "component_id", "copies")


def _resolved(
    docs: DataFrame, id: str, text: str, words: int, percent: int, row: Column
) -> tuple[DataFrame, DataFrame, int]:
    """(doc, sid, n, row) of all documents, (sid, copies, root, component_id) of all classes, and the number of documents."""
    # All work in Python is done when the function returns; what is left to run are joins of written tables.
    with arrow_rows(docs.sparkSession, _ARROW_ROWS):
        return _linked(docs, id, text, words, percent, row)


def _linked(
    docs: DataFrame, id: str, text: str, words: int, percent: int, row: Column
) -> tuple[DataFrame, DataFrame, int]:
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("doc"), text_of(text).alias("text"))
    told = docs.select(F.col(id).cast("long").alias("doc"), text_of(text).alias("text"), row.alias("row"))
    described = told.mapInArrow(_describe(words), "is_doc boolean, doc long, sid long, n long, row string")
    described = stored(described, "sets")
    members = described.where("is_doc").select("doc", "sid", "n", "row")
    held = members.where("n > 0")
    total = members.count()

    frequent = described.where("not is_doc").groupBy(F.col("sid").alias("token")).agg(F.sum("n").alias("df"))
    # About LISTED tokens at most, whatever the size of the corpus.
    listed = most_frequent(frequent, LISTED)
    sets = held.groupBy("sid").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    sets = stored(sets, "classes")
    for turn in range(ROUNDS):
        order = np.array(sorted(listed, key=lambda t: (listed[t], t)), dtype="int64").view("uint64")
        place = np.argsort(order)
        shared = spark.sparkContext.broadcast((order[place], place))
        prefixes = rows.mapInArrow(_prefixes(words, percent, shared), "token long, sid long, fam long, n long")
        prefixes = stored(prefixes, "prefixes")
        families = prefixes.where("token is null").groupBy("sid").agg(F.first("fam").alias("fam"))
        classes = stored(sets.join(families, "sid"), "families")
        large = classes.groupBy("fam").agg(
            F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("parts")
        )
        large = stored(large.where("parts > 1"), "large-families")

        def grouped(df: DataFrame) -> DataFrame:
            part = F.coalesce(F.pmod(F.xxhash64("sid"), "parts"), F.lit(0))
            return df.join(large, "fam", "left").withColumn("gid", F.xxhash64("fam", part)).drop("fam", "parts")

        matrix = grouped(prefixes.where("token is not null")).groupBy("token", "gid")
        matrix = matrix.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        breadth = F.count(F.lit(1)).over(Window.partitionBy("token"))
        matrix = stored(matrix.withColumn("breadth", breadth).where("breadth > 1"), "matrix")
        if turn + 1 == ROUNDS or len(listed) >= 0.98 * LISTED:
            break
        wide = matrix.where(F.col("breadth") > WIDE).groupBy("token").agg(F.first("breadth").alias("df"))
        fresh = {t: n for t, n in most_frequent(wide, LISTED).items() if t not in listed}
        if not fresh:
            break
        listed |= dict(list(fresh.items())[: LISTED - len(listed)])

    classes = stored(grouped(classes), "grouped-classes")
    groups = classes.groupBy("gid").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("k"))
    groups = stored(groups, "groups")

    def meet(hi_a: str, lo_a: str, hi_b: str, lo_b: str) -> Column:
        return (F.col(hi_a) * 100 >= F.col(lo_b) * percent) & (F.col(hi_b) * 100 >= F.col(lo_a) * percent)

    # Sets that qualify stand in both entries of each token that their prefixes share, so no such entry is left out.
    one = matrix.select("token", F.col("gid").alias("a"), F.col("lo").alias("from_a"), F.col("hi").alias("to_a"))
    other = matrix.select("token", F.col("gid").alias("b"), F.col("lo").alias("from_b"), F.col("hi").alias("to_b"))
    pairs = one.join(other, "token").where((F.col("a") < F.col("b")) & meet("to_a", "from_a", "to_b", "from_b"))
    pairs = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("hits"))
    pairs = pairs.join(groups.toDF("a", "lo_a", "hi_a", "k_a"), "a").join(groups.toDF("b", "lo_b", "hi_b", "k_b"), "b")
    # Beyond the shared entries two sets can only share what follows the prefix of one of them. The bound is
    # loosest for the largest and the smallest size that may meet.
    hi = F.greatest("hi_a", "hi_b")
    lo = F.greatest(F.least("lo_a", "lo_b"), _least_sql(hi, percent))
    bound = F.col("hits") + _least_sql(hi, percent) + 1
    pairs = pairs.where(meet("hi_a", "lo_a", "hi_b", "lo_b") & (bound * (100 + percent) >= (hi + lo) * percent))
    stays = (F.col("k_a") > F.col("k_b")) | ((F.col("k_a") == F.col("k_b")) & (F.col("a") < F.col("b")))
    pairs = pairs.select(
        F.when(stays, F.col("a")).otherwise(F.col("b")).alias("host"),
        F.when(stays, F.col("b")).otherwise(F.col("a")).alias("guest"),
        F.least("k_a", "k_b").alias("visitors"),
    )
    pairs = stored(pairs, "pairs")
    lanes = pairs.groupBy("host").agg(F.ceil(F.sum("visitors") / LANE).alias("lanes"))
    alone = groups.where("k > 1").select(F.col("gid").alias("host"), F.lit(1).cast("long").alias("lanes"))
    lanes = stored(lanes.unionByName(alone).groupBy("host").agg(F.max("lanes").alias("lanes")), "lanes")

    needed = lanes.select(F.col("host").alias("gid")).unionByName(pairs.select(F.col("guest").alias("gid"))).distinct()
    wanted = classes.join(needed, "gid", "left_semi")
    wanted = stored(wanted.select("sid", "gid", F.coalesce("rep", F.lit(0)).alias("doc")), "wanted")
    bits = filter_bits(wanted.count(), MAX_BITS)
    keys = wanted.select("doc", "sid").mapInPandas(_rep_keys, "h long")
    found_in = spark.sparkContext.broadcast(cell_filter(keys, "h", bits))
    named = rows.select(F.coalesce("doc", F.lit(0)).alias("doc"), "text")
    fetched = named.mapInArrow(_fetch(words, found_in, bits), "sid long, tokens binary")
    opened = stored(fetched.join(wanted.select("sid", "gid"), "sid").dropDuplicates(["sid"]), "opened-sets")
    at_home = opened.join(lanes, F.col("gid") == F.col("host")).select(
        "host", F.explode(F.sequence(F.lit(0), (F.col("lanes") - 1).cast("int"))).alias("lane"), F.lit(0).alias("side"), "sid", "tokens"
    )
    lane = F.pmod(F.xxhash64("sid"), "lanes").cast("int").alias("lane")
    visiting = pairs.join(lanes, "host").join(opened, F.col("gid") == F.col("guest"))
    visiting = visiting.select("host", lane, F.lit(1).alias("side"), "sid", "tokens")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = at_home.unionByName(visiting).repartition(tasks, "host", "lane")
    dealt = dealt.sortWithinPartitions("host", "lane", "side", "sid")
    found = components(dealt.mapInArrow(_open(percent), "u long, v long"))

    linked = classes.join(found, F.col("sid") == F.col("node"), "left")
    linked = linked.select("sid", "rep", "copies", F.coalesce("root", "sid").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    return members, stored(linked.join(smallest, "root").select("sid", "copies", "root", "component_id"), "components"), total


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    A null id comes after all others. Of rows of one component that share the smallest id the one with the longest text
    stays, then the one with the smallest MD5; of fully repeated rows one stays. Rows that share an id, or have none, but
    are not linked by their texts are different documents. All rows without words stay.
    """
    # The text of a row as a value that sorts longer texts first and tells texts of one length apart.
    row = F.concat(F.lpad((F.lit((1 << 31) - 1) - F.length(text_of(text))).cast("string"), 10, "0"), F.md5(text_of(text)))
    members, known, total = _resolved(docs, id, text, words, percent, row)
    held = members.where("n > 0").select("doc", "sid", "row")
    met = attach(held, known.select("sid", "copies", "root"), "sid", "copies", total)
    first = F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "row")).alias("first")
    best = met.groupBy("root").agg(first).select("first.doc", "first.row")
    best = best.select(row_key("doc", F.col("row")).alias("_keep_key"))
    worded = text_of(text).rlike(_WORDED)
    keyed = docs.where(worded).withColumn("_keep_key", row_key(id, row))
    return docs.where(~worded).unionByName(kept_rows(keyed, best, "_keep_key"))
