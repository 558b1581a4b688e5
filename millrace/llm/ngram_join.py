"""Documents with similar sets of word n-grams, by a grouped prefix join.

Two sets are linked when ``percent`` hundredths of their union are common to both.

1. Every text is taken as the set of the 64-bit hashes of its shingles. Equal sets are one node.
2. Shingles are put in one order for all: those found often come last, by how often, all others
   by hash. Which ones are often is learnt from all texts by lossy counting, ``FREQUENT`` of them
   at most. The order decides how much work is done, never what is found.
3. Of a set of n shingles only the first n - ceil(percent * n / 100) + 1 are its prefix: sets that
   can be linked share a shingle of their prefixes. Sets with the same prefix and size form one
   group, and a list holds the groups whose prefix has a shingle.
4. First, every member of a group meets the group's first member, and that of the first group
   in one of its lists, the smallest of these. What is linked so far forms components. Then
   members meet the first groups of all their lists that belong to other components.
5. Then the groups of a list meet each other, where they belong to different components. Pairs
   of groups are filtered by size, by the place of the common shingle (it is the first one in
   at least one list) and by how many shingles their prefixes can have in common, estimated
   from above by exclusive-or of prefix bitmaps. What is left is expanded to members.
6. A bitmap of about as many bits as a set has shingles bounds the difference of two sets from
   below. Pairs that it leaves are verified on their complete sets. Sets are not kept from step
   1: they are made again from the texts of the documents in question, which a small filter
   picks, where one of a pair's sets meets the other.

In a list of many near copies, step 4 checks as many pairs as there are copies and leaves one
component, so step 5 does not pair them. Sets that are not linked although they share a rare
shingle of both prefixes and pass the filters are compared in pairs, as they must be.

Words are runs of characters other than space and U+0009 to U+000D, A-Z lowered. A text of fewer
words than a shingle is one shingle; one without words (or null) has the empty set and is linked
with nothing. Rows that repeat give repeated result rows; a component is named by its smallest id,
null only if no member has an id. Hashes of 64 bits stand for shingles. An empty table gives an
empty result. Only the named columns are read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected
from millrace.llm.shared import Batches, map_batches, out_batch, staged, steps, utf8
from millrace.operators.joins import join_splittable
from millrace.operators.keyfilter import possible, words_for
from millrace.session import release, workspace

SHINGLE = 4
PERCENT = 85
#: Shingles whose frequency counts in the order, at most.
FREQUENT = 2**18
_SEED = 11
#: Hashes counted together, and the entries a task keeps between counts.
_COUNTED, _REMEMBERED = 2**21, 2**17
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a text that are hashed in one step.
_POWERS = 2**20
_MAP_WORDS = 8
_MAPS = [f"m{i}" for i in range(_MAP_WORDS)]


def _powers(base: int) -> np.ndarray:
    out = np.full(_POWERS, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Shingles:
    """Hashes of shingles, from running sums over the bytes of a text.

    Every byte has a random number of 64 bits; a string's hash is the polynomial of these
    modulo 2**64 with a random odd base, which is the difference of two running sums, moved
    back to where the string begins by the inverse of the base.
    """

    def __init__(self, width: int = SHINGLE) -> None:
        self.width = width
        draw = np.random.default_rng(_SEED)
        self.of_byte = draw.integers(0, 2**64, size=256, dtype=np.uint64)
        base = int(draw.integers(0, 2**63, dtype=np.uint64)) * 2 + 1
        self.up, self.down = _powers(base), _powers(pow(base, -1, 2**64))

    def of(self, text: bytes) -> np.ndarray:
        """Sorted hashes of the distinct shingles, as signed 64-bit integers."""
        joined = np.frombuffer(b" ".join(text.lower().split()), dtype=np.uint8)
        if not len(joined):
            return np.zeros(0, dtype=np.int64)
        spaces = np.flatnonzero(joined == 32)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(joined))
        if len(starts) > self.width:
            starts, ends = starts[: 1 - self.width], ends[self.width - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        parts, at = [], 0
        while at < len(starts):
            # As many shingles as the powers reach, one at least.
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + _POWERS)))
            parts.append(self._hashes(joined, starts[at:upto], ends[at:upto]))
            at = upto
        found = np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])
        return found[np.append(True, found[1:] != found[:-1])]

    def _hashes(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, size = starts[0], int(ends[-1] - starts[0])
        up, down = self.up, self.down
        if size >= _POWERS:  # a shingle longer than all of the powers
            return np.array([xxhash.xxh3_64_intdigest(joined[first : ends[-1]].tobytes())], np.uint64).view(np.int64)
        sums = np.zeros(size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.of_byte[joined[first : ends[-1]]] * up[:size], out=sums[1:])
            mixed = (sums[ends - first] - sums[starts - first]) * down[starts - first]
            mixed ^= mixed >> np.uint64(32)
            mixed *= _ODD
            mixed ^= mixed >> np.uint64(29)
        return mixed.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _set_steps(shingles: Shingles, batch: pa.RecordBatch):
    """Steps of rows: their numbers and their sets."""
    texts = batch.column("text").to_pylist()
    for a, b in steps(texts):
        yield a, b, [shingles.of(t) for t in texts[a:b]]


def _sign(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(width: int, batches: Batches) -> Batches:
    """The sets of the rows whose text has the sign they are asked for."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    shingles = Shingles(width)
    for batch in batches:
        signs = batch.column("sign").to_pylist()
        for a, b, sets in _set_steps(shingles, batch):
            own = [i for i in range(a, b) if _sign(sets[i - a]) == signs[i]]
            taken = pa.array(own, pa.int64())
            yield out_batch(
                schema,
                batch.column("u").take(taken),
                batch.column("v").take(taken),
                _lists([sets[i - a] for i in own]),
            )


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the hashes modulo a power of two, at least 64 and at least their number."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount(shingles.view(np.uint64) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """A lower bound of how many shingles are in one set only."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = np.bitwise_xor(*np.split(x, 2))
    while len(y) > len(x):
        y = np.bitwise_xor(*np.split(y, 2))
    return int(np.bitwise_count(x ^ y).sum())


def _near(percent: int, batches: Batches) -> Batches:
    """Pairs whose sketches allow a link."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    for batch in batches:
        size = zip(batch.column("n_u").to_pylist(), batch.column("n_v").to_pylist())
        sketches = zip(batch.column("of_u").to_pylist(), batch.column("of_v").to_pylist())
        near = [
            m + n - 2 * -(-percent * (m + n) // (100 + percent)) >= _apart(a, b)
            for (m, n), (a, b) in zip(size, sketches)
        ]
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_())).cast(schema)


def _often(width: int, batches: Batches) -> Batches:
    """Lossy counting: shingles that stand out in this task's texts, with their counts."""
    held, held_counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    waiting, n, shingles = [], 0, Shingles(width)

    def counted():
        new, counts = np.unique(np.concatenate(waiting), return_counts=True)
        new, counts = new[counts > 1], counts[counts > 1]
        every, back = np.unique(np.concatenate([held, new]), return_inverse=True)
        total = np.zeros(len(every), dtype=np.int64)
        np.add.at(total, back, np.concatenate([held_counts, counts]))
        if len(every) > _REMEMBERED:
            floor = np.partition(total, len(total) - _REMEMBERED)[len(total) - _REMEMBERED]
            every, total = every[total > floor], total[total > floor]
        return every, total

    for batch in batches:
        for _, _, sets in _set_steps(shingles, batch):
            waiting += sets
            n += sum(map(len, sets))
            if n >= _COUNTED:
                held, held_counts = counted()
                waiting, n = [], 0
    if waiting:
        held, held_counts = counted()
    schema = pa.schema([("shingle", pa.int64()), ("n", pa.int64())])
    yield out_batch(schema, pa.array(held), pa.array(held_counts))


def _prefixes(width: int, percent: int, sent, batches: Batches) -> Batches:
    """Size, prefix, prefix bitmap, and what stands for the set and for prefix and size."""
    often, rank = sent.value  # sorted, and their place by frequency
    shingles = Shingles(width)
    for batch in batches:
        schema = pa.schema(
            [
                ("id", batch.column("id").type),
                ("tag", pa.int64()),
                ("n", pa.int32()),
                ("sign", pa.binary()),
                ("key", pa.binary()),
                ("prefix", pa.list_(pa.int64())),
                ("sketch", pa.binary()),
                *((m, pa.int64()) for m in _MAPS),
            ]
        )
        for a, b, sets in _set_steps(shingles, batch):
            prefixes, keys = [], []
            maps = np.zeros((b - a, _MAP_WORDS), dtype=np.uint64)
            for i, own in enumerate(sets):
                size = len(own)
                take = size - -(-percent * size // 100) + 1 if size else 0
                ranks = np.zeros(size, dtype=np.int64)
                if len(often) and size:
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    ranks = np.where(often[at] == own, rank[at], 0)
                prefix = own[np.lexsort((own, ranks))[:take]]
                prefixes.append(prefix)
                keys.append(xxhash.xxh3_128_digest(prefix.tobytes() + size.to_bytes(4, "little")))
                bits = prefix.view(np.uint64) % np.uint64(64 * _MAP_WORDS)
                np.bitwise_xor.at(maps[i], bits >> np.uint64(6), np.uint64(1) << (bits & np.uint64(63)))
            yield out_batch(
                schema,
                batch.column("id").slice(a, b - a),
                batch.column("tag").slice(a, b - a),
                [len(s) for s in sets],
                [_sign(s) for s in sets],
                keys,
                _lists(prefixes),
                [sketch(s) if len(s) else b"" for s in sets],
                *(pa.array(np.ascontiguousarray(maps[:, j]).view(np.int64)) for j in range(_MAP_WORDS)),
            )


def ngram_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Every row's ``id_col``, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("id", "text"))  # finds a document's text again
    id_type = rows.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(_order(rows, width))  # FREQUENT shingles at most
    prefixed = staged(
        map_batches(
            rows,
            partial(_prefixes, width, percent, sent),
            f"id {id_type}, tag long, n int, sign binary, key binary, prefix array<long>, "
            "sketch binary, "
            + ", ".join(f"{m} long" for m in _MAPS),
        ).withColumn("node", F.monotonically_increasing_id()),
        workspace(spark, "ngram-prefixes"),
    )
    # A row of each different set stands for it: the node.
    of_set = F.struct("node", "n", "key", "prefix", "sketch", *_MAPS, "tag")
    sets = staged(
        prefixed.filter("n > 0")
        .groupBy("sign")
        .agg(F.min(of_set).alias("set"), F.min("id").alias("least"))
        .select("sign", "least", "set.*"),
        workspace(spark, "ngram-nodes"),
    )
    first = sets.groupBy("key").agg(F.min("node").alias("group"))
    members = staged(
        join_splittable(sets.select("node", "key"), first, "key", "inner").select("node", "group"),
        workspace(spark, "ngram-members"),
    )
    label = _components(rows, sets, members, width, percent)
    labelled = sets.select("node", "sign", "least").join(label, "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node")).drop("node")
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    of_sign = labelled.drop("least").join(named, "label").drop("label")
    slim = prefixed.select("id", "n", "sign")
    linked = join_splittable(slim.filter("n > 0"), of_sign, "sign", "inner")
    return (
        linked.select("id", "n", "component_id")
        .unionByName(slim.filter("n = 0").select("id", "n", F.col("id").alias("component_id")))
        .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")
    )


def _order(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their rank by frequency (from 1)."""
    spark = rows.sparkSession
    path = workspace(spark, "ngram-often")
    found = staged(
        map_batches(rows.select("text"), partial(_often, width), "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n")),
        path,
    )
    # So many of the highest levels, an eighth of an octave each, as keep within the bound.
    level = F.floor(F.log2("n") * 8)
    least, held = None, 0
    for r in found.groupBy(level.alias("level")).count().orderBy(F.col("level").desc()).collect():
        held += r["count"]
        if held > FREQUENT:
            break
        least = r["level"]
    kept = found.filter(level >= least if least is not None else F.lit(False)).toArrow()
    release(spark, path)
    shingle, n = (kept.column(c).to_numpy() for c in ("shingle", "n"))
    rank = np.empty(len(n), dtype=np.int64)
    rank[np.lexsort((shingle, n))] = np.arange(1, len(n) + 1)
    by_shingle = np.argsort(shingle)
    return shingle[by_shingle], rank[by_shingle]


def _needed(a: str, b: str, percent: int) -> str:
    """SQL for the least intersection that links sets of sizes ``a`` and ``b``."""
    return f"(({percent} * (cast({a} as long) + {b}) + {99 + percent}) div {100 + percent})"


def _may_link(percent: int) -> Column:
    """Whether sets of groups x and y that share x.place and y.place first may be linked."""
    apart = " + ".join(f"bit_count(x.{m} ^ y.{m})" for m in _MAPS)
    least_x, least_y = (f"(({percent} * cast({s}.n as long) + 99) div 100)" for s in "xy")
    in_prefixes = f"(x.n - {least_x} + 1 + y.n - {least_y} + 1 - ({apart})) div 2"
    return F.expr(
        f"""{_needed("x.n", "y.n", percent)} <= least(
              least(x.n, y.n) - cast(x.n = y.n as int),
              1 + least(x.n - x.place - 1, y.n - y.place - 1),
              {in_prefixes} + greatest({least_x}, {least_y}) - 1)"""
    )


def _components(
    rows: DataFrame, sets: DataFrame, members: DataFrame, width: int, percent: int
) -> DataFrame:
    """``node``, ``label`` of every node that is linked."""
    spark = sets.sparkSession
    groups = sets.join(members.filter("node = group"), "node")
    about = groups.select("group", "n", *_MAPS)
    lists = groups.select("group", F.posexplode("prefix").alias("place", "shingle"))
    heads = (
        lists.groupBy("shingle")
        .agg(F.count("*").alias("n_groups"), F.min(F.struct("group", "place")).alias("head"))
        .filter("n_groups > 1")
        .select("shingle", "head")
    )
    shared = staged(
        join_splittable(lists, heads, "shingle", "inner"), workspace(spark, "ngram-lists")
    )
    heads = staged(_heads(shared, about, percent), workspace(spark, "ngram-heads"))
    own = members.filter("node <> group").select(F.col("node").alias("u"), F.col("group").alias("v"))
    nearest = heads.groupBy("group").agg(F.min("head_group").alias("v"))
    nearest = join_splittable(members, nearest, "group", "inner").select(F.col("node").alias("u"), "v")
    links = _links(own.unionByName(nearest), rows, sets, width, percent)
    label = connected(links)
    for others in (_other_heads, _across):
        placed = staged(
            members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")),
            workspace(spark, "ngram-placed"),
        )
        more = _links(others(shared, heads, about, placed, percent), rows, sets, width, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            label = connected(links)
    return label


def _heads(shared: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """``group``, ``head_group``: groups with the heads of their lists that they may be linked to."""
    of_x = about.select("group", F.struct("group", "n", *_MAPS).alias("x"))
    of_y = about.select(F.col("group").alias("head_group"), F.struct("n", *_MAPS).alias("y"))
    met = shared.filter("group <> head.group").withColumn("head_group", F.col("head.group"))
    met = join_splittable(join_splittable(met, of_x, "group", "inner"), of_y, "head_group", "inner")
    return (
        met.select(
            "group",
            "head_group",
            F.struct("x.*", "place").alias("x"),
            F.struct("y.*", F.col("head.place").alias("place")).alias("y"),
        )
        .filter(_may_link(percent))
        .select("group", "head_group")
        .distinct()
    )


def _other_heads(
    shared: DataFrame, heads: DataFrame, about: DataFrame, placed: DataFrame, percent: int
) -> DataFrame:
    """Members with the first members of heads that belong to other components."""
    first = placed.filter("node = group").select(
        F.col("group").alias("head_group"), F.col("label").alias("of_v")
    )
    apart = join_splittable(heads, first, "head_group", "inner").join(placed, "group")
    return apart.filter("label <> of_v").select(F.col("node").alias("u"), F.col("head_group").alias("v"))


def _across(
    shared: DataFrame, heads: DataFrame, about: DataFrame, placed: DataFrame, percent: int
) -> DataFrame:
    """Members of different components whose groups meet in a list or are the same."""
    spark = shared.sparkSession
    labels = placed.select("group", "label").distinct()
    entries = shared.select("shingle", "group", "place").join(labels, "group")
    several = (
        entries.groupBy("shingle", "label")
        .agg(F.count("*").alias("n_entries"))
        .groupBy("shingle")
        .agg(
            F.count("*").alias("n_labels"),
            F.max_by("label", F.struct("n_entries", "label")).alias("largest"),
        )
        .filter("n_labels > 1")
        .select("shingle", "largest")
    )
    active = join_splittable(entries, several, "shingle", "inner")
    active = staged(
        join_splittable(active, about, "group", "inner"), workspace(spark, "ngram-active")
    )
    # The largest component of a list meets the others there, never itself.
    met = (
        active.filter("label <> largest")
        .alias("x")
        .join(
            active.alias("y"),
            F.expr(
                """x.shingle = y.shingle and x.label <> y.label and x.group <> y.group
                   and (y.label = y.largest or x.label < y.label)"""
            )
            & _may_link(percent),
        )
        .selectExpr("x.group as a", "x.label as of_a", "y.group as b", "y.label as of_b")
        .distinct()
    )
    several_labels = labels.groupBy("group").agg(F.count("*").alias("n_labels")).filter("n_labels > 1")
    own = labels.join(several_labels.join(about, "group").select("group", "n"), "group")
    own = own.filter(F.expr(f"{_needed('n', 'n', percent)} < n"))
    within = own.select(F.col("group").alias("a"), F.col("label").alias("of_a")).join(
        own.select(F.col("group").alias("b"), F.col("label").alias("of_b")),
        F.expr("a = b and of_a < of_b"),
    )
    # Members of the largest component meet few of the others: those are the v.
    of_a = placed.select(F.col("group").alias("a"), F.col("label").alias("of_a"), F.col("node").alias("v"))
    of_b = placed.select(F.col("group").alias("b"), F.col("label").alias("of_b"), F.col("node").alias("u"))
    return met.unionByName(within).join(of_a, ["a", "of_a"]).join(of_b, ["b", "of_b"]).select("u", "v")


def _links(
    pairs: DataFrame, rows: DataFrame, sets: DataFrame, width: int, percent: int
) -> DataFrame:
    """Those of the pairs ``u``, ``v`` whose sets are similar enough."""
    spark = pairs.sparkSession
    work = [workspace(spark, f"ngram-{name}") for name in ("pairs", "asked", "sets")]
    about = sets.select("node", "n", "sketch")
    of_u = about.toDF("u", "n_u", "of_u")
    of_v = about.toDF("v", "n_v", "of_v")
    both = join_splittable(join_splittable(pairs, of_u, "u", "inner"), of_v, "v", "inner")
    pairs = staged(map_batches(both, partial(_near, percent), "u long, v long"), work[0])
    # The set of u is wanted once per pair, that of v once for all its pairs (as u null).
    wanted = pairs.select(F.col("u").alias("node"), "u", "v").unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("u"), "v").distinct()
    )
    # The document that a node was taken from has its set; few others can have its tag.
    asked = staged(
        join_splittable(wanted, sets.select("node", "sign", "tag"), "node", "inner").drop("node"), work[1]
    )
    texts = possible(rows.select("tag", "text"), asked, "tag", words_for(asked.count()))
    made = staged(
        map_batches(
            texts.join(asked, "tag").select("u", "v", "sign", "text"),
            partial(_sets, width),
            "u long, v long, shingles array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        work[2],
    )
    # Rows that repeat an id and a text made a set several times.
    first = made.groupBy("u", "v").agg(F.min("row").alias("row"), F.count("*").alias("n"))
    if not first.filter("n > 1").isEmpty():
        made = made.join(first.select("row"), "row", "left_semi")
    one = made.filter("u is null").select("v", F.col("shingles").alias("of_v"))
    met = join_splittable(made.filter("u is not null"), one, "v", "inner")
    common = F.size(F.array_intersect("shingles", "of_v"))
    least = F.expr(_needed("size(shingles)", "size(of_v)", percent))
    links = staged(met.filter(common >= least).select("u", "v"), workspace(spark, "ngram-links"))
    release(spark, *work)
    return links
