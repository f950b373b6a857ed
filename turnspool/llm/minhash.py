"""Near-duplicate documents by b-bit MinHash.

A document is its set of five-word shingles (A-Z lowered; a shorter text is one shingle). Documents
with equal sets form a class, and only one member of a class is compared. Of 128 minima, bands of
four give candidate buckets; at a similarity of 0.75 a pair shares a band with a chance of
1 - 5e-6. A document that shares a bucket gets a signature of 2,048 minima, of which only two low
bits are kept, packed in 64 longs. The share of equal bit pairs, corrected for those that are equal
by chance, estimates the similarity; pairs far below the threshold are dropped, all others are
confirmed on full sets.

No bucket is expanded into all its pairs. Its members are compared with one of them, and components
of confirmed links are found. Buckets that still hold several components are compared again with
another center, and what then remains across components block by block, in bit counts over packed
arrays. A pair leaves that comparison once, from the first bucket that it shares, and only with a
sufficient estimate. Documents of one bucket that are neither linked nor far apart cost a bit count
for each pair, the one cost that grows with the square of a bucket.

A null or empty text, and one without words, has no shingle, is linked with nothing and kept. Null
ids are never a component's id while another is there. Repeated rows are one class. Extra columns
play no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnspool.llm.components import components
from turnspool.llm.words import NOT_SPACE, Words, WordReader, grams, mix, slices, windows_of
from turnspool.staging import stage

SHINGLE = 5
PERCENT = 75
MINIMA, BAND_ROWS, BITS = 128, 4, 2
# For signatures of documents that share a bucket.
FINE_MINIMA = 2048
# Pairs whose estimate is that many deviations below the threshold are no links.
DEVIATIONS = 5.5
HASHED_ROUNDS = 1
BLOCK = 8192
# Bytes of text that are hashed at a time: their minima stay in a core's cache.
SLICE = 1 << 20

SKETCH = "struct<n:bigint,fp1:bigint,fp2:bigint,bands:array<bigint>>"


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)``, each once, by row and hash."""
    first = words.first
    at = windows_of(first, SHINGLE)
    row = np.repeat(np.arange(len(first) - 1), np.maximum(np.diff(first) - SHINGLE + 1, 0))
    code = grams(words.code, SHINGLE, seed=SHINGLE)[at]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
    if len(short):
        size = np.diff(first)[short]
        whole = mix(size.astype(np.uint64))
        for k in range(SHINGLE - 1):
            has = size > k
            whole[has] = mix(whole[has] * np.uint64(3) + words.code[first[short][has] + k])
        row, code = np.concatenate([row, short]), np.concatenate([code, whole])
    order = np.argsort(code)
    row, code = row[order], code[order]
    kind = np.uint16 if len(first) < 1 << 16 else np.int64
    order = np.argsort(row.astype(kind), kind="stable")
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return row[new], code[new]


def _minima(code: np.ndarray, heads: np.ndarray, count: int = MINIMA) -> np.ndarray:
    """Smallest value of each permutation for every set, as uint32."""
    rng = np.random.default_rng(count)
    factor = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 2**32, count, dtype=np.uint32)
    x = (code >> np.uint64(32)).astype(np.uint32)
    y = np.empty_like(x)
    out = np.empty((count, len(heads)), np.uint32)
    for k in range(count):
        np.multiply(x, factor[k], out=y)
        np.add(y, shift[k], out=y)
        out[k] = np.minimum.reduceat(y, heads)
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """BITS low bits of each minimum, 64 bits to a long."""
    each = 64 // BITS
    longs = np.zeros((len(minima) // each, minima.shape[1]), np.uint64)
    for k, values in enumerate(minima):
        low = mix(values.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
        longs[k // each] |= low << np.uint64(k % each * BITS)
    return longs.T


def _bands(minima: np.ndarray) -> np.ndarray:
    wide = minima.astype(np.uint64).reshape(MINIMA // BAND_ROWS, BAND_ROWS, -1)
    key = np.repeat(
        np.arange(1, MINIMA // BAND_ROWS + 1, dtype=np.uint64)[:, None], wide.shape[2], axis=1
    )
    for r in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, r])
    return key.T


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel().view(np.int64)))


def _sketches():
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = WordReader(NOT_SPACE, lower=True)
        for column in columns:
            n = np.zeros(len(column), np.int64)
            prints = np.zeros((2, len(column)), np.uint64)
            bands = np.zeros((len(column), MINIMA // BAND_ROWS), np.uint64)
            for low, high, data, bounds in slices(column, SLICE):
                row, code = shingle_sets(reader.read(data, bounds))
                if not len(row):
                    continue
                heads = np.flatnonzero(np.diff(row, prepend=-1))
                at = low + row[heads]
                n[low:high] = np.bincount(row, minlength=high - low)
                prints[0, at] = np.add.reduceat(code, heads)
                prints[1, at] = np.add.reduceat(mix(code), heads)
                bands[at] = _bands(_minima(code, heads))
            arrays = [pa.array(n), *(pa.array(p.view(np.int64)) for p in prints)]
            yield pa.StructArray.from_arrays(
                [*arrays, _lists(bands)], names=["n", "fp1", "fp2", "bands"]
            )

    return F.arrow_udf(run, SKETCH)


def _fine_signatures():
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = WordReader(NOT_SPACE, lower=True)
        for column in columns:
            packed = np.zeros((len(column), FINE_MINIMA * BITS // 64), np.uint64)
            for low, _, data, bounds in slices(column, SLICE):
                row, code = shingle_sets(reader.read(data, bounds))
                heads = np.flatnonzero(np.diff(row, prepend=-1))
                if len(heads):
                    packed[low + row[heads]] = _packed(_minima(code, heads, FINE_MINIMA))
            yield _lists(packed)

    return F.arrow_udf(run, "array<bigint>")


def _overlap():
    """Whether two texts have PERCENT of the union of their sets in common."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        reader = WordReader(NOT_SPACE, lower=True)
        for left, right in batches:
            linked = np.zeros(len(left), bool)
            for low, high, data, bounds in slices(left, SLICE):
                row, code = shingle_sets(reader.read(data, bounds))
                rows, codes = [row], [code]
                for a, _, data, bounds in slices(right.slice(low, high - low), SLICE):
                    row, code = shingle_sets(reader.read(data, bounds))
                    rows.append(row + a)
                    codes.append(code)
                row, code = np.concatenate(rows), np.concatenate(codes)
                order = np.lexsort((code, row))
                row, code = row[order], code[order]
                twice = (row[1:] == row[:-1]) & (code[1:] == code[:-1])
                common = np.bincount(row[1:][twice], minlength=high - low)
                union = np.bincount(row, minlength=high - low) - common
                linked[low:high] = (100 * common >= PERCENT * union) & (union > 0)
            yield pa.array(linked)

    return F.arrow_udf(run, "boolean")


def differing(a: Column, b: Column) -> Column:
    """How many bit pairs of two packed signatures differ."""
    odd = F.lit(0x5555555555555555)

    def count(x: Column, y: Column) -> Column:
        other = x.bitwiseXOR(y)
        return F.bit_count(other.bitwiseOR(F.shiftrightunsigned(other, 1)).bitwiseAND(odd))

    return F.aggregate(F.zip_with(a, b, count), F.lit(0), lambda s, x: s + x)


def most_differing(minima: int) -> int:
    """The bit pairs in which a link differs at most, but for a chance of 2e-8.

    The similarity is estimated by the share of equal bit pairs without those equal by chance.
    """
    chance = 1 / (1 << BITS)
    equal = chance + (1 - chance) * PERCENT / 100
    deviation = (equal * (1 - equal) / minima) ** 0.5
    return int(minima * (1 - equal + DEVIATIONS * deviation))


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` whose sizes and signatures allow a link."""
    left = nodes.select(
        F.col("node").alias("u"), F.col("n").alias("n1"), F.col("signature").alias("s1")
    )
    right = nodes.select(
        F.col("node").alias("v"), F.col("n").alias("n2"), F.col("signature").alias("s2")
    )
    both = pairs.join(left, "u").join(right, "v")
    near = differing(F.col("s1"), F.col("s2")) <= most_differing(FINE_MINIMA)
    sized = 100 * F.least("n1", "n2") >= PERCENT * F.greatest("n1", "n2")
    return both.filter(sized & near).select("u", "v")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are links, by their full sets."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("t1"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("t2"))
    both = pairs.join(left, "u").join(right, "v")
    return both.filter(_overlap()(F.col("t1"), F.col("t2"))).select("u", "v")


def star_pairs(members: DataFrame, seed: int | None) -> DataFrame:
    """Every member of a bucket with one of them, unless they are connected.

    Without a seed that one is the smallest, the same for the buckets of a group. With a seed each
    bucket has its own, so a member meets about as many others as it has buckets.
    """
    order = F.col("node") if seed is None else F.xxhash64(F.lit(seed), "bucket", "node")
    centers = members.groupBy("bucket").agg(
        F.min(F.struct(order.alias("order"), "node", "root")).alias("c")
    )
    return (
        members.join(centers, "bucket")
        .filter(F.col("c.root") != F.col("root"))
        .select(F.least("c.node", "node").alias("u"), F.greatest("c.node", "node").alias("v"))
        .distinct()
    )


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy().view(np.uint64).reshape(len(values), -1)


def _blocks_compared(table: pa.Table, most: int) -> pa.RecordBatch:
    """The pairs of each pair of blocks in ``table``, which is sorted by bucket, blocks and own."""
    bucket, low, high, own, node, root, n = (
        table[c].to_numpy() for c in ("bucket", "low", "high", "own", "node", "root", "n")
    )
    bits, bands = _rows_of(table["signature"]), _rows_of(table["bands"])
    odd = np.uint64(0x5555555555555555)
    # Even and odd bits apart, each kind packed in half as many longs.
    first, second = bits & odd, (bits >> np.uint64(1)) & odd
    first = first[:, ::2] | first[:, 1::2] << np.uint64(1)
    second = second[:, ::2] | second[:, 1::2] << np.uint64(1)
    heads = _heads(bucket, low, high)
    found = [np.zeros((2, 0), np.int64)]
    for start, stop in zip(heads, [*heads[1:], len(node)], strict=True):
        within = low[start] == high[start]
        middle = stop if within else start + int(np.searchsorted(own[start:stop], high[start]))
        for i in range(start, middle):
            j = np.arange(i + 1 if within else middle, stop)
            sized = 100 * np.minimum(n[j], n[i]) >= PERCENT * np.maximum(n[j], n[i])
            j = j[(root[j] != root[i]) & sized]
            if not len(j):
                continue
            unequal = (first[j] ^ first[i]) | (second[j] ^ second[i])
            j = j[np.bitwise_count(unequal).sum(1, dtype=np.int64) <= most]
            shared = (bands[j] == bands[i]).argmax(1)
            j = j[bands[i][shared] == bucket[i].view(np.uint64)]
            found.append(np.stack([np.minimum(node[j], node[i]), np.maximum(node[j], node[i])]))
    u, v = np.concatenate(found, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _across(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            if not len(table):
                continue
            last = int(_heads(*(table[c].to_numpy() for c in ("bucket", "low", "high")))[-1])
            rest = table.slice(last)
            if last:
                yield _blocks_compared(table.slice(0, last), most)
        if rest is not None:
            yield _blocks_compared(rest, most)

    return run


def cross_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs of a bucket across components that may be links, each once.

    Each block of members meets each other block; only the pairs that pass leave the comparison.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (
        members.join(sizes, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("bucket", "node", "root", "own", other.alias("other"))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )
    keys = ["bucket", "low", "high"]
    return (
        placed.join(nodes.select("node", "n", "signature", "bands"), "node")
        .select(*keys, "own", "node", "root", "n", "signature", "bands")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "own")
        .mapInArrow(_across(most_differing(FINE_MINIMA)), "u bigint, v bigint")
    )


def undecided(members: DataFrame) -> DataFrame:
    """The members of buckets with several components."""
    open_buckets = (
        members.groupBy("bucket")
        .agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
        .filter("r1 <> r2")
        .select("bucket")
    )
    return members.join(open_buckets, "bucket", "left_semi")


def with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` after links between roots: a root that is in ``roots`` is replaced."""
    moved = roots.select(F.col("node").alias("root"), F.col("root").alias("to"))
    return members.join(moved, "root", "left").withColumn(
        "root", F.coalesce("to", "root")
    ).drop("to")


def between_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links of documents as links of the components that they are in."""
    for end in ("u", "v"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias("to"))
        links = links.join(of, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return links.filter("u <> v").distinct()


def joined_roots(roots: DataFrame, moved: DataFrame) -> DataFrame:
    """``roots`` after components were joined as ``moved`` says, which may name new nodes too."""
    new = moved.join(roots.select("node"), "node", "left_anti")
    return with_roots(roots, moved).select("node", "root").unionByName(new)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``df``: ``(doc_id, text_hash, n_shingles, component_id, kept,
    keeper)``. ``kept`` says that the row has its component's id, ``keeper`` picks one row of each
    component. ``doc_id`` and ``text_hash`` lead back to ``df``.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    rows = stage(
        source.select(
            "doc_id",
            "text_hash",
            F.monotonically_increasing_id().alias("place"),
            _sketches()(F.col("text")).alias("s"),
        ).select("doc_id", "text_hash", "place", "s.*"),
        "sketches",
    )
    classes = stage(
        rows.filter("n > 0").groupBy("fp1", "fp2", "n").agg(F.min("place").alias("node")),
        "classes",
    )
    nodes = rows.join(classes.select(F.col("node").alias("place")), "place", "left_semi").select(
        F.col("place").alias("node"), "n", "bands", "doc_id", "text_hash"
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = stage(
        buckets.join(shared.select("bucket"), "bucket", "left_semi").withColumn(
            "root", F.col("node")
        ),
        "buckets",
    )
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    # Null ids are compared as a flag and a value, so that rows lie by these keys once and for all.
    keys = {
        "text_hash": F.col("text_hash"),
        "none": F.col("doc_id").isNull(),
        "id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
    }
    texts = stage(
        source.select("text", *[c.alias(k) for k, c in keys.items()])
        .join(wanted.select("node", "n", "bands", *[c.alias(k) for k, c in keys.items()]), [*keys])
        .dropDuplicates([*keys])
        .select("node", "n", "bands", "text", _fine_signatures()(F.col("text")).alias("signature")),
        "texts",
    )

    def links_of(pairs: DataFrame) -> DataFrame:
        return stage(confirmed(stage(pairs, "pairs"), texts), "links")

    first = links_of(plausible(star_pairs(members, None), texts))
    roots = stage(components(first), "roots")
    members = stage(undecided(with_roots(members, roots)), "buckets")
    for seed in [*range(HASHED_ROUNDS), None]:
        if members.isEmpty():
            break
        across = seed is None
        pairs = cross_pairs(members, texts) if across else plausible(star_pairs(members, seed), texts)
        # Only what is new is linked: components found before are one node each.
        moved = stage(components(between_roots(links_of(pairs), roots)), "moved")
        roots = stage(joined_roots(roots, moved), "roots")
        if not across:
            members = stage(undecided(with_roots(members, moved)), "buckets")
    return _result(rows, classes, roots)


def _result(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    placed = (
        rows.select("doc_id", "text_hash", "place", "n", "fp1", "fp2")
        .join(classes, ["fp1", "fp2", "n"], "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node", "place"))
        .select("doc_id", "text_hash", "place", "n", "root")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place"))
    heads = placed.groupBy("root").agg(first.alias("head"))
    return placed.join(heads, "root").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.col("head.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("head.doc_id")).alias("kept"),
        (F.col("place") == F.col("head.place")).alias("keeper"),
    )
