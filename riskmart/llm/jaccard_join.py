"""op4: n-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

Two sets can only reach a Jaccard similarity of p / 100 if their sizes differ by at most that
ratio, so sets fall into bands of geometrically growing size and a set meets only its own
band and the next.  Bands are cut into blocks of bounded size; a pair of blocks is a tile,
and a tile is a task's unit of work, so neither a common size nor a large group of near
copies meets in one task.

In a tile every set is a bitmap of its hashed shingles, about as wide as the set is large.
The bits of one bitmap that the other lacks are shingles the other lacks, so bit counts bound
the overlap from above; pairs whose bound is too low are out.  What is left are candidate
pairs, and a tile returns a spanning forest of them, not the pairs.  Documents of a candidate
component are then compared exactly, by intersection of sorted arrays, again in bounded tiles
by component; pairs already connected in the tile need no comparison, and a tile returns a
spanning forest of true links.

Equal sets are collapsed first, so copies cost nothing.  Sets of fewer than ``least`` shingles
can link only if equal and skip the tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import broadcast_below, components, fresh, materialize, runs, ship, slices, table, texts

N, PERCENT, BLOCK_ROWS, CHECK_ROWS = 4, 85, 16_384, 512
#: Bytes of bitmaps in a block and of sets in a block of the exact comparison; large sets make smaller blocks.
BLOCK_BYTES, CHECK_BYTES = 64 << 20, 32 << 20
_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Word -> 64-bit hash, a bounded cache of a worker."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 150_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str, n: int = N) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-word shingles of a whole text.

    Words are split at ASCII white space after lower-casing A-Z.  With fewer than n words the
    whole sequence is the one shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()  # both act on ASCII only
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(ids) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix(out * _MULT + ids[i:len(ids) - width + 1 + i])
    return np.unique(out)


def bands(percent: int, top: int) -> np.ndarray:
    """Least size of each band; a set can only link within its band or with a band beside it."""
    lows = [1]
    while lows[-1] <= top:
        lows.append(lows[-1] * 100 // percent + 1)
    return np.array(lows)


def bitmap(hashes: np.ndarray) -> bytes:
    """Hashed bitmap of a set: the power of two of bits, 64 at least, that is not below its size."""
    width = 1 << max(6, int(len(hashes) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(hashes & _U(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _fold(signature: bytes, words: int) -> np.ndarray:
    """A bitmap folded to ``words`` 64-bit words: the bitmap of the same set at that width."""
    b = np.frombuffer(signature, "<u8")
    return np.bitwise_or.reduce(b.reshape(-1, words), axis=0)


def forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smallest connected row of each of ``n`` rows after adding links a-b to labels ``root``."""
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def least_overlap(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection with which sets of these sizes link: 100 i >= percent (x + y - i)."""
    return -(-percent * (x + y) // (100 + percent))


def candidate_tile(sizes: np.ndarray, signatures: list[bytes], left: np.ndarray, within: bool, percent: int) -> np.ndarray:
    """Labels of a spanning forest of the pairs (left, right) whose bitmaps allow a link.

    ``left`` marks rows of the left block.  ``within``: both sides are one block, of which
    ``left`` is all, and each pair is looked at once.
    """
    n = len(sizes)
    root = np.arange(n)
    words = min(map(len, signatures)) // 8
    maps = np.stack([_fold(s, words) for s in signatures])
    order = np.argsort(sizes, kind="stable")
    rows = order[left[order]]
    cols = rows if within else order[~left[order]]
    col_sizes = sizes[cols]
    col_maps = np.ascontiguousarray(maps[cols].T)  # word by word
    head = max(1, (words * 2 + 4) // 5)
    col_head = np.bitwise_count(col_maps[:head]).astype(np.int32).sum(axis=0)
    col_all = np.bitwise_count(col_maps).astype(np.int32).sum(axis=0)
    start = 0
    while start < len(rows):
        some = rows[start:start + max(1, 2_000_000 // max(1, len(cols)))]
        x = sizes[some].astype(np.int64)
        low = start + 1 if within else int(np.searchsorted(col_sizes, -(-x[0] * percent // 100)))
        high = int(np.searchsorted(col_sizes, x[-1] * 100 // percent, "right"))
        start += len(some)
        if low >= high:
            continue
        y = col_sizes[low:high].astype(np.int64)
        need = least_overlap(x[:, None], y[None, :], percent)
        row_maps = maps[some]
        both = np.zeros((len(some), high - low), np.int32)
        for w in range(head):
            both += np.bitwise_count(row_maps[:, w, None] & col_maps[w, None, low:high])
        row_head = np.bitwise_count(row_maps[:, :head]).astype(np.int32).sum(axis=1)
        bound = np.minimum(x[:, None] - row_head[:, None], y[None, :] - col_head[None, low:high]) + both
        if within:
            at = np.arange(start - len(some), start)
            bound[at[:, None] >= np.arange(low, high)[None, :]] = -1
        i, j = np.nonzero(bound >= need)
        if len(i) and head < words:
            keep = []
            for a in range(0, len(i), 200_000):
                p, q = i[a:a + 200_000], j[a:a + 200_000]
                common = np.bitwise_count(row_maps[p] & maps[cols[low + q]]).astype(np.int64).sum(axis=1)
                all_row = np.bitwise_count(row_maps[p]).astype(np.int64).sum(axis=1)
                top = np.minimum(x[p] - all_row, y[q] - col_all[low + q]) + common
                keep.append(top >= need[p, q])
            keep = np.concatenate(keep)
            i, j = i[keep], j[keep]
        if len(i):
            root = forest(n, some[i], cols[low + j], root)
    return root


def verified_tile(sizes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, within: bool, percent: int) -> np.ndarray:
    """Labels of a spanning forest of the true links between left rows and the others."""
    n = len(sizes)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    order = np.argsort(sizes, kind="stable").tolist()
    members = [i for i in order if not left[i]] if not within else order
    sides = sizes.tolist()
    for at, i in enumerate(order):
        if not left[i]:
            continue
        for j in order[at + 1:] if within else members:
            small, large = sorted((sides[i], sides[j]))
            if 100 * small < percent * large:
                if sides[j] > sides[i]:
                    break
                continue
            a, b = find(i), find(j)
            if a == b:
                continue
            need = -(-percent * (small + large) // (100 + percent))
            both = np.concatenate((sets[i], sets[j]))
            both.sort(kind="stable")  # two sorted runs
            if int((both[1:] == both[:-1]).sum()) >= need:
                parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def _tile_links(group: pa.Table, root: np.ndarray) -> pa.RecordBatch:
    keys = np.array(group["key"].to_pylist(), object)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_pydict({"a": pa.array(keys[moved].tolist(), pa.string()),
                                       "b": pa.array(keys[root[moved]].tolist(), pa.string())})


def shingle_sets(df: DataFrame, text_col: str, keep: list[str], n: int = N, percent: int = PERCENT) -> DataFrame:
    """``keep`` columns, n_shingles, set_key, signature and band of every whole text."""
    ship(df.sparkSession)
    source = df.select(*keep, F.col(text_col).alias(fresh(df.select(*keep), "text_to_cut")[0]))
    schema = df.select(*keep).schema.add("n_shingles", "long").add("set_key", "string").add("signature", "binary").add("band", "integer")
    lows = bands(percent, 1 << 40)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            size, key, signature = [], [], []
            for t in texts(batch.column(batch.num_columns - 1)):
                s = shingles(t, n)
                size.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None)
                signature.append(bitmap(s) if len(s) else None)
            band = np.searchsorted(lows, np.array(size, np.int64), "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(size, pa.int64()), pa.array(key, pa.string()),
                                              pa.array(signature, pa.binary()), pa.array(band, pa.int32())], names=schema.names)

    return source.mapInArrow(run, schema)


def _candidates(sets: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """(a, b): a spanning forest of candidate pairs for each tile of ``sets`` (key, n, signature, band)."""
    sizes = sets.groupBy("band").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("signature")).alias("bytes")).collect()  # a row a band
    counts = {r.band: max(math.ceil(r.rows / block_rows), math.ceil(r.bytes / BLOCK_BYTES)) for r in sizes}
    blocks = F.create_map(*[F.lit(x) for b, c in counts.items() for x in (b, c)]) if counts else F.create_map().cast("map<int,int>")
    of = lambda b: F.coalesce(F.try_element_at(blocks, b), F.lit(0))
    own, after, before = of(F.col("band")), of(F.col("band") + 1), of(F.col("band") - 1)
    block = F.pmod(F.xxhash64("key"), own).cast("int")
    upto = lambda c: F.when(c > 0, F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))

    def tiles(others, tile):
        return F.transform(others, tile)

    # (left band, left block, right band, right block, is left); a block within itself is one tile
    t = lambda lb, li, rb, ri, left: F.struct(lb.alias("lb"), li.alias("li"), rb.alias("rb"), ri.alias("ri"), left.alias("left"))
    band, up, down = F.col("band"), F.col("band") + 1, F.col("band") - 1
    where = F.flatten(F.array(
        tiles(F.filter(upto(own), lambda j: j >= block), lambda j: t(band, block, band, j, F.lit(True))),
        tiles(F.filter(upto(own), lambda j: j < block), lambda j: t(band, j, band, block, F.lit(False))),
        tiles(upto(after), lambda j: t(band, block, up, j, F.lit(True))),
        tiles(upto(before), lambda j: t(down, j, band, block, F.lit(False)))))
    rows = sets.select("key", "n_shingles", "signature", F.explode(where).alias("t")).select("t.*", "key", "n_shingles", "signature")
    tile = ["lb", "li", "rb", "ri"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, tile):
            first = group.slice(0, 1).to_pylist()[0]
            within = first["lb"] == first["rb"] and first["li"] == first["ri"]
            left = group["left"].to_numpy(zero_copy_only=False)
            if within or not left.all():
                root = candidate_tile(group["n_shingles"].to_numpy(), group["signature"].to_pylist(), left, within, percent)
                yield _tile_links(group, root)

    return rows.repartition(*tile).sortWithinPartitions(*tile, "key").mapInArrow(run, "a string, b string")


def _verified(arrays: DataFrame, percent: int, check_rows: int) -> DataFrame:
    """(a, b): true links of ``arrays`` (component, key, hashes), a spanning forest for each tile."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / check_rows), F.ceil(F.sum(F.octet_length("hashes")) / CHECK_BYTES))
    sizes = arrays.groupBy("component").agg(blocks.alias("blocks")).where("blocks > 1")
    rows = arrays.join(broadcast_below(materialize(sizes, "jac-blocks")), "component", "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("key"), F.col("blocks"))
    tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.least(block, j).alias("i"), F.greatest(block, j).alias("j"), (block <= j).alias("left")))
    rows = rows.select("component", F.explode(tiles).alias("t"), "key", "hashes").select("component", "t.*", "key", "hashes")
    tile = ["component", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, tile):
            if group.num_rows < 2:
                continue
            first = group.slice(0, 1).to_pylist()[0]
            sets = [np.frombuffer(h, "<u8") for h in group["hashes"].to_pylist()]
            root = verified_tile(np.array([len(s) for s in sets]), sets, group["left"].to_numpy(zero_copy_only=False),
                                 first["i"] == first["j"], percent)
            yield _tile_links(group, root)

    return rows.repartition(*tile).sortWithinPartitions(*tile, "key").mapInArrow(run, "a string, b string")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, percent: int = PERCENT,
                       block_rows: int = BLOCK_ROWS, check_rows: int = CHECK_ROWS, with_digest: bool = False) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id linked, itself included).

    Documents link when percent% of the union of their shingle sets is shared.  A null or
    wordless text has an empty set and links with nothing; equal sets link.  Null ids take
    part in links but not in the minimum; alone they have a null component.  Other columns
    are not read.  ``with_digest`` adds text_digest, which tells rows of one id apart.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    digest = ["text_digest"] if with_digest else []
    told = docs.withColumn("text_digest", F.md5(F.col("body").cast("binary"))) if with_digest else docs
    sets = materialize(shingle_sets(told, "body", ["id", *digest], n, percent), "jac-sets")
    distinct = materialize(sets.where("set_key is not null").groupBy(F.col("set_key").alias("key")).agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"),
        F.first("band").alias("band")), "jac-distinct")
    least = 1
    while 100 * least < percent * (least + 1):
        least += 1  # smaller sets that differ are always too far apart
    candidates = components(_candidates(distinct.where(F.col("n_shingles") >= least), percent, block_rows), "a", "b", "jac-cand")
    candidates = materialize(candidates.select(F.col("node").alias("key"), F.col("root").alias("component")), "jac-groups")
    # The sets of candidates are cut again from their texts, of which one a set is read.
    chosen = materialize(candidates.join(distinct.select("key", "id"), "key"), "jac-chosen")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t, n) for t in texts(batch["body"])]
            yield pa.RecordBatch.from_pydict({
                "set_key": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in found], pa.string()),
                "hashes": pa.array([s.astype("<u8").tobytes() for s in found], pa.binary())})

    ids = chosen.select(F.col("id").alias("chosen_id")).distinct()
    read = docs.join(broadcast_below(ids), F.col("id").eqNullSafe(F.col("chosen_id")), "left_semi")
    arrays = read.mapInArrow(cut, "set_key string, hashes binary").join(
        broadcast_below(chosen.select(F.col("key"), "component")), F.col("set_key") == F.col("key"))
    arrays = materialize(arrays.groupBy("key").agg(F.first("component").alias("component"), F.first("hashes").alias("hashes")), "jac-arrays")
    linked = components(_verified(arrays, percent, check_rows), "a", "b", "jac")
    nodes = distinct.select("key", "id").join(linked.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = nodes.groupBy("root").agg(F.min("id").alias("component_id"))
    per_key = nodes.join(smallest, "root").select(F.col("key").alias("set_key"), "component_id")
    return sets.select("id", "n_shingles", "set_key", *digest).join(per_key, "set_key", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), *digest)


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """4-word shingle Jaccard components (0.85) of all ``documents``."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
