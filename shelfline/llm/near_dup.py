"""Near-duplicate detection: MinHash bands for candidates, odd sketches to screen them, full sets to confirm.

A document's set is its distinct word shingles. Equal sets are one class from the start. Each class has MinHash
values for the bands and an odd sketch: the parity bitmap of its shingles, for sets above ``SAMPLE`` of those whose
hash lies below a limit that halves with every doubling of the set. Sets that can be similar are at most one such
level apart and are compared below the lower limit of the two, so both samples come from the same part of the hashes.
The popcount of the XOR of two bitmaps bounds the symmetric difference and so the similarity; pairs whose bounds
reach the threshold are confirmed on the full sets; links are closed into components.

Large buckets. Only links that change the components are needed, so a task proposes a spanning forest of its pairs,
the most similar first, and the links that the full sets refute are looked at again: in their buckets, trees are now the
confirmed components and refuted pairs are left out; ``LOOKS`` rounds propose the next best forest (each costs a pass
for components), then
every remaining pair of different components that may be linked is confirmed. No link is lost, and a group of copies
proposes links in proportion to its size. A bucket of more than ``TILE`` classes is first compared with its hub (the
class that most of its other buckets share); only classes that do not seem linked to the hub go on, against all tiles
of the bucket, each tile pair in its own task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat
from shelfline.session import materialize

VALUES = 150  # MinHash values of a set
MISSED = 1e-5  # a pair just at the threshold may be in no common bucket with this probability
SAMPLE, BITS = 1024, 2048  # most shingles of a sample, and bits of its odd sketch
SIGMA = 4.5
TILE = 512
LOOKS = 0
_rng = np.random.default_rng(20240229)
_MULT = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingle_sets(chunk: flat.Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, documents) of the distinct shingles, ordered by document and hash.

    A document with fewer than ``words`` words has its whole sequence as the only shingle, without words none.
    """
    data = flat.LOWER[chunk.data]
    starts, ends = flat.runs(~flat.SPACE[data], chunk.bounds)
    hashes, docs = flat.range_hashes(data, starts, ends), flat.doc_of(starts, chunk.bounds)
    grams, owner = flat.ngrams(hashes, docs, words)
    counts = np.bincount(docs, minlength=chunk.n)
    for k in range(1, words):  # short documents
        g, d = flat.ngrams(hashes, docs, k)
        keep = counts[d] == k
        grams, owner = np.r_[grams, g[keep] ^ np.uint64(k)], np.r_[owner, d[keep]]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    if len(grams):
        keep = np.r_[True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])]
        grams, owner = grams[keep], owner[keep]
    return grams, owner


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def banding(threshold: float) -> tuple[int, int]:
    """(rows, bands): the longest bands that miss a pair at the threshold with probability ``MISSED`` at most."""
    for rows in range(12, 1, -1):
        if (1 - threshold**rows) ** (VALUES // rows) <= MISSED:
            return rows, VALUES // rows
    return 1, VALUES


def level_of(size: np.ndarray) -> np.ndarray:
    """How often the limit of the hashes is halved for sets of these sizes."""
    return np.ceil(np.log2(np.maximum(size, SAMPLE) / SAMPLE)).astype(np.int64)


def _sketches(grams: np.ndarray, owner: np.ndarray, n: int, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size of the sample of each document at its ``level``, and the odd sketch of the sample."""
    shift = np.clip(64 - level[owner], 1, 63).astype(np.uint64)
    low = (level[owner] == 0) | (grams >> shift == 0)
    cell = owner[low] * BITS + (flat.mix(grams[low]) >> np.uint64(53)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * BITS) & 1).astype(np.uint8).reshape(n, BITS)
    return np.bincount(owner[low], minlength=n), np.packbits(odd, axis=1)


def signatures(words: int, rows: int, bands: int):
    """mapInArrow function: (doc_id, text, tie) to set size, 128-bit set digest, band keys, odd sketches and tie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in flat.chunks(batch.column(1)):
                n = chunk.n
                grams, owner = shingle_sets(chunk, words)
                size = np.bincount(owner, minlength=n)
                at = flat.first_of_doc(owner)
                own = owner[at]
                digest = _digests(grams, owner, n)
                keys = np.zeros((n, bands), np.uint64)
                if len(grams):
                    for band in range(bands):
                        key = np.full(len(at), band, np.uint64)
                        for i in range(band * rows, band * rows + rows):
                            least = np.minimum.reduceat((grams * _MULT[i] + _ADD[i]) >> np.uint64(24), at)
                            key = flat.mix(key * np.uint64(0x9FB21C651E98DF25) + least)
                        keys[own, band] = key
                level = level_of(size)
                sampled, sketch = _sketches(grams, owner, n, level)
                # Only sets above half the sample size can be similar to one of the next level.
                large = np.flatnonzero(size > SAMPLE // 2)
                part = np.isin(owner, large)
                number = np.searchsorted(large, owner[part])
                up, sketch_up = _sketches(grams[part], number, len(large), level[large] + 1)
                sampled_up, ups = np.zeros(n, np.int64), [b""] * n
                sampled_up[large] = up
                for i, row in zip(large, sketch_up):
                    ups[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(chunk.first, n), pa.array(size.astype(np.int64)),
                    pa.array(digest[0]), pa.array(digest[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, n * bands + 1, bands, dtype=np.int32)),
                                             pa.array(_as_long(keys.ravel()))),
                    pa.array(sampled.astype(np.int64)), pa.array([x.tobytes() for x in sketch], pa.binary()),
                    pa.array(sampled_up), pa.array(ups, pa.binary()), batch.column(2).slice(chunk.first, n),
                ], names=["doc_id", "n_shingles", "d1", "d2", "bands", "k", "sketch", "k_up", "sketch_up", "tie"])

    return run


SKETCH = ["n_shingles", "k", "sketch", "k_up", "sketch_up"]
SKETCH_TYPES = "n_shingles long, k long, sketch binary, k_up long, sketch_up binary"
SIGNATURE = ("doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, k long, sketch binary, k_up long, "
             "sketch_up binary, tie long")


def _similarity(z: np.ndarray, a: np.ndarray, b: np.ndarray, sampled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimate of the similarity of two samples of sizes ``a`` and ``b``, and an upper bound for that of the sets.

    ``z`` is the popcount of the XOR of their sketches, ``sampled`` tells whether the samples are less than the sets.
    The popcount never exceeds the difference of the samples: that bounds the similarity of whole sets that differ
    little; otherwise ``SIGMA`` standard errors do.
    """
    ab = (a + b).astype(float)
    left = np.maximum(1 - 2 * z / BITS, 1e-3)
    d = -BITS / 2 * np.log(left)
    of = lambda gap: np.clip((ab - gap) / np.maximum(ab + gap, 1), 0, 1)
    est = of(d)
    var = np.maximum(BITS / 4 * (1 - left**2) - d * left**2, 0) / left**2 * (2 * ab / np.maximum(ab + d, 1) ** 2) ** 2
    var += np.where(sampled, est * (1 - est) / np.maximum((ab + d) / 2, 1), 0)
    return est, np.where(~sampled & (z < 64), of(z), est + SIGMA * np.sqrt(var))


@dataclass
class Sketched:
    """The classes of a bucket: sizes, levels, and the sketch and sample size at the own level and the next."""

    size: np.ndarray
    level: np.ndarray
    bits: np.ndarray  # (2, n, words)
    k: np.ndarray  # (2, n)

    @staticmethod
    def of(table: pa.Table, prefix: str = "") -> Sketched:
        size = table[f"{prefix}n_shingles"].to_numpy().astype(np.int64)
        blank = bytes(BITS // 8)
        bits = [np.frombuffer(b"".join(x or blank for x in table[prefix + c].to_pylist()), np.uint64).reshape(len(size), -1) for c in ("sketch", "sketch_up")]
        return Sketched(size, level_of(size), np.stack(bits), np.stack([table[prefix + c].to_numpy() for c in ("k", "k_up")]))

    def at(self, rows: np.ndarray) -> Sketched:
        return Sketched(self.size[rows], self.level[rows], self.bits[:, rows], self.k[:, rows])

    def bounds(self, other: Sketched, pairwise: bool) -> tuple[np.ndarray, np.ndarray]:
        """``_similarity`` of every row with every row of ``other``, or of the rows side by side if ``pairwise``."""
        wide = (lambda x, y: (x, y)) if pairwise else (lambda x, y: (x[:, None], y[None, :]))
        la, lb = wide(self.level, other.level)
        level, (sa, sb) = np.maximum(la, lb), wide(self.size, other.size)
        z, a, b = (np.zeros(level.shape, np.int64) for _ in range(3))
        for up_a, up_b in ((0, 0), (0, 1), (1, 0)):
            here = (la + up_a == level) & (lb + up_b == level) & (la + up_a == lb + up_b)
            if not here.any():
                continue
            x, y = self.bits[up_a], other.bits[up_b]
            part = np.zeros(level.shape, np.int64)
            for w in range(x.shape[1]):
                part += np.bitwise_count(np.bitwise_xor(*wide(x[:, w], y[:, w])))
            ka, kb = np.broadcast_arrays(*wide(self.k[up_a], other.k[up_b]))
            z[here], a[here], b[here] = part[here], ka[here], kb[here]
        est, high = _similarity(z, a, b, level > 0)
        # Sets of very different size cannot be similar, whatever their samples say.
        most = np.minimum(sa, sb) / np.maximum(np.maximum(sa, sb), 1)
        return np.minimum(est, most), np.where(np.abs(la - lb) > 1, most, np.minimum(high, most))


LINK = "a long, b long"


def propose(threshold: float, full: bool = False):
    """applyInArrow function over one bucket or tile pair: links to be confirmed.

    Rows have ``id``, the columns of ``SKETCH``, and may have ``open`` (at least one end of a link is open), ``tree``
    (the component a class is known to be in) and ``refuted`` (classes it is known not to be linked with). Of the pairs
    that may reach the threshold, a spanning forest between the trees is proposed, the most similar first, or if
    ``full`` all pairs of different trees.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, n = table["id"].to_numpy(), table.num_rows
        is_open = table["open"].to_numpy(zero_copy_only=False).astype(bool) if "open" in table.column_names else np.ones(n, bool)
        sets = Sketched.of(table)
        tree = np.unique(table["tree"].to_numpy(), return_inverse=True)[1] if "tree" in table.column_names else np.arange(n)
        # The closed rows of a bucket are linked to its hub already, so they form one tree.
        tree = np.where(is_open, tree, -1)
        apart = table["refuted"].to_pylist() if "refuted" in table.column_names else [None] * n
        place = {x: i for i, x in enumerate(ids.tolist())}
        rows = np.flatnonzero(is_open)
        out: list[tuple[int, int]] = []
        for lo in range(0, len(rows), 256):
            block = rows[lo : lo + 256]
            est, high = sets.at(block).bounds(sets, pairwise=False)
            may = (high >= threshold) & (tree[block][:, None] != tree[None, :])
            for k, i in enumerate(block):
                for other in apart[i] or ():
                    if other in place:
                        may[k, place[other]] = False
            i, j = np.nonzero(may)
            if full:
                once = (block[i] < j) | ~is_open[j]
                out.extend(zip(block[i[once]], j[once]))
                continue
            order = np.argsort(-est[i, j], kind="stable")
            i, j = i[order], j[order]
            while len(i):  # each round links every remaining tree pair once, best pair first
                a, b = tree[block[i]], tree[j]
                live = a != b
                i, j, a, b = i[live], j[live], a[live], b[live]
                used: set[int] = set()
                for k in np.sort(np.unique(a, return_index=True)[1]):
                    if a[k] not in used and b[k] not in used:
                        used.update((a[k], b[k]))
                        out.append((block[i[k]], j[k]))
                        tree[tree == max(a[k], b[k])] = min(a[k], b[k])
        a, b = ids[np.array(out, np.int64).reshape(-1, 2)].T
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def hub_links(threshold: float):
    """mapInArrow function: does (id, sketches) seem linked to the hub of its bucket?"""
    columns = ["bucket", "n", "id", *SKETCH, "hub"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            est, _ = Sketched.of(t).bounds(Sketched.of(t, "hub_"), pairwise=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in columns] + [pa.array(est < threshold)], names=[*columns, "open"])

    return run


def _digests(grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit digests of each document's set, as rows of signed integers."""
    out = np.zeros((2, n), np.uint64)
    at = flat.first_of_doc(owner)
    if len(grams):
        for i, salt in enumerate((0x51ED270B, 0xC2B2AE35)):
            out[i, owner[at]] = np.add.reduceat(flat.mix(grams + np.uint64(salt)), at)
    return _as_long(out)


def set_arrays(words: int):
    """mapInArrow function: (doc_id, text) to the set digest and the sorted shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in flat.chunks(batch.column(1)):
                grams, owner = shingle_sets(chunk, words)
                digest = _digests(grams, owner, chunk.n)
                ends = np.zeros(chunk.n + 1, np.int32)
                np.cumsum(np.bincount(owner, minlength=chunk.n), out=ends[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.n), pa.array(digest[0]), pa.array(digest[1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(_as_long(grams)))], names=["doc_id", "d1", "d2", "grams"])

    return run


def bucket_members(classes: DataFrame) -> DataFrame:
    """(bucket, n, id): the classes of each bucket with more than one, stored."""
    exploded = classes.select("id", F.posexplode("bands").alias("band", "key")).select(
        "id", F.xxhash64("band", "key").alias("bucket"))
    sizes = exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("who"))
    # Buckets with the same members are one bucket.
    kept = sizes.where("n > 1").groupBy("n", "who").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return materialize(exploded.join(kept, "bucket"), "near-members")


def candidate_links(members: DataFrame, narrow: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs (a, b) of class ids that may be linked; ``narrow``: id and sketches of the classes."""
    small = members.where(F.col("n") <= TILE).join(narrow, "id").withColumn("open", F.lit(True))
    pairs = small.groupBy("bucket").applyInArrow(propose(threshold), LINK)

    large = members.where(F.col("n") > TILE)
    score = members.groupBy("id").agg(F.sum("n").alias("score"))
    hubs = large.join(score, "id").groupBy("bucket").agg(
        F.max_by("id", F.struct(F.col("score"), -F.col("id"))).alias("hub"))
    hubs = hubs.join(narrow.select(F.col("id").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in SKETCH]), "hub")
    starred = large.join(narrow, "id").join(hubs, "bucket").mapInArrow(
        hub_links(threshold), f"bucket long, n long, id long, {SKETCH_TYPES}, hub long, open boolean")
    starred = materialize(starred, "near-starred")
    star = starred.where("not open and id != hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    # Tiles of the whole bucket against tiles of its open classes.
    shape = starred.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"), F.ceil(F.sum(F.col("open").cast("long")) / TILE).alias("open_tiles"))
    dealt = starred.join(shape.where("open_tiles > 0"), "bucket").withColumn("h", F.xxhash64("id", "bucket"))
    resident = dealt.select("bucket", "id", *SKETCH, "open", F.pmod("h", "tiles").alias("i"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.col("open_tiles") - 1)).alias("j"))
    visiting = dealt.where("open").select("bucket", "id", *SKETCH, "open", F.pmod("h", "open_tiles").alias("j"),
                                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("i"))
    grid = resident.unionByName(visiting).groupBy("bucket", "i", "j", "id").agg(*[F.first(c).alias(c) for c in (*SKETCH, "open")])
    crossed = grid.groupBy("bucket", "i", "j").applyInArrow(propose(threshold), LINK)
    return pairs.unionByName(star).unionByName(crossed).distinct()


def second_look(members: DataFrame, narrow: DataFrame, recent: DataFrame, refuted: DataFrame, roots: DataFrame,
                threshold: float, full: bool) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, in the buckets that hold both ends of a ``recent``
    refuted link.

    ``refuted`` are all pairs known not to be linked. Buckets are worked through by pairs of tiles.
    """
    first, second = members.select(F.col("id").alias("a"), "bucket"), members.select(F.col("id").alias("b"), "bucket")
    buckets = recent.join(first, "a").join(second, ["b", "bucket"]).select("bucket").distinct()
    rows = members.join(buckets, "bucket", "left_semi").join(roots, "id", "left").withColumn("tree", F.coalesce("root", "id"))
    rows = materialize(rows.select("bucket", "n", "id", "tree"), "near-again")
    split = rows.groupBy("bucket").agg(F.min("tree").alias("lo"), F.max("tree").alias("hi")).where("lo < hi")
    turned = refuted.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")),
                                              F.struct(F.col("b").alias("id"), F.col("a").alias("other")))).alias("p"))
    known = turned.groupBy("p.id").agg(F.collect_list("p.other").alias("refuted"))
    rows = rows.join(split, "bucket", "left_semi").join(narrow, "id").join(known, "id", "left").withColumn("tiles", F.ceil(F.col("n") / TILE))
    own = F.pmod(F.xxhash64("id", "bucket"), F.col("tiles"))
    every = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    tiles = F.transform(every, lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    grid = rows.select("bucket", "id", *SKETCH, "tree", "refuted", F.explode(tiles).alias("t")).select("*", "t.i", "t.j").drop("t")
    return grid.groupBy("bucket", "i", "j").applyInArrow(propose(threshold, full), LINK).distinct()


def class_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, grams) of the classes in ``ids``, stored; ``classes``: id, d1, d2 and doc_id of one member."""
    wanted = classes.join(ids, "id", "left_semi").select("id", "d1", "d2", "doc_id")
    arrays = docs.join(wanted, "doc_id", "left_semi").mapInArrow(
        set_arrays(words), "doc_id long, d1 long, d2 long, grams array<long>")
    return materialize(arrays.join(wanted, ["doc_id", "d1", "d2"]).groupBy("id").agg(F.first("grams").alias("grams")), "near-sets")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``pairs`` with ``linked``: do the full sets meet ``100 * intersection >= percent * union``? Stored."""
    sets = class_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), classes, docs, words)
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(left, "a").join(right, "b")
    same = F.size(F.array_intersect("ga", "gb"))
    linked = 100 * same >= percent * (F.size("ga") + F.size("gb") - same)
    return materialize(both.select(*pairs.columns, linked.alias("linked")), "near-confirmed")


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in ``links``: the smallest id of its component.

    Alternates two relabelling steps on the link table, each stored, until it is a set of stars: every id takes
    the smallest id among its neighbours, then larger neighbours are passed on to it.
    """
    edges = materialize(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "near-edges")
    before = None
    while True:
        for larger in (True, False):
            if larger:
                near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            else:
                near = edges
            least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            moved = near.join(least, "u")
            if larger:
                moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            else:
                moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                    least.select("u", F.col("m").alias("v")))
            edges = materialize(moved.where("u != v").distinct(), "near-edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "id")
        before = now


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, tie, n_shingles, component_id, kept``; ``tie`` is ``xxhash64`` of the text.

    A null text is empty, and an empty set is linked with nothing. Rows that repeat an id are documents of their
    own; the component is named by the smallest id in it, and rows with that id are kept. Rows without an id join
    a component only through an equal set (and are then dropped); otherwise their component is null and they are
    kept. Other columns play no part. An empty table gives no rows.
    """
    flat.reachable(docs.sparkSession)
    threshold = percent / 100
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = base.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    signed = materialize(signed.mapInArrow(signatures(words, *banding(threshold)), SIGNATURE).select(
        "doc_id", "tie", "d1", "d2", "bands", *SKETCH), "near-signatures")
    classes = signed.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("bands", *SKETCH[1:])])
    classes = materialize(classes.where("doc_id is not null").withColumn("id", F.xxhash64("d1", "d2")), "near-classes")
    named_docs, narrow = base.where("doc_id is not null"), classes.select("id", *SKETCH)
    members = bucket_members(classes)
    pairs = materialize(candidate_links(members, narrow, threshold), "near-pairs")
    checked = confirmed(pairs, classes, named_docs, words, percent)
    links, refuted = checked.where("linked").select("a", "b"), checked.where("not linked").select("a", "b")
    recent = refuted
    for look in range(LOOKS + 1):
        if not recent.limit(1).count():
            break
        again = second_look(members, narrow, recent, refuted, components(links), threshold, full=look == LOOKS)
        checked = confirmed(materialize(again, "near-pairs"), classes, named_docs, words, percent)
        recent = checked.where("not linked").select("a", "b")
        links, refuted = links.unionByName(checked.where("linked").select("a", "b")), refuted.unionByName(recent)
    rooted = classes.select("id", "d1", "d2", "n_shingles", "doc_id").join(components(links), "id", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "id"))
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(names, "root").select("d1", "d2", "n_shingles", "component_id")
    labelled = signed.select("doc_id", "tie", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    out = labelled.select("doc_id", "tie", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
