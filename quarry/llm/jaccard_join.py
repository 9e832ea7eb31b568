"""Exact Jaccard join of word n-gram sets by pivots, Voronoi regions and triangle windows.

Unrelated texts all lie at distance 1 from any pivot, so pivots drawn from the
whole corpus would give one boundary region that holds everything.  The first
regions are therefore formed where distances carry information: under any fixed
order of the n-grams, two sets within the distance share one of their first ones
(the prefix bound), and each n-gram met in two prefixes is a region.

1. One pass over the texts gives each document's size and set fingerprint, and
   a count sketch of all n-grams with ``2 ** SKETCH_BITS`` counters, whatever
   the corpus.  An n-gram's key is (level of its counter, hash): the order by
   key puts frequent n-grams last, and is exact however full the sketch is.
2. Equal sets become one class; the rest works on class representatives.
3. The n-grams of all prefixes are sorted by (n-gram, size of the set).  From the
   place of the n-gram in a prefix follows how large a partner may be, so each
   n-gram's run is cut wherever no pair can reach across; runs of one member are
   gone.  Prefixes are longer by ``n / SPARE`` than one shared n-gram asks for, so
   linked sets share that many more, and members met in fewer runs leave.  Of
   regions with the same members one stays, and regions whose members all share
   one larger region are part of it.
4. The sets of the members left (the texts themselves are never shuffled) meet
   their regions.  A region is joined recursively in its task (:func:`join_region`): members
   that share too few n-grams with all others leave; ``PIVOTS`` pivots are drawn
   far apart, exact distances from them link what is near, every member goes to
   the Voronoi cell of its nearest pivot and, as a boundary member, to each cell
   whose pivot is at most twice the join distance farther; cells of one component
   are done, the others are joined in the same way without the pivots.  Where cells
   overlap so much that they hold more pairs than the members left, these stay one cell.
5. Regions of more than ``WEIGHT`` n-grams are not given to one task: they are
   divided by the same step as a Spark job, and what still is too heavy then is
   joined in pairs of blocks, members near the pivot only with those that are not.
6. Components of the links are found by label propagation with shortcuts.

Edge cases: NULL and empty texts have no n-grams and link with nothing; a text
of fewer than n words is one n-gram; very long texts are read whole; rows of
equal doc_id and text are one document, rows of one doc_id and different texts
belong to one node; NULL ids get no class and no row; empty tables give no rows;
only ``doc_id`` and ``text`` are read, so further columns of any name do not
matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import materialise, unwrapped, wrapped
from quarry.llm.textblocks import blocks, distinct_by_document, mix, shingles, words
from quarry.sources.worktables import WorkTables

WORDS = 5
PERCENT = 80
PIVOTS = 8
#: A prefix is longer by a set's size over this, which is how many n-grams linked sets share in it.
SPARE = 20
#: N-grams of a region that one task joins at most, and rounds of dividing heavier ones.
WEIGHT, DIVISIONS = 1 << 22, 3
#: Counters of the n-gram sketch and bits of the id bitmap (as powers of two): fixed sizes.
SKETCH_BITS = 22
SLAB_BITS = 16
BITMAP_BITS = 25
KEY_BITS = 58


def _plain(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.col("doc_id").isNotNull()))


def _prints(values: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
    """Two sums over each set tell sets apart like a 128-bit hash."""
    out = []
    for salt in (1, 2):
        mixed = mix(values + np.uint64(salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        out.append((sums[of[1:]] - sums[of[:-1]]).view(np.int64))
    return out


SURVEY = "doc_id long, n_shingles long, p1 long, p2 long, slab int, width int, counts binary"


def _survey(k: int):
    """A row per document (size and fingerprint) and a row per slab of the task's n-gram counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = [c.split()[0] for c in SURVEY.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
        for batch in batches:
            for first, last, raw, at in blocks(batch["text"], 1 << 20):
                values, of = distinct_by_document(*shingles(*words(raw, at), k))
                met, times = np.unique((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int32), return_counts=True)
                counts[met] += times.astype(np.uint32)
                cols = [batch["doc_id"].slice(first, last - first), np.diff(of), *_prints(values, of)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(cols, kinds)]
                    + [pa.nulls(last - first, t) for t in kinds[4:]], names=names)
        for slab, part in enumerate(counts.reshape(-1, 1 << SLAB_BITS)):
            if part.any():
                width = 1 if part.max() < 256 else 4
                blob = zlib.compress(part.astype(f"<u{width}").tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, t) for t in kinds[:4]] + [pa.array([slab], pa.int32()), pa.array([width], pa.int32()),
                                                           pa.array([blob], pa.binary())], names=names)

    return run


def _sum_slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Eighths of the binary logarithm of the summed counters, a byte each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slab, width, blob in zip(*(batch[c].to_pylist() for c in ("slab", "width", "counts"))):
            total = sums.setdefault(slab, np.zeros(1 << SLAB_BITS, np.int64))
            total += np.frombuffer(zlib.decompress(blob), f"<u{width}")
    for slab, total in sums.items():
        logs = np.minimum(np.round(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([int(total.sum())], pa.int64()),
                                          pa.array([logs.tobytes()], pa.binary())], names=["slab", "n", "logs"])


def sketch_levels(survey: DataFrame) -> np.ndarray:
    """The level of each counter: half octaves above the mean load (2 ** SKETCH_BITS bytes in all)."""
    slabs = (survey.where("slab is not null").select("slab", "width", "counts")
             .repartition(1 << (SKETCH_BITS - SLAB_BITS), "slab").mapInArrow(_sum_slabs, "slab int, n long, logs binary"))
    logs, n = np.zeros((1 << (SKETCH_BITS - SLAB_BITS), 1 << SLAB_BITS), np.uint8), 0
    for r in slabs.collect():
        logs[r["slab"]], n = np.frombuffer(r["logs"], np.uint8), n + r["n"]
    base = 8 * np.log2(max(1.0, n / (1 << SKETCH_BITS)))
    return np.clip((logs.reshape(-1) - base) // 4, 0, 63).astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _set_rows(k: int, levels, percent: int | None, bitmap=None):
    """Sorted keys of each set: the prefix (``percent`` given) or all; of the ids in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels.value, np.uint8)
        member = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            if member is not None:
                at = _bits(batch["doc_id"].to_numpy())
                batch = batch.filter(pa.array((member[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0))
            for first, last, raw, at in blocks(batch["text"], 1 << 20):
                values, of = distinct_by_document(*shingles(*words(raw, at), k))
                p1, p2 = _prints(values, of)
                keys = ((level[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
                         << np.uint64(KEY_BITS)) | (values >> np.uint64(64 - KEY_BITS)))
                out = []
                for a, b in zip(of[:-1], of[1:]):
                    n = int(b - a)
                    out.append(np.sort(keys[a:b])[:head_length(n, percent) if percent else n].astype("<u8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(first, last - first), pa.array(np.diff(of), pa.int64()), pa.array(p1),
                     pa.array(p2), pa.array(out, pa.binary())], names=["doc_id", "n_shingles", "p1", "p2", "s"])

    return run


SET_ROWS = "doc_id long, n_shingles long, p1 long, p2 long, s binary"
PRINT = ["doc_id", "n_shingles", "p1", "p2"]


def spare(n):
    return np.maximum(n // SPARE, 1)


def head_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + int(spare(n))


# --- regions -------------------------------------------------------------------------------------------------------

def _grams(percent: int):
    """(g, id, q, n, most) of each key of a prefix: ``most`` is the largest partner that the key's place allows.

    If the key at place i (from 0) is among the first ``spare`` ones that two
    sets share, they share at most n - i and those before it; sizes n and m need
    percent / (100 + percent) * (n + m).  ``q`` tells sets of one id apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.frombuffer(s, "<i8") for s in batch["s"].to_pylist()]
            if not keys:
                continue
            lengths = [len(x) for x in keys]
            n = np.repeat(batch["n_shingles"].to_numpy(), lengths)
            place = np.concatenate([np.arange(x) for x in lengths])
            most = np.minimum((n - place + spare(n) - 1) * (100 + percent) // percent - n, n * 100 // percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.repeat(batch["doc_id"].to_numpy(), lengths)),
                 pa.array(np.repeat(batch["p1"].to_numpy().astype(np.int32), lengths)), pa.array(n.astype(np.int32)),
                 pa.array(most.astype(np.int32))], names=["g", "id", "q", "n", "most"])

    return run


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (g, n): the runs within which pairs can link, without those of one row.

    Only the last row is carried from batch to batch; ``r`` numbers the runs of the task.
    """
    names = ["g", "id", "q", "n", "most"]
    run, reach, last = 0, 0, None

    def out(rows: list[np.ndarray], runs: np.ndarray, keep: np.ndarray) -> pa.RecordBatch:
        g, i, p, n, _ = (r[keep] for r in rows)
        return pa.RecordBatch.from_arrays([pa.array(g), pa.array(runs[keep]), pa.array(i), pa.array(p), pa.array(n)],
                                          names=["g", "r", "id", "q", "n"])

    paired = False  # whether the carried row's run had a row before it
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch[c].to_numpy() for c in names]
        if last is not None:
            rows = [np.concatenate([[x], y]) for x, y in zip(last, rows)]
        g, n, most = rows[0], rows[3], rows[4].astype(np.int64)
        if last is not None:
            most[0] = max(most[0], reach)
        # The farthest reach of the earlier rows of the same n-gram.
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        group = np.cumsum(np.concatenate([[False], g[1:] != g[:-1]]))
        farthest = np.maximum.accumulate(most + group * (1 << 40)) - group * (1 << 40)
        new = np.ones(len(g), bool)
        new[1:] = n[1:] > farthest[:-1]
        new[first] = True
        new[0] = last is None
        runs = run + np.cumsum(new)
        beside = np.zeros(len(g), bool)
        beside[1:] |= ~new[1:]
        beside[:-1] |= ~new[1:]
        beside[0] |= paired
        if len(g) > 1:
            yield out([r[:-1] for r in rows], runs[:-1], beside[:-1])
        # A run's reach goes on past the batch; of the carried row only its own reach is known otherwise.
        last, reach, run, paired = [r[-1] for r in rows], int(farthest[-1]), int(runs[-1]), bool(~new[-1] if len(g) > 1 else paired)
    if last is not None and paired:
        yield out([np.array([x]) for x in last], np.array([run]), np.array([True]))


def regions(heads: DataFrame, percent: int) -> DataFrame:
    """(g, id, q, n): members of the runs of each n-gram, runs of one member left out; ``g`` names the run."""
    grams = heads.select(*PRINT, "s").mapInArrow(_grams(percent), "g long, id long, q int, n int, most int")
    runs = grams.repartition("g").sortWithinPartitions("g", "n").mapInArrow(_cut_runs, "g long, r long, id long, q int, n int")
    return runs.select(F.xxhash64("g", "r", F.spark_partition_id()).alias("g"), "id", "q", "n")


def often_met(left: DataFrame, percent: int) -> DataFrame:
    """Members that are in as many regions as a link's shared n-grams need; regions of one member left out.

    The smallest partner has ``percent`` of a member's size, and shares the
    spare n-grams of the smaller one.
    """
    need = F.greatest(F.floor(F.ceil(F.col("n") * percent / 100) / SPARE), F.lit(1))
    members = left.groupBy("id", "q", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= need).select("id", "q")
    rows = left.join(members, ["id", "q"], "left_semi")
    shared = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g")
    return rows.join(shared, "g", "left_semi")


def distinct_regions(left: DataFrame) -> DataFrame:
    """One region of those with the same members (told apart by count, ends and two 64-bit sums of hashes)."""
    same = [F.count(F.lit(1)), F.min("id"), F.max("id"), F.bit_xor(F.xxhash64("id", "q")),
            F.bit_xor(F.xxhash64("id", "q", F.lit(1)))]
    marks = left.groupBy("g").agg(*[c.alias(f"m{k}") for k, c in enumerate(same)])
    first = marks.groupBy(*[f"m{k}" for k in range(len(same))]).agg(F.min("g").alias("g")).select("g")
    return left.join(first, "g", "left_semi")


def outer_regions(left: DataFrame) -> DataFrame:
    """Regions that are not part of the largest region of all their members."""
    sized = left.join(left.groupBy("g").agg(F.count(F.lit(1)).alias("size")), "g")
    home = sized.groupBy("id", "q").agg(F.max(F.struct("size", "g"))["g"].alias("home"))
    homes = left.join(home, ["id", "q"]).groupBy("g").agg(F.min("home").alias("lo"), F.max("home").alias("hi"))
    return left.join(homes.where("lo <> hi or lo = g").select("g"), "g", "left_semi")


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITMAP_BITS, np.uint8)
    for batch in batches:
        bits[_bits(batch["id"].to_numpy())] = 1
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["bits"])


def id_bitmap(ids: DataFrame) -> bytes:
    """A bitmap of hashed ids: a fixed number of bits, false positives only."""
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in ids.coalesce(8).mapInArrow(_bitmap, "bits binary").collect():
        out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.tobytes()


# --- joining a region ----------------------------------------------------------------------------------------------

class _Region:
    """The sets of one region as numbers of their n-grams, and the components found so far."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], percent: int):
        self.ids, self.percent = ids, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.grams, self.codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.parent = list(range(len(ids)))
        self.links: list[tuple[int, int]] = []
        #: A number for each n-gram, 0 between uses: what a cell costs depends on its own n-grams only.
        self.counts = np.zeros(len(self.grams), np.int64)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def one_component(self, cell: np.ndarray) -> bool:
        first = self.root(int(cell[0]))
        return all(self.root(int(x)) == first for x in cell[1:])

    def flat(self, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams of the members, one after the other, and where each member's begin."""
        sizes = self.sizes[cell]
        begin = np.cumsum(sizes) - sizes
        return self.codes[np.repeat(self.starts[cell] - begin, sizes) + np.arange(sizes.sum())], begin

    def related(self, cell: np.ndarray) -> np.ndarray:
        """Members of whose n-grams others of the cell hold as many as a link needs."""
        while len(cell) > 1:
            codes, begin = self.flat(cell)
            np.add.at(self.counts, codes, 1)
            shared = self.counts[codes] > 1
            self.counts[codes] = 0
            enough = 100 * np.add.reduceat(shared.astype(np.int64), begin) >= self.percent * self.sizes[cell]
            if enough.all():
                break
            cell = cell[enough]
        return cell

    def distances(self, pivot: int, cell: np.ndarray, codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Exact distances of the cell from the pivot; near members join it."""
        own = self.codes[self.starts[pivot]:self.starts[pivot + 1]]
        self.counts[own] = 1
        both = np.add.reduceat(self.counts[codes], begin)
        self.counts[own] = 0
        either = self.sizes[cell] + self.sizes[pivot] - both
        for x in cell[100 * both >= self.percent * either]:
            a, b = self.root(pivot), self.root(int(x))
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self.links.append((pivot, int(x)))
        return 1 - both / either

    def join(self, pivots: int) -> list[tuple[int, int]]:
        """Pairs of ids that link and connect all that links connect."""
        # Two times the join distance, and a little for rounding.
        window = 2 * (100 - self.percent) / 100 + 1e-9
        cells = [np.arange(len(self.ids))]
        while cells:
            cell = self.related(cells.pop())
            if len(cell) < 2 or self.one_component(cell):
                continue
            codes, begin = self.flat(cell)
            drawn, rows, away = [], [], np.full(len(cell), np.inf)
            for _ in range(min(pivots, len(cell))):
                at = int(np.argmax(away)) if drawn else 0
                drawn.append(at)
                rows.append(self.distances(int(cell[at]), cell, codes, begin))
                away = np.minimum(away, rows[-1])
                away[drawn] = -1.0
            rest = np.delete(np.arange(len(cell)), drawn)
            if not len(rest):
                continue
            table = np.array(rows)[:, rest]
            inside = table <= table.min(axis=0) + window
            # Cells of the same members are one.
            inside = np.unique(inside, axis=0)
            if (inside.sum(axis=1) ** 2).sum() > len(rest) ** 2:
                # Cells that overlap so much hold more pairs than the members left, and would again and
                # again: those stay together, which never takes more distances than there are pairs.
                inside = np.ones((1, len(rest)), bool)
            cells += [cell[rest[row]] for row in inside if row.sum() > 1]
        return [(self.ids[a], self.ids[b]) for a, b in self.links]


def join_region(ids: list[int], sets: list[np.ndarray], percent: int = PERCENT, pivots: int = PIVOTS) -> list[tuple[int, int]]:
    """Linked pairs of ids that connect whatever links of the sets connect."""
    return _Region(ids, sets, percent).join(pivots) if len(ids) > 1 else []


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _join_regions(percent: int, pivots: int):
    """Rows sorted by region: each region's links.  A region's rows are at most ``WEIGHT`` n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []
        for batch in batches:
            found = []
            for g, i, s in zip(batch["g"].to_pylist(), batch["id"].to_pylist(), batch["s"]):
                if g != now:
                    found += join_region(ids, sets, percent, pivots)
                    now, ids, sets = g, [], []
                ids.append(i)
                sets.append(np.frombuffer(s.as_py(), "<u8"))
            yield _edges(found)
        yield _edges(join_region(ids, sets, percent, pivots))

    return run


def _divide(percent: int):
    """A member of a heavy region: its links with the pivots, and the cells it belongs to."""
    window = 2 * (100 - percent) / 100 + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for g, i, s, pivots in zip(*(batch[c].to_pylist() for c in ("g", "id", "s", "pivots"))):
                own, away = np.frombuffer(s, "<u8"), []
                for p in pivots:
                    other = np.frombuffer(p["s"], "<u8")
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    either = len(own) + len(other) - both
                    away.append((1 - both / either, 100 * both >= percent * either, p["id"]))
                near = min(a for a, *_ in away)
                pivot = any(a == 0 for a, *_ in away)
                for k, (a, linked, p) in enumerate(away):
                    if linked and p != i:
                        rows.append((g, i, p, None, True))
                    if a <= near + window and not pivot:
                        rows.append((g, i, None, k, linked))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["g", "id", "pivot", "cell", "linked"])

    return run


def divide(heavy: DataFrame, percent: int, turn: int) -> DataFrame:
    """(g, id, pivot, cell, linked): links with pivots (``pivot``), and Voronoi cells with their boundaries (``cell``)."""
    salted = F.xxhash64("id", F.lit(turn))
    drawn = heavy.groupBy("g").agg(*[F.min_by(F.struct("id", "s"), F.when(F.pmod(salted, F.lit(PIVOTS)) == k, salted)).alias(f"p{k}")
                                     for k in range(PIVOTS)])
    pivots = drawn.select("g", F.filter(F.array(*[f"p{k}" for k in range(PIVOTS)]), lambda p: p.isNotNull()).alias("pivots"))
    return heavy.join(pivots, "g").select("g", "id", "s", "pivots").mapInArrow(
        _divide(percent), "g long, id long, pivot long, cell int, linked boolean")


def block_pairs(cells: DataFrame, weight: int) -> DataFrame:
    """Cells that stay too heavy, in pairs of blocks of at most half of ``weight``.

    Members that link with the cell's pivot are in one component, so only the
    others meet each other, and each block of them every block of the linked.
    """
    size = (F.sum(F.when(F.col("linked"), F.col("n"))), F.sum(F.when(~F.col("linked"), F.col("n"))))
    counts = cells.groupBy("g").agg(*[F.ceil(F.coalesce(c, F.lit(0)) * 2 / weight).cast("int").alias(x) for c, x in zip(size, "lo")])
    both = cells.join(counts, "g").withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), F.greatest(
        F.when(F.col("linked"), F.col("l")).otherwise(F.col("o")), F.lit(1))).cast("int"))

    def each(count):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda k: k)).otherwise(
            F.array().cast("array<int>"))

    with_linked = F.transform(each(F.col("l")), lambda k: F.struct(F.lit("l").alias("t"), k.alias("x"), F.col("own").alias("y")))
    with_others = F.transform(each(F.col("o")), lambda k: F.struct(
        F.lit("o").alias("t"), F.least(k, "own").alias("x"), F.greatest(k, "own").alias("y")))
    linked = F.transform(each(F.col("o")), lambda k: F.struct(F.lit("l").alias("t"), F.col("own").alias("x"), k.alias("y")))
    spread = F.when(F.col("linked"), linked).otherwise(F.concat(with_linked, with_others))
    return both.withColumn("b", F.explode(spread)).select(F.xxhash64("g", "b").alias("g"), "id", "n", "s")


def join_all(left: DataFrame, sets: DataFrame, percent: int, work: WorkTables, weight: int | None = None,
             pivots: int = PIVOTS) -> DataFrame:
    """(a, b): links of all regions (g, id, q, n) that connect whatever links of the sets (id, q, s) connect."""
    weight = weight or WEIGHT

    def by_weight(rows: DataFrame, name: str):
        total = rows.groupBy("g").agg(F.sum("n").alias("w"))
        heavy = work.keep(total.where(F.col("w") > weight).select("g"), f"heavy-{name}")
        return heavy, rows.join(heavy, "g", "left_anti")

    def with_sets(rows: DataFrame) -> DataFrame:
        return rows.join(sets, ["id", "q"]).select("g", "id", "n", "s")

    def solve(rows: DataFrame) -> DataFrame:
        return rows.repartition("g").sortWithinPartitions("g").select("g", "id", "s").mapInArrow(
            _join_regions(percent, pivots), "a long, b long")

    heavy, light = by_weight(left, "0")
    edges = work.keep(solve(with_sets(light)), "links-0")
    if heavy.isEmpty():
        return edges
    rows = work.keep(with_sets(left.join(heavy, "g", "left_semi")), "rows-0", compression="zstd")
    for turn in range(1, DIVISIONS + 1):
        found = work.keep(divide(rows.select("g", "id", "s"), percent, turn), f"cells-{turn}")
        placed = found.where("cell is not null").select(F.col("g").alias("_g"), F.col("id").alias("_id"), "cell", "linked")
        cells = (placed.join(rows.drop("linked"), (F.col("_g") == F.col("g")) & (F.col("_id") == F.col("id")))
                 .select(F.xxhash64("g", "cell").alias("g"), "id", "n", "linked", "s"))
        cells = work.keep(cells, f"rows-{turn}", compression="zstd")
        edges = edges.unionByName(found.where("pivot is not null").select(F.col("id").alias("a"), F.col("pivot").alias("b")))
        work.drop(f"rows-{turn - 1}")
        heavy, light = by_weight(cells, str(turn))
        edges = edges.unionByName(work.keep(solve(light.drop("linked")), f"links-{turn}"))
        rows = cells.join(heavy, "g", "left_semi")
        if heavy.isEmpty():
            return edges
    return edges.unionByName(solve(block_pairs(rows, weight)))


def components(edges: DataFrame, work: WorkTables) -> DataFrame:
    """(id, component): the smallest id reachable, for ids with an edge."""
    both = work.keep(edges.select(F.col("a").alias("x"), F.col("b").alias("y"))
                     .union(edges.select("b", "a")).distinct(), "edges")
    label = work.keep(both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("c"))
                      .select(F.col("x").alias("id"), "c"), "labels-0")
    turn = 0
    while True:
        near = (both.join(label, both["y"] == label["id"]).groupBy("x").agg(F.min("c").alias("near")))
        to = label.select(F.col("id").alias("_c"), F.col("c").alias("far"))
        step = (label.join(near, label["id"] == near["x"], "left")
                .select("id", F.col("c").alias("old"), F.least("c", F.coalesce("near", "c")).alias("c")))
        step = (step.join(to, step["c"] == to["_c"], "left")
                .select("id", "old", F.least("c", F.coalesce("far", "c")).alias("c")))
        turn += 1
        step = work.keep(step, f"labels-{turn}", result=True)
        work.drop(f"labels-{turn - 1}")
        if step.where("old <> c").isEmpty():
            return step.select("id", F.col("c").alias("component"))
        label = step.drop("old")


def one_of_each(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest doc_id.

    Groups are formed of rows, not of ids: repeated rows and rows that share an
    id are told apart by their place; rows without an id take part, and stay only where no row has one.
    Rows of equal id: the first one stays.  Texts without words are in no group.
    """
    rows = materialise(wrapped(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), k, percent)
    placed = found.join(rows.select("_row", F.col("doc_id").alias("_id")), F.col("doc_id") == F.col("_row"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row"))
    kept = placed.groupBy("component_id").agg(first.alias("first")).select(F.col("first._row").alias("_row"))
    return unwrapped(rows.join(kept, "_row", "left_semi"), docs.columns)


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, weight: int | None = None,
                    pivots: int = PIVOTS) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    send = docs.sparkSession.sparkContext.broadcast
    plain = _plain(docs)
    with WorkTables(docs.sparkSession, "near") as work:
        survey = work.keep(plain.mapInArrow(_survey(k), SURVEY), "survey")
        slim = work.keep(survey.where("doc_id is not null").select(*PRINT).distinct(), "slim", result=True)
        levels = send(sketch_levels(survey).tobytes())
        work.drop("survey")
        classes = work.keep(slim.where("n_shingles > 0").groupBy("n_shingles", "p1", "p2")
                            .agg(F.min("doc_id").alias("doc_id")), "classes", result=True)
        heads = (plain.mapInArrow(_set_rows(k, levels, percent), SET_ROWS).dropDuplicates(PRINT)
                 .join(classes.select(*PRINT), PRINT, "left_semi"))
        met = work.keep(regions(heads, percent), "met")
        often = work.keep(often_met(often_met(met, percent), percent), "often")
        work.drop("met")
        left = work.keep(outer_regions(distinct_regions(often)), "regions")
        work.drop("often")
        chosen = send(id_bitmap(left.select("id").distinct()))
        sets = (plain.mapInArrow(_set_rows(k, levels, None, chosen), SET_ROWS)
                .select(F.col("doc_id").alias("id"), F.expr("cast(p1 << 32 >> 32 as int)").alias("q"), "s").dropDuplicates(["id", "q"]))
        links = work.keep(join_all(left, sets, percent, work, weight, pivots), "links")
        parts = components(links, work)
    member = classes.join(parts, F.col("doc_id") == F.col("id"), "left").select(
        "n_shingles", "p1", "p2", F.coalesce("component", "doc_id").alias("component"))
    return (slim.join(member, ["n_shingles", "p1", "p2"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


#: The contract's result as DuckDB SQL over ``documents``: shingles, pairs that share one, labels spread along links.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n, list(g ORDER BY g) AS gs FROM s GROUP BY doc_id),
c AS MATERIALIZED (SELECT gs, any_value(n) AS n, min(doc_id) AS rep FROM n GROUP BY gs),
r AS MATERIALIZED (SELECT s.* FROM s JOIN c ON doc_id = rep),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM r AS x JOIN r AS y ON x.g = y.g AND x.doc_id < y.doc_id
                    GROUP BY ALL) JOIN c AS ca ON ca.rep = a JOIN c AS cb ON cb.rep = b
  WHERE 100 * common >= 80 * (ca.n + cb.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS id, rep AS root FROM c UNION SELECT edges.b, reach.root FROM reach JOIN edges ON edges.a = reach.id),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(roots.root, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (gs) LEFT JOIN roots ON roots.id = c.rep
"""
