"""Near-duplicate detection with fast similarity sketches.

Sketch: ``COORDINATES`` bins are filled in rounds. In a round every shingle is
thrown into one hashed bin with a hashed value; bins still empty before the
round keep their smallest value. After ``COORDINATES`` such rounds a bin that
is still empty takes the smallest value of all shingles, one bin a round, so
every coordinate fills, and the share of equal coordinates of two sets is an
unbiased estimate of their similarity with the concentration of independent
samples. Large sets fill in one or two rounds.

Banding: ``BANDS`` bands of ``COORDINATES / BANDS`` coordinates. At a
similarity of 0.85 a pair shares no band with a chance of (1 - 0.85^4)^32, about
6e-11. Every pair of a shared band is a candidate; none is capped.

Exact verification on full shingle sets, arranged so that no group is
expanded into its pairs:

1. documents with equal sets are one class (a group of copies is one node);
2. each class is verified against the smallest member of the bucket it shares
   most, and the links are contracted to components; ``TURNS`` times, each class
   outside the largest component of a bucket is verified against the member of
   those components, one drawn from each bucket, whose one-bit coordinates are
   closest. That only finds links early: a large group of near copies is one
   component before its pairs are looked at;
3. in buckets that still hold several components (open classes), every class
   outside the bucket's main component is verified against the members of the
   other components. Pairs of one component need no link between them.
   A pair is left out only if its sizes rule a link out, if the shingles that
   can be in its intersection are too few, or if more than ``MAX_DIFFERENT`` of
   128 one-bit coordinates differ (a linked pair expects 10; chance below
   1e-12). Shingles held by at most ``RARE`` open classes make the second test
   sharp: pairs that share one are listed by it, and for all other pairs only
   the remaining shingles count. Those are counted in ``BLOCKS`` hash blocks:
   an intersection has at most the smaller count of each block.

Defined results: words are split at ASCII white space after lower-casing A-Z;
fewer words than a shingle are one shingle; without words a document has no
shingles and no links. Rows that repeat an id are one document. A null id has
no links and ``component_id`` null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm import keyset
from keelson.llm import textbytes as tb
from keelson.llm.components import by_merge, components
from keelson.llm.scratch import stored

COORDINATES = 128
BANDS = 32
MAX_DIFFERENT = 40
TURNS = 2
RARE = 16
BLOCKS = 64
_CLASS = ("node", "n_shingles", "b1", "b2")
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each row, ascending, and their offsets by row."""
    lower = tb.LOWER[buf]
    starts, ends, first = tb.word_spans(lower, offs, tb.SPACELESS)
    h = tb.word_hashes(lower, starts, ends)
    counts = np.diff(first)
    n = np.where(counts == 0, 0, np.maximum(counts - words + 1, 1))
    off = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(off[-1], _U)
    full = counts >= words
    if len(h) >= words:
        every = tb.combine([h[i : len(h) - words + 1 + i] for i in range(words)], 100 + words)
        row = np.repeat(np.flatnonzero(full), n[full])
        within = np.arange(len(row)) - np.repeat(np.cumsum(n[full]) - n[full], n[full])
        out[np.repeat(off[:-1][full], n[full]) + within] = every[first[row] + within]
    for k in range(1, words):
        short = np.flatnonzero(counts == k)
        if len(short):
            out[off[short]] = tb.combine([h[first[short] + i] for i in range(k)], 100 + k)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    row = tb.row_of(off)
    new = np.ones(len(out), bool)
    if len(out) > 1:
        new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.concatenate(([0], np.cumsum(np.bincount(row[new], minlength=len(offs) - 1))))


def sketches(items: np.ndarray, off: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketches of sets (rows of ``off``), ``t`` a power of two; an empty set has no values."""
    rows = len(off) - 1
    out = np.full((rows, t), _EMPTY, _U)
    flat = out.reshape(-1)
    shift, low = _U(64 - (t.bit_length() - 1)), _U((1 << (64 - (t.bit_length() - 1))) - 1)
    row = tb.row_of(off)
    open_rows = np.flatnonzero(np.diff(off) > 0)
    salts = tb.randoms(2 * t, 77)
    for i in range(2 * t):
        if not len(open_rows):
            break
        v = tb.mix(items + salts[i])
        if i < t:
            at = row * t + (v >> shift).astype(np.int64)
        else:
            at = row * t + (i - t)
        free = flat[at] == _EMPTY
        # A round's values are minima among themselves only: earlier rounds win.
        np.minimum.at(flat, at[free], (v & low)[free] >> _U(1))
        still = (out[open_rows] == _EMPTY).any(1)
        if not still.all():
            open_rows = open_rows[still]
            stay = np.zeros(rows, bool)
            stay[open_rows] = True
            pick = stay[row]
            items, row = items[pick], row[pick]
    return out


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, s1, s2`` (128-bit name of the set), ``b1, b2`` (one-bit coordinates), ``bands``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(1)):
                items, off = shingle_sets(buf, offs, words)
                n = np.diff(off)
                sketch = sketches(items, off)
                some = np.flatnonzero(n)
                names = np.zeros((2, len(n)), _U)
                if len(some):
                    names[0, some] = np.add.reduceat(tb.mix(items + _U(0xA5A5A5A5)), off[some])
                    names[1, some] = np.add.reduceat(tb.mix(items ^ _U(0x1234567890ABCDEF)), off[some])
                bits = np.packbits((tb.mix(sketch.reshape(-1)) & _U(1)).astype(np.uint8).reshape(sketch.shape), axis=1)
                halves = np.ascontiguousarray(bits).view(np.int64)
                width = COORDINATES // BANDS
                bands = np.stack(
                    [tb.combine([sketch[:, b * width + j] for j in range(width)], 1000 + b) for b in range(BANDS)], 1
                )
                k = len(n)
                bands_at = np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(n, pa.int64()),
                        pa.array(names[0].view(np.int64)),
                        pa.array(names[1].view(np.int64)),
                        pa.array(halves[:, 0] if k else np.zeros(0, np.int64)),
                        pa.array(halves[:, 1] if k else np.zeros(0, np.int64)),
                        pa.ListArray.from_arrays(pa.array(bands_at), pa.array(bands[n > 0].reshape(-1).view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "s1", "s2", "b1", "b2", "bands"],
                )

    return docs.mapInArrow(
        tb.task(run), f"doc_id {id_type}, n_shingles bigint, s1 bigint, s2 bigint, b1 bigint, b2 bigint, bands array<bigint>"
    )


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``node, items``: the full shingle sets of the documents named in ``ids (node)``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    wanted = ids.select(F.col("node").alias("doc_id"))
    some = keyset.maybe_in(docs, "doc_id", keyset.build(wanted, "doc_id")).join(wanted.distinct(), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(1)):
                items, off = shingle_sets(buf, offs, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(items.view(np.int64))),
                    ],
                    ["node", "items"],
                )

    return some.dropDuplicates(["doc_id"]).mapInArrow(tb.task(run), f"node {id_type}, items array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v, ...)`` whose full sets reach the similarity."""
    a = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(b, "v").join(a, "u")
    return joined.filter(100 * both >= percent * (F.size("a") + F.size("b") - both)).select(*pairs.columns)


def _different() -> Column:
    """In how many one-bit coordinates the pair differs."""
    one, two = (F.bit_count(F.col(c).bitwiseXOR(F.col(f"x_{c}"))) for c in ("b1", "b2"))
    return one + two


def _sizes_allow(percent: int) -> Column:
    return 100 * F.least("n_shingles", "x_n_shingles") >= percent * F.greatest("n_shingles", "x_n_shingles")


def _rooted(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the ``root`` of each node's component, itself where it has no link."""
    return members.join(by_merge(labels), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _raised(members: DataFrame, tops: DataFrame) -> DataFrame:
    """``members`` whose components are joined to larger ones, as ``tops (node, root)`` names them."""
    above = tops.select(F.col("node").alias("root"), F.col("root").alias("above"))
    return members.join(by_merge(above), "root", "left").withColumn("root", F.coalesce("above", "root")).drop("above")


def _mixed(members: DataFrame, **drawn: Column) -> DataFrame:
    """The classes by the buckets (``band``) that hold several components.

    ``main`` is the component with most of the bucket's classes; ``drawn``
    are aggregates over that component's classes in the bucket. The buckets
    are dealt out once, for the sums and for the classes they go back to.
    """
    placed = members.select(*_CLASS, "root", F.explode("bands").alias("band")).repartition("band")
    sizes = placed.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in drawn.items()))
    main = sizes.groupBy("band").agg(
        F.count(F.lit(1)).alias("roots"), F.max_by(F.struct("root", *drawn), F.struct("n", "root")).alias("main")
    )
    several = main.filter("roots > 1").select("band", F.col("main.root").alias("main"), *(f"main.{k}" for k in drawn))
    return placed.join(by_merge(several), "band")


def _closest(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """``u, v, ru, rv``: each class outside its buckets' main components, the closest of the members drawn from those, and their roots."""
    inside = _mixed(members, x=F.min_by(F.struct(*_CLASS), F.xxhash64("node", "band", F.lit(turn))))
    tried = inside.filter("root != main").select("node", "root", "main", *_CLASS[1:], *(F.col(f"x.{c}").alias(f"x_{c}") for c in _CLASS))
    near = (
        tried.filter(_sizes_allow(percent) & (_different() <= MAX_DIFFERENT))
        .groupBy("node")
        .agg(F.min_by(F.struct("x_node", "main", "root"), F.struct(_different().alias("different"), "x_node")).alias("near"))
    )
    return near.select(
        F.col("near.x_node").alias("u"), F.col("node").alias("v"), F.col("near.main").alias("ru"), F.col("near.root").alias("rv")
    )


def _joined_roots(linked: DataFrame) -> DataFrame:
    """``linked (u, v, ru, rv)`` as links between the components of its ends."""
    return linked.select(F.col("ru").alias("u"), F.col("rv").alias("v"))


def _blocks(sets: DataFrame) -> DataFrame:
    """``sets`` with ``blocks`` instead of ``items, rare_items``: how many of a node's common shingles fall in each hash block."""
    rest = sets.drop("items", "rare_items").schema
    names = rest.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for items, rare in zip(batch.column("items"), batch.column("rare_items"), strict=True):
                n = np.bincount(items.values.to_numpy().view(_U) % _U(BLOCKS), minlength=BLOCKS)
                if rare.is_valid:
                    n -= np.bincount(rare.values.to_numpy().view(_U) % _U(BLOCKS), minlength=BLOCKS)
                counts.append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(counts, pa.list_(pa.int32()))], [*names, "blocks"]
            )

    return sets.mapInArrow(tb.task(run), T.StructType([*rest.fields, T.StructField("blocks", T.ArrayType(T.IntegerType()))]))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id`` (the smallest id linked, itself included).

    Two documents are linked when ``100 * |A & B| >= percent * |A | B|`` for
    their sets of ``words``-word shingles. The bands are laid out for
    similarities of 0.8 and more.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(_signatures(rows, words), "signatures")
    known = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        known.groupBy("s1", "s2").agg(
            F.min("doc_id").alias("node"), *(F.min(c).alias(c) for c in _CLASS[1:]), F.any_value("bands").alias("bands")
        ),
        "classes",
    )
    placed = classes.select(*_CLASS, F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("pivot")).filter("n > 1").drop("n")
    shared = stored(shared, "buckets")
    seated = keyset.maybe_in(placed, "band", keyset.build(shared, "band")).join(shared, "band")
    other_pivot = F.when(F.col("pivot") != F.col("node"), F.struct(F.size("bands").alias("n"), "pivot"))
    members = stored(
        seated.repartition("node")
        .groupBy(*_CLASS, "pivot")
        .agg(F.collect_list("band").alias("bands"))
        .groupBy(*_CLASS)
        .agg(F.max_by("pivot", other_pivot).alias("pivot"), F.flatten(F.collect_list("bands")).alias("bands")),
        "members",
    )

    tries = members.filter("pivot IS NOT NULL").select(F.col("pivot").alias("u"), F.col("node").alias("v"))
    sets = stored(_sets(rows, members.select("node"), words), "sets")
    members = stored(_rooted(members.drop("pivot"), components(_linked(tries, sets, percent))), "rooted")
    for turn in range(TURNS):
        found = _linked(_closest(members, turn, percent), sets, percent)
        members = stored(_raised(members, components(_joined_roots(found))), "rooted")

    opened = stored(
        _mixed(members).groupBy(*_CLASS, "root").agg(F.collect_list(F.struct("band", "main")).alias("seats")), "open"
    )
    items = sets.join(opened.select("node"), "node").select("node", F.explode("items").alias("item"))
    holders = items.groupBy("item").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") <= RARE)
    rare = stored(items.join(holders, "item"), "rare")
    scarce = rare.groupBy("node").agg(
        F.count(F.lit(1)).alias("rare"),
        F.sum((F.col("held") == 1).cast("long")).alias("alone"),
        F.collect_list("item").alias("rare_items"),
        F.collect_list(F.when(F.col("held") > 1, F.col("item"))).alias("rare_shared"),
    )
    counted = stored(
        _blocks(
            opened.join(scarce, "node", "left")
            .join(sets, "node")
            .select(
                *opened.columns,
                (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("shared"),
                (F.col("n_shingles") - F.coalesce("rare", F.lit(0))).alias("common"),
                "rare_shared",
                "rare_items",
                "items",
            )
        ),
        "counted",
    )

    def other(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c).alias(c if c in ("band", "item") else f"x_{c}") for c in df.columns if c != "main"))

    def may_link(most: str) -> Column:
        """Sizes, the largest possible intersection and the one-bit coordinates allow a link."""
        total = F.col("n_shingles") + F.col("x_n_shingles")
        return (
            (F.col("root") != F.col("x_root"))
            & _sizes_allow(percent)
            & ((100 + percent) * F.least(most, f"x_{most}") >= percent * total)
            & (_different() <= MAX_DIFFERENT)
        )

    def enough(extra: Column) -> Column:
        """The common shingles that fall in the same blocks, and ``extra`` others, are enough for a link."""
        both = F.aggregate(F.zip_with("blocks", "x_blocks", lambda a, b: F.least(a, b)), F.lit(0), lambda n, k: n + k)
        return (100 + percent) * (both + extra) >= percent * (F.col("n_shingles") + F.col("x_n_shingles"))

    first = F.col("node") < F.col("x_node")
    ends = (
        F.least("node", "x_node").alias("u"),
        F.greatest("node", "x_node").alias("v"),
        F.when(first, F.col("root")).otherwise(F.col("x_root")).alias("ru"),
        F.when(first, F.col("x_root")).otherwise(F.col("root")).alias("rv"),
    )
    told = (*_CLASS, "root", "blocks", "shared", "common")
    # Pairs with no rare shingle in common: only the others can be in the intersection.
    able = counted.filter(100 * F.col("common") >= percent * F.col("n_shingles"))
    # A pair that meets in several bands is listed by the first.
    seats = able.select(*told, F.col("seats.band").alias("bands"), F.explode("seats").alias("seat"))
    placed = seats.select(*told, "bands", "seat.band", "seat.main")
    first_band = F.array_min(F.array_intersect("bands", "x_bands")) == F.col("band")
    plain = (
        other(placed.filter("root != main"))
        .join(placed, "band")
        .filter(((F.col("root") == F.col("main")) | (F.col("x_node") < F.col("node"))) & may_link("common"))
        .filter(first_band)
        .filter(enough(F.lit(0)))
        .select(*ends)
    )
    # Pairs with a rare shingle in common: at most RARE classes hold one.
    able = counted.filter(100 * F.col("shared") >= percent * F.col("n_shingles"))
    listed = able.select(*told, F.explode("rare_shared").alias("item"))
    odd = (
        other(listed)
        .join(listed, "item")
        .filter((F.col("x_node") < F.col("node")) & may_link("shared"))
        .filter(enough(F.least(F.col("shared") - F.col("common"), F.col("x_shared") - F.col("x_common"))))
        .select(*ends)
    )
    pairs = plain.unionByName(odd).distinct()
    members = _raised(members, components(_joined_roots(_linked(pairs, sets, percent))))
    final = (
        classes.select("s1", "s2", "node")
        .join(by_merge(members.select("node", "root").dropDuplicates(["node"])), "node", "left")
        .select("s1", "s2", F.coalesce("root", "node").alias("class_component"))
    )
    linked = signed.select("doc_id", "n_shingles", "s1", "s2").join(final, ["s1", "s2"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class_component")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", "n_shingles", own.alias("component_id"))
