"""MinHash near-duplicates (4): an inverted join over signature coordinates.

A document is its set of word shingles. Equal sets are one class from the start, so exact copies cost nothing further. A
class has a signature of ``coordinates`` minima, and is posted under each (coordinate, value). Two sets of similarity s agree
in about s * coordinates postings; pairs must agree in at least ``matches`` of them, set so low that a true pair fails it
in at most 1.6 of ten thousand cases (28 of 48, at a similarity of exactly 0.8). That bound prunes twice before any pair is made:

* skip: a value that one class alone has can't count, and a class left with fewer than ``matches`` values drops out;
* prefix: of two classes with enough matches, the rarest values of either up to ``coordinates - matches + 1`` meet in at
  least one. Only these are posted, so lines and passages that many documents share, being frequent, seldom are.

Postings of one value are not paired with each other. In every round a value has one centre, and each class is compared with
the centre it meets under most values; those found alike join its component. What stays apart between components is not
paired either, but held against the differences from a centre (``_by_differences``): two sets that are alike, of which one is
not alike a centre, must share some of what makes them differ from it, so they are posted under their rarest differences
alone. Pairs that meet there in numbers that allow a link are confirmed on the full sets. A family of n half-alike copies
of one text so costs about n comparisons and postings, and no link between components is lost to the rounds.

Defined cases: null, empty and wordless texts have an empty set and link with nothing; a text with fewer words than a
shingle has one shingle; rows of one id are one document, which links whatever any of its texts links; rows without an
id are never linked; extra columns are left out by ``near_duplicates`` and pass through ``deduplicated``. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.paths import quote
from tablebridge.llm.common import discard, fresh, kept, portions
from tablebridge.llm.components import components

_random = np.random.default_rng(20240229)
BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
TIMES = np.uint64(0x9E3779B97F4A7C15)
PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
SPREAD = _random.integers(1, 1 << 63, 512, dtype=np.uint64) | np.uint64(1)
SHIFT = _random.integers(1, 1 << 63, 512, dtype=np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text; A-Z count as a-z."""
    raw = [(text or "").encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in raw])
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    letters = LOWER[data[inside]]
    place = np.cumsum(inside)  # letters up to and with this byte
    first = place[starts] - 1  # each word's first letter among the letters
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    size = np.diff(np.append(first, len(letters)))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(size.max()), TIMES, np.uint64))
        value = BYTES[letters] * powers[np.arange(len(letters)) - np.repeat(first, size)]
        hashes = _mixed(np.add.reduceat(value, first) + size.astype(np.uint64))
        count = len(hashes)
        runs = np.zeros(max(0, count - words + 1), np.uint64)
        for k in range(words):
            runs += hashes[k : k + len(runs)] * PLACES[k]
        runs = _mixed(runs)
    to = np.searchsorted(starts, ends)
    out = []
    at = 0
    for end in to.tolist():
        n = end - at
        if n >= words:
            out.append(np.unique(runs[at : end - words + 1]))
        elif n:
            with np.errstate(over="ignore"):
                out.append(_mixed((hashes[at:end] * PLACES[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
        at = end
    return out


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """The minima of ``coordinates`` hash functions over each set, none of which may be empty; 32 bits each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), coordinates), np.int32)
    with np.errstate(over="ignore"):
        for k in range(coordinates):
            spun = ((flat ^ SHIFT[k]) * SPREAD[k]) >> np.uint64(32)
            out[:, k] = np.minimum.reduceat(spun, starts).astype(np.uint32).view(np.int32)
    return out


def _node(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _described(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """(doc_id, n_shingles, node, signature): the node is a 128-bit hash of the whole set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, 1, rows=250):
                sets = shingle_sets(batch.column(1).to_pylist(), words)
                full = [x for x in sets if len(x)]
                found = iter(signatures(full, coordinates).tolist()) if full else iter(())
                nodes = list(map(_node, sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(nodes, pa.binary()),
                        pa.array([next(found) if len(x) else None for x in sets], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "n_shingles", "node", "signature"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node binary, signature array<int>")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of (id, node, text), without texts of other nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, 2, rows=250):
                sets = shingle_sets(batch.column(2).to_pylist(), words)
                ids, nodes = (batch.column(i).to_pylist() for i in range(2))
                own = [i for i, x in enumerate(sets) if _node(x) == nodes[i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in own], pa.int64()), pa.array([sets[i].view(np.int64) for i in own], pa.list_(pa.int64()))],
                    names=["id", "shingles"],
                )

    return texts.mapInArrow(run, "id long, shingles array<long>")


def _values(classes: DataFrame, matches: int) -> DataFrame:
    """(id, n, first_id, node, own): classes with enough values that others have, too; own is their sorted (count, key)."""
    postings = classes.select("id", F.posexplode("signature").alias("k", "value")).select(
        (F.shiftleft(F.col("k").cast("long"), 32) + F.col("value")).alias("key"), "id"
    )
    shared = kept(postings.groupBy("key").count().filter("count > 1"), "neardup-shared")
    own = kept(_enough(postings.join(shared, "key"), ["id"], matches), "neardup-own")
    values = kept(own.join(classes.select("id", "n", "first_id", "node"), "id"), "neardup-values")
    discard(shared, own)
    return values


def _enough(postings: DataFrame, by: list[str], matches: int) -> DataFrame:
    """(by..., own): the sorted (count, key) of each id, at most one per coordinate, where there are enough to match."""
    own = F.sort_array(F.collect_list(F.struct("count", "key"))).alias("own")
    return postings.groupBy(*by).agg(own).filter(F.size("own") >= matches)


def _prefix(least: Column | int) -> Column:
    """The rarest keys of ``own``: two that share ``least`` of them have one of these in common."""
    rarest = F.slice("own", F.lit(1), (F.size("own") - least + 1).cast("int"))
    return F.explode(F.transform(rarest, lambda x: x["key"])).alias("key")


def _apart(values: DataFrame, labels: DataFrame, matches: int) -> DataFrame:
    """(id, n, label, popularity, own): skip once more, for pairs from different components alone.

    Such a pair matches only in values that more than one component has. A class with too few of these drops out, which
    leaves others with too few; two turns take out nearly all that share no more than a passage.
    """
    by = ["id", "n", "label", "popularity"]
    rows = values.join(labels, "id").select("id", "n", "label", _popularity(), "own")
    before = None
    for _ in range(2):
        postings = rows.select(*by, F.inline("own"))
        mixed = postings.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
        mixed = kept(mixed.select("key"), "neardup-mixed")
        rows = kept(_enough(postings.join(mixed, "key"), by, matches), "neardup-apart")
        discard(mixed, *([before] if before else []))
        before = rows
    return rows


def _popularity() -> Column:
    """How often all values of a class occur: the middle of a family has many that the others have."""
    return F.aggregate("own", F.lit(0).cast("long"), lambda total, x: total + x["count"]).alias("popularity")


def _merged(labels: DataFrame, links: DataFrame, turn: int) -> DataFrame:
    """``labels`` after the links of a turn: each component goes to the one of least priority that it was linked to.

    A centre's component comes before those of its links, so the steps form trees; two jumps along them merge nearly all,
    and what stays apart is only a component too many, which costs comparisons and no links.
    """
    first = F.min_by("c_label", _priority("c_label", "c_size", turn))
    step = links.groupBy(F.col("label").alias("a")).agg(first.alias("b"))
    step = kept(step, "neardup-steps")
    for _ in range(2):
        on = step.select(F.col("a").alias("b"), F.col("b").alias("further"))
        before, step = step, kept(step.join(on, "b", "left").select("a", F.coalesce("further", "b").alias("b")), "neardup-steps")
        discard(before)
    after = labels.join(step, F.col("label") == F.col("a"), "left")
    merged = kept(after.select("id", F.coalesce("b", "label").alias("label")), "neardup-labels")
    discard(step)
    return merged


def _priority(label: str, size: str, turn: int):
    """Large components first, so that what is still apart is compared with them; then by a hash that changes by turn."""
    return F.struct(-F.col(size), F.xxhash64(label, F.lit(turn)), F.col(label))


def _sized(labels: DataFrame) -> DataFrame:
    """(id, label, size): labels with the size of their component."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    return labels.join(sizes, "label")


class _Comparison:
    """Full sets of the classes that may have partners, and what makes two of them alike."""

    def __init__(self, sets: DataFrame, percent: int) -> None:
        self.sets, self.percent = sets, percent

    def fits(self, n: str, m: str) -> Column:
        """Sets of too unequal sizes cannot be alike enough."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def alike(self, common: Column, n: Column, m: Column) -> Column:
        return common * 100 >= (n + m - common) * self.percent

    def joined(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) with their shingles s and t."""
        left = self.sets.select(F.col("id").alias("u"), F.col("shingles").alias("s"))
        right = self.sets.select(F.col("id").alias("v"), F.col("shingles").alias("t"))
        return pairs.join(left, "u").join(right, "v")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are alike enough."""
        common = F.size(F.array_intersect("s", "t")).cast("long")
        both = self.joined(pairs).withColumn("common", common)
        return kept(both.filter(self.alike(F.col("common"), F.size("s"), F.size("t"))).select(*pairs.columns), "neardup-links")


def _by_differences(rows: DataFrame, labels: DataFrame, matches: int, comparison: _Comparison) -> DataFrame:
    """The links (u, v) between components that are left, found by differences from centres.

    ``rows`` are those of ``_apart``. All that meet under a value, and have sizes that allow a link, share a centre c; each is
    compared with it in full. For sets u and v of one centre

        |u n v| = |c| - |c - u| - |c - v| + |D(u) n D(v)|,   D(x) = the elements of only one of x and c, marked which,

    so u and v are alike only if their differences share at least need = t |u| + |c - u| + t |v| + |c - v| - |c| elements,
    t = percent / (100 + percent). That is above 0 unless both are alike c, in which case nothing is left to find. So each
    is posted under its rarest differences only, and meets there whom it may be alike. Rare are the changes of its own.
    """
    p, whole = comparison.percent, 100 + comparison.percent
    # Sets whose sizes allow a link share one of two cells, and all sets of a cell are within a factor of (100 / percent) ** 2.
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / p)) + 1e-9) if p < 100 else F.col("n")
    keys = rows.select("id", "n", "label", "popularity", _prefix(matches))
    cells = keys.withColumn("cell", F.explode(F.array(step, step + 1)))
    sized = _sized(labels).select("id", "size")
    live = kept(cells.join(sized, "id"), "neardup-live")
    order = F.struct(-F.col("size"), -F.col("popularity"), F.col("id"))
    groups = live.groupBy("key", "cell").agg(
        F.min_by(F.struct("id", "label", "n", "size"), order).alias("c"), F.min("label").alias("least"), F.max("label").alias("most")
    )
    centres = kept(groups.filter("least <> most").select("key", "cell", "c"), "neardup-centres")
    met = live.join(centres, ["key", "cell"]).filter("id <> c.id")
    met = met.select(
        F.col("id").alias("u"), F.col("c.id").alias("v"), "label", "n", F.col("c.label").alias("c_label"), F.col("c.n").alias("m"), F.col("c.size").alias("c_size")
    ).distinct()
    met = kept(met, "neardup-pairs")
    discard(live, centres)
    marked = F.transform(F.array_except("t", "s"), lambda x: F.bitwise_not(x))  # c - u
    both = comparison.joined(met).select(*met.columns, F.array_except("s", "t").alias("more"), marked.alias("less"))
    alike = comparison.alike(F.col("n") - F.size("more"), F.col("n"), F.col("m"))
    weight = F.col("n") * p + F.size("less") * whole
    differing = kept(
        both.select(*met.columns, alike.alias("alike"), weight.alias("weight"), F.concat("more", "less").alias("differences")), "neardup-differing"
    )
    discard(met)
    direct = kept(differing.filter("alike AND label <> c_label").select("u", "v", "label", "c_label", "c_size"), "neardup-links")
    after = _merged(labels, direct, -1)
    # What is the least that any partner in the group brings; a partner of one that is alike the centre is not.
    group = differing.groupBy("v").agg(F.min("weight").alias("any"), F.min(F.when(~F.col("alike"), F.col("weight"))).alias("far"))
    group = kept(group.filter("far IS NOT NULL"), "neardup-groups")
    least = F.col("weight") + F.when(F.col("alike"), F.col("far")).otherwise(F.col("any")) - F.col("m") * whole
    new = after.select(F.col("id").alias("u"), F.col("label").alias("now"))
    known = differing.join(group, "v").join(new, "u").withColumn("need", F.greatest(F.ceil(least / whole), F.lit(1)))
    by = ["u", "v", "now", "n", "m", "weight", "alike", "need"]
    postings = known.filter(F.size("differences") >= F.col("need")).select(*by, F.explode("differences").alias("key"))
    postings = kept(postings, "neardup-postings")
    discard(differing, group)
    shared = postings.groupBy("v", "key").agg(F.count("*").alias("count"), F.min("now").alias("least"), F.max("now").alias("most"))
    shared = kept(shared.filter("least <> most").select("v", "key", "count"), "neardup-shared")
    own = F.sort_array(F.collect_list(F.struct("count", "key"))).alias("own")
    mine = postings.join(shared, ["v", "key"]).groupBy(*by).agg(own).withColumn("own_size", F.size("own"))
    few = kept(mine.filter("own_size >= need").select(*by, "own_size", _prefix(F.col("need"))), "neardup-prefix")
    discard(postings, shared)
    names = {"u": "x", "now": "a", "n": "n", "weight": "wx", "alike": "ax", "own_size": "dx"}
    left = few.select("v", "key", "m", *[F.col(c).alias(name) for c, name in names.items()])
    names = {"u": "y", "now": "b", "n": "k", "weight": "wy", "alike": "ay", "own_size": "dy"}
    right = few.select("v", "key", *[F.col(c).alias(name) for c, name in names.items()])
    allowed = (
        (F.col("a") < F.col("b"))
        & ~(F.col("ax") & F.col("ay"))
        & comparison.fits("n", "k")
        & (F.col("wx") + F.col("wy") - F.col("m") * whole <= F.least("dx", "dy") * whole)
    )
    pairs = left.alias("l").join(right.alias("r"), (F.col("l.v") == F.col("r.v")) & (F.col("l.key") == F.col("r.key")) & allowed)
    rest = comparison.confirmed(kept(pairs.select(F.col("x").alias("u"), F.col("y").alias("v")).distinct(), "neardup-pairs"))
    discard(few)
    return direct.select("u", "v").unionByName(rest)


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    coordinates: int = 48,
    matches: int = 28,
    rounds: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, and component_id, the smallest id reachable by links.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets. ``rounds`` bounds only the cheap
    rounds; what they leave is found by differences from centres.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    described = kept(_described(texts, words, coordinates), "neardup-rows")
    named = described.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    classes = named.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.max("signature").alias("signature")
    )
    # Classes go by a number of 8 bytes from here on; it is fixed as it is written.
    classes = kept(classes.withColumn("id", F.monotonically_increasing_id()), "neardup-classes")
    rows = kept(described.select("doc_id", "n_shingles", "node"), "neardup-rows")
    discard(described)
    named = rows.filter(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    values = _values(classes, matches)
    buckets = kept(values.select("id", "n", _popularity(), _prefix(matches)), "neardup-buckets")
    # By id and then by the set itself, as an id may have several texts, and one text in several rows.
    chosen = texts.join(values.select(F.col("first_id").alias("doc_id"), "id", "node"), "doc_id").select("id", "node", "text")
    sets = kept(_sets(chosen.filter(F.col("text").isNotNull()), words), "neardup-sets")
    if sets.count() > values.count():
        several, sets = sets, kept(sets.dropDuplicates(["id"]), "neardup-sets")
        discard(several)
    comparison = _Comparison(sets, percent)
    labels = values.select("id", F.col("id").alias("label"))
    links: list[DataFrame] = []
    for turn in range(rounds):
        live = kept(buckets.join(_sized(labels), "id"), "neardup-live") if turn else buckets.withColumns({"label": F.col("id"), "size": F.lit(1).cast("long")})
        first = F.xxhash64("id", F.lit(turn)) if turn else -F.col("popularity")
        order = F.struct(_priority("label", "size", turn), first, F.col("id")) if turn else F.struct(first, F.col("id"))
        centre = F.min_by(F.struct("id", "label", "n", "size"), order)
        centres = live.groupBy("key").agg(centre.alias("c"), F.min("label").alias("least"), F.max("label").alias("most"))
        centres = kept(
            centres.filter("least <> most").select(
                "key", F.col("c.id").alias("v"), F.col("c.label").alias("c_label"), F.col("c.n").alias("c_n"), F.col("c.size").alias("c_size")
            ),
            "neardup-centres",
        )
        met = live.join(centres, "key").filter(comparison.fits("n", "c_n")).filter("label <> c_label")
        met = met.groupBy(F.col("id").alias("u"), "v", "label", "c_label", "c_size").count()
        best = F.max(F.struct("count", "v", "c_label", "c_size")).alias("best")
        pairs = kept(met.groupBy("u", "label").agg(best).select("u", "label", "best.v", "best.c_label", "best.c_size"), "neardup-pairs")
        found = comparison.confirmed(pairs)
        discard(centres, pairs, live)
        if found.isEmpty():
            break
        links.append(found.select("u", "v"))
        before, labels = labels, _merged(labels, found, turn)
        discard(before)
    left = _apart(values, labels, matches)
    if not left.isEmpty():
        links.append(_by_differences(left, labels, matches, comparison))
    # An id with several sets ties them together.
    numbered = named.join(classes.select("node", "id"), "node").select("doc_id", "id")
    ties = numbered.groupBy("doc_id").agg(F.min("id").alias("v"), F.max("id").alias("most")).filter("v <> most")
    ties = kept(ties.select("doc_id", "v"), "neardup-ties")
    tied = numbered.select("doc_id", F.col("id").alias("u")).join(ties, "doc_id").filter("u <> v").select("u", "v")
    # Components of the components: most links lie within one of those the rounds have found.
    of = classes.select("id").join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
    of = kept(of, "neardup-labels")
    links = reduce(DataFrame.unionByName, links, tied if not ties.isEmpty() else tied.limit(0))
    across = (
        links.join(of.select(F.col("id").alias("u"), F.col("label").alias("a")), "u")
        .join(of.select(F.col("id").alias("v"), F.col("label").alias("b")), "v")
        .filter("a <> b")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    roots = components(across).select(F.col("node").alias("label"), "root")
    grouped = classes.select("id", "node", "first_id").join(of, "id").join(roots, "label", "left")
    grouped = kept(grouped.select("node", "first_id", F.coalesce("root", "label").alias("root")), "neardup-grouped")
    discard(values, buckets, sets, left, of, ties, classes, roots)
    least = kept(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")), "neardup-least")
    ids = kept(grouped.join(least, "root").select("node", "component_id"), "neardup-components")
    discard(grouped, least)
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(ids, "node", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, once. Rows without an id all stay.

    Of several rows with that id the one whose text has the least hash stays, then the least text and other columns.
    """
    found = near_duplicates(docs, id_column=id_column, text_column=text_column, **options).filter("doc_id IS NOT NULL")
    (own,) = fresh(docs, "_id")
    ids = found.groupBy(F.col("doc_id").alias(own)).agg(F.min("component_id").alias("least"), F.count("*").alias("n"))
    mine = F.col(own)
    marked = kept(ids.filter((mine != F.col("least")) | (F.col("n") > 1)).select(own, (mine != F.col("least")).alias("gone")), "neardup-marked")
    key = F.col(id_column).cast("long")
    alone = docs.join(marked.select(own), key == mine, "left_anti")
    # Written first, so that rows of one id are read by many tasks and combined there.
    several = kept(docs.join(marked.filter("NOT gone").select(own), key == mine, "left_semi"), "neardup-repeated")
    text = F.col(text_column).cast("string")
    others = [F.col(quote(c)) for c in docs.columns if c not in (id_column, text_column)]
    order = F.struct(F.xxhash64(text), text, F.to_json(F.struct(*others)) if others else F.lit(""))
    one = several.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*[F.col(quote(c)) for c in docs.columns]), order).alias("_row"))
    return alone.unionByName(one.select("_row.*"))
