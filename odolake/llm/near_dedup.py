"""Near-duplicate documents: banded MinHash, odd sketches as filter, exact check on full shingle sets.

Documents with equal shingle sets are one node. Every node has ``SAMPLES`` MinHash samples. The samples of a
band form a bucket key, and all samples together are folded into a parity bitmap (odd sketch): the number of
differing bits of two sketches estimates how many samples differ, precisely so for high similarity.

1. In every bucket one node is compared with the others (one pair per member, never all pairs): the one that shares
   the most buckets, which in a group of copies is the original or close to it.
2. Components of the confirmed links are formed. Buckets that still hold several components are looked at again in
   rounds: in each, nodes of up to ``TURNS`` components that had no turn yet in the bucket are compared with the members
   of the others. A round is linear in the members of the buckets. The rounds end after ``QUIET`` turns without a link.
3. Of all nodes, whether they share a bucket or not, those are taken of which enough of the smallest shingles are also
   among the smallest ones of nodes of other components (``_strangers``); any other node has no link left to find. They
   are joined on the rare shingles of their full sets (``_rest``). That finds every pair of different components that
   is similar enough, so buckets, sketches and rounds only make components large early and decide nothing.
4. Every pair is confirmed on full sets before it counts as a link.

Two nodes that are similar enough end in one component.

The least similarity is a parameter; the number of bands and the limit of the sketch test follow from it. A pair at the
least similarity misses all bands with a probability of at most 1e-8 (32 bands and 7e-9 at 0.85, 47 bands and 8e-9 at
0.8). The sketch test rejects such a pair only if it is five standard deviations off. Step 3 does without both.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from odolake.llm.common import chunks, lists, mix, shingle_sets, stored
from odolake.llm.components import components
from odolake.llm.marks import marked, marks, with_mark

ROWS = 5  # samples of a band
MISSED = 1e-8  # share of pairs at the least similarity that may miss all bands
SAMPLES = 512  # of which the first ones form the bands
SKETCH_BITS = 1024
QUIET = 2  # turns without a new link after which the rest is joined on shingles
TURNS = 2  # of a bucket in a round
SPARE = 20  # one in so many shingles of a set is added to its beginning, so that a link shows in several of them
STEP = 1.03  # sizes of sets that differ by less are of one class, or of two neighbours
PERCENT = 85
NODE = "n_shingles long, node long"


class Limits(NamedTuple):
    """What follows from the least similarity of a link, in percent."""

    percent: int
    bands: int
    sketch: int  # differing bits of two sketches


def limits(percent: int) -> Limits:
    """At 85: 32 bands and 203 bits, as about 133 are expected with a deviation of 14. At 80: 47 bands and 244 bits."""
    like = percent / 100
    bands = math.ceil(math.log(MISSED) / math.log1p(-(like**ROWS))) if like < 1 else 1
    if not 0 < percent <= 100 or bands * ROWS > SAMPLES:
        raise ValueError(f"{SAMPLES} samples do not find pairs at {percent} percent")
    # Samples that differ flip two bits each. The spread is that of their number and that of the bits that meet.
    flips = 2 * SAMPLES * (1 - like)
    alike = math.exp(-2 * flips / SKETCH_BITS)
    odd = (1 - alike) / 2
    spread = 4 * alike**2 * SAMPLES * like * (1 - like) + SKETCH_BITS * odd * (1 - odd) - flips * alike**2
    return Limits(percent, bands, round(SKETCH_BITS * odd) + 5 * math.ceil(math.sqrt(max(spread, 0))))


def _samples(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples, one row per hash function and one column per set; empty sets are not asked for."""
    seeds = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
    out = np.empty((SAMPLES, len(bounds) - 1), np.uint64)
    for i in range(SAMPLES):
        out[i] = np.minimum.reduceat((values ^ seeds[2 * i]) * (seeds[2 * i + 1] | np.uint64(1)), bounds[:-1])
    return out


def _band_keys(samples: np.ndarray, bands: int) -> np.ndarray:
    keys = np.empty((samples.shape[1], bands), np.uint64)
    for band in range(bands):
        key = np.full(samples.shape[1], band + 1, np.uint64)
        for row in range(ROWS):
            key = mix(key * np.uint64(31) + samples[band * ROWS + row])
        keys[:, band] = key
    return keys


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples: each flips one bit."""
    sets = np.arange(samples.shape[1])
    out = np.zeros((samples.shape[1], SKETCH_BITS // 64), np.uint64)
    for i, sample in enumerate(samples):
        bit = mix(sample + np.uint64(i * 0x10001 + 7)) % np.uint64(SKETCH_BITS)
        out[sets, (bit >> np.uint64(6)).astype(int)] ^= np.uint64(1) << (bit & np.uint64(63))
    return out


def _nodes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit name of each set: equal sets have equal names."""
    sizes = np.diff(bounds)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values), dtype=np.uint64)])
    return mix((total[bounds[1:]] - total[bounds[:-1]]) * np.uint64(31) + sizes.astype(np.uint64))


def _begin(values: np.ndarray, bounds: np.ndarray, percent: int) -> pa.Array:
    """The smallest shingles of each set. See ``_strangers`` for their number."""
    sizes = np.diff(bounds)
    many = np.minimum(sizes - (sizes * percent + 99) // 100 + sizes // SPARE + 1, sizes)
    ends = np.concatenate([[0], np.cumsum(many)])
    return lists(values[np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], many)], ends)


def _sign(least: Limits):
    bands = least.bands

    def sign(batches):
        for part in chunks(batches):
            values, bounds = shingle_sets(part.column("text"))
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            at = np.append(bounds[:-1][full], len(values))
            node = pa.array(_nodes(values, bounds).view(np.int64), mask=sizes == 0)
            keys, sketch = np.zeros((0, bands), np.uint64), np.zeros((0, SKETCH_BITS // 64), np.uint64)
            if len(full):
                samples = _samples(values, at)
                keys, sketch = _band_keys(samples, bands), _odd_sketch(samples)
            steps = np.concatenate([[0], np.cumsum(sizes > 0)])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(sizes.astype(np.int64)),
                    node,
                    lists(sketch.ravel(), steps * sketch.shape[1]),
                    lists(keys.ravel(), steps * bands),
                    _begin(values, bounds, least.percent),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "sketch", "bands", "begin"],
            )

    return sign


def _sets(batches):
    for part in chunks(batches):
        values, bounds = shingle_sets(part.column("text"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(_nodes(values, bounds).view(np.int64)), lists(values, bounds)], ["node", "shingles"]
        )


def _may_link(a: str, b: str, least: Limits) -> Column:
    """Size test and sketch test for two nodes."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = (n * 100 >= m * least.percent) & (m * 100 >= n * least.percent)
    bits = [
        F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH_BITS // 64)
    ]
    return sizes & (sum(bits[1:], bits[0]) <= least.sketch)


def _alike(met: DataFrame, light: DataFrame, least: Limits) -> DataFrame:
    """The pairs (a, b) of a hub and a node met (hub, node) that pass the size and the sketch test."""
    # Dealt by node, which has few hubs: neither the distinct pairs nor the join with the node shuffle them again.
    pairs = met.select("hub", F.col("node").alias("member")).repartition("member").distinct()
    both = pairs.join(light.alias("y"), F.col("member") == F.col("y.node")).join(light.alias("x"), F.col("hub") == F.col("x.node"))
    both = both.where(_may_link("x", "y", least))
    return both.select(F.least("hub", "member").alias("a"), F.greatest("hub", "member").alias("b"))


def _among(df: DataFrame, h: Column, hashes: DataFrame) -> DataFrame:
    """The rows of ``df`` whose hash may be among the column ``h`` of ``hashes``; others need not be shuffled."""
    return with_mark(df, h, marks(hashes, store=False), "_among").where("_among").drop("_among")


def _full_sets(docs: DataFrame, signed: DataFrame, named: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes ``named``, read out of the texts once."""
    # One text stands for each node, that of the smallest id if there is one.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    speaker = signed.join(named, "node").groupBy("node").agg(first)
    speaker = stored(speaker.select(F.xxhash64("first.doc_id", "first.text_hash").alias("h")), "speakers")
    # Only the texts of speakers, and a few more, are shuffled. Rows that come twice go as texts, not as longer sets.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.withColumn("h", F.xxhash64("doc_id", "text_hash"))
    texts = marked(texts, F.col("h"), marks(speaker, store=False)).join(speaker, "h", "left_semi")
    texts = texts.dropDuplicates(["h", "doc_id", "text_hash"])
    return stored(texts.select("text").mapInArrow(_sets, "node long, shingles array<long>"), "sets")


def _confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    sets = _among(sets, F.col("node"), pairs.select(F.explode(F.array("a", "b")).alias("h")))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b").withColumn("same", F.size(F.array_intersect("left", "right")))
    union = F.size("left") + F.size("right") - F.col("same")
    return stored(both.where(F.col("same") * 100 >= union * percent).select("a", "b"), "confirmed")


def _open(met: DataFrame, label: DataFrame) -> DataFrame:
    """(bucket, node, label) of the buckets that hold several components."""
    named = label.select("node", "label")
    placed = met.join(named, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return stored(placed.join(mixed.select("bucket"), "bucket", "left_semi"), "open")


def _strangers(signed: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the nodes that may have a link with a node of another label, among them all that have one.

    A set of ``n`` shingles is linked with sets that have ``l = ceil(n * percent / 100)`` of them at least. So of its
    ``n - l + k`` smallest shingles ``k`` are in common with a partner and, if ``k`` is not more than the partner's,
    among the partner's smallest ones too. ``k`` is ``n // SPARE + 1``; the smallest partner has ``l // SPARE + 1``, so
    a node is taken if so many of its smallest shingles are among the smallest ones of another label. A bitmap leaves
    few nodes to count them for, on very large tables more.
    """
    placed = signed.where("n_shingles > 0").join(label.select("node", "label"), "node", "left")
    placed = placed.select("node", F.coalesce("label", "node").alias("label"), "n_shingles", F.size("begin").alias("many"), "begin")
    spots = placed.select("node", "label", "n_shingles", "many", F.explode("begin").alias("shingle"))
    labels = spots.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    shared = stored(labels.where("low < high").select(F.col("shingle").alias("h")), "shared")
    pages = marks(shared)
    # Copies have one node and equal beginnings: their mean is the count of one of them.
    seen = with_mark(spots, F.col("shingle"), pages, "seen").groupBy("node", "label", "n_shingles", "many")
    seen = seen.agg(F.sum(F.col("seen").cast("long")).alias("seen"), F.count("*").alias("rows"))
    needed = f"((n_shingles * {percent}L + 99) div 100) div {SPARE} + 1"
    maybe = seen.where(f"seen * many >= ({needed}) * rows")
    maybe = stored(maybe.select("node", "label", "n_shingles", F.expr("rows div many").alias("copies")), "maybe")

    begins = _among(signed.select("node", "begin"), F.col("node"), maybe.select(F.col("node").alias("h")))
    spots = begins.join(maybe.select("node"), "node", "left_semi").select("node", F.explode("begin").alias("h"))
    spots = with_mark(spots, F.col("h"), pages, "seen").where("seen").select("node", "h")
    sure = spots.join(shared, "h", "left_semi").groupBy("node").agg(F.count("*").alias("rows"))
    return stored(maybe.join(sure, "node").where(f"rows >= ({needed}) * copies").select("node", "label"), "strangers")


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / math.log(STEP))


def _kin(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The nodes of ``members`` (node, label) that have no more shingles of their own alone than a link leaves them."""
    # A few sets of other nodes may be among them: then less is alone, and more nodes stay. Sets are not shuffled for a join.
    held = _among(sets, F.col("node"), members.select(F.col("node").alias("h")))
    holders = held.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    holders = holders.agg(F.count("*").alias("held"), F.min("node").alias("node"))
    alone = holders.where("held = 1").groupBy("node").agg(F.count("*").alias("alone"))
    sizes = held.select("node", F.size("shingles").alias("n"))
    kin = members.join(sizes, "node").join(alone, "node", "left")
    return stored(kin.where(f"coalesce(alone, 0L) <= n - (n * {percent}L + 99) div 100").select("node", "label"), "kin")


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different labels, among them every one that is similar enough.

    The shingles of a set are put in one order for all sets: first those that only one label has, then the rarest. Sets
    that have ``c`` shingles in common have the first of these at places with ``c - 1`` or more shingles of each set
    behind them, so only the beginnings of sets are joined. The larger set of a pair looks for the smaller one in the classes
    of size that its place allows. Where a shingle and class has many rows of one label these are not joined with each other.
    Sets with too many shingles that no other set has are left out first (``_kin``); most are.
    """
    held = _kin(members, sets, percent).join(sets, "node").select("node", "label", F.size("shingles").alias("n"), "shingles")
    spread = held.select("node", "label", "n", F.explode("shingles").alias("shingle"))
    labels = spread.groupBy("shingle").agg(F.count("*").alias("held"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = labels.where("low < high").select("shingle", "held")
    order = spread.join(mixed, "shingle").groupBy("node", "label", "n")
    order = order.agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("order"))
    least = F.expr(f"(n * {percent}L + 99) div 100")  # size of the smallest set that a set of this size is linked with
    order = order.withColumn("own", F.col("n") - F.size("order")).withColumn("least", least)
    begin = F.greatest(F.col("n") - F.col("least") + 1 - F.col("own"), F.lit(0)).cast("int")
    spots = order.select("node", "label", "n", "own", "least", F.posexplode(F.slice("order", F.lit(1), begin)).alias("at", "next"))
    spots = stored(spots.select("node", "label", "n", "least", F.expr("own + at").alias("at"), "next.shingle"), "beginnings")

    # The smaller set of a pair: needs so many in common with one of its own size, and more with a larger one.
    low = spots.where(f"at + (2L * n * {percent} + {99 + percent}) div {100 + percent} <= n")
    low = low.select("node", "label", "n", "at", "shingle", _size_class(F.col("n")).alias("class"))
    counts = low.groupBy("shingle", "class", "label").agg(F.count("*").alias("rows"))
    tops = counts.groupBy("shingle", "class").agg(F.max(F.struct("rows", "label")).alias("top"), F.count("*").alias("labels"))
    tops = stored(tops.select("shingle", "class", F.col("top.label").alias("top"), (F.col("labels") > 1).alias("several")), "tops")
    low = low.join(tops.where("several").select("shingle", "class", "top"), ["shingle", "class"], "left")
    low = low.withColumn("in_top", F.coalesce(F.col("label") == F.col("top"), F.lit(True))).drop("top").alias("y")

    most = F.expr(f"least(n, ({100 + percent}L * (n - at)) div {percent} - n)")
    high = spots.withColumn("most", most).where("least <= most")
    classes = F.sequence(_size_class(F.col("least")), _size_class(F.col("most")))
    high = high.select("node", "label", "n", "at", "shingle", F.explode(classes).alias("class")).join(tops, ["shingle", "class"])
    other = F.col("label") != F.col("top")
    wanted = F.filter(F.array(F.when(other, True), F.when(F.col("several"), False)), lambda x: x.isNotNull())
    high = high.select("node", "label", "n", "at", "shingle", "class", F.explode(wanted).alias("in_top")).alias("x")

    need = f"((x.n + y.n) * {percent}L + {99 + percent}) div {100 + percent}"
    fits = f"y.n <= x.n AND y.n * 100L >= x.n * {percent}L AND x.at + {need} <= x.n AND y.at + {need} <= y.n"
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("shingle", "class", "in_top")]
    met = high.join(low, [*same, F.col("x.label") != F.col("y.label"), F.expr(fits)])
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, text_hash, kept.

    Documents whose five-word shingles have a Jaccard similarity of ``percent`` or more are linked (70 at least).
    Only ``doc_id`` and ``text`` are read; other columns are ignored whatever their names. Null, empty and
    word-less texts have no shingles and stay alone, with their own id. ``component_id`` is the smallest id of the
    component. Rows that repeat an id each get a row; equal rows get equal results. Rows without id are compared like
    all others; a component of such rows only has no ``component_id``, and all of them are kept. Very long texts
    are cut nowhere; a task holds one text at a time.
    """
    least = limits(percent)
    signed = stored(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
            _sign(least),
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, {NODE}, sketch array<long>, bands array<long>, begin array<long>",
        ),
        "signed",
    )
    # Most buckets have one row, or exact copies alone.
    filled = signed.where("n_shingles > 0")
    spots = filled.select("node", F.explode("bands").alias("bucket"))
    crowds = spots.groupBy("bucket").agg(F.count("*").alias("members"), F.min("node").alias("low"), F.max("node").alias("high"))
    crowds = stored(crowds.where("low < high").select("bucket", "members"), "crowds")
    spots = _among(spots, F.col("bucket"), crowds.select(F.col("bucket").alias("h"))).distinct()
    met = stored(spots.join(crowds, "bucket"), "met")
    light = filled.select("node", F.col("n_shingles").alias("n"), "sketch")
    light = _among(light, F.col("node"), met.select(F.col("node").alias("h"))).groupBy("node")
    light = stored(light.agg(F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")), "light")
    # An original shares more buckets with its copies than they do with each other.
    rank = met.groupBy("node").agg(F.sum("members").alias("rank"))
    hubs = met.join(rank, "node").groupBy("bucket").agg(F.max(F.struct("rank", "node")).alias("top"))
    hubs = stored(hubs, "hubs")

    starts = met.join(hubs.select("bucket", F.col("top.node").alias("hub")), "bucket").where("node <> hub")
    tested = stored(_alike(starts, light, least), "tested")
    sets = _full_sets(docs, signed, met.select("node").distinct())
    links = _confirm(sets, tested, percent)
    label = components(links)

    # What the comparison with one node has not joined is compared with further nodes, ``TURNS`` per bucket and round.
    tried = hubs.select("bucket", F.col("top.node").alias("hub"))
    compared = tested.select("a", "b")
    open_ = _open(met, label)
    quiet, turn = 0, 0
    while quiet < QUIET:
        turn += 1
        named = label.select("node", "label")
        served = tried.join(named.withColumnRenamed("node", "hub"), "hub", "left")
        served = served.select("bucket", F.coalesce("label", "hub").alias("label"))
        draw = F.xxhash64(F.lit(turn), "bucket", "node")  # other nodes in other buckets, so that many get their turn
        drawn = F.struct(draw.alias("draw"), "node", "label")
        fresh = open_.join(served, ["bucket", "label"], "left_anti").groupBy("bucket")
        fresh = fresh.agg(F.min(drawn).alias("low"), F.max(drawn).alias("high"))
        tops = F.when(F.col("low.label") == F.col("high.label"), F.array("low")).otherwise(F.array("low", "high"))
        fresh = stored(fresh.select("bucket", F.explode(tops).alias("top")), "hubs")
        if fresh.isEmpty():
            break
        hub = fresh.select("bucket", F.col("top.node").alias("hub"), F.col("top.label").alias("own"))
        met_hub = open_.join(hub, "bucket").where("label <> own")
        late = stored(_alike(met_hub, light, least).distinct().join(compared, ["a", "b"], "left_anti"), "late")
        tried, compared = tried.union(hub.select("bucket", "hub")), compared.union(late)
        found = None if late.isEmpty() else _confirm(sets, late, percent)
        if found is None or found.isEmpty():
            quiet += TURNS
            continue
        quiet, links = 0, links.union(found)
        label = components(links)
        open_ = _open(met, label)

    # The exact way for what the rounds have not compared.
    strangers = _strangers(signed, label, percent)
    unread = stored(strangers.select("node").join(sets, "node", "left_anti"), "unread")
    if not unread.isEmpty():
        sets = sets.union(_full_sets(docs, signed, unread))
    if not strangers.isEmpty():
        rest = _rest(strangers, sets, percent).join(compared, ["a", "b"], "left_anti")
        found = _confirm(sets, stored(rest, "rest"), percent)
        if not found.isEmpty():
            label = components(links.union(found))

    label = label.select("node", "label")
    grouped = signed.select("doc_id", "text_hash", "n_shingles", "node").join(label, "node", "left")
    grouped = grouped.withColumn("label", F.coalesce("label", "node"))
    first = grouped.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("first"))
    out = grouped.join(first, "label", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("component_id"),
        "text_hash",
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
