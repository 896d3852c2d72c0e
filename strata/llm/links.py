"""From banded sketches to exact links and components, without pairs within a large group.

A bucket (band value) may hold any number of documents. Its smallest member is its pivot:
1. every document is verified against the smallest of its pivots (a pair per document at most),
2. then against its other pivots, where the two are not yet in one component,
3. then, in buckets that still span several components, members of different components:
   directly in buckets of at most DIRECT members, otherwise by `difference_pairs`.
Every pair that shares a bucket ends verified, inside one component, or shown to be no link.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .graph import joined


DIRECT = 4      # members up to which a bucket's open pairs are few enough to list
LEVEL = 1.15    # ratio of neighbouring size classes in `difference_pairs`


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def _verify(shingles: Callable[[bytes], np.ndarray], percent: int):
    """Keeps the pairs whose full shingle sets reach `percent` of their union."""
    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            keep = []
            for i, (ta, tb) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())):
                if last[0] != ta:
                    last = (ta, shingles(ta))
                sa, sb = last[1], shingles(tb)
                small, large = sorted((len(sa), len(sb)))
                if 100 * small < percent * large:
                    continue
                n = overlap(sa, sb)
                if small and 100 * n >= percent * (len(sa) + len(sb) - n):
                    keep.append(i)
            pick = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pick), batch.column("b").take(pick)],
                                             names=["a", "b"])
    return run


def _differences(shingles: Callable[[bytes], np.ndarray]):
    """(a, x, n, e): for each pair of texts the size n of x's set and every element e that only
    one of the two sets has; the first row of a pair has no element."""
    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            parts = []
            for ta, tx in zip(batch.column("ta").to_pylist(), batch.column("tx").to_pylist()):
                if last[0] != ta:
                    last = (ta, shingles(ta))
                sx = shingles(tx)
                parts.append((len(sx), np.setxor1d(last[1], sx, assume_unique=True)))
            size = [len(e) + 1 for _, e in parts]
            row = pa.array(np.repeat(np.arange(len(parts)), size))
            first = np.zeros(sum(size), bool)
            first[np.cumsum(size) - size] = True
            e = np.concatenate([np.concatenate([[np.uint64(0)], e]) for _, e in parts]) if parts else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(row), batch.column("x").take(row),
                 pa.array(np.repeat(np.array([n for n, _ in parts], dtype=np.int64), size)),
                 pa.array(e.view(np.int64), mask=first)], names=["a", "x", "n", "e"])
    return run


def difference_pairs(group: DataFrame, texts: DataFrame, shingles: Callable[[bytes], np.ndarray],
                     percent: int) -> DataFrame:
    """Pairs (a, b) of members of one group but different components that may be links.

    group: (a, x, c): group (a vertex to compare with), member, its component. Let D(x) be the elements in which x
    differs from the group's centre (what more than half of the members hold). Then x and y
    differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| elements, and they are a link if and only if that
    is at most r (|x| + |y|) with r = (1 - J) / (1 + J). So either |D(x)| + |D(y)| is small enough,
    and then both link with the member of smallest |D(x)| - r |x|, one pair each; or D(x) and
    D(y) share t or more elements, t following from their sizes, and therefore one of the
    |D(x)| - t + 1 rarest of the one and of the other. Copies with edits of their own share no
    rare element: their group costs rows in proportion to its edits, not to its pairs."""
    r, j = (100 - percent) / (100 + percent), percent / 100
    pairs = (group.select("a", "x").join(texts.select(F.col("v").alias("x"), F.col("text").alias("tx")), "x")
             .join(texts.select(F.col("v").alias("a"), F.col("text").alias("ta")), "a").select("a", "x", "ta", "tx"))
    made = stored(pairs.mapInArrow(_differences(shingles), "a long, x long, n long, e long"), "link-differences")
    # a vertex with several texts (repeated ids) differs by the union; n is the smallest
    member = stored(made.where("e is null").groupBy("a", "x").agg(F.min("n").alias("n"))
                    .join(group.select("a", "x", "c").distinct(), ["a", "x"]), "link-members")
    rows = made.where("e is not null").select("a", "x", "e").distinct()
    size = member.groupBy("a").agg(F.count("*").alias("m"))
    count = rows.groupBy("a", "e").agg(F.count("*").alias("k"))
    flipped = stored(count.join(size, "a").where("2 * k > m").select("a", "e"), "link-centre")
    kept = rows.join(flipped, ["a", "e"], "left_anti")
    lacking = (member.select("a", "x").join(flipped, "a").join(rows, ["a", "x", "e"], "left_anti"))
    diff = stored(kept.unionByName(lacking.select("a", "x", "e")), "link-from-centre")
    own = stored(member.join(diff.groupBy("a", "x").agg(F.count("*").alias("d")), ["a", "x"], "left")
                 .select("a", "x", "n", "c", F.coalesce("d", F.lit(0)).alias("d")), "link-weights")

    weight = F.col("d") - r * F.col("n")
    lightest = own.groupBy("a").agg(F.min(F.struct(weight.alias("w"), F.col("x").alias("y"), F.col("c").alias("cy"))).alias("l"))
    small = (own.join(lightest, "a").where((weight + F.col("l.w") <= 1e-6) & (F.col("c") != F.col("l.cy")))
             .select("x", F.col("l.y").alias("y")))

    # members by size of D, and for each member the sizes a partner can have: with d = |D(x)| and a
    # partner's of at least lo, the two share at least t = (d + lo - r (|x| + |x| / J)) / 2 elements
    level = F.floor(F.log("d") / F.log(F.lit(LEVEL)))
    sized = own.where("d > 0").withColumn("own", level)
    levels = sized.groupBy("a", "own").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).withColumnRenamed("own", "to")
    need = F.greatest(F.lit(1.0), F.ceil((F.col("d") + F.col("lo") - r * (F.col("n") + F.col("n") / j)) / 2 - 1e-6))
    targets = (sized.join(levels, "a").withColumn("t", need).where("t <= least(d, hi)")
               .select("a", "x", "c", "own", "to", (F.col("d") - F.col("t") + 1).alias("first")))
    # rarest elements first; those of one member alone make no pair and only use up places
    rare = diff.groupBy("a", "e").agg(F.count("*").alias("k")).where("k > 1")
    common = stored(diff.join(rare, ["a", "e"]), "link-shared")
    alone = own.join(common.groupBy("a", "x").agg(F.count("*").alias("s")), ["a", "x"]).select(
        "a", "x", (F.col("d") - F.col("s")).alias("alone"))
    place = Window.partitionBy("a", "x").orderBy("k", "e")
    ranked = (common.withColumn("nth", F.row_number().over(place)).join(alone, ["a", "x"])
              .withColumn("nth", F.col("nth") + F.col("alone")))
    sent = stored(ranked.join(targets, ["a", "x"]).where("nth <= first").select("a", "e", "own", "to", "x", "c"), "link-sent")
    got = sent.select("a", "e", F.col("to").alias("own"), F.col("own").alias("to"), F.col("x").alias("y"), F.col("c").alias("cy"))
    both = sent.join(got, ["a", "e", "own", "to"]).where("x < y and c <> cy").select("x", "y")
    return small.unionByName(both).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def link(bands: DataFrame, texts: DataFrame, shingles: Callable[[bytes], np.ndarray], percent: int = 80,
         direct: int = DIRECT) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), components (v, component) of every vertex that shares a band).

    bands: (v, band) rows, repeats allowed, equal bands make candidates; texts: (v, text binary), one or more per
    vertex."""
    pivots = bands.groupBy("band").agg(F.min("v").alias("a"), F.max("v").alias("z")).where("a <> z").select("band", "a")
    # of all bands only those that two vertices share are made distinct
    members = stored(bands.join(pivots, "band").select("band", "a", F.col("v").alias("b")).distinct(), "link-buckets")
    star = members.where("a <> b").select("a", "b").distinct()
    involved = stored(members.select(F.col("b").alias("v")).distinct(), "link-vertices")
    held = stored(texts.join(involved, "v"), "link-texts")

    def verified(pairs, name):
        sized = (pairs.join(held.select(F.col("v").alias("b"), F.col("text").alias("tb")), "b")
                 .join(held.select(F.col("v").alias("a"), F.col("text").alias("ta")), "a"))
        return stored(sized.select("a", "b", "ta", "tb").mapInArrow(_verify(shingles, percent), "a long, b long")
                      .distinct(), name)

    alone = involved.select("v", F.col("v").alias("component"))
    first = star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    one = verified(first, "links-1")
    labels = joined(alone, one, "link-1")

    def labelled(df, c):
        return df.join(labels.select(F.col("v").alias(c), F.col("component").alias(f"_{c}")), c)

    apart = labelled(labelled(star.join(first, ["a", "b"], "left_anti"), "a"), "b").where("_a <> _b").select("a", "b")
    two = verified(apart, "links-2")
    labels = joined(labels, two, "link-2")

    spread = labelled(members.select("band", "a", "b"), "b").withColumnRenamed("_b", "c")
    open_bands = stored(spread.groupBy("band").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("m"))
                        .where("c0 <> c1").select("band", "m"), "link-open")
    rest = stored(spread.join(open_bands, "band"), "link-rest")
    few = rest.where(F.col("m") <= direct)
    pairs = (few.select("band", F.col("b").alias("x"), F.col("c").alias("cx"))
             .join(few.select("band", F.col("b").alias("y"), F.col("c").alias("cy")), "band")
             .where("x < y and cx <> cy").select(F.col("x").alias("a"), F.col("y").alias("b")))
    # one group, and one text to compare with, for all buckets whose pivots are in one component
    many = labelled(rest.where(F.col("m") > direct), "a").select(F.col("_a").alias("a"), F.col("b").alias("x"), "c").distinct()
    pairs = pairs.unionByName(difference_pairs(many, held, shingles, percent))
    pairs = pairs.distinct().join(star, ["a", "b"], "left_anti")
    three = verified(pairs, "links-3")
    return one.unionByName(two).unionByName(three), joined(labels, three, "link-3")
