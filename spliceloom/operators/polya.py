"""Poly(A) sites: peak clusters, gap clusters, groups, reference comparison and motif profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spliceloom.functions.sequence import SIGNALS, kmers
from spliceloom.operators.overlap import overlap_join, within_distance
from spliceloom.operators.sweeps import merged, with_point_island
from spliceloom.operators.transcripts import majority
from spliceloom.session import durable

# Hexamers drawn on their own; the other signals are summed.
MAIN_SIGNALS = SIGNALS[:6]
TILE = 1 << 14  # positions of a gene that a task looks at together


def end_sites(reads: DataFrame) -> DataFrame:
    """Read ends per gene on its majority chromosome: gene, chrom, strand, pos, n."""
    main = majority(reads, ["gene"], "chrom").select("gene", "chrom")
    pos = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    counts = reads.groupBy("gene", "chrom", "strand", pos.alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(main, ["gene", "chrom"], "left_semi")


PLACE = ["gene", "chrom", "strand"]
UNKNOWN, SEED, ATTACHED, BRIDGED = 0, 1, 2, 3


def _by_tile(df: DataFrame, reach: int, work, columns: str) -> DataFrame:
    """Run ``work`` on each tile of a gene's axis, with the rows up to ``reach`` beyond its borders; it returns arrays of its own positions, ``columns`` long or double.

    ``work(pos, others, lo, hi, first, last)`` gets ascending positions, the further columns, the gene's range and the tile's range.
    """
    others = [c for c in df.columns if c not in (*PLACE, "pos", "lo", "hi")]
    tile = lambda d: F.floor((F.col("pos") + d) / TILE).cast("long")
    rows = df.withColumn("_t", F.explode(F.array_distinct(F.array(tile(0), tile(-reach), tile(reach)))))
    key = [*PLACE, "_t"]
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        """Rows arrive sorted by tile; the last tile of a batch waits for the rest of its rows."""
        held = None

        def tiles(pdf: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
            got, of = [], []
            col = {c: pdf[c].to_numpy() for c in ("pos", "lo", "hi", "_t", *others)}
            for a, b in zip(cuts[:-1], cuts[1:]):
                first = int(col["_t"][a]) * TILE
                out = work(col["pos"][a:b], [col[c][a:b] for c in others], int(col["lo"][a]), int(col["hi"][a]), first, first + TILE - 1)
                got.append(out)
                of.append(np.full(len(out[0]), a))
            at = np.concatenate(of) if of else np.zeros(0, int)
            base = pdf.iloc[at][[*PLACE, "lo", "hi"]].reset_index(drop=True)
            return base.assign(**{n: np.concatenate([g[i] for g in got]) if got else [] for i, n in enumerate(names)})

        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(pdf):
                continue
            starts = np.flatnonzero((pdf[key] != pdf[key].shift()).any(axis=1).to_numpy())
            held = pdf.iloc[starts[-1]:]
            if len(starts) > 1:
                yield tiles(pdf, starts)
        if held is not None and len(held):
            yield tiles(held, np.array([0, len(held)]))

    gene_type = df.schema["gene"].dataType.simpleString()
    ordered = rows.select(*key, "pos", "lo", "hi", *others).repartition(*key).sortWithinPartitions(*key, "pos")
    return ordered.mapInPandas(run, f"gene {gene_type}, chrom string, strand string, lo long, hi long, {columns}")


def _heights(sites: DataFrame, window: int, support: int) -> DataFrame:
    """(place, lo, hi, pos, height) of all positions that may be a peak: smoothed depth of counted read ends, windows cut at the gene's range."""
    def work(pos, others, lo, hi, first, last):
        base, end = max(int(pos[0]) - window, lo), min(int(pos[-1]) + window, hi)
        depth = np.zeros(end - base + 1, np.int64)
        depth[pos - base] = others[0]
        total, at = np.concatenate([[0], np.cumsum(depth)]), np.arange(len(depth))
        around = total[np.minimum(at + window + 1, len(depth))] - total[np.maximum(at - window, 0)]
        width = np.minimum(at + base + window, hi) - np.maximum(at + base - window, lo) + 1
        height = np.where(around >= support, depth * 2 + around / width, 0.0)
        peak = np.flatnonzero((height > 0) & (at + base >= first) & (at + base <= last))
        return peak + base, height[peak]

    return _by_tile(sites, 2 * window + 1, work, "pos long, height double")


def _decide(peaks: DataFrame, distance: int, window: int) -> DataFrame:
    """One round: every peak whose higher neighbours are decided, or one of which reaches it for certain, gets its state.

    Peaks count from the highest down, the leftmost first. One that no earlier member of a cluster reaches is a SEED and covers ``window`` positions to
    either side; others are members of a cluster that reaches them: ATTACHED, or BRIDGED if only a cluster that begins distance + 1 further on does. Peaks beyond the
    tile that are not decided block those that they might reach.
    """
    def work(pos, others, lo, hi, first, last):
        height, state = others[0], others[1].copy()
        base = int(pos[0]) - distance - window - 2
        size = int(pos[-1]) + distance + window + 3 - base
        cover, strict, blocked = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
        for i in np.lexsort((pos, -height)).tolist():
            p = int(pos[i])
            if state[i] == UNKNOWN:
                if strict[p - base]:
                    state[i] = ATTACHED
                elif not blocked[p - base] and first <= p <= last:
                    state[i] = BRIDGED if cover[p - base] else SEED
            s, e = (p, p) if state[i] >= ATTACHED else (max(p - window, lo), min(p + window + 1, hi + 1))
            s, e = s - distance - 1 - base, e + distance + 1 - base
            if state[i] == UNKNOWN:
                blocked[s:e] = True
            else:
                cover[s:e] = True
                strict[s + 1:e] = True
        own = (pos >= first) & (pos <= last)
        return pos[own], height[own], state[own]

    return _by_tile(peaks, distance + window + 2, work, "pos long, height double, state long")


def peak_clusters(sites: DataFrame, distance: int = 20, window: int = 3, support: int = 5, min_rpkm: float = 0.0,
                  all_reads: int = 1_000_000) -> DataFrame:
    """Clusters of read ends by greedy smoothed peaks: start, end, n, peak (positions) per gene.

    sites: gene, chrom, strand, pos, n. The rule takes peaks by height, then position; a peak within `distance` of a cluster joins it, any other begins a
    cluster; clusters within `distance` of each other are one in the end. What a peak becomes depends only on higher ones in its reach, so
    all that are higher than their undecided neighbours are decided at once, in rounds, on tiles of TILE positions: a dense gene spreads over
    its tiles, and no scan, window or task holds more than a tile.
    """
    sites = durable(sites)  # counted positions, read by the scans below
    span = sites.groupBy(*PLACE).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    peaks = durable(_heights(sites.join(span, PLACE).select(*PLACE, "pos", "n", "lo", "hi"), window, support).withColumn("state", F.lit(UNKNOWN).cast("long")))
    while not peaks.filter(F.col("state") == UNKNOWN).isEmpty():
        peaks = durable(_decide(peaks, distance, window))
    seed, p = F.col("state") == SEED, F.col("pos")
    start = F.when(seed, F.greatest(p - window, F.col("lo"))).otherwise(p)
    end = F.when(seed, F.least(p + window + 1, F.col("hi") + 1)).when(F.col("state") == BRIDGED, p + distance + 1).otherwise(p)
    clusters = merged(peaks.select(*PLACE, start.alias("c_start"), end.alias("c_end")), PLACE, "c_start", "c_end", distance, True)
    spots = sites.select(*PLACE, "pos", "n", F.lit(0.0).alias("height")).unionByName(peaks.select(*PLACE, "pos", F.lit(0).cast("long").alias("n"), "height"))
    inside = overlap_join(spots.withColumn("pos_end", p + 1), clusters, PLACE, "pos", "pos_end", "c_start", "c_end")
    used = F.when(F.col("n") > 0, p)
    out = inside.groupBy(*PLACE, "c_start", "c_end").agg(F.min(used).alias("start"), F.max(used).alias("end"), F.sum("n").alias("n"), F.max_by("pos", F.struct("height", -p)).alias("peak"))
    out = out.filter("start IS NOT NULL").select(*PLACE, "start", "end", "n", "peak")
    if not min_rpkm:
        return out
    rpkm = F.col("n") * 1_000_000 / (F.lit(float(all_reads)) * (F.col("hi") - F.col("lo") + 1))
    return out.join(span, PLACE).filter(rpkm >= min_rpkm).drop("lo", "hi")


def cluster_reads(reads: DataFrame, clusters: DataFrame) -> DataFrame:
    """Long table of the reads in each cluster (the member list of a cluster)."""
    pos = F.when(F.col("strand") == "+", F.col("end")).otherwise(F.col("start"))
    ends = reads.select("gene", "chrom", "strand", pos.alias("pos"), "iso")
    spots = ends.select("gene", "chrom", "strand", "pos", (F.col("pos") + 1).alias("pos_end")).distinct()
    c = clusters.select("gene", "chrom", "strand", "peak", F.col("start").alias("c_start"), (F.col("end") + 1).alias("c_end"))
    hit = overlap_join(spots, c, ["gene", "chrom", "strand"], "pos", "pos_end", "c_start", "c_end")
    return ends.join(hit.select("gene", "chrom", "strand", "pos", "peak"), ["gene", "chrom", "strand", "pos"])


def gap_clusters(sites: DataFrame, gap: int = 24) -> DataFrame:
    """Clusters of read ends by gap alone; the peak is the most used position (smallest on ties)."""
    rows = with_point_island(sites, ["gene", "chrom", "strand"], "pos", gap, "cluster")
    return rows.groupBy("gene", "chrom", "strand", "cluster").agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.sum("n").alias("n"),
        F.min(F.struct((-F.col("n")).alias("neg"), F.col("pos").alias("pos"))).alias("_p")).withColumn("peak", F.col("_p.pos")).drop("_p", "cluster")


def pa_sites(reads: DataFrame) -> DataFrame:
    """Per gene and 3' end: innermost edge of the outer exon, reads and share of the gene's reads."""
    plus, x = F.col("strand") == "+", F.col("exons")
    key = ["chrom", "strand", "gene"]
    site = reads.select(*key, F.when(plus, F.col("end")).otherwise(F.col("start")).alias("pa"),
                        F.when(plus, F.element_at(x, -1)["s"]).otherwise(x[0]["e"]).alias("edge"))
    per = site.groupBy(*key, "pa").agg(F.max("edge").alias("_hi"), F.min("edge").alias("_lo"), F.count(F.lit(1)).alias("n")).withColumn(
        "edge", F.when(plus, F.col("_hi")).otherwise(F.col("_lo"))).drop("_hi", "_lo")
    total = per.groupBy(*key).agg(F.sum("n").alias("_all"))
    return per.join(total, key).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def pa_groups(sites: DataFrame) -> DataFrame:
    """One row per gene with lists in position order (distinct positions of a gene, so bounded by its length)."""
    rows = F.array_sort(F.collect_list(F.struct("pa", "edge", "n", "share")))
    col = lambda f: F.array_join(F.transform("_r", lambda r: r[f].cast("string")), ",")
    return sites.groupBy("chrom", "strand", "gene").agg(rows.alias("_r")).select(
        "chrom", "strand", "gene", col("pa").alias("pas"), col("edge").alias("edges"), col("n").alias("counts"), col("share").alias("shares"))


def compare_sites(sites: DataFrame, reference: DataFrame, reach: int = 30) -> DataFrame:
    """Sites Known within `reach` of a reference site of the gene, else Novel; genes named like chromosomes are left out.

    `gene_novel` tells whether any site of the row's gene is novel.
    """
    key = ["chrom", "strand", "gene"]
    use = sites.filter(~F.col("gene").cast("string").startswith("chr"))
    near = within_distance(use.select(*key, "pa").distinct(), reference.select(*key, F.col("pa").alias("ref_pa")).distinct(), key,
                           "pa", "ref_pa", reach, reach).select(*key, "pa").distinct().withColumn("_k", F.lit(True))
    out = use.join(near, [*key, "pa"], "left").withColumn("annotation", F.when(F.col("_k"), "Known").otherwise("Novel"))
    flag = out.groupBy(*key).agg(F.max(F.col("_k").isNull()).alias("gene_novel"))
    return out.drop("_k").join(flag, key)


def confident(positions: DataFrame, sites: DataFrame, before: int, after: int) -> DataFrame:
    """Positions (chrom, pos) lying in [site - before, site + after] of a confident site (chrom, site)."""
    hit = within_distance(positions.select("chrom", "pos").distinct(), sites.select("chrom", "site").distinct(), ["chrom"],
                          "pos", "site", before, after)
    return positions.join(hit.select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi")


def word_counts(windows: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """(side, offset, name, n): how many windows of a side have a named word at an offset; all other words of that length count under a null name.

    names: words of A, C, G and T, all of one length, in upper case. Every batch is counted by itself, so the shuffle carries counts and no letters.
    """
    k, labels = len(next(iter(names))), sorted(set(names.values()))
    kind = np.full(5**k, len(labels))
    for word, name in names.items():
        kind[int("".join(str("ACGT".index(c)) for c in word), 5)] = labels.index(name)
    code = np.full(128, 4)
    code[list(b"ACGT")] = range(4)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for side, texts in b.groupby("side", dropna=False)["_t"]:
                size = np.fromiter(map(len, texts), np.int64, len(texts))
                x = code[np.minimum(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), 127)]
                offset = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
                at = np.flatnonzero(offset <= np.repeat(size, size) - k)
                word = sum(x[at + j] * 5 ** (k - 1 - j) for j in range(k))
                n = np.bincount(offset[at] * (len(labels) + 1) + kind[word])
                cell = np.flatnonzero(n)
                column = lambda values: pd.Series(values, cell, dtype=object)
                yield pd.DataFrame({"side": column(None if pd.isna(side) else side), "offset": cell // (len(labels) + 1),
                                    "name": column([[*labels, None][c] for c in cell % (len(labels) + 1)]), "n": n[cell]})

    rows = windows.select("side", F.upper(F.col(text)).alias("_t")).filter("_t IS NOT NULL")
    schema = T.StructType([rows.schema["side"], T.StructField("offset", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
    return rows.mapInPandas(count, schema).groupBy("side", "offset", "name").agg(F.sum("n").alias("n"))


def with_share(cell: DataFrame, name: str) -> DataFrame:
    total = cell.groupBy("side", "offset").agg(F.sum("n").alias("_all"))
    return cell.withColumnRenamed("name", name).filter(F.col(name).isNotNull()).join(total, ["side", "offset"]).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def letter_profile(windows: DataFrame, text: str = "seq") -> DataFrame:
    """Share of each base by side and offset of equally long windows."""
    return with_share(word_counts(windows, text, {b: b for b in "ACGT"}), "base")


def signal_profile(windows: DataFrame, text: str = "seq") -> DataFrame:
    """Share of windows with each signal hexamer at an offset; signals outside the main six are summed as Other."""
    return with_share(word_counts(windows, text, {s: s if s in MAIN_SIGNALS else "Other" for s in [*SIGNALS, *MAIN_SIGNALS]}), "signal")


def label_sites(lists: DataFrame) -> DataFrame:
    """Report rows of site lists (gene, pas text): one row per site with the number of sites and the label of the gene."""
    p = F.split("pas", ",")
    label: Column = F.when(F.size(p) > 1, "APA").otherwise("single")
    return lists.select("chrom", "strand", "gene", F.size(p).alias("n_sites"), label.alias("label"), F.explode(F.transform(p, lambda x: x.cast("long"))).alias("pa"))
