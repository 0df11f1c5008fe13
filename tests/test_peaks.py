"""Peak clusters in rounds on tiles against the serial rule."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spliceloom.operators import polya as PA


def serial(pos, n, lo, hi, distance, window, support):
    """Clusters (first, last, count, peak) of one stretch of positions inside the gene range [lo, hi]."""
    base = max(int(pos.min()) - window, lo)
    depth = np.zeros(min(int(pos.max()) + window, hi) - base + 1, dtype=np.int64)
    np.add.at(depth, pos - base, n)
    size = len(depth)
    total = np.concatenate([[0], np.cumsum(depth)])
    at = np.arange(size)
    # windows are cut at the gene range only; outside this stretch the depth is 0
    left, right = np.maximum(at - window, 0), np.minimum(at + window + 1, size)
    width = np.minimum(at + base + window + 1, hi + 1) - np.maximum(at + base - window, lo)
    around = total[right] - total[left]
    height = np.where(around >= support, depth * 2 + around / width, 0.0)
    found: list[list[int]] = []
    for p in sorted(np.flatnonzero(height > 0), key=lambda i: (-height[i], i)):
        near = [c for c in found if p - distance <= c[1] and c[0] <= p + distance + 1]
        if near:
            c = min(near, key=lambda c: (min(abs(p - c[0]), abs(p - c[1])), c[0]))
            c[0], c[1] = min(c[0], p), max(c[1], p)
        else:
            found.append([max(p - window, lo - base), min(p + window + 1, hi - base + 1)])
    merged: list[list[int]] = []
    for c in sorted(found):
        if merged and c[0] - distance <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], c[1])
        else:
            merged.append(list(c))
    out = []
    for s, e in merged:
        s, e = max(s, 0), min(e, size)
        used = np.flatnonzero(depth[s:e])
        if len(used):
            peak = s + int(np.argmax(height[s:e]))
            out.append((base + s + int(used[0]), base + s + int(used[-1]), int(depth[s:e].sum()), base + peak))
    return out


def random_gene(rng, kind):
    if kind == "dense":
        return [rng.randint(0, 900) for _ in range(1500)]
    if kind == "spots":
        return [rng.choice([500, 900, 2000, 2040, 2062, 5000]) + int(rng.gauss(0, 6)) for _ in range(400)]
    if kind == "edge":  # many gaps of just the distance, and one more
        at = [0]
        for _ in range(120):
            at.append(at[-1] + rng.choice([1, 2, 5, 6, 7, 8, 9, 12, 30]))
        return [p for p in at for _ in range(rng.choice([1, 2, 3, 6]))]
    return [rng.randint(0, 40) for _ in range(rng.randint(1, 12))]


@pytest.mark.parametrize("tile", [1 << 14, 64, 41])
def test_equals_the_serial_rule(spark, monkeypatch, tile):
    monkeypatch.setattr(PA, "TILE", tile)  # small tiles: one gene spreads over many, decisions cross their borders
    rng = random.Random(tile)
    genes = {f"g{i}": random_gene(rng, ["dense", "spots", "edge", "few"][i % 4]) for i in range(24)}
    rows = [(g, "c", "+" if hash(g) % 2 else "-", p) for g, ps in genes.items() for p in ps]
    sites = spark.createDataFrame(rows, "gene string, chrom string, strand string, pos long").groupBy("gene", "chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("n"))
    for distance, window, support in ((20, 3, 5), (6, 1, 2), (7, 5, 1)):
        if tile <= distance + window + 2:
            continue
        got = sorted((r["gene"], r["start"], r["end"], r["n"], r["peak"]) for r in PA.peak_clusters(sites, distance, window, support).collect())
        want = []
        for g, ps in genes.items():
            at, n = np.unique(np.array(ps), return_counts=True)
            want += [(g, *c) for c in serial(at, n, int(at.min()), int(at.max()), distance, window, support)]
        assert got == sorted(want)


def test_one_dense_gene_spreads_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(PA, "TILE", 128)
    rng = random.Random(3)
    ps = [rng.randint(0, 6000) for _ in range(9000)]
    sites = spark.createDataFrame([("g", "c", "+", p) for p in ps], "gene string, chrom string, strand string, pos long").groupBy("gene", "chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("n"))
    seen = []

    def work(pos, others, lo, hi, first, last):
        own = (pos >= first) & (pos <= last)
        return pos[own], np.full(own.sum(), len(pos))

    span = sites.agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    df = PA._by_tile(sites.withColumns({"lo": F.lit(span["lo"]), "hi": F.lit(span["hi"])}), 25, work, "pos long, size long")
    seen = df.collect()
    assert len(seen) == len(set(ps)) and max(r["size"] for r in seen) <= 128 + 2 * 25
    at, n = np.unique(np.array(ps), return_counts=True)
    got = sorted((r["start"], r["end"], r["n"], r["peak"]) for r in PA.peak_clusters(sites, 20, 3, 5).collect())
    assert got == sorted(serial(at, n, int(at.min()), int(at.max()), 20, 3, 5))
